import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import rows
from tagloom.operators import rfm
from tagloom.settings import RfmSettings

DAY = "20240430"
CONSUME = ("user_id bigint, last_1y_paid_orders bigint, last_1y_paid_order_amount decimal(18,2), "
           "last_order_paid_time string, app_name string, data_date string")
USERS = "user_id bigint, country string, site_id int, last_date string, data_date string"
BASE = ("user_id bigint, country string, last_1y_paid_orders bigint, "
        "last_1y_paid_order_amount decimal(18,2), last_pay_date date")


def consume(spark, *items):
    from decimal import Decimal
    return spark.createDataFrame(
        [(u, o, None if a is None else Decimal(a), t, app, d) for u, o, a, t, app, d in items], CONSUME)


def test_base_filters_and_keeps_duplicates(spark):
    snapshot = consume(
        spark,
        (1, 2, "10.00", "20240401120000", "JC", DAY),
        (1, 2, "10.00", "20240401120000", "JC", DAY),   # repeated row stays
        (2, 2, "10.00", None, "JC", DAY),               # never paid
        (3, 2, "10.00", "20240401120000", "XX", DAY),   # other app
        (4, 2, "10.00", "20240401120000", "JC", "20240429"),
        (5, 2, "10.00", "2024-bad", "JC", DAY),         # unreadable date
        (None, 1, "1.00", "20240401", "JC", DAY))
    users = spark.createDataFrame([
        (1, "ID", 600, "2024-01-01", DAY), (1, "MY", 900, "2024-02-01", DAY),
        (1, "SG", 100, "2024-03-01", DAY),              # other site
        (1, None, 600, "2024-04-01", DAY),              # no country
        (1, "TH", 600, "2024-04-01", "20240429"),       # other snapshot
        (None, "ID", 600, "2024-01-01", DAY)], USERS)
    base = rfm.rfm_base(snapshot, users, DAY)
    assert rows(base, "user_id", "country", "last_pay_date") == [
        (None, None, dt.date(2024, 4, 1)),
        (1, "MY", dt.date(2024, 4, 1)), (1, "MY", dt.date(2024, 4, 1)), (5, None, None)]


def test_country_ties_and_missing_dates(spark):
    users = spark.createDataFrame([
        (1, "MY", 600, "2024-02-01", DAY), (1, "ID", 600, "2024-02-01", DAY),
        (2, "TH", 600, None, DAY), (2, "SG", 600, "2020-01-01", DAY)], USERS)
    assert rows(rfm.latest_country(users, DAY)) == [(1, "ID"), (2, "SG")]


@pytest.mark.parametrize("country, orders, amount, days, expected", [
    ("ID", 2, "49.99", 89, ("near", "low", "low")),
    ("ID", 3, "50.00", 90, ("far", "high", "high")),
    ("MY", 3, "299.99", -5, ("near", "high", "low")),
    ("MY", 3, "300.00", 0, ("near", "high", "high")),
    ("MY", None, None, None, ("far", "high", "high")),
])
def test_score_boundaries(spark, country, orders, amount, days, expected):
    from decimal import Decimal
    last = None if days is None else dt.date(2024, 4, 30) - dt.timedelta(days)
    base = spark.createDataFrame(
        [(1, country, orders, amount and Decimal(amount), last)], BASE)
    assert rows(rfm.rfm_score(base, DAY)) == [(1, *expected)]


def test_unknown_country_has_no_score(spark):
    base = spark.createDataFrame([(1, None, 1, None, None)], BASE)
    assert rows(rfm.rfm_score(base, DAY)) == []


def test_recency_day_and_limits_are_parameters(spark):
    from decimal import Decimal
    base = spark.createDataFrame([(1, "MY", 5, Decimal("75"), dt.date(2024, 4, 1))], BASE)
    custom = RfmSettings(near_days=10, frequent_orders=6, high_amount={"MY": 70})
    assert rows(rfm.rfm_score(base, "20240405", custom)) == [(1, "near", "low", "high")]
    assert rows(rfm.rfm_score(base, "20240411", custom)) == [(1, "far", "low", "high")]


CELLS = {("near", "high", "high"): "001", ("far", "high", "high"): "002",
         ("near", "low", "high"): "003", ("far", "low", "high"): "004",
         ("near", "high", "low"): "005", ("far", "high", "low"): "006",
         ("near", "low", "low"): "007", ("far", "low", "low"): "008"}
GRADES = st.sampled_from(["near", "far", "high", "low", "other", None])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(GRADES, GRADES, GRADES), min_size=1, max_size=60))
def test_every_grade_has_one_cell(spark, grades):
    grades = grades + list(CELLS)
    scores = spark.createDataFrame([(i, *g) for i, g in enumerate(grades)],
                                   "user_id bigint, recency string, frequency string, monetary string")
    tags = {int(r.userid): r.tagid for r in rfm.rfm_user_tag(scores).collect()}
    assert tags == {i: "A111U008_" + CELLS.get(g, "008") for i, g in enumerate(grades)}


def test_hot_user_is_split(spark, changed_conf, tmp_path):
    """A third of the rows on one user, a third without user."""
    changed_conf(spark__sql__autoBroadcastJoinThreshold="-1",
                 spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
                 spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                 spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
                 spark__sql__shuffle__partitions="16")
    (spark.range(60000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 7 WHEN 1 THEN id % 1000 END AS user_id", "id AS last_1y_paid_orders",
        "CAST(5 AS DECIMAL(18,2)) AS last_1y_paid_order_amount", "'20240401' AS last_order_paid_time",
        "'JC' AS app_name", f"'{DAY}' AS data_date").repartition(8).write.parquet(f"{tmp_path}/c"))
    (spark.range(1000).selectExpr("id AS user_id", "'MY' AS country", "600 AS site_id",
                                  "'x' AS last_date", f"'{DAY}' AS data_date")
     .write.parquet(f"{tmp_path}/u"))
    base = rfm.rfm_base(spark.read.parquet(f"{tmp_path}/c"), spark.read.parquet(f"{tmp_path}/u"), DAY)
    found = base.collect()
    assert len(found) == 60000 and len({r.last_1y_paid_orders for r in found}) == 60000
    assert sum(r.country is None for r in found) == 20000
    assert "skew=true" in base._jdf.queryExecution().executedPlan().toString()


def test_bucketed_tables_join_without_a_shuffle(spark, changed_conf):
    changed_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    (spark.range(50).selectExpr(
        "id AS user_id", "id AS last_1y_paid_orders", "CAST(5 AS DECIMAL(18,2)) AS last_1y_paid_order_amount",
        "'20240401' AS last_order_paid_time", "'JC' AS app_name", f"'{DAY}' AS data_date")
     .write.bucketBy(4, "user_id").mode("overwrite").saveAsTable("bucketed_consume"))
    (spark.range(40).selectExpr("id AS user_id", "'MY' AS country", "600 AS site_id", "'x' AS last_date",
                                f"'{DAY}' AS data_date")
     .write.bucketBy(4, "user_id").mode("overwrite").saveAsTable("bucketed_users"))
    try:
        base = rfm.rfm_base(spark.table("bucketed_consume"), spark.table("bucketed_users"), DAY)
        assert base.count() == 50 and base.filter("country IS NULL").count() == 10
        assert "Exchange" not in base._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("DROP TABLE bucketed_consume")
        spark.sql("DROP TABLE bucketed_users")
