"""Payment totals carried from day to day against the tags of the whole table."""

import datetime as dt
import random
from decimal import Decimal

import pytest

from frames import rows
from pyspark.sql import functions as F
from tagloom.functions.days import days_before
from tagloom.operators import paid, paid_state
from tagloom.operators.paid_state import PaidState
from tagloom.plans import registry

SCHEMA = ("user_id bigint, order_id {}, order_total_amount decimal(18,2), pay_status int, pay_time string, "
          "result_pay_time string")
FIRST = dt.date(2024, 1, 1)


def orders(spark, ids="bigint", seed=1):
    """Orders paid in parts over several days, by several users, and some without a number, an owner or a time."""
    rng, data = random.Random(seed), []
    for _ in range(400):
        order = rng.choice([None, *range(60), (1 << 20) - 1, 1 << 20, 5 << 20])
        time = rng.choice([None, "", "soon"]) if rng.random() < 0.03 else str(FIRST + dt.timedelta(rng.randrange(12)))
        data.append((rng.choice([None, 1, 2, 3, 4, 5, 6]), order if ids == "bigint" or order is None else f"o{order}",
                     rng.choice([None, Decimal(rng.randrange(10_000)) / 100]), rng.choice([0, 1, 1, 3, None]), time, time))
    return spark.createDataFrame(data, SCHEMA.format(ids))


def tags(df):
    return rows(df, "tagtype", "tagid", "userid", "tagweight")


@pytest.mark.parametrize("ids, merge", [("bigint", 64), ("string", 2)])
def test_days_add_up(spark, tmp_path, monkeypatch, ids, merge):
    monkeypatch.setattr(paid_state, "MERGE_AFTER", merge)
    table, state = orders(spark, ids), PaidState(spark, f"{tmp_path}/state")
    unreadable = F.coalesce(F.col("result_pay_time"), F.lit("")).isin("", "soon")
    for n in range(8):
        day = FIRST + dt.timedelta(4 + n)
        state.run_day(table, day, bootstrap=n == 0)
        seen = table.filter(unreadable | (F.col("result_pay_time") <= day.isoformat()))
        assert tags(paid_state.paid_tags_of(state.totals(day), day)) == tags(paid.paid_tags(seen, day))
    assert len(state.days.names(day)["orders"]) == (8 if merge == 64 else 2)


def test_a_day_can_be_repeated_and_needs_the_day_before(spark, tmp_path):
    table, state = orders(spark), PaidState(spark, f"{tmp_path}/state")
    with pytest.raises(LookupError):
        state.run_day(table, FIRST)
    state.run_day(table, FIRST, bootstrap=True)
    second = days_before(FIRST, -1)
    expected = rows(state.run_day(table, second))
    assert rows(state.run_day(table, second)) == expected
    with pytest.raises(LookupError):
        state.run_day(table, days_before(FIRST, -3))
    # A later payment for the day changes the rerun and nothing before it.
    before = rows(state.totals(FIRST))
    late = spark.createDataFrame([(99, 7, Decimal("1.00"), 1, str(second), str(second))], SCHEMA.format("bigint"))
    assert len(state.run_day(table.unionByName(late), second).filter("user_id = 99").collect()) == 1
    assert rows(state.totals(FIRST)) == before
    assert state.days.vacuum() == 4 and rows(state.totals(second)) != expected


def test_an_interrupted_day_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table, state = orders(spark), PaidState(spark, f"{tmp_path}/state")
    expected = rows(state.run_day(table, FIRST, bootstrap=True))

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(paid_state.DayFolder, "commit", fail)
    with pytest.raises(RuntimeError):
        state.run_day(table.limit(3), FIRST, bootstrap=True)
    assert rows(state.totals(FIRST)) == expected


def test_days_without_payments_and_empty_tables(spark, tmp_path):
    state, none = PaidState(spark, f"{tmp_path}/state"), orders(spark).limit(0)
    assert rows(state.run_day(none, FIRST, bootstrap=True)) == []
    second, third = days_before(FIRST, -1), days_before(FIRST, -2)
    one = spark.createDataFrame([(1, 7, Decimal("2.50"), 1, str(second), str(second))], SCHEMA.format("bigint"))
    assert rows(state.run_day(one, second)) == [(1, Decimal("2.50"), 1, second)]
    assert rows(state.run_day(one, third)) == [(1, Decimal("2.50"), 1, second)]


def test_a_day_reads_one_day_and_its_own_ranges(spark, tmp_path):
    """The plan of a daily run filters the payments by day and prunes kept orders to the ranges of the day."""
    data = [(u, o, Decimal("1.00"), 1, d, d) for u, o, d in
            [(1, 5, "2024-01-01"), (2, 7 << 20, "2024-01-01"), (1, 5, "2024-01-02"), (3, 9, "2024-01-02")]]
    spark.createDataFrame(data, SCHEMA.format("bigint")).write.parquet(f"{tmp_path}/orders")
    table, state = spark.read.parquet(f"{tmp_path}/orders"), PaidState(spark, f"{tmp_path}/state")
    state.run_day(table, FIRST, bootstrap=True)
    second = days_before(FIRST, -1)
    day_rows = paid_state._payments(table.filter(paid_state.in_days(table, "result_pay_time", second, second)),
                                    "result_pay_time")
    plan = state._mark_known(day_rows, state.days.names(FIRST)["orders"])._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(result_pay_time,2024-01-02)" in plan
    kept = [line for line in plan.splitlines() if "PartitionFilters" in line and "part" in line]
    assert kept and any("part#" in line.split("PartitionFilters")[1].split("]")[0] for line in kept)
    state.run_day(table, second)
    assert rows(state.totals(second), "user_id", "orders") == [(1, 1), (2, 1), (3, 1)]


def test_payments_are_made_once_for_all_that_comes_of_them(spark, tmp_path, monkeypatch):
    """Totals, new orders and ranges of a day come from one pass over its payments, the days of the chain from one join."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def counted(order):
        made.add(1)
        return order

    last = registry.sample.PAID_DAY
    data = [(u, o, Decimal(o), 1, *[str(days_before(last, (u + o) % 6))] * 2) for u in range(4) for o in range(30)]
    table = spark.createDataFrame(data, SCHEMA.format("bigint"))
    payments = table.withColumn("order_id", counted("order_id"))
    state = PaidState(spark, f"{tmp_path}/state")
    for n, day in enumerate((days_before(last, 1), last)):
        made.value = 0
        state.run_day(payments, day, bootstrap=n == 0)
        assert made.value == sum(d[5] == str(day) if n else d[5] <= str(day) for d in data)
        assert state.days.vacuum() == 0
    made.value = 0
    monkeypatch.setattr(registry.sample, "order_payments", lambda *_: payments)
    assert tags(registry.paid_state_chain(spark, "")) == tags(paid.paid_tags(table, last))
    assert made.value == len(data)


def test_a_small_day_does_not_shuffle_the_kept_orders(spark, tmp_path, changed_conf):
    changed_conf(spark__sql__autoBroadcastJoinThreshold="4000")
    table, state = orders(spark), PaidState(spark, f"{tmp_path}/state")
    state.run_day(table, FIRST + dt.timedelta(11), bootstrap=True)
    spark.createDataFrame([(1, 5, 0), (None, 9, 0), (2, None, None)], "user_id bigint, order_id bigint, part bigint"
                          ).coalesce(1).write.parquet(f"{tmp_path}/day")
    day, folders = spark.read.parquet(f"{tmp_path}/day"), state.days.names(FIRST + dt.timedelta(11))["orders"]
    marked = state._mark_known(day, folders)
    joins = [line for line in marked._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join " in line]
    assert any("BroadcastHashJoin" in line and "LeftSemi, BuildRight" in line for line in joins)
    kept = {tuple(r) for r in state._orders(day, folders).select("user_id", "order_id").collect()}
    assert rows(marked, "user_id", "order_id", "known") == sorted(
        [(u, o, (u, o) in kept or None) for u, o in [(1, 5), (None, 9), (2, None)]],
        key=lambda r: [(v is not None, v) for v in r])
