import datetime as dt

import pytest
from pyspark.sql import functions as F

from frames import rows
from tagloom.functions.days import day_of, days_before, in_days, parse_day, partition_value


def test_parse_day():
    day = dt.date(2024, 3, 1)
    assert {parse_day("20240301"), parse_day("2024-03-01"), parse_day(day),
            parse_day(dt.datetime(2024, 3, 1, 9))} == {day}
    assert partition_value("2024-03-01") == "20240301"
    assert days_before("20240301", 1) == dt.date(2024, 2, 29)


MOMENTS = ["2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-05 23:59:59",
           "2024-01-06 00:00:00"]


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "timestamp_ntz", "bigint"])
def test_ranges_include_both_days(spark, kind):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(MOMENTS)] + [(9, None)], "id int, m string")
    column = F.col("m").cast("timestamp")
    if kind == "bigint":
        column = F.unix_timestamp(column)
    elif kind != "string":
        column = column.cast(kind)
    df = df.withColumn("m", F.col("m") if kind == "string" else column)
    assert rows(df.filter(in_days(df, "m", "20240102", "20240105")), "id") == [(1,), (2,)]
    assert [r.d for r in df.orderBy("id").select(day_of(df, "m").alias("d")).collect()] == [
        dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 5), dt.date(2024, 1, 6), None]


def test_unreadable_text_has_no_day(spark):
    texts = ["2024-01-03", "2024-01-03T10:00", "2024-1-3 10:00:00", "soon", "2024-13-01", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "m string")
    assert [r[0] for r in df.select(day_of(df, "m")).collect()] == [dt.date(2024, 1, 3)] * 3 + [None] * 4


def test_epoch_days_follow_the_session_time_zone(spark, changed_conf):
    changed_conf(spark__sql__session__timeZone="Asia/Shanghai")
    # 2024-01-02 00:00 in Shanghai is 2024-01-01 16:00 UTC.
    df = spark.createDataFrame([(1704124799,), (1704124800,)], "m bigint")
    assert rows(df.filter(in_days(df, "m", "20240102", "20240102"))) == [(1704124800,)]


def test_range_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "2024-01-01 10:00:00")], "id int, m string").write.parquet(path)
    df = spark.read.parquet(path)
    plan = df.filter(in_days(df, "m", "20240102", "20240105"))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(m,2024-01-02)" in plan and "LessThan(m,2024-01-06)" in plan
