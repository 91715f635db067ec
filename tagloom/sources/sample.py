"""The upstream tables of the tag jobs, derived from the sample star schema.

Each function returns a table with the columns the operators expect.  Time
columns keep the type of the sample data, so day filters reach the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import PAID_STATUSES, RfmSettings
from .replay import table

RFM_DAY = dt.date(2001, 7, 31)
RETURN_DAY = dt.date(2001, 7, 1)
SMS_DAY = dt.date(2024, 1, 16)
LINK_DAY = dt.date(2024, 1, 30)
PAID_DAY = dt.date(2001, 7, 31)
CONSUME_SINCE = dt.date(2000, 7, 1)
# Prices in the sample are far above the default limits.
SAMPLE_RFM = RfmSettings(high_amount={"ID": 200_000}, high_amount_elsewhere=450_000)
MONEY = "decimal(18,2)"


def order_fact(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").cast(MONEY).alias("order_total_amount"),
        F.when(status == "F", 1).when(status == "O", 3).otherwise(0).alias("pay_status"),
        F.col("o_orderdate").alias("pay_time"), F.col("o_orderdate").alias("result_pay_time"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``order_fact`` once per order line, so orders repeat."""
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return order_fact(spark, folder).join(lines, "order_id", "left")


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    """A payment for each order line, a day later each, so that orders are paid over several days."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").cast(MONEY).alias("price"), "l_linenumber")
    paid = (F.col("pay_time").cast("timestamp") + F.make_dt_interval(F.col("l_linenumber"))).cast("timestamp_ntz")
    return order_fact(spark, folder).join(lines, "order_id").select(
        "user_id", "order_id", F.col("price").alias("order_total_amount"), "pay_status",
        paid.alias("pay_time"), paid.alias("result_pay_time"))


def user_info(spark: SparkSession, folder: str) -> DataFrame:
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    nation = F.col("n_nationkey")
    country = (F.when(nation == 3, "ID").when(nation == 7, F.lit(None).cast("string"))
               .otherwise(F.col("n_name")))
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == nation)
    return customers.select(
        F.col("c_custkey").alias("user_id"), country.alias("country"),
        F.when(segment == "FURNITURE", 600).when(segment == "BUILDING", 900)
        .otherwise(100).alias("site_id"),
        F.lit(RFM_DAY.isoformat()).alias("last_date"),
        F.when(balance < 0, 0).when(balance >= 100, balance).cast(MONEY).alias("paid_order_amount"),
        F.lit(RFM_DAY.strftime("%Y%m%d")).alias("data_date"))


def user_consume_info(spark: SparkSession, folder: str) -> DataFrame:
    orders = order_fact(spark, folder)
    last = F.max("pay_time")
    return (orders.filter(F.col("pay_status").isin(*PAID_STATUSES)
                          & (F.col("pay_time") > F.lit(CONSUME_SINCE).cast("timestamp_ntz")))
            .groupBy("user_id")
            .agg(F.countDistinct("order_id").alias("last_1y_paid_orders"),
                 F.sum("order_total_amount").alias("last_1y_paid_order_amount"),
                 F.date_format(last, "yyyyMMddHHmmss").alias("last_order_paid_time"))
            .select("*", F.lit("JC").alias("app_name"),
                    F.lit(RFM_DAY.strftime("%Y%m%d")).alias("data_date")))


def returned_order_info(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    day = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("returned_order_id"),
        F.col("l_linenumber").alias("return_status"),
        (F.col("l_suppkey") % 3).cast("int").alias("site_id"),
        (day + 5 * 86400 * F.col("l_linenumber")).alias("returned_time"))


def sms_delivered(spark: SparkSession, folder: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    hard = F.get_json_object("props", "$.k") == "9"
    return table(spark, folder, "events").select(
        "user_id",
        F.when(failed & hard, "9").when(failed & (F.col("event_id") % 4 == 0), "2")
        .otherwise("0").alias("status_code"),
        F.col("ts").alias("event_captured_dt"))


def cookie_user_relation(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(F.lit("ck"), (F.col("event_id") % 800).cast("string")).alias("cookie_id"),
        F.col("user_id").alias("userid"), F.col("ts").alias("last_time"),
        F.col("event_id").alias("last_date"))


def _message_text() -> Column:
    """JSON messages; some are broken in each way a message can be."""
    event, user = F.col("event_id"), F.col("user_id").cast("string")
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    kind = event % 50
    info = F.concat(F.lit('{"i":{"timestamp":'),
                    F.when(kind == 23, '"yesterday"')
                    .when(kind == 29, F.concat(F.lit('"'), seconds, F.lit('"')))
                    .otherwise(seconds), F.lit("}"))
    device = (F.when(kind == 11, "")
              .when(kind == 13, ',"d":"none"')
              .when(kind == 17, ',"d":{"d":null}')
              .when(kind == 19, F.concat(F.lit(',"d":{"d":"u'), user, F.lit('##x"}')))
              .when(kind == 31, ',"d":{"d":""}')
              .otherwise(F.concat(F.lit(',"d":{"d":"u'), user, F.lit('"}'))))
    return F.when(kind == 7, "not json").otherwise(F.concat(info, device, F.lit("}")))


def kafka_log(events: DataFrame) -> DataFrame:
    """``events`` as messages of an eight-partition topic; batch or stream."""
    event = F.col("event_id")
    return events.select(
        F.col("user_id").cast("string").alias("key"), _message_text().alias("value"),
        F.lit("events").alias("topic"), (event % 8).cast("int").alias("partition"),
        F.expr("event_id div 8").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"))
