"""Recency, frequency and monetary segments of users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.days import Day, parse_day, partition_value
from ..functions.tagrows import tag_rows
from ..settings import RFM_USER_TAG_PREFIX, RfmSettings


def latest_country(user_info: DataFrame, snapshot: Day,
                   settings: RfmSettings = RfmSettings()) -> DataFrame:
    """(user_id, country) from the newest dimension row of each user.

    Equal dates are resolved by country name.
    """
    # All rows have one data_date.  With it among the keys, a join on user_id
    # shuffles the ranked rows by itself, and adaptive execution can split a
    # hot user only when both join inputs are plain shuffles.
    newest = Window.partitionBy("user_id", "data_date").orderBy(
        F.col("last_date").desc(), F.col("country").asc())
    return (user_info
            .filter((F.col("data_date") == partition_value(snapshot))
                    & F.col("site_id").isin(*settings.site_ids)
                    & F.col("country").isNotNull())
            .select("user_id", "country", F.row_number().over(newest).alias("_rank"))
            .filter("_rank = 1").drop("_rank"))


def _last_pay_date(consume: DataFrame) -> Column:
    kind, value = consume.schema["last_order_paid_time"].dataType, F.col("last_order_paid_time")
    if isinstance(kind, T.StringType):
        parts = (F.substring(value, start, length) for start, length in ((1, 4), (5, 2), (7, 2)))
        return F.concat_ws("-", *parts).try_cast("date")
    return F.to_date(value)


def rfm_base(consume: DataFrame, user_info: DataFrame, snapshot: Day,
             settings: RfmSettings = RfmSettings()) -> DataFrame:
    """Measures of every user with a payment, and the country if known.

    Rows repeated in the snapshot stay repeated.
    """
    paid = (consume
            .filter((F.col("data_date") == partition_value(snapshot))
                    & (F.col("app_name") == settings.app_name)
                    & F.col("last_order_paid_time").isNotNull())
            .select("user_id", "last_1y_paid_orders", "last_1y_paid_order_amount",
                    _last_pay_date(consume).alias("last_pay_date")))
    joined = paid.join(latest_country(user_info, snapshot, settings), "user_id", "left")
    return joined.select("user_id", "country", "last_1y_paid_orders",
                         "last_1y_paid_order_amount", "last_pay_date")


def rfm_score(base: DataFrame, recency_as_of: Day,
              settings: RfmSettings = RfmSettings()) -> DataFrame:
    """(user_id, recency, frequency, monetary) of users with a known country.

    A missing date is far, a missing count or amount is high.
    """
    country, amount = F.col("country"), F.col("last_1y_paid_order_amount")
    limit = F.lit(settings.high_amount_elsewhere)
    for name, value in settings.high_amount.items():
        limit = F.when(country == name, F.lit(value)).otherwise(limit)
    gap = F.datediff(F.lit(parse_day(recency_as_of)), F.col("last_pay_date"))
    return base.filter(country.isNotNull()).select(
        "user_id",
        F.when(gap < settings.near_days, "near").otherwise("far").alias("recency"),
        F.when(F.col("last_1y_paid_orders") < settings.frequent_orders, "low")
        .otherwise("high").alias("frequency"),
        F.when(amount < limit, "low").otherwise("high").alias("monetary"))


def rfm_user_tag(scores: DataFrame) -> DataFrame:
    """One tag per scored row, numbered 1 (best) to 8 over the three grades."""

    def grade(name: str, good: str, bad: str, weight: int) -> Column:
        return F.when(F.col(name) == good, 0).when(F.col(name) == bad, weight)

    cell = (grade("recency", "near", "far", 1) + grade("frequency", "high", "low", 2)
            + grade("monetary", "high", "low", 4))
    number = (F.coalesce(cell, F.lit(7)) + 1).cast("string")
    return tag_rows(scores, F.concat(F.lit(RFM_USER_TAG_PREFIX), F.lpad(number, 3, "0")), "user_id")
