"""Payment tags: total amount, number of orders, days since the last payment,
and registered users who never paid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.days import Day, day_of, parse_day, partition_value, until_day
from ..functions.tagrows import tag_rows
from ..settings import PAID_STATUSES, TAG_IDS


def _paid(orders: DataFrame, until: Day | None) -> DataFrame:
    paid = orders.filter(F.col("pay_status").isin(*PAID_STATUSES))
    if until is None:
        return paid
    return paid.filter(until_day(orders, "result_pay_time", until))


def _amount() -> Column:
    return F.sum("order_total_amount")


def _orders() -> Column:
    return F.countDistinct("order_id")


def _days_since(orders: DataFrame, as_of: Day) -> Column:
    return F.datediff(F.lit(parse_day(as_of)), F.max(day_of(orders, "result_pay_time")))


def tag_total_paid_amount(orders: DataFrame, until: Day | None = None) -> DataFrame:
    """Sum of paid order amounts per user, over all dates unless ``until``."""
    totals = _paid(orders, until).groupBy("user_id").agg(_amount().alias("w"))
    return tag_rows(totals, TAG_IDS["userid_all_paid_money"], "user_id", F.col("w"))


def tag_total_paid_orders(orders: DataFrame, until: Day | None = None) -> DataFrame:
    """Number of distinct paid orders per user, over all dates unless ``until``."""
    totals = _paid(orders, until).groupBy("user_id").agg(_orders().alias("w"))
    return tag_rows(totals, TAG_IDS["userid_all_paid_times"], "user_id", F.col("w"))


def tag_days_since_last_paid(orders: DataFrame, as_of: Day, until: Day | None = None) -> DataFrame:
    """Days from the latest payment to ``as_of``: negative for later payments,
    NULL when no payment has a time."""
    totals = _paid(orders, until).groupBy("user_id").agg(_days_since(orders, as_of).alias("w"))
    return tag_rows(totals, TAG_IDS["userid_last_paid"], "user_id", F.col("w"))


def paid_tags(orders: DataFrame, as_of: Day, until: Day | None = None) -> DataFrame:
    """The three payment tags from one scan and one aggregate, with ``tagtype``."""
    weights = {"userid_all_paid_money": _amount(), "userid_all_paid_times": _orders(),
               "userid_last_paid": _days_since(orders, as_of)}
    totals = _paid(orders, until).groupBy("user_id").agg(
        *(weight.cast("string").alias(tagtype) for tagtype, weight in weights.items()))
    rows = totals.select("user_id", F.inline(F.array(*(
        F.struct(F.lit(tagtype).alias("tagtype"), F.lit(TAG_IDS[tagtype]).alias("id"),
                 F.col(tagtype).alias("w")) for tagtype in weights))))
    return tag_rows(rows, F.col("id"), "user_id", F.col("w"), "userid", F.col("tagtype"))


def tag_registered_unpaid(user_info: DataFrame, snapshot: Day) -> DataFrame:
    """Users of the snapshot whose paid amount is zero or missing."""
    amount = F.col("paid_order_amount")
    unpaid = (user_info
              .filter((F.col("data_date") == partition_value(snapshot))
                      & ((amount == 0) | amount.isNull()))
              .select("user_id").distinct())
    return tag_rows(unpaid, TAG_IDS["userid_regist_notpaid"], "user_id")
