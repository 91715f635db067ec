"""Share of recently paid orders that were returned.

Paid orders and returns are laid on top of each other and grouped by (user,
order).  Every shuffle is then a grouping with map-side combine, so neither a
user nor an order with very many rows meets in one task, and the join of
orders with returns is gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.days import Day, days_before, in_days
from ..functions.tagrows import tag_rows
from ..settings import TAG_IDS, ReturnSettings


# returned / paid to two places, half up, in whole numbers; NULL without orders.
RATE = "((200 * returned + paid) div nullif(2 * paid, 0)) / 100"


def _paid_in_window(orders: DataFrame, as_of: Day, settings: ReturnSettings) -> DataFrame:
    first = days_before(as_of, settings.window_days)
    return (orders
            .filter(F.col("pay_status").isin(*settings.paid_statuses)
                    & in_days(orders, "pay_time", first, as_of))
            .select("user_id", "order_id"))


def _returned_in_window(orders: DataFrame, returns: DataFrame, as_of: Day,
                        settings: ReturnSettings) -> DataFrame:
    first = days_before(as_of, settings.window_days)
    kinds = {field.name: field.dataType for field in orders.schema}
    return (returns
            .filter(F.col("return_status").isin(*settings.return_statuses)
                    & F.col("site_id").isin(*settings.site_ids)
                    & in_days(returns, "returned_time", first, as_of))
            .select(F.col("user_id").try_cast(kinds["user_id"]).alias("user_id"),
                    F.col("returned_order_id").try_cast(kinds["order_id"]).alias("order_id"))
            # A missing key equals no key.
            .filter("user_id IS NOT NULL AND order_id IS NOT NULL"))


def window_orders(orders: DataFrame, returns: DataFrame, as_of: Day,
                  settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """(user_id, order_id, returned): each order paid in the window, once."""
    paid = _paid_in_window(orders, as_of, settings)
    returned = _returned_in_window(orders, returns, as_of, settings)
    both = (paid.withColumn("returned", F.lit(0)).withColumn("paid", F.lit(1))
            .union(returned.withColumn("returned", F.lit(1)).withColumn("paid", F.lit(0))))
    return (both.groupBy("user_id", "order_id")
            .agg(F.max("paid").alias("paid"), F.max("returned").alias("returned"))
            .filter("paid = 1").drop("paid"))


def paid_orders_window(orders: DataFrame, as_of: Day,
                       settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """(user_id, paid_orders): distinct orders paid in the window."""
    return (_paid_in_window(orders, as_of, settings)
            .groupBy("user_id").agg(F.countDistinct("order_id").alias("paid_orders")))


def returned_orders_window(orders: DataFrame, returns: DataFrame, as_of: Day,
                           settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """(user_id, returned_orders): of those orders, the ones returned in it."""
    return (window_orders(orders, returns, as_of, settings).filter("returned = 1")
            .groupBy("user_id").agg(F.count("order_id").alias("returned_orders")))


def tag_return_rate(orders: DataFrame, returns: DataFrame, as_of: Day,
                    settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """Returned / paid orders per user, rounded half up to two places.

    A return counts only with an order paid in the window, so every user has
    paid orders; users who returned nothing get 0.
    """
    counts = (window_orders(orders, returns, as_of, settings)
              .groupBy("user_id")
              .agg(F.count("order_id").alias("paid"), F.sum("returned").alias("returned")))
    return tag_rows(counts, TAG_IDS["return_goods_rate"], "user_id", F.expr(RATE))
