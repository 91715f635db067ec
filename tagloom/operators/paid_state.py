"""The payment tags of all history, carried from day to day.

The state of a day holds, for every user, the sum, the number of distinct
orders and the last payment day of everything up to that day.  The orders
themselves are kept apart, in folders by number range.  A day's run reads one
day of payments, the totals of the day before, and only those earlier orders
whose numbers lie in the ranges of the day's own.  The payments are grouped and
compared with the earlier orders once, and written down for what comes of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import DayFolder
from ..functions.days import Day, day_of, days_before, in_days, parse_day, until_day
from ..functions.tagrows import tag_rows
from ..session import delete_path, stored
from ..settings import PAID_STATUSES, TAG_IDS

#: Order numbers in one range; orders without a whole number are dealt into so many ranges by hash.
RANGE, HASHED = 1 << 20, 64
#: Days of new orders that are kept apart before they are merged into one folder.
MERGE_AFTER = 64
TOTALS, ORDERS = "totals", "orders"


def _range_of(orders: DataFrame) -> Column:
    if isinstance(orders.schema["order_id"].dataType, T.IntegralType):
        return F.floor(F.col("order_id") / RANGE)
    return F.pmod(F.xxhash64("order_id"), F.lit(HASHED))


def _payments(orders: DataFrame, day_column: str) -> DataFrame:
    """(user_id, order_id, amount, last_day, part): the payments for each order of a user."""
    return (orders.groupBy("user_id", "order_id")
            .agg(F.sum("order_total_amount").alias("amount"), F.max(day_of(orders, day_column)).alias("last_day"))
            .withColumn("part", _range_of(orders)))


def merge_totals(payments: DataFrame, new_order: Column, before: DataFrame | None = None) -> DataFrame:
    """(user_id, amount, orders, last_day): the totals ``before`` and payments, whose orders count where new.

    One grouping with map-side combine over both.
    """
    rows = payments.select("user_id", "amount", F.when(new_order, 1).otherwise(0).cast("long").alias("orders"),
                           "last_day")
    if before is not None:
        rows = rows.unionByName(before.select(rows.columns))
    return rows.groupBy("user_id").agg(F.sum("amount").alias("amount"), F.sum("orders").alias("orders"),
                                       F.max("last_day").alias("last_day"))


def paid_tags_of(totals: DataFrame, as_of: Day) -> DataFrame:
    """The three payment tags, with ``tagtype``, from totals."""
    days = F.datediff(F.lit(parse_day(as_of)), F.col("last_day"))
    weights = {"userid_all_paid_money": F.col("amount"), "userid_all_paid_times": F.col("orders"),
               "userid_last_paid": days}
    rows = totals.select("user_id", F.inline(F.array(*(
        F.struct(F.lit(tagtype).alias("tagtype"), F.lit(TAG_IDS[tagtype]).alias("id"),
                 weight.cast("string").alias("w")) for tagtype, weight in weights.items()))))
    return tag_rows(rows, F.col("id"), "user_id", F.col("w"), "userid", F.col("tagtype"))


@dataclass(frozen=True)
class PaidState:
    """Payment totals by day under a path.

    Days follow each other: a day goes on from the day before, unless it is
    the first (``bootstrap``), which takes in all payments up to its end and
    those without a readable day.  A rerun of a day replaces its state; the
    days after it have to be rerun as well.  ``day_column`` holds the day on
    which a payment comes in.
    """

    spark: SparkSession
    location: str
    day_column: str = "result_pay_time"

    @property
    def days(self) -> DayFolder:
        return DayFolder(self.spark, self.location)

    def run_day(self, orders: DataFrame, day: Day, bootstrap: bool = False) -> DataFrame:
        """Bring the state to ``day``; returns its totals."""
        paid = orders.filter(F.col("pay_status").isin(*PAID_STATUSES))
        yesterday = days_before(day, 1)
        if self.days.previous(yesterday, TOTALS, bootstrap):
            today = in_days(paid, self.day_column, day, day)
            before, folders = self.days.read(yesterday, TOTALS), self.days.names(yesterday)[ORDERS]
        else:
            today = until_day(paid, self.day_column, day) | day_of(paid, self.day_column).isNull()
            before, folders = None, []
        aside = self.days.stage()
        payments = stored(_payments(paid.filter(today), self.day_column), f"{self.location}/{aside}/payments")
        if folders:
            payments = stored(self._mark_known(payments, folders), f"{self.location}/{aside}/marked")
            new = F.col("order_id").isNotNull() & F.col("known").isNull()
        else:
            new = F.col("order_id").isNotNull()
        run = self.days.stage()
        merge_totals(payments, new, before).write.parquet(f"{self.location}/{run}/{TOTALS}")
        orders_run = self.days.stage()
        added = payments.filter(new).select("user_id", "order_id", "part")
        if len(folders) >= MERGE_AFTER:
            added, folders = added.unionByName(self._orders(added, folders)), []
        added.write.partitionBy("part").parquet(f"{self.location}/{orders_run}")
        delete_path(self.spark, f"{self.location}/{aside}")
        self.days.commit(day, {TOTALS: f"{run}/{TOTALS}", ORDERS: [*folders, orders_run]})
        return self.totals(day)

    def totals(self, day: Day) -> DataFrame:
        """(user_id, amount, orders, last_day) up to a day."""
        return self.days.read(day, TOTALS)

    def _orders(self, like: DataFrame, folders: Sequence[str]) -> DataFrame:
        columns = [T.StructField(c, like.schema[c].dataType) for c in ("user_id", "order_id", "part")]
        return (self.spark.read.schema(T.StructType(columns)).option("basePath", f"{self.location}/data")
                .parquet(*(f"{self.location}/{folder}" for folder in folders))
                .select("user_id", "order_id", "part"))

    def _mark_known(self, payments: DataFrame, folders: Sequence[str]) -> DataFrame:
        """``payments`` with ``known`` where the user has paid for the order before.

        The bounds of the day's ranges are looked up first, so that the scan
        of the kept orders is pruned to their folders.  Only kept orders that
        are paid again meet the payments' other columns: where the day's keys
        are small enough to be broadcast, the kept orders are not shuffled.
        """
        lowest, highest = payments.agg(F.min("part"), F.max("part")).first()
        kept = self._orders(payments, folders)
        kept = kept.filter(F.lit(False)) if lowest is None else kept.filter(F.col("part").between(lowest, highest))
        kept = kept.select(F.col("user_id").alias("_user"), F.col("order_id").alias("_order"), F.lit(True).alias("known"))
        same = F.col("user_id").eqNullSafe(F.col("_user")) & (F.col("order_id") == F.col("_order"))
        again = kept.join(payments.select("user_id", "order_id"), same, "left_semi")
        return payments.join(again, same, "left").drop("_user", "_order")
