"""Windowed tags of many days in one pass.

A row counts for the days from its own to the last one whose window still
reaches back to it.  Written as a step up on the first of these days and a
step down on the day after the last, the counts of every day are running sums
over the steps of a user, of which there are at most as many as days.  The
source is read once, whatever the number of days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.days import Day, day_of, days_before, in_days, parse_day
from ..functions.tagrows import tag_rows
from ..settings import TAG_IDS, ReturnSettings, SmsSettings
from .returns import RATE

DATE = "data_date"


def running_segments(steps: DataFrame, key: str, columns: list[str], first: Day, last: Day) -> DataFrame:
    """(key, columns, since, until): running sums of ``columns`` over the steps (key, at, columns) of a key, and the
    days in [first, last] on which they hold."""
    by_day = steps.groupBy(key, "at").agg(*(F.sum(c).alias(c) for c in columns))
    order = Window.partitionBy(key).orderBy("at")
    sums = by_day.select(key, *(F.sum(c).over(order).alias(c) for c in columns), "at",
                         F.lead("at").over(order).alias("next"))
    low, high = F.lit(parse_day(first)), F.lit(parse_day(last))
    segments = sums.select(key, *columns, F.greatest("at", low).alias("since"),
                           F.least(F.coalesce(F.date_sub("next", 1), high), high).alias("until"))
    return segments.filter(F.col("since") <= F.col("until"))


def each_day(segments: DataFrame, since: str = "since", until: str | Column = "until") -> DataFrame:
    """A row with ``data_date`` for every day of a segment."""
    until = F.col(until) if isinstance(until, str) else until
    days = F.sequence(F.col(since), until)
    return segments.withColumn("day", F.explode(days)).withColumn(DATE, F.date_format("day", "yyyyMMdd")).drop("day")


def window_order_days(orders: DataFrame, returns: DataFrame, first: Day, last: Day,
                      settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """(user_id, paid, returned, present, data_date): for each day the distinct orders that are paid, and of these the
    returned ones, in the window that ends on it.  ``present`` also counts payments without an order number; times
    without a readable day are left out."""
    start, length = days_before(first, settings.window_days), settings.window_days
    kinds = {field.name: field.dataType for field in orders.schema}
    paid = (orders.filter(F.col("pay_status").isin(*settings.paid_statuses) & in_days(orders, "pay_time", start, last))
            .select("user_id", "order_id", day_of(orders, "pay_time").alias("paid"),
                    F.lit(None).cast("date").alias("returned")))
    returned = (returns.filter(F.col("return_status").isin(*settings.return_statuses)
                               & F.col("site_id").isin(*settings.site_ids)
                               & in_days(returns, "returned_time", start, last))
                .select(F.col("user_id").try_cast(kinds["user_id"]).alias("user_id"),
                        F.col("returned_order_id").try_cast(kinds["order_id"]).alias("order_id"),
                        F.lit(None).cast("date").alias("paid"), day_of(returns, "returned_time").alias("returned"))
                .filter("user_id IS NOT NULL AND order_id IS NOT NULL"))
    # The state of an order changes on a day of its own or where one leaves the window.
    own = F.coalesce("paid", "returned")
    points = (paid.union(returned).filter(own.isNotNull()).distinct()
              .select("user_id", "order_id", F.inline(F.array(
                  F.struct(own.alias("at"), F.col("paid"), F.col("returned")),
                  F.struct(F.date_add(own, length + 1).alias("at"), F.lit(None).cast("date").alias("paid"),
                           F.lit(None).cast("date").alias("returned")))))
              .groupBy("user_id", "order_id", "at").agg(F.max("paid").alias("paid"), F.max("returned").alias("returned")))
    order = Window.partitionBy("user_id", "order_id").orderBy("at")

    def inside(day: str) -> Column:
        return F.coalesce(F.max(day).over(order) >= F.date_sub("at", length), F.lit(False))

    states = points.select("user_id", "order_id", "at", inside("paid").cast("long").alias("present"),
                           (inside("paid") & inside("returned")).cast("long").alias("back"))

    def step(name: str) -> Column:
        return F.col(name) - F.coalesce(F.lag(name).over(order), F.lit(0))

    numbered = F.col("order_id").isNotNull().cast("long")
    steps = states.select("user_id", "at", step("present").alias("present"),
                          (step("present") * numbered).alias("paid"), (step("back") * numbered).alias("returned"))
    steps = steps.filter("present <> 0 OR returned <> 0")
    return each_day(running_segments(steps, "user_id", ["paid", "returned", "present"], first, last)
                    .filter("present > 0")).select("user_id", "paid", "returned", "present", DATE)


def paid_orders_days(orders: DataFrame, returns: DataFrame, first: Day, last: Day,
                     settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """(user_id, paid_orders, returned_orders, data_date): the counts behind the rate, for each day in [first, last]."""
    days = window_order_days(orders, returns, first, last, settings)
    return days.select("user_id", F.col("paid").alias("paid_orders"), F.col("returned").alias("returned_orders"), DATE)


def tag_return_rate_days(orders: DataFrame, returns: DataFrame, first: Day, last: Day,
                         settings: ReturnSettings = ReturnSettings()) -> DataFrame:
    """``tag_return_rate`` of every day in [first, last], with ``data_date``."""
    days = window_order_days(orders, returns, first, last, settings)
    return tag_rows(days, TAG_IDS["return_goods_rate"], "user_id", F.expr(RATE), "userid", F.col(DATE))


def _failure_segments(failures: DataFrame, first: Day, last: Day, settings: SmsSettings) -> DataFrame:
    """Segments with enough failures from (userid, day, n)."""
    steps = failures.select("userid", F.inline(F.array(
        F.struct(F.col("day").alias("at"), F.col("n")),
        F.struct(F.date_add("day", settings.window_days + 1).alias("at"), (-F.col("n")).alias("n")))))
    return running_segments(steps, "userid", ["n"], first, last).filter(F.col("n") >= settings.min_failures)


def _failures(deliveries: DataFrame, first: Day, last: Day, settings: SmsSettings) -> Column:
    return ((F.col("status_code") != settings.delivered_code)
            & in_days(deliveries, "event_captured_dt", days_before(first, settings.window_days), last))


def sms_repeat_failures_days(deliveries: DataFrame, first: Day, last: Day,
                             settings: SmsSettings = SmsSettings()) -> DataFrame:
    """(userid, num, data_date): ``sms_repeat_failures`` of every day in [first, last]."""
    failures = (deliveries.filter(_failures(deliveries, first, last, settings))
                .groupBy(F.col("user_id").cast("string").alias("userid"),
                         day_of(deliveries, "event_captured_dt").alias("day")).agg(F.count("*").alias("n")))
    return each_day(_failure_segments(failures, first, last, settings)).select("userid", F.col("n").alias("num"), DATE)


def sms_blacklist_days(deliveries: DataFrame, previous: DataFrame | None, first: Day, last: Day,
                       settings: SmsSettings = SmsSettings()) -> DataFrame:
    """The blacklists of every day in [first, last], with ``data_date``, as the daily runs would make them one on the
    other: ``previous`` is the list before ``first``.

    Users never leave the list, so the first day that lists a user decides.  The log is scanned once.
    """
    hard = F.coalesce(F.col("status_code").isin(*settings.hard_codes), F.lit(False))
    recent = F.coalesce(_failures(deliveries, first, last, settings), F.lit(False))
    # A permanent failure lists its user from the start, so it needs no day.
    day = F.when(recent, day_of(deliveries, "event_captured_dt"))
    users = (deliveries.filter(recent | hard)
             .groupBy(F.col("user_id").cast("string").alias("userid"), day.alias("day"))
             .agg(F.count("*").alias("n"), F.bool_or(hard).alias("hard")))
    repeated = _failure_segments(users.filter("day IS NOT NULL").select("userid", "day", "n"), first, last, settings)
    start = F.lit(parse_day(first))
    listed = (repeated.select("userid", "since")
              .union(users.filter("hard").select("userid", start.alias("since"))))
    if previous is not None:
        listed = listed.union(previous.select("userid", start.alias("since")))
    since = listed.groupBy("userid").agg(F.min("since").alias("since"))
    days = each_day(since, until=F.lit(parse_day(last)))
    return tag_rows(days, TAG_IDS["sms_blacklist"], "userid", None, "userid", F.col(DATE))
