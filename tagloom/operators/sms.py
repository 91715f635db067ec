"""Users whose SMS deliveries keep failing, carried from day to day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.days import Day, days_before, in_days
from ..functions.tagrows import tag_rows
from ..settings import TAG_IDS, SmsSettings
from .coverage import DayRange, in_ranges


def _recent_failure(deliveries: DataFrame, as_of: Day, settings: SmsSettings) -> Column:
    return ((F.col("status_code") != settings.delivered_code)
            & in_days(deliveries, "event_captured_dt", days_before(as_of, settings.window_days), as_of))


def _hard_failure(settings: SmsSettings) -> Column:
    return F.col("status_code").isin(*settings.hard_codes)


def sms_repeat_failures(deliveries: DataFrame, as_of: Day,
                        settings: SmsSettings = SmsSettings()) -> DataFrame:
    """(userid, num) of users with enough failures in the recent window."""
    return (deliveries.filter(_recent_failure(deliveries, as_of, settings))
            .groupBy(F.col("user_id").cast("string").alias("userid"))
            .agg(F.count("*").alias("num"))
            .filter(F.col("num") >= settings.min_failures))


def sms_hard_failures(deliveries: DataFrame, settings: SmsSettings = SmsSettings()) -> DataFrame:
    """(userid) of users with a permanent failure at any time."""
    return (deliveries.filter(_hard_failure(settings))
            .select(F.col("user_id").cast("string").alias("userid")).distinct())


def sms_blacklist(deliveries: DataFrame, previous: DataFrame | None, as_of: Day,
                  settings: SmsSettings = SmsSettings(),
                  uncovered: Sequence[DayRange] | None = None) -> DataFrame:
    """Today's blacklist: yesterday's users and those who fail now.

    The log is scanned once, and the previous list joins the same grouping:
    one shuffle with map-side combine.  Users never leave the list.

    Permanent failures count at any time, so the whole log is read; the
    scan takes only failures of either kind from it.  With ``uncovered``, the
    days whose permanent failures the previous list does not hold yet, only
    these and the recent window are read, and permanent failures without a
    time.
    """
    recent = _recent_failure(deliveries, as_of, settings)
    hard = _hard_failure(settings)
    if uncovered is not None:
        hard &= in_ranges(deliveries, "event_captured_dt", uncovered) | F.col("event_captured_dt").isNull()
    listed = (deliveries.filter(recent | hard)
              .select(F.col("user_id").cast("string").alias("userid"),
                      F.when(recent, F.lit(1).cast("long")).otherwise(0).alias("failures"),
                      F.coalesce(hard, F.lit(False)).alias("certain")))
    if previous is not None:
        listed = listed.union(previous.select(
            F.col("userid"), F.lit(0).cast("long").alias("failures"), F.lit(True).alias("certain")))
    users = (listed.groupBy("userid")
             .agg(F.sum("failures").alias("failures"), F.bool_or("certain").alias("certain"))
             .filter(F.col("certain") | (F.col("failures") >= settings.min_failures)))
    return tag_rows(users, TAG_IDS["sms_blacklist"], "userid")
