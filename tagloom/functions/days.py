"""Calendar-day helpers that keep filters on the raw column.

Day columns arrive as ``yyyy-MM-dd...`` strings, dates, timestamps (with or
without zone) or epoch seconds.  ``in_days`` turns an inclusive day range into
a half-open range on the column itself, so the scan can use it for pushdown
and file skipping.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Day = dt.date | str


def parse_day(day: Day) -> dt.date:
    """A date from a date, ``yyyyMMdd`` or ``yyyy-MM-dd``."""
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    layout = "%Y-%m-%d" if "-" in day else "%Y%m%d"
    return dt.datetime.strptime(day, layout).date()


def partition_value(day: Day) -> str:
    """The ``data_date`` partition value of a day."""
    return parse_day(day).strftime("%Y%m%d")


def days_before(day: Day, days: int) -> dt.date:
    return parse_day(day) - dt.timedelta(days=days)


def _start_of(day: dt.date, kind: T.DataType) -> Column:
    """The first value of a day in a column of type ``kind``."""
    if isinstance(kind, T.StringType):
        return F.lit(day.isoformat())
    if isinstance(kind, T.IntegralType):
        return F.unix_timestamp(F.lit(day).cast("timestamp"))
    return F.lit(day).cast(kind)


def since_day(df: DataFrame, column: str, first: Day) -> Column:
    """Rows of ``df`` whose ``column`` falls on ``first`` or a later day."""
    return F.col(column) >= _start_of(parse_day(first), df.schema[column].dataType)


def until_day(df: DataFrame, column: str, last: Day) -> Column:
    """Rows of ``df`` whose ``column`` falls on ``last`` or an earlier day."""
    return F.col(column) < _start_of(days_before(last, -1), df.schema[column].dataType)


def in_days(df: DataFrame, column: str, first: Day, last: Day) -> Column:
    """Rows of ``df`` whose ``column`` falls on a day in [first, last]."""
    return since_day(df, column, first) & until_day(df, column, last)


def day_of(df: DataFrame, column: str) -> Column:
    """The calendar day of ``column``; NULL when a string holds no date."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.substring(value, 1, 10).try_cast("date")
    if isinstance(kind, T.IntegralType):
        value = F.timestamp_seconds(value)
    return F.to_date(value)
