"""Which days of a source a state holds."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..commits import CommitLog
from ..functions.days import Day, days_before, in_days, parse_day, partition_value, until_day

#: First and last day, both inside; no first day means from the beginning.
DayRange = tuple[dt.date | None, dt.date]


class GapError(LookupError):
    """A state lacks days that lie before others it holds."""


def merge_ranges(ranges: Iterable[DayRange]) -> list[DayRange]:
    """The same days in as few ranges as possible, in order."""
    out: list[DayRange] = []
    for first, last in sorted(ranges, key=lambda r: (r[0] or dt.date.min, r[1])):
        if out and first is not None and first > days_before(out[-1][1], -1):
            out.append((first, last))
        elif out:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def without_days(ranges: Iterable[DayRange], days: Iterable[Day]) -> list[DayRange]:
    """``ranges`` with single days taken out."""
    out = list(ranges)
    for day in map(parse_day, days):
        cut: list[DayRange] = []
        for first, last in out:
            if day > last or (first is not None and day < first):
                cut.append((first, last))
                continue
            if first is None or first < day:
                cut.append((first, days_before(day, 1)))
            if day < last:
                cut.append((days_before(day, -1), last))
        out = cut
    return out


def missing_ranges(held: Sequence[DayRange], last: Day) -> tuple[list[DayRange], list[DayRange]]:
    """Days up to ``last`` that are not held: those between held days, and those after the last one."""
    held, last = merge_ranges(held), parse_day(last)
    if not held:
        return [], [(None, last)]
    gaps = [(None, days_before(held[0][0], 1))] if held[0][0] is not None else []
    gaps += [(days_before(a[1], -1), days_before(b[0], 1)) for a, b in zip(held, held[1:])]
    gaps = [(first, min(end, last)) for first, end in gaps if first is None or first <= last]
    tail = [(days_before(held[-1][1], -1), last)] if held[-1][1] < last else []
    return gaps, tail


def in_ranges(df: DataFrame, column: str, ranges: Iterable[DayRange]) -> Column:
    """Rows whose ``column`` falls into one of the ranges; filters on the raw column."""
    inside = F.lit(False)
    for first, last in ranges:
        inside |= until_day(df, column, last) if first is None else in_days(df, column, first, last)
    return inside


@dataclass(frozen=True)
class CoveredDays:
    """The source days behind each day's state, kept beside it under a path."""

    spark: SparkSession
    location: str

    def _log(self, day: Day) -> CommitLog:
        return CommitLog(self.spark, f"{self.location}/{partition_value(day)}")

    def of(self, day: Day) -> list[DayRange] | None:
        """Ranges that the state of ``day`` holds; None if nothing was recorded."""
        ranges = self._log(day).read().get("ranges")
        return None if ranges is None else [(first and parse_day(first), parse_day(last)) for first, last in ranges]

    def record(self, day: Day, ranges: Iterable[DayRange]) -> None:
        found = [[first and partition_value(first), partition_value(last)] for first, last in merge_ranges(ranges)]
        self._log(day).update(lambda old: {"ranges": found})

    def to_read(self, day: Day, bootstrap: bool = False, fill_gaps: bool = False) -> list[DayRange]:
        """What the state of ``day`` has to read on top of the day before.

        Days missing between held ones are an error, because nobody would
        notice them later, unless they are to be read now.
        """
        held = self.of(days_before(day, 1))
        if held is None:
            if bootstrap:
                return [(None, parse_day(day))]
            raise LookupError(f"{self.location} does not say which days the state of "
                              f"{partition_value(days_before(day, 1))} holds")
        gaps, tail = missing_ranges(held, day)
        if gaps and not fill_gaps:
            raise GapError(f"{self.location}: days missing before {partition_value(day)}: " + ", ".join(
                f"{first or 'the beginning'} to {last}" for first, last in gaps))
        return gaps + tail
