"""Covered days, and a blacklist that reads only the days it lacks."""

import datetime as dt

import pytest

from frames import rows
from hypothesis import given
from hypothesis import strategies as st
from tagloom.functions.days import days_before
from tagloom.operators import coverage, sms
from tagloom.operators.coverage import CoveredDays, GapError
from tagloom.operators.writer import PathTagTable
from tagloom.plans import daily

ZERO = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else ZERO + dt.timedelta(n)


def days_of(ranges, low=-5, high=60):
    return {n for n in range(low, high) for a, b in ranges if (a is None or a <= day(n)) and day(n) <= b}


RANGES = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 40)), st.integers(0, 12)).map(
    lambda r: (day(r[0]), day((r[0] or 0) + r[1]))), max_size=6)


@given(RANGES, st.lists(st.integers(-3, 55), max_size=4), st.integers(0, 50))
def test_ranges_are_sets_of_days(ranges, absent, last):
    merged = coverage.merge_ranges(ranges)
    assert days_of(merged) == days_of(ranges) and coverage.merge_ranges(merged) == merged
    left = coverage.without_days(ranges, [day(n) for n in absent])
    assert days_of(left) == days_of(ranges) - set(absent)
    gaps, tail = coverage.missing_ranges(ranges, day(last))
    wanted = {n for n in range(-5, last + 1)}
    assert days_of(gaps) | days_of(tail) == wanted - days_of(ranges) and not days_of(gaps) & days_of(tail)
    assert all(b < merged[-1][1] for _, b in gaps) if merged else not gaps


LOG = "user_id bigint, status_code string, event_captured_dt string"
HARD = [(n, "9", str(day(n))) for n in range(12)] + [(100, "9", None), (101, "2", None)]
SOFT = [(50 + u, "2", f"{day(n)} 10:00:00") for u in range(4) for n in range(u, u + 3)]


def run(spark, tmp_path, log, n, **options):
    tags = PathTagTable(spark, f"{tmp_path}/tags")
    sources = {"sms_delivered": lambda: log}
    daily.run_sms_blacklist(sources, tags, day(n), covered=CoveredDays(spark, f"{tmp_path}/covered"), **options)
    return {r.userid for r in tags.partition(day(n), "sms_blacklist").collect()}


def full(log, n):
    """The chain from day 2 on, each day with all permanent failures up to its end."""
    seen = log.filter(log.event_captured_dt.isNull() | (log.event_captured_dt < str(day(n + 1))))
    listed = None
    for k in range(2, n + 1):
        listed = sms.sms_blacklist(seen.filter(seen.event_captured_dt.isNull() | (seen.event_captured_dt < str(day(k + 1)))),
                                   listed, day(k))
    return {r.userid for r in listed.collect()}


def test_a_day_reads_what_is_not_covered(spark, tmp_path):
    log = spark.createDataFrame(HARD + SOFT, LOG)
    with pytest.raises(LookupError):
        run(spark, tmp_path, log, 2)
    assert run(spark, tmp_path, log, 2, bootstrap=True) == full(log, 2)
    for n in (3, 4, 4, 5):
        assert run(spark, tmp_path, log, n) == full(log, n)
    # Days that are covered are not read again: a row added to them later is not found.
    later = log.union(spark.createDataFrame([(900, "9", str(day(1))), (901, "9", str(day(6)))], LOG))
    found = run(spark, tmp_path, later, 6)
    assert found == full(log, 6) | {"901"}


def test_a_hole_is_an_error_until_it_is_filled(spark, tmp_path):
    log = spark.createDataFrame(HARD + SOFT, LOG)
    arrived = log.filter(log.event_captured_dt.isNull() | ~log.event_captured_dt.startswith(str(day(4))))
    run(spark, tmp_path, arrived, 2, bootstrap=True)
    run(spark, tmp_path, arrived, 3)
    assert "4" not in run(spark, tmp_path, arrived, 4, absent=[day(4)])
    covered = CoveredDays(spark, f"{tmp_path}/covered")
    assert covered.of(day(4)) == [(None, day(3))]
    # The day after can read the missing day as part of its own tail.
    assert run(spark, tmp_path, arrived, 5, absent=[day(4)]) == full(arrived, 5)
    assert covered.of(day(5)) == [(None, day(3)), (day(5), day(5))]
    with pytest.raises(GapError, match="2024-01-05 to 2024-01-05"):
        run(spark, tmp_path, log, 6)
    assert run(spark, tmp_path, log, 6, fill_gaps=True) == full(log, 6)
    assert covered.of(day(6)) == [(None, day(6))]
    assert run(spark, tmp_path, log, 7) == full(log, 7)


def test_only_uncovered_days_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(HARD, LOG).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    frame = sms.sms_blacklist(log, None, day(40), uncovered=[(day(39), day(40))])
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    filters = next(line for line in plan.splitlines() if "Filter" in line and "status_code" in line)
    assert f">= {day(39)}" in filters and f">= {days_before(day(40), 14)}" in filters
    assert "PushedFilters: [Or(" in frame._jdf.queryExecution().executedPlan().toString()
    assert rows(frame, "userid") == [("100",)]
