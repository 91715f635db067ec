import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import rows
from tagloom.operators import sms

DAY = dt.date(2024, 1, 31)
LOG = "user_id bigint, status_code string, event_captured_dt timestamp"


def log(spark, items):
    return spark.createDataFrame(
        [(u, c, None if d is None else dt.datetime.combine(DAY + dt.timedelta(d), dt.time(23, 59)))
         for u, c, d in items], LOG)


def previous(spark, *users):
    return spark.createDataFrame([(u,) for u in users], "userid string")


def test_repeat_failures(spark):
    df = log(spark, [(1, "2", -14), (1, "2", 0), (1, "x", -3),
                     (2, "2", -15), (2, "2", 0), (2, "2", 0),      # one is too old
                     (3, "2", 1), (3, "2", 0), (3, "2", 0),        # one is in the future
                     (4, "0", 0), (4, None, 0), (4, "2", 0), (4, "2", 0),
                     (None, "2", 0), (None, "2", 0), (None, "2", 0)])
    assert rows(sms.sms_repeat_failures(df, DAY)) == [(None, 3), ("1", 3)]


def test_hard_failures_ignore_the_day(spark):
    df = log(spark, [(1, "9", -900), (1, "10", 5), (2, "2", 0), (3, "21", None), (4, None, 0)])
    assert rows(sms.sms_hard_failures(df)) == [("1",), ("3",)]


def test_blacklist_adds_to_the_previous_day(spark):
    df = log(spark, [(1, "2", 0), (1, "2", 0), (1, "2", 0), (2, "9", -100), (3, "2", 0),
                     (None, "2", 0), (None, "2", 0), (None, "2", -1)])
    today = sms.sms_blacklist(df, previous(spark, "3", "7", "2", "2"), DAY)
    assert rows(today, "tagid", "userid") == [("B120U037_003", u) for u in (None, "1", "2", "3", "7")]
    assert rows(sms.sms_blacklist(df, None, DAY), "userid") == [(None,), ("1",), ("2",)]


def test_hard_failures_count_at_any_time(spark):
    df = log(spark, [(1, "9", -20), (2, "9", -2), (3, "2", -14), (3, "2", -14), (3, "2", -14),
                     (4, "9", None)])
    full = sms.sms_blacklist(df, previous(spark), DAY)
    assert rows(full, "userid") == [("1",), ("2",), ("3",), ("4",)]
    assert rows(sms.sms_blacklist(df, previous(spark, "1", "4"), DAY)) == rows(full)


ENTRY = st.tuples(st.sampled_from([1, 2, 3, None]), st.sampled_from(["0", "2", "9", None]),
                  st.integers(-17, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ENTRY, max_size=25), st.sets(st.sampled_from(["1", "2", "8", None])))
def test_one_pass_equals_the_union_and_only_grows(spark, entries, before):
    df = log(spark, entries)
    state = previous(spark, *before)
    today = {r.userid for r in sms.sms_blacklist(df, state, DAY).collect()}
    parts = (sms.sms_repeat_failures(df, DAY).select("userid")
             .union(sms.sms_hard_failures(df)).union(state).collect())
    assert today == {r.userid for r in parts} >= before
    again = sms.sms_blacklist(df, previous(spark, *today), DAY).collect()
    assert sorted(map(str, today)) == sorted(str(r.userid) for r in again)


def test_log_is_scanned_once(spark, tmp_path):
    path = str(tmp_path / "log")
    log(spark, [(1, "9", 0)]).write.parquet(path)
    plan = sms.sms_blacklist(spark.read.parquet(path), previous(spark, "1"), DAY)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "PushedFilters: [Or(" in text
