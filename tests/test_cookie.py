import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import rows
from tagloom.operators import cookie

LINKS = "cookie_id string, userid bigint, last_time string, last_date string"
TAGS = "userid string, tagid string"


def test_oldest_link_wins(spark):
    links = spark.createDataFrame([
        ("a", 1, "2024-01-02", "x"), ("a", 2, "2024-01-01", "x"),
        ("b", 1, "2024-01-01", "x"), ("b", 2, None, "x"),          # no time is oldest
        ("c", 1, "2024-01-01", "y"), ("c", 2, "2024-01-01", "x"),  # then the date
        ("d", 1, "2024-01-01", "x"), ("d", 3, "2024-01-01", "x"),  # then the highest id
        (None, 1, "2024-01-01", "x"), ("e", None, "2024-01-01", "x")], LINKS)
    assert rows(cookie.cookie_user_binding(links), "cookieid", "userid") == [
        ("a", 2), ("b", 2), ("c", 2), ("d", 3)]
    assert rows(cookie.cookie_user_binding(links, latest=True), "cookieid", "userid") == [
        ("a", 1), ("b", 1), ("c", 1), ("d", 3)]


def test_tags_are_mapped_and_distinct(spark):
    tags = spark.createDataFrame([
        ("1", "A111U008_001"), ("1", "A111U008_001"), ("1", "A111U008_007"),
        ("2", "A111U008_008"), ("2", "B000X000_001"), ("2", None), ("3", "A111U008_002")], TAGS)
    binding = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "userid bigint, cookieid string")
    result = cookie.cookie_rfm_tag(tags, binding)
    assert result.columns == ["tagid", "cookieid", "tagweight", "tagranking", "reserve", "reserve1"]
    assert rows(result, "tagid", "cookieid") == [
        ("A111H008_001", "a"), ("A111H008_001", "b"), ("A111H008_007", "a"),
        ("A111H008_007", "b"), ("A111H008_008", "c")]


LINK = st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([1, 2, 3, None]),
                 st.sampled_from(["1", "2", None]), st.sampled_from(["1", "2", None]))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LINK, max_size=20))
def test_binding_equals_sorting(spark, links):
    usable = [l for l in links if l[0] is not None and l[1] is not None]
    key = lambda l: (l[2] is not None, l[2] or "", l[3] is not None, l[3] or "", -l[1])
    expected = sorted((c, min(group, key=key)[1]) for c, group in itertools.groupby(
        sorted(usable, key=lambda l: l[0]), key=lambda l: l[0])
        for group in [list(group)])
    df = spark.createDataFrame(links, LINKS)
    assert rows(cookie.cookie_user_binding(df), "cookieid", "userid") == expected


def test_user_with_a_third_of_the_cookies_is_split(spark, changed_conf, tmp_path):
    changed_conf(spark__sql__autoBroadcastJoinThreshold="-1",
                 spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
                 spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10k",
                 spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
                 spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
                 spark__sql__adaptive__coalescePartitions__enabled="false",
                 spark__sql__shuffle__partitions="16")
    links = spark.range(60000).selectExpr(
        "concat('c', id) AS cookie_id", "IF(id % 3 = 0, 7, id % 1000) AS userid",
        "'t' AS last_time", "'d' AS last_date")
    tags = spark.range(1000).selectExpr("CAST(id AS STRING) AS userid", "'A111U008_001' AS tagid")
    result = cookie.cookie_rfm_tag(tags.union(tags), cookie.cookie_user_binding(links))
    found = result.collect()
    assert len(found) == len({r.cookieid for r in found}) == 60000
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("latest", [False, True])
def test_links_merge_day_by_day(spark, tmp_path, latest):
    rng = random.Random(4)
    times = [None, "2024-01-01 10:00:00", "2024-01-02 08:00:00", "2024-01-02 09:00:00", "2024-01-03 00:00:00",
             "2024-01-05 23:59:59"]
    links = spark.createDataFrame(
        [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3, -7]), rng.choice(times), rng.choice([None, "1", "2"]))
         for _ in range(200)], "cookie_id string, userid bigint, last_time string, last_date string")
    state = cookie.CookieLinks(spark, f"{tmp_path}/links", latest)
    with pytest.raises(LookupError):
        state.run_day(links, "20240102")
    for n in range(1, 6):
        day = f"2024010{n}"
        seen = links.filter(links.last_time.isNull() | (links.last_time < f"2024-01-0{n + 1}"))
        for _ in range(2):
            found = cookie.binding_of(state.run_day(links, day, bootstrap=n == 1))
            assert rows(found) == rows(cookie.cookie_user_binding(seen, latest))


def test_best_links_of_empty_and_null_links(spark):
    schema = "cookie_id string, userid bigint, last_time string, last_date string"
    assert rows(cookie.best_links(spark.createDataFrame([], schema))) == []
    none = spark.createDataFrame([("a", None, "1", "1"), (None, 1, "1", "1"), ("b", 5, None, None)], schema)
    assert rows(cookie.best_links(none)) == [("b", None, None, 5)]
