import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest

from frames import rows
from pyspark.sql import functions as F
from tagloom.commits import CommitLog
from tagloom.functions.tagrows import tag_schema
from tagloom.operators import writer
from tagloom.operators.writer import CatalogTagTable, PathTagTable, PublishedTagTable
from tagloom.plans import daily

DAY, NEXT = "20240130", "20240131"
TAGS = "tagid string, userid bigint, tagweight double, tagranking string, reserve string, reserve1 string"


@pytest.fixture(params=["path", "published", "catalog"])
def tags(request, spark, tmp_path):
    if request.param == "path":
        yield PathTagTable(spark, str(tmp_path / "tags"))
    elif request.param == "published":
        yield PublishedTagTable(spark, str(tmp_path / "tags"))
    else:
        table = CatalogTagTable(spark, "tags_under_test")
        table.create()
        yield table
        spark.sql("DROP TABLE tags_under_test")


def some(spark, *users):
    return spark.createDataFrame([("T", u, 3.5, "", "", "") for u in users], TAGS)


def content(tags):
    return rows(tags.read(), "data_date", "tagtype", "userid")


def test_overwrite_replaces_one_partition(spark, tags):
    assert tags.overwrite(some(spark, 1, 2), DAY, "a") == {"a": 2}
    tags.overwrite(some(spark, 3), DAY, "b")
    tags.overwrite(some(spark, 4), NEXT, "a")
    assert tags.overwrite(some(spark, 5), DAY, "a") == {"a": 1}
    assert content(tags) == [(DAY, "a", "5"), (DAY, "b", "3"), (NEXT, "a", "4")]
    assert sorted(tags.read().columns) == sorted(tag_schema().fieldNames())
    assert rows(tags.partition(DAY, "a"), "tagid", "userid", "tagweight", "data_date") == [
        ("T", "5", "3.5", DAY)]


def test_empty_result_empties_the_partition(spark, tags):
    tags.overwrite(some(spark, 1), DAY, "a")
    tags.overwrite(some(spark, 2), DAY, "b")
    assert tags.overwrite(some(spark), DAY, "a") == {"a": 0}
    assert content(tags) == [(DAY, "b", "2")]
    assert tags.exists(DAY, "a") and not tags.exists(NEXT, "a")
    assert rows(tags.partition(DAY, "a")) == []


def test_several_types_in_one_write(spark, tags):
    from pyspark.sql import functions as F
    tags.overwrite(some(spark, 9), DAY, "c")
    tags.overwrite(some(spark, 8), DAY, "other")
    mixed = some(spark, 1, 2, 3).withColumn("tagtype", F.when(F.col("userid") < 3, "a").otherwise("b"))
    assert tags.overwrite(mixed, DAY, ["a", "b", "c"]) == {"a": 2, "b": 1, "c": 0}
    assert content(tags) == [(DAY, "a", "1"), (DAY, "a", "2"), (DAY, "b", "3"), (DAY, "other", "8")]


def test_a_missing_partition_has_no_rows(spark, tags):
    tags.overwrite(some(spark, 1), DAY, "a")
    assert rows(tags.partition(NEXT, "a")) == [] and rows(tags.partition(DAY, "b")) == []
    assert tags.partition(NEXT, "a").columns == tags.partition(DAY, "a").columns


def sms(spark, *entries):
    moment = lambda day: dt.datetime.strptime(day, "%Y%m%d")
    return {"sms_delivered": lambda: spark.createDataFrame(
        [(u, c, moment(d)) for u, c, d in entries], "user_id bigint, status_code string, event_captured_dt timestamp")}


def test_blacklist_reads_and_writes_one_table(spark, tags):
    with pytest.raises(LookupError):
        daily.run_sms_blacklist(sms(spark), tags, DAY)
    daily.run_sms_blacklist(sms(spark, (1, "9", DAY)), tags, DAY, bootstrap=True)
    assert daily.run_sms_blacklist(sms(spark, (2, "9", NEXT)), tags, NEXT) == {"sms_blacklist": 2}
    # A repeat of the day gives the same partition.
    daily.run_sms_blacklist(sms(spark, (2, "9", NEXT)), tags, NEXT)
    assert content(tags) == [(DAY, "sms_blacklist", "1"), (NEXT, "sms_blacklist", "1"),
                             (NEXT, "sms_blacklist", "2")]
    with pytest.raises(LookupError):
        daily.run_sms_blacklist(sms(spark), tags, "20240202")


def test_blacklist_continues_from_an_empty_day(spark, tags):
    daily.run_sms_blacklist(sms(spark), tags, DAY, bootstrap=True)
    assert daily.run_sms_blacklist(sms(spark, (2, "9", NEXT)), tags, NEXT) == {"sms_blacklist": 1}


def test_partition_read_is_pruned(spark, tags):
    tags.overwrite(some(spark, 1), DAY, "a")
    tags.overwrite(some(spark, 1), NEXT, "a")
    assert len(tags.partition(DAY, "a").inputFiles()) >= 1
    plan = tags.partition(DAY, "a").select("userid")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ReadSchema: struct<userid:string>" in plan
    if isinstance(tags, PathTagTable):
        assert all(DAY in path for path in tags.partition(DAY, "a").inputFiles())


@pytest.mark.parametrize("kind", ["typo", None])
def test_a_tag_type_that_is_not_named_fails_and_changes_nothing(spark, tags, kind):
    tags.overwrite(some(spark, 1), DAY, "x")
    mixed = some(spark, 2, 3).withColumn("tagtype", F.when(F.col("userid") == 2, F.lit("x")).otherwise(F.lit(kind)))
    with pytest.raises(Exception, match="not named for this write"):
        tags.overwrite(mixed, DAY, ["x", "y"])
    assert content(tags) == [(DAY, "x", "1")]


def test_many_days_in_one_write(spark, tags):
    tags.overwrite(some(spark, 9), DAY, "a")
    tags.overwrite(some(spark, 8), DAY, "other")
    tags.overwrite(some(spark, 7), NEXT, "a")
    mixed = some(spark, 1, 2, 3).withColumn("data_date", F.when(F.col("userid") < 3, "20240129").otherwise(NEXT))
    assert tags.overwrite_days(mixed, "20240129", NEXT, "a") == {"20240129": 2, DAY: 0, NEXT: 1}
    assert content(tags) == [("20240129", "a", "1"), ("20240129", "a", "2"), (DAY, "other", "8"), (NEXT, "a", "3")]
    assert tags.exists(DAY, "a")
    with pytest.raises(Exception, match="not named for this write"):
        tags.overwrite_days(mixed, DAY, NEXT, "a")
    assert len(content(tags)) == 4


def test_threads_keep_each_others_partitions_and_settings(spark, tags):
    """Writers in one session, of several types of a day and of several days, while settings are read."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before, seen = spark.conf.get(mode, None), set()
    tags.overwrite(some(spark, 0), DAY, "kept")

    def write(n):
        tags.overwrite(some(spark, n, n + 100), DAY if n % 2 else NEXT, f"t{n}")
        seen.add(spark.conf.get(mode, None))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(1, 9)))
    assert content(tags) == sorted([(DAY, "kept", "0")] + [
        (DAY if n % 2 else NEXT, f"t{n}", str(u)) for n in range(1, 9) for u in (n, n + 100)])
    assert seen == {before}


def test_an_interrupted_write_leaves_the_old_day(spark, tmp_path, monkeypatch):
    tags = PublishedTagTable(spark, f"{tmp_path}/tags")
    mixed = some(spark, 1, 2).withColumn("tagtype", F.when(F.col("userid") < 2, "a").otherwise("b"))
    tags.overwrite(mixed, DAY, ["a", "b"])
    before = content(tags)
    # Lost while rows are written: half of them fail.
    bad = mixed.withColumn("reserve", F.when(F.col("userid") == 2, F.raise_error(F.lit("lost"))).otherwise("")).cache()
    with pytest.raises(Exception, match="lost"):
        tags.overwrite(bad, DAY, ["a", "b"])
    assert content(tags) == before
    # Lost between the rows and the commit.
    with monkeypatch.context() as patch:
        patch.setattr(writer.DayFolder, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            tags.overwrite(some(spark, 7, 8).withColumn("tagtype", F.lit("a")), DAY, ["a", "b"])
    assert content(tags) == before
    tags.overwrite(some(spark, 7).withColumn("tagtype", F.lit("a")), DAY, ["a", "b"])
    assert content(tags) == [(DAY, "a", "7")] and tags.exists(DAY, "b")
    assert tags.days.vacuum() == 3 and content(tags) == [(DAY, "a", "7")]


def test_numbered_documents_add_up(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.read() == {}
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(lambda n: log.update(lambda old: {**old, str(n): n}), range(20)))
    assert log.read() == {str(n): n for n in range(20)}
    assert len(log._numbers()) == 5
    # Another process has taken the next number: the change is applied to its document.
    number, found = log._read()
    calls = []

    def change(old):
        if not calls:
            assert log._put(number + 1, {**old, "other": 1})
        calls.append(old)
        return {**old, "own": 1}

    log.update(change)
    assert log.read() == {**found, "other": 1, "own": 1} and len(calls) == 2
