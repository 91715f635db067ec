"""Merging the folders of stream batches."""

import pytest

from frames import rows
from pyspark.sql import types as T
from tagloom.streaming import events, sinks
from tagloom.streaming.offsets import OffsetLedger
from tagloom.streaming.runner import BatchKey
from tagloom.streaming.sinks import BatchFolder, merging

SCHEMA = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def batch(spark, *words):
    return spark.createDataFrame([(w, 1) for w in words], SCHEMA)


@pytest.fixture(params=[SCHEMA, None])
def sink(request, spark, tmp_path):
    folder = BatchFolder(spark, f"{tmp_path}/counts", request.param)
    for query in ("q", "other"):
        for n in range(6):
            folder.write(batch(spark, f"{query}{n}", "same"), BatchKey(query, n))
    return folder


def folders(tmp_path):
    return sorted(p.name for p in (tmp_path / "counts" / "query_id=q").iterdir())


def test_merged_batches_read_the_same(spark, sink, tmp_path):
    before = rows(sink.read(), "query_id", "batch_id", "word", "n")
    assert len(before) == 24 and sink.read().columns == ["word", "n", "query_id", "batch_id"]
    assert sink.merge() == 10 and sink.merge() == 0
    assert rows(sink.read(), "query_id", "batch_id", "word", "n") == before
    assert len(folders(tmp_path)) == 6                       # still there for readers that have listed them
    sink.write(batch(spark, "late"), BatchKey("q", 6))
    assert sink.merge() == 1 and folders(tmp_path) == ["batch_id=5", "batch_id=6"]
    assert rows(sink.read(), "query_id", "batch_id", "word", "n") == sorted(before + [("q", 6, "late", 1)])
    assert sink.read().schema["batch_id"].dataType == T.LongType()


def test_merged_folders_are_merged(spark, sink):
    before = rows(sink.read())
    for n in range(6, 12):
        sink.write(batch(spark, "x"), BatchKey("q", n))
        assert sink.merge(runs=3) > 0
        assert len(sink._log.read()["runs"]) <= 3
    assert len(rows(sink.read())) == len(before) + 6


def test_the_newest_batch_can_be_repeated_and_a_merged_one_stays(spark, sink):
    sink.merge()
    sink.write(batch(spark, "again"), BatchKey("q", 5))
    sink.write(batch(spark, "lost"), BatchKey("q", 2))
    found = rows(sink.read(), "query_id", "batch_id", "word")
    assert ("q", 5, "again") in found and ("q", 5, "same") not in found
    assert ("q", 2, "q2") in found and ("q", 2, "lost") not in found


@pytest.mark.parametrize("moment", ["data", "commit", "delete"])
def test_an_interrupted_merge_loses_nothing(spark, sink, monkeypatch, moment):
    before = rows(sink.read(), "query_id", "batch_id", "word", "n")
    sink.merge(keep=3)

    def fail(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        if moment == "data":
            patch.setattr(BatchFolder, "_rows", fail)
        elif moment == "commit":
            patch.setattr(sinks.CommitLog, "update", fail)
        else:
            patch.setattr(sinks, "delete_path", fail)
        with pytest.raises(RuntimeError):
            sink.merge()
    assert rows(sink.read(), "query_id", "batch_id", "word", "n") == before
    sink.merge()
    assert rows(sink.read(), "query_id", "batch_id", "word", "n") == before


def test_a_reader_with_a_schema_opens_no_file_for_it(spark, tmp_path):
    sink = BatchFolder(spark, f"{tmp_path}/none", SCHEMA)
    assert rows(sink.read()) == [] and sink.merge() == 0
    sink.write(batch(spark), BatchKey("q", 0))
    assert rows(sink.read()) == []


def test_an_unfinished_batch_is_not_read(spark, sink, tmp_path):
    before = rows(sink.read())
    (tmp_path / "counts" / "query_id=q" / "batch_id=5" / "_SUCCESS").unlink()
    assert len(rows(sink.read())) == len(before) - 2


def test_handlers_merge_now_and_then(spark, tmp_path):
    sink = BatchFolder(spark, f"{tmp_path}/counts", SCHEMA)
    handle = merging(sink.write, sink, every=4)
    for n in range(9):
        handle(batch(spark, str(n)), BatchKey("q", n))
    assert sink._log.read()["upto"] == {"q": 6} and len(rows(sink.read())) == 9


def test_a_merged_batch_is_still_measured(spark, tmp_path):
    sink = BatchFolder(spark, f"{tmp_path}/e", events.EVENTS)
    ledger = OffsetLedger(spark, f"{tmp_path}/l")
    handle = events.recorded(events.append_handler(sink), ledger, partitions=[("t", 0, 0)])
    rows_of = spark.createDataFrame([("bad", "t", 0, 4)], "value string, topic string, partition int, offset bigint")
    for n in (0, 1):
        handle(rows_of, BatchKey("q", n))
    assert sink.merge() == 1
    handle(rows_of, BatchKey("q", 0))
    assert sink.read().count() == 2 and rows(ledger.read()) == [("t", 0, 5)]
