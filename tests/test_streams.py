"""Streams over files: batches, restarts and repeats."""

import datetime as dt
import json
from collections import Counter
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from frames import rows
from tagloom.plans import live
from tagloom.sources.kafka import after_ledger, kafka_options, topic_list, union_streams
from tagloom.streaming import events, runner, words
from tagloom.streaming.offsets import (LedgerListener, OffsetLedger, OffsetReporter, batch_offsets,
                                       progress_ranges)
from tagloom.streaming.runner import BatchKey
from tagloom.streaming.sinks import BatchFolder, JdbcTable

LOG = "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
START = dt.datetime(2024, 1, 1)


def key(batch_id, query_id="q"):
    return BatchKey(query_id, batch_id)


def message(text, partition=0, offset=0, second=0, topic="t"):
    return ("k", text, topic, partition, offset, START + dt.timedelta(seconds=second))


class Inbox:
    """A folder that stands for the topic: one file, one batch."""

    def __init__(self, spark, path):
        self.spark, self.path = spark, str(path)

    def put(self, *messages):
        self.spark.createDataFrame(messages, LOG).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return (self.spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1)
                .parquet(self.path))


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path / "inbox")


def event(second, device):
    return json.dumps({"i": {"timestamp": second}, "d": {"d": device}})


def test_word_counts_do_not_carry_over(spark, inbox, tmp_path):
    sink, seen = BatchFolder(spark, f"{tmp_path}/counts"), []
    handler = words.word_count_handler(sink, preview=seen.append)
    inbox.put(message("a b a"), message("b  "))
    inbox.put(message(" ".join(f"w{n}" for n in range(12)) + " a"))
    runner.drain_batches(inbox.stream(), handler, f"{tmp_path}/q")
    counts = Counter()
    for r in sink.read().collect():
        counts.setdefault(r.batch_id, {})[r.word] = r.n
    assert sorted(counts) == [0, 1] and sorted(map(len, counts.values())) == [2, 13]
    assert {"a": 2, "b": 2} in counts.values()
    assert sorted(map(len, seen)) == [2, 10]


def test_job_restarts_where_it_stopped(spark, inbox, tmp_path):
    out = f"{tmp_path}/job"
    inbox.put(message("a b"))
    live.start_word_count(inbox.stream(), out, available_now=True).awaitTermination()
    inbox.put(message("b c"))
    live.start_word_count(inbox.stream(), out, available_now=True).awaitTermination()
    sink = BatchFolder(spark, f"{out}/counts")
    assert rows(sink.read(), "batch_id", "word", "n") == [
        (0, "a", 1), (0, "b", 1), (1, "b", 1), (1, "c", 1)]


def test_running_query_takes_new_batches(spark, inbox, tmp_path):
    """The timed trigger of a live job."""
    inbox.put(message("a"))
    query = live.start_word_count(inbox.stream(), f"{tmp_path}/job")
    try:
        query.processAllAvailable()
        inbox.put(message("b"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(BatchFolder(spark, f"{tmp_path}/job/counts").read(), "batch_id", "word", "n") == [
        (0, "a", 1), (1, "b", 1)]


def brute_windows(messages, length, slide):
    counts = Counter()
    for text, second in messages:
        for word in text.split(" "):
            start = second // slide * slide
            while start > second - length:
                counts[(start, start + length, word)] += 1
                start -= slide
    return counts


def seconds_of(counts):
    return {(int((r.window_start - START).total_seconds()), int((r.window_end - START).total_seconds()),
             r.word): r.n for r in counts.collect()}


SPOKEN = [("a b", 0), ("a", 1), ("a", 2), ("b", 59), ("a", 60), ("c c", 61), ("a", 200)]


def test_window_counts_of_a_table(spark):
    df = spark.createDataFrame([message(t, second=s) for t, s in SPOKEN], LOG)
    assert seconds_of(words.window_word_counts(df)) == brute_windows(SPOKEN, 60, 2)
    assert (seconds_of(words.window_word_counts(df, length=12, slide=4))
            == brute_windows(SPOKEN, 12, 4))
    with pytest.raises(ValueError):
        words.window_word_counts(df, length=10, slide=4)


def test_window_counts_of_a_stream(spark, inbox, tmp_path):
    for start in range(0, len(SPOKEN), 2):
        inbox.put(*(message(t, second=s) for t, s in SPOKEN[start:start + 2]))
    out = f"{tmp_path}/job"
    live.start_window_word_count(inbox.stream(), out, available_now=True).awaitTermination()
    closed = {k: n for k, n in brute_windows(SPOKEN, 60, 2).items() if k[1] <= 200 - 60}
    schema = words.window_word_counts(inbox.stream()).schema
    assert seconds_of(spark.read.schema(schema).parquet(f"{out}/counts")) == closed
    # Later input closes the rest.
    inbox.put(message("z", second=900))
    live.start_window_word_count(inbox.stream(), out, available_now=True).awaitTermination()
    assert seconds_of(spark.read.schema(schema).parquet(f"{out}/counts")) == brute_windows(SPOKEN, 60, 2)


def test_union(spark, tmp_path):
    inboxes = [Inbox(spark, tmp_path / f"in{n}") for n in range(3)]
    for n, box in enumerate(inboxes):
        box.put(message(f"m{n}"), message("same"))
    united = union_streams(*(box.stream() for box in inboxes))
    assert rows(runner.drain(united, f"{tmp_path}/u"), "value") == [
        ("m0",), ("m1",), ("m2",), ("same",), ("same",), ("same",)]


def test_extract_job(spark, inbox, tmp_path):
    out = f"{tmp_path}/job"
    inbox.put(message(event(60, "x"), 0, 5), message("bad", 1, 7), message(event(61, "y"), 0, 6))
    live.start_event_extract(inbox.stream(), out, available_now=True).awaitTermination()
    inbox.put(message(event(62, "z"), 1, 8))
    live.start_event_extract(inbox.stream(), out, available_now=True).awaitTermination()
    assert rows(BatchFolder(spark, f"{out}/events").read(), "batch_id", "data_date", "cookies_num") == [
        (0, "(unknown)", "(unknown)"), (0, "1970-01-01 00:01:00", "x"),
        (0, "1970-01-01 00:01:01", "y"), (1, "1970-01-01 00:01:02", "z")]
    assert rows(BatchFolder(spark, f"{out}/counts").read(), "batch_id", "n") == [(0, 3), (1, 1)]
    assert rows(OffsetLedger(spark, f"{out}/offsets").read()) == [("t", 0, 7), ("t", 1, 9)]


def test_a_repeated_batch_leaves_no_copies(spark, tmp_path):
    batch = spark.createDataFrame([message(event(60, "x"), 0, 5)], LOG)
    sink, ledger = BatchFolder(spark, f"{tmp_path}/e"), OffsetLedger(spark, f"{tmp_path}/l")
    handler = events.together(events.append_handler(sink), events.ledger_handler(ledger))
    for batch_id in (0, 0, 1, 1):
        handler(batch, key(batch_id))
    assert rows(sink.read(), "batch_id", "cookies_num") == [(0, "x"), (1, "x")]
    assert rows(ledger.read()) == [("t", 0, 6)]


def test_ledger_replaces_rows_by_key(spark, tmp_path):
    ledger = OffsetLedger(spark, f"{tmp_path}/l")
    assert rows(ledger.read()) == []

    def update(batch_id, *messages):
        ledger.update(batch_offsets(spark.createDataFrame(messages, LOG)), key(batch_id))

    update(0, message("", 0, 4), message("", 0, 9), message("", 1, 2), message("", 0, 1, topic="u"))
    update(1, message("", 0, 11))
    assert rows(ledger.read()) == [("t", 0, 12), ("t", 1, 3), ("u", 0, 2)]
    update(1, message("", 0, 11))                       # repeated
    update(5, message("", 0, 0))                        # the topic began again
    assert rows(ledger.read()) == [("t", 0, 1), ("t", 1, 3), ("u", 0, 2)]
    assert len(list((tmp_path / "l" / "query_id=q").iterdir())) == 2   # it does not grow with the batches


def test_ledger_survives_a_broken_write(spark, tmp_path):
    ledger = OffsetLedger(spark, f"{tmp_path}/l")
    offsets = batch_offsets(spark.createDataFrame([message("", 0, 4)], LOG))
    ledger.update(offsets, key(0))
    left = tmp_path / "l" / "query_id=q" / "slot=1" / "_temporary" / "0"
    left.mkdir(parents=True)                            # batch 1 died without a commit
    (left / "part-0.parquet").write_bytes(b"half")
    assert rows(ledger.read()) == [("t", 0, 5)]
    ledger.update(batch_offsets(spark.createDataFrame([message("", 0, 8)], LOG)), key(1))
    assert rows(ledger.read()) == [("t", 0, 9)]


def test_start_offsets(spark):
    df = spark.createDataFrame([message("a", p, o) for p in (0, 1, 2) for o in range(3)]
                               + [message("a", 1, 9, topic="u")], LOG)
    schema = "topic string, partitionname int, untilOffset bigint"
    kept = after_ledger(df, spark.createDataFrame([("t", 1, 1), ("t", 2, 2)], schema))
    assert kept.columns == df.columns
    assert rows(kept, "topic", "partition", "offset") == [
        ("t", 0, 0), ("t", 0, 1), ("t", 0, 2), ("t", 1, 1), ("t", 1, 2), ("t", 2, 2), ("u", 1, 9)]
    assert after_ledger(df, spark.createDataFrame([], schema)).count() == df.count()


def test_ledger_as_start_offsets(spark, tmp_path):
    ledger = OffsetLedger(spark, f"{tmp_path}/l")
    assert ledger.start_offsets() == []
    ledger.update(batch_offsets(spark.createDataFrame([message("", 1, 4), message("", 0, 9)], LOG)), key(0))
    options = kafka_options("a:1", ["t"], ledger.start_offsets() + [("t", 2, -2)])
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 10, "1": 5, "2": -2}}


def test_two_checkpoints_share_a_sink_and_a_ledger(spark, inbox, tmp_path):
    """Batch numbers begin anew with a checkpoint; no run removes the rows of another."""
    sink, ledger = BatchFolder(spark, f"{tmp_path}/e"), OffsetLedger(spark, f"{tmp_path}/l")
    double = SqlDouble()
    handler = events.together(
        events.append_handler(sink), events.ledger_handler(ledger),
        events.append_handler(double.table(spark, "dau")), events.ledger_handler(double.table(spark, "places")))
    inbox.put(message(event(1, "u1"), 0, 1), message(event(2, "u2"), 0, 2), message("", 1, 7))
    runner.drain_batches(inbox.stream(), handler, f"{tmp_path}/run1")
    inbox.put(message(event(5, "u5"), 0, 5))
    runner.drain_batches(inbox.stream(), handler, f"{tmp_path}/run1")
    other = Inbox(spark, tmp_path / "other")
    other.put(message(event(9, "u100"), 0, 100))
    runner.drain_batches(other.stream(), handler, f"{tmp_path}/run2")
    expected = [(0, "(unknown)"), (0, "u1"), (0, "u100"), (0, "u2"), (1, "u5")]
    assert rows(sink.read(), "batch_id", "cookies_num") == expected
    assert double.rows("SELECT batch_id, cookies_num FROM dau") == expected
    assert rows(ledger.read()) == [("t", 0, 101), ("t", 1, 8)]
    assert double.rows("SELECT topic, partitionname, untilOffset FROM places") == [("t", 0, 101), ("t", 1, 8)]


def test_late_rows_are_reported_and_open_windows_flushed(spark, inbox, tmp_path):
    early, late = [("a", 0), ("b", 100)], [("x", 1)]
    for text, second in [*early, ("c", 200), *late]:
        inbox.put(message(text, second=second))
    closed, watermark, dropped = runner.drain_closed(words.window_word_counts(inbox.stream()), f"{tmp_path}/w")
    assert dropped == 1
    table = spark.read.schema(LOG).parquet(inbox.path)
    whole = seconds_of(closed.unionByName(words.open_window_counts(table, watermark)))
    assert whole == brute_windows([*early, ("c", 200)], 60, 2)
    waiting = words.window_word_counts(inbox.stream(), lateness="10 minutes")
    closed, watermark, dropped = runner.drain_closed(waiting, f"{tmp_path}/w2")
    assert dropped == 0
    whole = seconds_of(closed.unionByName(words.open_window_counts(table, watermark)))
    assert whole == brute_windows([*early, ("c", 200), *late], 60, 2)
    assert "GreaterThanOrEqual(timestamp" in words.open_window_counts(
        table, watermark)._jdf.queryExecution().executedPlan().toString()


def test_kafka_options():
    explicit = kafka_options("a:1,b:2", ["t"], [("t", 1, 16), ("t", 2, 25)], group_id="g")
    assert json.loads(explicit["assign"]) == {"t": [1, 2]}
    assert json.loads(explicit["startingOffsets"]) == {"t": {"1": 16, "2": 25}}
    assert explicit["kafka.bootstrap.servers"] == "a:1,b:2" and explicit["kafka.group.id"] == "g"
    assert "subscribe" not in explicit
    latest = kafka_options("a:1", topic_list("t, u"), min_partitions=30, max_offsets=1000)
    assert latest["subscribe"] == "t,u" and latest["startingOffsets"] == "latest"
    assert latest["minPartitions"] == "30" and latest["maxOffsetsPerTrigger"] == "1000"
    assert "assign" not in latest and "kafka.group.id" not in latest


def test_offset_ranges_of_a_progress():
    progress = json.dumps({"sources": [
        {"startOffset": {"t": {"0": 3, "10": 7}}, "endOffset": {"t": {"0": 5, "10": 7, "2": 4}}},
        {"startOffset": None, "endOffset": {"logOffset": 3}}]})
    assert [tuple(r) for r in progress_ranges(progress)] == [
        ("t", 0, 3, 5), ("t", 2, 4, 4), ("t", 10, 7, 7)]


def test_reporter_sees_every_batch(spark, inbox, tmp_path):
    import time
    seen = []
    reporter = OffsetReporter(lambda batch, n, ranges, late: seen.append((batch, n)))
    spark.streams.addListener(reporter)
    try:
        inbox.put(message("a"), message("b"))
        inbox.put(message("c"))
        runner.drain(inbox.stream(), f"{tmp_path}/q")
        for _ in range(100):
            if len(seen) >= 2:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(reporter)
    assert sum(n for _, n in seen) == 3


def test_console(spark, inbox, tmp_path):
    inbox.put(message("a"))
    query = runner.start_console(inbox.stream().select("value"), f"{tmp_path}/c", available_now=True)
    query.awaitTermination()
    assert query.exception() is None


class SqlDouble:
    """Runs the statements of a JDBC table in the oracle's SQL engine.

    Every append is made twice, as by a task that was repeated after it had
    committed.  The JDBC driver itself is not part of these tests.
    """

    def __init__(self):
        import duckdb
        self.con = duckdb.connect()

    def write(self, frame, url, name, properties):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frame.schema)
        self.con.execute(f"CREATE TABLE IF NOT EXISTS {name} ({columns})")
        found = [tuple(r) for r in frame.collect()] * 2
        if found:
            marks = ", ".join("?" * len(frame.columns))
            self.con.executemany(f"INSERT INTO {name} VALUES ({marks})", found)

    def transact(self, spark, url, properties, statements):
        self.con.execute("BEGIN")
        for statement in statements:
            self.con.execute(statement)
        self.con.execute("COMMIT")

    def table(self, spark, name):
        return JdbcTable(spark, "jdbc:x", name, write=self.write, transact=self.transact)

    def rows(self, query):
        return sorted(self.con.execute(query).fetchall())


def test_jdbc_events_survive_repeated_tasks_and_batches(spark):
    double = SqlDouble()
    first = spark.createDataFrame([message(event(60, "x"), 0, 5), message(event(60, "x"), 0, 6)], LOG)
    second = spark.createDataFrame([message(event(61, "y"), 1, 1)], LOG)
    # The last two batches are delivered again to a job that has restarted.
    for batch, batch_id in ((first, 0), (second, 1)) * 2:
        events.append_handler(double.table(spark, "dau"))(batch, key(batch_id))
    assert double.rows("SELECT batch_id, data_date, cookies_num FROM dau") == [
        (0, "1970-01-01 00:01:00", "x"), (0, "1970-01-01 00:01:00", "x"),
        (1, "1970-01-01 00:01:01", "y")]
    assert double.rows("SELECT * FROM dau_stage") == []


def test_jdbc_ledger_keeps_one_row_per_partition(spark):
    double = SqlDouble()
    handler = events.ledger_handler(double.table(spark, "offsetinfo"))
    for batch_id, messages in enumerate([[message("", 0, 4), message("", 1, 2)], [message("", 0, 9)]]):
        for _ in range(2):
            handler(spark.createDataFrame(messages, LOG), key(batch_id))
    assert double.rows("SELECT topic, partitionname, untilOffset FROM offsetinfo") == [
        ("t", 0, 10), ("t", 1, 3)]


class Database:
    """Records what a JDBC table would be told; no database is started."""

    def __init__(self):
        self.writes, self.transactions = [], []

    def write(self, frame, url, name, properties):
        self.writes.append((name, frame.columns, [tuple(r) for r in frame.collect()], properties))

    def transact(self, spark, url, properties, statements):
        self.transactions.append(statements)


def test_jdbc_append_moves_a_batch_in_one_transaction(spark):
    database = Database()
    table = JdbcTable(spark, "jdbc:x", "dau", {"user": "u"}, write=database.write,
                      transact=database.transact)
    handler = events.append_handler(table)
    handler(spark.createDataFrame([message(event(60, "x"), 3, 5)], LOG), key(7))
    handler(spark.createDataFrame([message(event(60, "x"), 3, 6)], LOG), key(8))
    names = ["src_topic", "src_partition", "src_offset", "data_date", "cookies_num", "query_id", "batch_id"]
    assert [(w[0], w[1], w[2]) for w in database.writes] == [
        ("dau", names[3:], []),
        ("dau_stage", names, [("t", 3, 5, "1970-01-01 00:01:00", "x", "q", 7)]),
        ("dau_stage", names, [("t", 3, 6, "1970-01-01 00:01:00", "x", "q", 8)])]
    assert database.writes[0][3] == {"user": "u", "numPartitions": "8"}
    assert database.transactions[0] == [
        "DELETE FROM dau WHERE query_id = 'q' AND batch_id = 7",
        "INSERT INTO dau (data_date, cookies_num, query_id, batch_id) SELECT data_date, cookies_num, query_id, batch_id "
        "FROM (SELECT DISTINCT src_topic, src_partition, src_offset, data_date, cookies_num, query_id, batch_id "
        "FROM dau_stage WHERE query_id = 'q' AND batch_id = 7) s",
        "DELETE FROM dau_stage WHERE query_id = 'q' AND batch_id = 7"]


def test_jdbc_ledger_replaces_its_keys(spark):
    database = Database()
    table = JdbcTable(spark, "jdbc:x", "offsetinfo", write=database.write, transact=database.transact)
    events.ledger_handler(table)(spark.createDataFrame([message("", 3, 5)], LOG), key(2))
    assert database.writes[1][2] == [("t", 3, 6, "q", 2)]
    assert database.transactions == [[
        "DELETE FROM offsetinfo WHERE EXISTS (SELECT 1 FROM offsetinfo_stage s WHERE s.query_id = 'q' AND s.batch_id = 2 "
        "AND s.topic = offsetinfo.topic AND s.partitionname = offsetinfo.partitionname)",
        "INSERT INTO offsetinfo (topic, partitionname, untilOffset) SELECT topic, partitionname, "
        "untilOffset FROM (SELECT DISTINCT topic, partitionname, untilOffset, query_id, batch_id "
        "FROM offsetinfo_stage WHERE query_id = 'q' AND batch_id = 2) s",
        "DELETE FROM offsetinfo_stage WHERE query_id = 'q' AND batch_id = 2"]]


def test_command_line_values():
    assert live._start_offset("t:3:17") == ("t", 3, 17)
    with pytest.raises(SystemExit):
        live.main(["event-extract", "--servers", "b:1", "--topics", "t", "--out", "/o",
                   "--jdbc-url", "jdbc:x"])


def test_a_table_of_several_files_is_streamed_whole(spark, tmp_path):
    from tagloom.sources.replay import table, table_stream
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    query = (table_stream(spark, str(tmp_path), "t", files_per_batch=1).writeStream.format("memory")
             .queryName("several_files").trigger(availableNow=True).start())
    query.awaitTermination()
    assert spark.table("several_files").count() == table(spark, str(tmp_path), "t").count() == 1000
    assert query.lastProgress["batchId"] == 2
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        table_stream(spark, str(tmp_path), "missing")


def test_ledger_and_counts_come_from_the_pass_that_writes(spark, tmp_path):
    """Silent and new partitions, repeated batches, and every message read once."""
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value

    sink, ledger = BatchFolder(spark, f"{tmp_path}/e", events.EVENTS), OffsetLedger(spark, f"{tmp_path}/l")
    counts = BatchFolder(spark, f"{tmp_path}/c", events.BATCH_COUNT)
    handle = events.recorded(events.append_handler(sink), ledger, counts, [("t", 0, 3), ("t", 1, 7), ("u", 0, 0)])

    def run(batch_id, *messages):
        frame = spark.createDataFrame(messages, LOG).withColumn("value", counted.asNondeterministic()("value"))
        handle(frame, key(batch_id))

    for _ in range(2):
        run(0, message(event(60, "x"), 0, 5), message(event(61, "y"), 0, 4))
    assert rows(ledger.counts()) == [("t", 0, 6, 2), ("t", 1, 7, 0), ("u", 0, 0, 0)]
    assert read.value == 4
    run(1, message("bad", 1, 9), message("bad", 2, 30), message("bad", 2, 31))
    assert rows(ledger.read()) == [("t", 0, 6), ("t", 1, 10), ("t", 2, 32), ("u", 0, 0)]
    read.value = 0
    run(2, message("bad", 2, 32))
    run(3)
    assert read.value == 1
    assert rows(ledger.read()) == [("t", 0, 6), ("t", 1, 10), ("t", 2, 33), ("u", 0, 0)]
    assert rows(counts.read(), "batch_id", "n") == [(0, 2), (1, 3), (2, 1), (3, 0)]
    # A new run knows the partitions of the ledger.
    again = events.recorded(events.append_handler(sink), ledger, counts)
    again(spark.createDataFrame([message("bad", 0, 6)], LOG), key(0, "second"))
    assert rows(ledger.read()) == [("t", 0, 7), ("t", 1, 10), ("t", 2, 33), ("u", 0, 0)]


def test_ledger_from_reported_progress(spark, tmp_path):
    ledger = OffsetLedger(spark, f"{tmp_path}/l")
    listener = LedgerListener(ledger, "q")

    def progress(batch_id, start, end, query="q"):
        text = json.dumps({"sources": [{"startOffset": start, "endOffset": end}]})
        return SimpleNamespace(progress=SimpleNamespace(id=query, batchId=batch_id, json=text))

    listener.onQueryProgress(progress(0, {"t": {"0": 5, "1": 9}}, {"t": {"0": 8, "1": 9}}))
    assert rows(ledger.counts()) == [("t", 0, 8, 3), ("t", 1, 9, 0)]
    listener.onQueryProgress(progress(0, {"t": {"0": 5, "1": 9}}, {"t": {"0": 8, "1": 9}}))
    listener.onQueryProgress(progress(1, None, {"t": {"0": 8, "1": 11}}, "another"))
    listener.onQueryProgress(progress(1, {"t": {"0": 8, "1": 9}}, {"t": {"0": 8, "1": 11}}))
    assert rows(ledger.counts()) == [("t", 0, 8, 0), ("t", 1, 11, 2)]
    listener.onQueryProgress(progress(2, {"logOffset": 1}, {"logOffset": 2}))
    assert ledger.start_offsets() == [("t", 0, 8), ("t", 1, 11)]


def test_late_rows_of_all_batches_are_counted(spark, inbox, tmp_path, changed_conf):
    """More batches than a query remembers."""
    changed_conf(spark__sql__streaming__numRecentProgressUpdates="2")
    inbox.put(message("z", second=1000))
    for n in range(5):
        inbox.put(message("late", second=n))
    found, mark, late = runner.drain_closed(words.window_word_counts(inbox.stream(), lateness="0 seconds"),
                                            f"{tmp_path}/q")
    # A batch drops what is older than the watermark that the batch before it began with: not yet in the second one.
    assert late == 4 and mark.startswith("2024-01-01T00:16:40") and found.count() == 30
