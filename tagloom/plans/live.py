"""The message-stream jobs on Kafka.

    spark-submit --packages <kafka connector> live.py word-count \
        --servers broker:9092 --topics clicks,views --out hdfs:///streams/words
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tagloom.session import STREAMING, build_session
from tagloom.sources.kafka import StartOffset, kafka_options, kafka_stream, topic_list
from tagloom.streaming import events, rolling, runner, words
from tagloom.streaming.late import WindowTable
from tagloom.streaming.offsets import OffsetLedger, OffsetReporter
from tagloom.streaming.sinks import BatchFolder, JdbcTable, merging


def start_word_count(messages: DataFrame, out: str, available_now: bool = False) -> StreamingQuery:
    """Words of each two-second batch, with a preview of ten counts."""
    sink = BatchFolder(messages.sparkSession, f"{out}/counts", words.COUNTS)
    handler = words.word_count_handler(sink, preview=lambda rows: print(*rows, sep="\n"))
    return runner.start_batches(messages, merging(handler, sink), f"{out}/checkpoint", available_now)


def start_window_word_count(messages: DataFrame, out: str, available_now: bool = False,
                            lateness: str = "1 minute", totals: bool = False) -> StreamingQuery:
    """Words of the last minute, every two seconds; with ``totals`` from one running total for each word."""
    count = rolling.rolling_word_counts if totals else words.window_word_counts
    return runner.start_append(count(messages, lateness=lateness), f"{out}/counts", f"{out}/checkpoint", available_now)


def start_late_word_count(messages: DataFrame, out: str, available_now: bool = False,
                          lateness: int = 60) -> StreamingQuery:
    """Words of the last minute, every two seconds; late ones are kept for ``WindowTable.correct``."""
    windows = WindowTable(messages.sparkSession, out, text="value", lateness=lateness)
    return runner.start_batches(messages, windows.handle, f"{out}/checkpoint", available_now)


def report_batch(batch: int, rows: int, ranges: list, late: int) -> None:
    print(f"batch {batch}: {rows} messages, {late} counts of late words dropped", *ranges, sep="\n")


def start_event_extract(messages: DataFrame, out: str, available_now: bool = False,
                        sink: BatchFolder | JdbcTable | None = None,
                        ledger: OffsetLedger | JdbcTable | None = None,
                        partitions: Sequence[StartOffset] = ()) -> StreamingQuery:
    """Events, batch counts and the offset ledger from one pass over each batch.

    ``partitions`` have their row in the ledger before their first message.
    """
    spark = messages.sparkSession
    sink = sink or BatchFolder(spark, f"{out}/events", events.EVENTS)
    counts = BatchFolder(spark, f"{out}/counts", events.BATCH_COUNT)
    handler = events.recorded(events.append_handler(sink), ledger or OffsetLedger(spark, f"{out}/offsets"), counts,
                              partitions)
    for folder in (sink, counts):
        if isinstance(folder, BatchFolder):
            handler = merging(handler, folder)
    return runner.start_batches(messages, handler, f"{out}/checkpoint", available_now)


def _start_offset(text: str) -> tuple[str, int, int]:
    topic, partition, offset = text.rsplit(":", 2)
    return topic, int(partition), int(offset)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="message-stream jobs")
    parser.add_argument("job", choices=["word-count", "window-word-count", "late-word-count", "event-extract"])
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topics", required=True, type=topic_list, help="comma separated")
    parser.add_argument("--out", required=True, help="shared folder for output and checkpoints")
    parser.add_argument("--start", action="append", default=[], type=_start_offset,
                        metavar="TOPIC:PARTITION:OFFSET", help="OFFSET -2: the earliest")
    parser.add_argument("--start-from-ledger", metavar="FOLDER",
                        help="start where the offset ledger of another run ends; "
                             "--start names partitions that it does not hold")
    parser.add_argument("--lateness", default="1 minute",
                        help="how long windows wait for late messages")
    parser.add_argument("--late-seconds", type=int, default=60, help="late-word-count: seconds before a window closes")
    parser.add_argument("--totals", action="store_true",
                        help="window-word-count: one running total for each word instead of one for each window")
    parser.add_argument("--console", action="store_true", help="print the first messages of every batch")
    parser.add_argument("--group-id")
    parser.add_argument("--min-partitions", type=int, help="read tasks per batch")
    parser.add_argument("--max-offsets", type=int, help="messages per batch")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-table")
    parser.add_argument("--jdbc-user", help="the password comes from JDBC_PASSWORD")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-connections", type=int, default=8, help="write tasks per batch")
    parser.add_argument("--jdbc-ledger", metavar="TABLE", help="keep the offset ledger in a table")
    args = parser.parse_args(argv)
    if args.jdbc_url and not args.jdbc_table:
        parser.error("--jdbc-url needs --jdbc-table")
    if args.jdbc_ledger and not args.jdbc_url:
        parser.error("--jdbc-ledger needs --jdbc-url")

    spark = build_session(args.job, **STREAMING)
    spark.streams.addListener(OffsetReporter(report_batch))
    start = list(args.start)
    if args.start_from_ledger:
        named = {place[:2] for place in start}
        start += [place for place in OffsetLedger(spark, args.start_from_ledger).start_offsets()
                  if place[0] in args.topics and place[:2] not in named]
    messages = kafka_stream(spark, kafka_options(args.servers, args.topics, start,
                                                 args.group_id, args.min_partitions,
                                                 args.max_offsets))
    if args.job == "word-count":
        query = start_word_count(messages, args.out)
    elif args.job == "window-word-count":
        query = start_window_word_count(messages, args.out, lateness=args.lateness, totals=args.totals)
    elif args.job == "late-word-count":
        query = start_late_word_count(messages, args.out, lateness=args.late_seconds)
    else:
        sink = ledger = None
        if args.jdbc_url:
            login = {"user": args.jdbc_user, "driver": args.jdbc_driver,
                     "password": os.environ.get("JDBC_PASSWORD")}
            login = {key: value for key, value in login.items() if value}
            sink = JdbcTable(spark, args.jdbc_url, args.jdbc_table, login, args.jdbc_connections)
            if args.jdbc_ledger:
                ledger = JdbcTable(spark, args.jdbc_url, args.jdbc_ledger, login)
        query = start_event_extract(messages, args.out, sink=sink, ledger=ledger,
                                    partitions=[place for place in start if place[2] >= 0])
    if args.console:
        runner.start_console(messages.select("topic", "partition", "offset", "value"),
                             f"{args.out}/console-checkpoint")
    query.awaitTermination()


if __name__ == "__main__":
    main()
