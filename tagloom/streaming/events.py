"""Event extraction with its offset ledger and batch counts."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.messages import extract_events
from ..sources.kafka import StartOffset
from .offsets import LEDGER_KEYS, ObservedOffsets, OffsetLedger, batch_offsets, ranges_frame
from .runner import BatchHandler, BatchKey
from .sinks import BatchFolder, JdbcTable

EVENTS = T.StructType([T.StructField(name, T.StringType()) for name in ("data_date", "cookies_num")])
BATCH_COUNT = T.StructType([T.StructField("n", T.LongType())])
# Column names of the staging table: the source names are reserved words.
IDENTITY = {"topic": "src_topic", "partition": "src_partition", "offset": "src_offset"}


def append_handler(sink: BatchFolder | JdbcTable) -> BatchHandler:
    """Append the extracted events of each batch."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        if isinstance(sink, JdbcTable):
            rows = extract_events(batch, *IDENTITY).withColumnsRenamed(IDENTITY)
            sink.append_batch(rows, list(IDENTITY.values()), key)
        else:
            sink.write(extract_events(batch), key)

    return handle


def ledger_handler(ledger: OffsetLedger | JdbcTable) -> BatchHandler:
    """Record where each batch ended."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        offsets = batch_offsets(batch)
        if isinstance(ledger, JdbcTable):
            ledger.replace_keys(offsets.drop("n"), LEDGER_KEYS, key)
        else:
            ledger.update(offsets, key)

    return handle


def recorded(handler: BatchHandler, ledger: OffsetLedger | JdbcTable, counts: BatchFolder | None = None,
             partitions: Iterable[StartOffset] = ()) -> BatchHandler:
    """``handler``, which reads a batch once, and from the same pass the offset ledger and the batch's row count.

    Partitions named by ``partitions``, with the offsets they start at, have a
    row before their first message.  Others are found by a grouping of the
    batch that first brings them, and known from then on.
    """
    known = {place[:2]: place for place in partitions}
    if isinstance(ledger, OffsetLedger):
        known |= {place[:2]: place for place in ledger.start_offsets() if place[:2] not in known}

    def handle(batch: DataFrame, key: BatchKey) -> None:
        seen = ObservedOffsets(batch, known.values())
        handler(seen.rows, key)
        offsets = ranges_frame(batch.sparkSession, seen.ranges)
        if seen.unknown:
            named = [(F.col("topic") == topic) & (F.col("partition") == partition) for topic, partition in known]
            found = batch.where(~functools.reduce(Column.__or__, named)) if named else batch
            found = [tuple(r) for r in batch_offsets(found).collect()]  # one row for each new partition
            offsets = ranges_frame(batch.sparkSession, [*seen.ranges, *found])
            known.update({(t, p): (t, p, until) for t, p, until, _ in found})
        known.update({(t, p): (t, p, until) for t, p, until, _ in seen.ranges})
        if counts is not None:
            counts.write(batch.sparkSession.createDataFrame([(seen.total,)], "n bigint"), key)
        if isinstance(ledger, JdbcTable):
            ledger.replace_keys(offsets.drop("n"), LEDGER_KEYS, key)
        else:
            ledger.update(offsets, key)

    return handle


def count_handler(sink: BatchFolder) -> BatchHandler:
    """Record the number of messages in each batch."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        sink.write(batch.agg(F.count("*").alias("n")), key)

    return handle


def together(*handlers: BatchHandler) -> BatchHandler:
    """Run several handlers on each batch, which is read from its source once."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for handler in handlers:
                handler(batch, key)
        finally:
            batch.unpersist()

    return handle
