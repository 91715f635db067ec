"""What each batch has read: offset ranges, counts and the offset ledger.

The checkpoint alone decides where a restart begins.  The ledger is for
people and monitors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..session import path_exists
from ..sources.kafka import StartOffset
from .runner import BatchKey, late_rows

LEDGER_KEYS = ("topic", "partitionname")
_LEDGER_SCHEMA = ("topic STRING, partitionname INT, untilOffset BIGINT, n BIGINT, written TIMESTAMP, "
                  "batch_id BIGINT, query_id STRING, slot INT")


def batch_offsets(batch: DataFrame) -> DataFrame:
    """(topic, partitionname, untilOffset, n) of a batch: the exclusive end and
    the number of rows of each partition, from one grouping."""
    return (batch.groupBy("topic", F.col("partition").alias("partitionname"))
            .agg((F.max("offset") + 1).alias("untilOffset"), F.count("*").alias("n")))


BatchRange = tuple[str, int, int, int]
_RANGE_SCHEMA = "topic string, partitionname int, untilOffset bigint, n bigint"


class ObservedOffsets:
    """What a batch holds of known partitions, measured while something else reads the batch.

    ``rows`` is to be used in the batch's place, by one action that reads all
    of it; ``ranges`` then has (topic, partition, end offset, number of rows)
    of every known partition, with the offset it had before where the batch
    holds nothing of it.  Rows of other partitions are counted in ``unknown``.
    """

    def __init__(self, batch: DataFrame, known: Iterable[StartOffset]):
        self._known = sorted(known)
        self._seen = Observation(f"offsets-{uuid.uuid4().hex}")
        places = [(F.col("topic") == topic) & (F.col("partition") == partition) for topic, partition, _ in self._known]
        metrics = [F.count("*").alias("n")]
        for i, here in enumerate(places):
            metrics += [F.count_if(here).alias(f"n{i}"), (F.max(F.when(here, F.col("offset"))) + 1).alias(f"until{i}")]
        self.rows = batch.observe(self._seen, *metrics)

    @property
    def total(self) -> int:
        return self._seen.get.get("n") or 0

    @property
    def unknown(self) -> int:
        return self.total - sum(n for *_, n in self.ranges)

    @property
    def ranges(self) -> list[BatchRange]:
        seen = self._seen.get
        return [(topic, partition, start if seen.get(f"until{i}") is None else seen[f"until{i}"], seen.get(f"n{i}") or 0)
                for i, (topic, partition, start) in enumerate(self._known)]


def ranges_frame(spark: SparkSession, ranges: Sequence[BatchRange]) -> DataFrame:
    """Ranges as rows for ``OffsetLedger.update``."""
    return spark.createDataFrame(list(ranges), _RANGE_SCHEMA)


@dataclass(frozen=True)
class OffsetLedger:
    """The latest end offset of every partition, kept under a path.

    The ledger is as large as the number of topic partitions for each query
    that has written it.  Every query has two folders that take turns: a batch
    merges what the batch before it has left in one with its own offsets and
    writes them to the other as one file.  A failed write spoils only the
    folder that a repeat of the batch replaces.  Within a query later batches
    win, also when a topic restarts at lower offsets; between queries the
    partition's later write wins.
    """

    spark: SparkSession
    location: str

    def update(self, offsets: DataFrame, key: BatchKey) -> None:
        rows = offsets.select(*LEDGER_KEYS, "untilOffset", "n", F.current_timestamp().alias("written"),
                              F.lit(key.batch_id).cast("bigint").alias("batch_id"))
        own = self._rows().where((F.col("query_id") == key.query_id) & (F.col("batch_id") < key.batch_id))
        newest = own.agg(F.max(F.struct("batch_id", "slot")).alias("top")).first()["top"]
        slot = 0
        if newest is not None:
            slot = 1 - newest["slot"]
            old = own.where(F.col("slot") == newest["slot"]).select(rows.columns)
            rows = (old.unionByName(rows).groupBy(*LEDGER_KEYS)
                    .agg(*(F.max_by(c, "batch_id").alias(c) for c in ("untilOffset", "n", "written"))))
        (rows.withColumn("batch_id", F.lit(key.batch_id).cast("bigint")).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.location}/query_id={key.query_id}/slot={slot}"))

    def read(self) -> DataFrame:
        """(topic, partitionname, untilOffset)"""
        newest = F.max("batch_id").over(Window.partitionBy("query_id"))
        latest = self._rows().withColumn("newest", newest).where("batch_id = newest")
        return latest.groupBy(*LEDGER_KEYS).agg(F.max_by("untilOffset", "written").alias("untilOffset"))

    def counts(self) -> DataFrame:
        """(topic, partitionname, untilOffset, n), with the rows of each partition's last batch."""
        newest = F.max("batch_id").over(Window.partitionBy("query_id"))
        latest = self._rows().withColumn("newest", newest).where("batch_id = newest")
        return (latest.groupBy(*LEDGER_KEYS).agg(F.max_by(F.struct("untilOffset", "n"), "written").alias("last"))
                .select(*LEDGER_KEYS, "last.untilOffset", "last.n"))

    def start_offsets(self) -> list[StartOffset]:
        """Where to go on, for ``kafka_options``: one row per partition."""
        return [tuple(row) for row in self.read().orderBy(*LEDGER_KEYS).collect()]

    def _rows(self) -> DataFrame:
        if not path_exists(self.spark, self.location):
            return self.spark.createDataFrame([], _LEDGER_SCHEMA)
        return self.spark.read.schema(_LEDGER_SCHEMA).parquet(self.location)


def progress_ranges(progress: str) -> list[Row]:
    """Offset ranges of the Kafka sources in a query progress (JSON text)."""
    Range = Row("topic", "partition", "fromOffset", "untilOffset")
    ranges = []
    for source in json.loads(progress)["sources"]:
        begin, end = (_offsets(source.get(side)) for side in ("startOffset", "endOffset"))
        for topic, partitions in sorted(end.items()):
            for partition, until in sorted(partitions.items(), key=lambda item: int(item[0])):
                start = begin.get(topic, {}).get(partition, until)
                ranges.append(Range(topic, int(partition), start, until))
    return ranges


def _offsets(value: object) -> dict:
    value = json.loads(value) if isinstance(value, str) else value
    if not isinstance(value, dict):
        return {}
    return {topic: parts for topic, parts in value.items() if isinstance(parts, dict)}


class OffsetReporter(StreamingQueryListener):
    """Hands the number of every batch, its rows, its offset ranges and its late
    rows, which the watermark has dropped, to a function.

    Spark reports both by itself, so this reads no message.
    """

    def __init__(self, report: Callable[[int, int, list[Row], int], None]):
        self._report = report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self._report(progress.batchId, progress.numInputRows, progress_ranges(progress.json),
                     late_rows(json.loads(progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class LedgerListener(StreamingQueryListener):
    """Writes the offset ranges that Spark reports for the Kafka sources of one query to a ledger.

    No message is read for it, and partitions without messages have their
    rows.  Ranges count offsets, also where a compacted topic has none left.
    """

    def __init__(self, ledger: OffsetLedger, query_id: str | None = None):
        self._ledger, self._query_id = ledger, query_id

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        ranges = [(r.topic, r.partition, r.untilOffset, r.untilOffset - r.fromOffset)
                  for r in progress_ranges(progress.json)]
        if ranges and self._query_id in (None, str(progress.id)):
            self._ledger.update(ranges_frame(self._ledger.spark, ranges), BatchKey(str(progress.id), progress.batchId))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
