"""Starting streaming queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener


class BatchKey(NamedTuple):
    """What tells a micro-batch apart.

    Batch numbers begin at 0 with every checkpoint; the query id belongs to
    the checkpoint and stays the same over restarts.
    """

    query_id: str
    batch_id: int


BatchHandler = Callable[[DataFrame, BatchKey], None]
# Fixed value: seconds between micro-batches.
BATCH_SECONDS = 2


def _start(writer: DataStreamWriter, checkpoint: str, available_now: bool,
           seconds: int) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def start_batches(stream: DataFrame, handler: BatchHandler, checkpoint: str,
                  available_now: bool = False, seconds: int = BATCH_SECONDS) -> StreamingQuery:
    """Call ``handler(batch, key)`` per micro-batch.

    A batch can arrive again with the same key after a failure, so handlers
    replace what a key has written before.
    """
    found: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not found:
            found.append(query_id(batch.sparkSession, checkpoint))
        handler(batch, BatchKey(found[0], batch_id))

    return _start(stream.writeStream.foreachBatch(handle), checkpoint, available_now, seconds)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query has left in its checkpoint before its first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start_append(stream: DataFrame, folder: str, checkpoint: str,
                 available_now: bool = False, seconds: int = BATCH_SECONDS) -> StreamingQuery:
    """Append final rows to a parquet folder, each exactly once."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", folder)
    return _start(writer, checkpoint, available_now, seconds)


def start_console(stream: DataFrame, checkpoint: str, rows: int = 10,
                  available_now: bool = False, seconds: int = BATCH_SECONDS) -> StreamingQuery:
    """Print the first rows of every batch."""
    writer = stream.writeStream.outputMode("append").format("console").option("numRows", rows)
    return _start(writer, checkpoint, available_now, seconds)


def drain(stream: DataFrame, folder: str) -> DataFrame:
    """Run over all input that is there now and return what was appended."""
    start_append(stream, f"{folder}/rows", f"{folder}/checkpoint",
                 available_now=True).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


class _Progress(StreamingQueryListener):
    """The watermark and the late rows of one run, from every batch: the query itself remembers the last hundred."""

    def __init__(self) -> None:
        self._ended: set[str] = set()
        self._waiting = threading.Condition()
        self._seen: dict[str, list[dict]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self._waiting:
            self._seen.setdefault(str(event.progress.runId), []).append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._waiting:
            self._ended.add(str(event.runId))
            self._waiting.notify_all()

    def of(self, run_id: str, seconds: float = 60) -> list[dict]:
        """All progress of a run, once its end has been reported."""
        with self._waiting:
            if not self._waiting.wait_for(lambda: run_id in self._ended, seconds):
                raise TimeoutError(f"the end of run {run_id} was not reported")
            return self._seen.get(run_id, [])


def drain_closed(stream: DataFrame, folder: str) -> tuple[DataFrame, str | None, int]:
    """``drain`` with the last watermark (ISO text) and the number of late rows
    that it has dropped, from all batches."""
    listener = _Progress()
    streams = stream.sparkSession.streams
    streams.addListener(listener)
    try:
        query = start_append(stream, f"{folder}/rows", f"{folder}/checkpoint", available_now=True)
        query.awaitTermination()
        found = listener.of(str(query.runId))
    finally:
        streams.removeListener(listener)
    marks = [p["eventTime"]["watermark"] for p in found if "watermark" in p.get("eventTime", {})]
    rows = stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")
    return rows, max(marks, default=None), sum(late_rows(p) for p in found)


def late_rows(progress: dict) -> int:
    """Rows that the watermark has dropped, from a query progress."""
    return sum(state.get("numRowsDroppedByWatermark", 0) for state in progress.get("stateOperators", []))


def drain_batches(stream: DataFrame, handler: BatchHandler, folder: str) -> None:
    """Run a batch handler over all input that is there now."""
    start_batches(stream, handler, f"{folder}/checkpoint",
                  available_now=True).awaitTermination()
