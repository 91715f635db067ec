"""Window counts that keep what comes late.

A stream's aggregate drops words older than the watermark.  Here every batch
writes its counts by slide, windows are closed from the written slides, and
slides that come after their windows have closed are kept aside.  A batch step
then adds them to the windows they belong to.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..commits import CommitLog
from ..functions.words import explode_words
from .runner import BatchKey
from .sinks import BatchFolder
from .words import SLIDE_SECONDS, WINDOW_SECONDS

_LONG = T.LongType()
SLIDES = T.StructType([T.StructField("word", T.StringType()), T.StructField("slide_end", _LONG), T.StructField("n", _LONG)])
LATE = T.StructType([*SLIDES.fields, T.StructField("mark", _LONG)])
WINDOWS = T.StructType([T.StructField("word", T.StringType()), T.StructField("end", _LONG), T.StructField("n", _LONG)])
#: Corrections of a query are kept as batches of a query of this name behind its own.
CORRECTION = ".late"


@dataclass(frozen=True)
class WindowTable:
    """Word counts over sliding windows under a path, as a batch handler.

    A window closes when the newest time seen lies ``lateness`` seconds behind
    its end.  A batch reads the slides of those earlier batches only that reach
    into its closing windows; a small document by query names them, so a
    repeated batch starts from what was known before it.
    """

    spark: SparkSession
    location: str
    time: str = "timestamp"
    text: str = "value"
    length: int = WINDOW_SECONDS
    slide: int = SLIDE_SECONDS
    lateness: int = 60

    @property
    def slides(self) -> BatchFolder:
        return BatchFolder(self.spark, f"{self.location}/slides", SLIDES)

    @property
    def late(self) -> BatchFolder:
        """Slides that came after at least one of their windows had closed, and the time up to which they had."""
        return BatchFolder(self.spark, f"{self.location}/late", LATE)

    @property
    def windows(self) -> BatchFolder:
        return BatchFolder(self.spark, f"{self.location}/windows", WINDOWS)

    @property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self.location}/_batches")

    def handle(self, batch: DataFrame, key: BatchKey) -> None:
        known = self._log.read().get(key.query_id, {"batch": -1, "after": {"mark": None, "newest": None, "open": []}})
        if known["batch"] > key.batch_id:
            return
        before = known["before"] if known["batch"] == key.batch_id else known["after"]
        slide = 1000 * self.slide
        end = (F.floor(F.unix_millis(F.col(self.time).cast("timestamp")) / slide) + 1) * slide
        words = explode_words(batch.where(F.col(self.time).isNotNull()).withColumn("slide_end", end), self.text, "slide_end")
        self.slides.write(words.groupBy("word", "slide_end").agg(F.count("*").alias("n")), key)
        written = self.slides.read_batch(key)
        low, high = written.agg(F.min("slide_end"), F.max("slide_end")).first()
        mark = before["mark"]
        if mark is not None and low is not None and low <= mark:
            self.late.write(written.where(F.col("slide_end") <= mark).withColumn("mark", F.lit(mark)), key)
        newest = max((t for t in (before["newest"], high) if t is not None), default=None)
        # A slide's end stands for the times in it.
        after = None if newest is None else max(newest - slide - 1000 * self.lateness, mark or 0)
        open_ = [*before["open"], *([[key.batch_id, high]] if high is not None else [])]
        if after is not None and after != mark:
            self.windows.write(self._closing(key.query_id, open_, mark, after), key)
        kept = [place for place in open_ if after is None or place[1] > after - 1000 * self.length]
        self._log.update(lambda document: {**document, key.query_id: {
            "batch": key.batch_id, "before": before, "after": {"mark": after, "newest": newest, "open": kept}}})

    def _closing(self, query_id: str, batches: list[list[int]], mark: int | None, until: int | None) -> DataFrame:
        """Windows that end in (mark, until], from the slides of some batches."""
        frames = [self.slides.read_batch(BatchKey(query_id, batch)) for batch, _ in batches]
        slides = functools.reduce(DataFrame.unionByName, frames)
        if mark is not None:
            slides = slides.where(F.col("slide_end") > mark - 1000 * self.length)
        ends = self._ends(slides)
        if mark is not None:
            ends = ends.where(F.col("end") > mark)
        if until is not None:
            ends = ends.where(F.col("end") <= until)
        return ends.groupBy("word", "end").agg(F.sum("n").alias("n"))

    def _ends(self, slides: DataFrame) -> DataFrame:
        """Each slide in all windows that it lies in."""
        last = F.col("slide_end") + 1000 * (self.length - self.slide)
        return slides.withColumn("end", F.explode(F.sequence("slide_end", last, F.lit(1000 * self.slide)))).drop("slide_end")

    def correct(self) -> int:
        """Add late words to the closed windows they belong to; returns how many batches had any.

        A batch that was corrected before is written again with the same rows.
        """
        late = self.late
        keys = late._batches()
        done = set(self.windows._batches())
        todo = [key for key in keys if BatchKey(key.query_id + CORRECTION, key.batch_id) not in done]
        for key in todo:
            ends = self._ends(late.read_batch(key)).where("end <= mark")
            self.windows.write(ends.groupBy("word", "end").agg(F.sum("n").alias("n")),
                               BatchKey(key.query_id + CORRECTION, key.batch_id))
        return len(todo)

    def counts(self) -> DataFrame:
        """(window_start, window_end, word, n) of the closed windows, with the corrections made so far."""
        return self._named(self.windows.read())

    def open_counts(self) -> DataFrame:
        """The same for windows that have not closed, from all words so far."""
        found = [self._closing(query, state["after"]["open"], state["after"]["mark"], None)
                 for query, state in self._log.read().items() if state["after"]["open"]]
        if not found:
            return self._named(self.spark.createDataFrame([], WINDOWS))
        return self._named(functools.reduce(DataFrame.unionByName, found))

    def _named(self, ends: DataFrame) -> DataFrame:
        sums = ends.groupBy("word", "end").agg(F.sum("n").alias("n"))
        end = F.timestamp_millis("end")
        return sums.select((end - F.make_interval(secs=F.lit(self.length))).alias("window_start"),
                           end.alias("window_end"), "word", "n")
