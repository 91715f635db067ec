"""Word counts per micro-batch and over a sliding window."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.words import count_words, explode_words
from .runner import BatchHandler, BatchKey
from .sinks import BatchFolder

# Length and slide of the window, in seconds.
WINDOW_SECONDS, SLIDE_SECONDS = 60, 2
PREVIEW_ROWS = 10
COUNTS = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def word_count_handler(sink: BatchFolder, text: str = "value",
                       preview: Callable[[list], None] | None = None) -> BatchHandler:
    """Count the words of each batch on its own and keep the counts by batch."""

    def handle(batch: DataFrame, key: BatchKey) -> None:
        sink.write(count_words(batch, text), key)
        if preview:
            # From the written counts: the batch is not read again.
            preview(sink.read_batch(key).take(PREVIEW_ROWS))

    return handle


def window_word_counts(messages: DataFrame, time: str = "timestamp", text: str = "value",
                       length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                       lateness: str = "1 minute") -> DataFrame:
    """Word counts over the last ``length`` seconds, every ``slide`` seconds.

    Words are first counted in windows of one slide.  Only these counts are
    repeated for the ``length / slide`` windows around them, not the words.
    As a stream it emits a window once the watermark has passed its end.
    """
    if length % slide:
        raise ValueError("the window length must be a multiple of the slide")
    words = explode_words(messages.withWatermark(time, lateness), text, time)
    slides = (words.groupBy(F.window(time, f"{slide} seconds").alias("part"), "word")
              .agg(F.count("*").alias("n")))
    if not messages.isStreaming:
        # Over a long time, neighbouring slides of a word meet in one task, so
        # the windows they share are added up before the next shuffle.  The
        # counts are about to grow by length / slide: a stated number of
        # partitions keeps adaptive execution from merging them by their size.
        stretch = F.floor(F.unix_timestamp("part.start") / (10 * length))
        partitions = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slides = slides.repartition(partitions, "word", stretch)
    return (slides
            .groupBy(F.window(F.window_time("part"), f"{length} seconds", f"{slide} seconds")
                     .alias("span"), "word")
            .agg(F.sum("n").alias("n"))
            .select(F.col("span.start").alias("window_start"),
                    F.col("span.end").alias("window_end"), "word", "n"))


def open_window_counts(messages: DataFrame, watermark: str | None, time: str = "timestamp",
                       text: str = "value", length: int = WINDOW_SECONDS,
                       slide: int = SLIDE_SECONDS) -> DataFrame:
    """The windows of a finished input that a stream has not emitted: those that
    end after its last watermark (ISO text; None: all).  Only the messages that
    fall into them are read."""
    if watermark is None:
        return window_word_counts(messages, time, text, length, slide)
    mark = F.to_timestamp(F.lit(watermark))
    since = mark - F.make_interval(secs=F.lit(length))
    counts = window_word_counts(messages.where(F.col(time) >= since), time, text, length, slide)
    return counts.where(F.col("window_end") > mark)
