"""Word counts of the last minute kept as one running total for each word.

Words are counted by slide first.  A word's state is its slides of the last
window and their sum: when time moves on by a slide, the newest slide is added
to the sum and the one that has left the window is taken off, so a word costs
one state row instead of one for each window it is in.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions.words import explode_words
from .words import SLIDE_SECONDS, WINDOW_SECONDS

_STATE = "due long, ends array<long>, counts array<long>"
_OUTPUT = "word string, end long, n long"


class RunningTotals(StatefulProcessor):
    """Counts over the last ``length`` ms at the end of every ``slide`` ms, from (end, n) of final slides.

    A timer at the next end due wakes a word once the watermark has passed it;
    a word whose last slide has left the window has no state.
    """

    def __init__(self, length: int, slide: int):
        self._length, self._slide = length, slide

    def init(self, handle) -> None:
        self._handle = handle
        self._state = handle.getValueState("slides", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        due, slides = None, {}
        if self._state.exists():
            due, ends, counts = self._state.get()
            slides = dict(zip(ends, counts))
        for frame in rows:
            for end, n in zip(frame["end"].tolist(), frame["n"].tolist()):
                slides[end] = slides.get(end, 0) + n
        first = min(slides)
        if due is None or first < due:
            if due is not None:
                self._handle.deleteTimer(due)
            due = first
            self._handle.registerTimer(due)
        self._keep(due, slides)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due, ends, counts = self._state.get()
        slides = dict(zip(ends, counts))
        out, slides, due = roll(slides, due, timerValues.getCurrentWatermarkInMs(), self._length, self._slide)
        if slides:
            self._handle.registerTimer(due)
            self._keep(due, slides)
        else:
            self._state.clear()
        if out:
            ends, sums = zip(*out)
            yield pd.DataFrame({"word": key[0], "end": ends, "n": sums})

    def _keep(self, due: int, slides: dict[int, int]) -> None:
        ends = sorted(slides)
        self._state.update((due, ends, [slides[end] for end in ends]))


def roll(slides: dict[int, int], due: int, now: int, length: int,
         slide: int) -> tuple[list[tuple[int, int]], dict[int, int], int]:
    """Sums at every window end in [due, now] whose window has words; what is still needed; the next end due.

    Ends between which nothing is in the window are jumped over.
    """
    ahead = sorted(slides)
    inside = [end for end in ahead if due - slide - length < end < due]
    total, added, out = sum(slides[end] for end in inside), len([e for e in ahead if e < due]), []
    first = added - len(inside)
    while due <= now and (total or added < len(ahead)):
        if not total:
            due = max(due, ahead[added])
            if due > now:
                break
        while added < len(ahead) and ahead[added] <= due:
            total += slides[ahead[added]]
            added += 1
        while first < added and ahead[first] <= due - length:
            total -= slides[ahead[first]]
            first += 1
        if total:
            out.append((due, total))
        due += slide
    left = {end: slides[end] for end in ahead if end > due - length}
    return out, left, due


def rolling_word_counts(messages: DataFrame, time: str = "timestamp", text: str = "value",
                        length: int = WINDOW_SECONDS, slide: int = SLIDE_SECONDS,
                        lateness: str = "0 seconds") -> DataFrame:
    """(window_start, window_end, word, n) of a stream, as ``window_word_counts``, from running totals.

    A window's rows appear with the first batch after the watermark has passed
    its end.  Needs the RocksDB state store.
    """
    if length % slide:
        raise ValueError("the window length must be a multiple of the slide")
    words = explode_words(messages.withWatermark(time, lateness), text, time)
    slides = (words.groupBy(F.window(time, f"{slide} seconds").alias("part"), "word")
              .agg(F.count("*").alias("n"))
              .select("word", F.unix_millis("part.end").alias("end"), "n", F.window_time("part").alias("at")))
    totals = slides.groupBy("word").transformWithStateInPandas(
        RunningTotals(1000 * length, 1000 * slide), _OUTPUT, "Append", "EventTime")
    end = F.timestamp_millis("end")
    return totals.select((end - F.make_interval(secs=F.lit(length))).alias("window_start"), end.alias("window_end"),
                         "word", "n")
