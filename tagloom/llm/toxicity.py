"""Toxic passages by maximum-scoring segments.

Every word has a score: the lower confidence bound of its log-odds between
toxic and other labelled texts under symmetric Dirichlet priors if that is
positive, else the drift, a small penalty.  A linear scan finds all maximal
scoring segments of a text; only positive words can begin or end one, so the
scan runs over them and their gaps.  The best segment's score follows an
extreme-value law in texts without toxicity; its normalised score is
calibrated to a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import bucket_of, materialize
from tagloom.llm.words import ALNUM, U64, Words, hash_words, slices

#: Labelled documents that the model is fitted on, at most: those of the smallest id hashes.
MAX_LABELLED = 100_000
PRIOR, CONFIDENCE, DRIFT, KARLIN = 0.5, 2.0, 0.25, 0.1
#: Expected number of chance segments of the score or more, in a text, below which a segment is significant.
EXPECT = 0.01


@dataclass(frozen=True)
class Model:
    words: np.ndarray  # sorted hashes
    scores: np.ndarray
    decay: float  # lambda of the extreme-value law
    slope: float
    offset: float

    def normalised(self, score: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.decay * score - np.log(KARLIN * np.maximum(n, 1))

    def probability(self, normalised: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * normalised + self.offset, -50, 50)))


def maximal_segments(places: np.ndarray, scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first place, last place, score), by one linear scan.

    ``places`` and ``scores`` are those of the positive words; every word
    between counts -DRIFT.  A candidate keeps the running total before and
    after it, and merges with earlier ones while that makes it larger.  It
    also keeps the nearest earlier candidate that begins at a lower total, so
    a search jumps over all that a former search has passed; where none
    begins lower, all earlier candidates are final.
    """
    done: list[tuple[int, int, float]] = []
    found: list[tuple[int, int, float, float, int]] = []
    total, last = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist()):
        total -= DRIFT * (place - last - 1)
        last = place
        first, left = place, total
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left:
                j = found[j][4]
            if j < 0:
                done += ((a, b, right - low) for a, b, low, right, _ in found)
                found = []
            if j < 0 or found[j][3] >= total:
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
        found.append((first, place, left, total, j))
    return done + [(a, b, right - low) for a, b, low, right, _ in found]


def _hits(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Places of positive words and their scores."""
    if len(model.words) == 0:
        return np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(model.words, words.hashes), len(model.words) - 1)
    places = np.flatnonzero(model.words[at] == words.hashes)
    return places, model.scores[at[places]]


def _segments(words: Words, model: Model) -> list[list[tuple[int, int, float]]]:
    places, scores = _hits(words, model)
    bounds = np.searchsorted(places, words.starts)
    return [maximal_segments(places[a:b] - words.starts[i], scores[a:b]) if b > a else []
            for i, (a, b) in enumerate(zip(bounds, bounds[1:]))]


def fit(documents: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """A model from the labelled documents that are not held out, at most MAX_LABELLED."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)
                          & (bucket_of(F.col(id_col), folds) != 0)).groupBy(id_col).agg(
        F.max(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(MAX_LABELLED)
    # One row for each labelled id, so that what is fitted is bounded also where ids repeat.
    rows = documents.select(F.col(id_col), F.col(text_col).alias("text")).join(F.broadcast(chosen), id_col).groupBy(
        id_col).agg(F.min("text").alias("text"), F.min("label").alias("label")).select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = hash_words(batch.column("text"), ALNUM)
            toxic = np.repeat(batch.column("label").to_numpy() == 1, np.diff(words.starts))
            distinct, at = np.unique(words.hashes, return_inverse=True)
            yield pa.record_batch([pa.array(distinct.view(np.int64)), *(
                pa.array(np.bincount(at[m], minlength=len(distinct))) for m in (toxic, ~toxic))],
                names=["word", "toxic", "clean"])

    counts = rows.mapInArrow(count, "word long, toxic long, clean long").groupBy("word").agg(
        F.sum("toxic").alias("y"), F.sum("clean").alias("x"))
    counts = materialize(counts, "word-counts")
    total = counts.agg(F.sum("y").alias("y"), F.sum("x").alias("x"), F.count("*").alias("v")).first()
    if not total["v"] or not total["y"] or not total["x"]:
        return Model(np.zeros(0, U64), np.zeros(0), 1.0, 1.0, -3.0)
    y, x = F.col("y") + PRIOR, F.col("x") + PRIOR
    n_y, n_x = total["y"] + PRIOR * total["v"], total["x"] + PRIOR * total["v"]
    odds = F.log(y / (n_y - y)) - F.log(x / (n_x - x))
    # All of them: their number is bounded by the words of MAX_LABELLED texts.
    terms = counts.select("word", "x", (odds - CONFIDENCE * F.sqrt(1 / y + 1 / x)).alias("score")).where(
        "score > 0").collect()
    terms.sort(key=lambda r: np.int64(r["word"]).view(U64))
    words = np.array([r["word"] for r in terms], np.int64).view(U64)
    scores = np.array([r["score"] for r in terms])
    decay = _decay(scores, np.array([r["x"] for r in terms], float), float(total["x"]))
    raw = Model(words, scores, decay, 1.0, 0.0)
    shared = documents.sparkSession.sparkContext.broadcast(raw)

    def normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = hash_words(batch.column("text"), ALNUM)
            best = np.array([max((s for *_, s in own), default=0.0) for own in _segments(words, shared.value)])
            yield pa.record_batch([pa.array(shared.value.normalised(best, np.diff(words.starts))),
                                   batch.column("label")], names=["value", "label"])

    seen = rows.mapInArrow(normalised, "value double, label int").toPandas()
    slope, offset = _calibrated(seen["value"].to_numpy(), seen["label"].to_numpy())
    return Model(words, scores, decay, slope, offset)


def _decay(scores: np.ndarray, clean: np.ndarray, total: float) -> float:
    """The positive root of the mean of exp(decay * score) = 1 over the words of other texts."""
    share = (clean + PRIOR) / total
    rest = max(1 - share.sum(), 1e-9)
    low, high = 1e-6, 5.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = (share * np.exp(np.minimum(middle * scores, 500))).sum() + rest * np.exp(-middle * DRIFT)
        low, high = (middle, high) if mean < 1 else (low, middle)
    return low


def _calibrated(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a weak prior."""
    design = np.column_stack((value, np.ones(len(value))))
    weights = np.array([0.1, -1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -50, 50)))
        gradient = design.T @ (p - label) + 1e-3 * weights
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        weights = weights - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def score_toxicity(documents: DataFrame, labels: DataFrame, folds: int = 5, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, held_out, score, predicted, segments) of every row of ``documents``.

    ``segments`` lists the significant passages as (start, end, score), in
    bytes of the text's UTF-8 form.  Labels of ids with crc32(id as text)
    % folds = 0 are not learned from; a score depends on the text alone.
    An id with several labels is toxic if one says so; null labels and
    labels other than 0 and 1 are ignored.  A null or wordless text has the
    score of a text without hits.  Without labels of both kinds no word is
    toxic.  Equal rows stay; other columns are not read.
    """
    shared = documents.sparkSession.sparkContext.broadcast(
        fit(documents, labels, folds, id_col, text_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in slices(batches):
            words = hash_words(batch.column("text"), ALNUM)
            found = _segments(words, model)
            n = np.diff(words.starts)
            score = model.probability(model.normalised(
                np.array([max((s for *_, s in own), default=0.0) for own in found]), n))
            least = (np.log(KARLIN * np.maximum(n, 1)) - np.log(EXPECT)) / model.decay
            spans = [[{"start": int(words.begin[words.starts[i] + a] - words.bounds[i]),
                       "end": int(words.end[words.starts[i] + b] - words.bounds[i]), "score": s}
                      for a, b, s in own if s >= least[i]] for i, own in enumerate(found)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.record_batch([batch.column("id"), batch.column("held"), pa.array(score),
                                   pa.array((score >= 0.5).astype(np.int32)), pa.array(spans, kind)],
                                  names=[id_col, "held_out", "score", "predicted", "segments"])

    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                              (bucket_of(F.col(id_col), folds) == 0).alias("held"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, held_out boolean, "
                                  "score double, predicted int, segments array<struct<start:long,end:long,score:double>>")
