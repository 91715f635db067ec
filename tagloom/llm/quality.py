"""Document quality by co-training two views.

One classifier sees the text only, the other what is known about the page:
its source, language and stated length.  In each round, each labels all
unlabelled documents that it is sure of for the other.  Both are then
calibrated on labelled documents that neither was fitted on, and combined.

The labelled documents are a bounded sample, which comes to the driver as a
few dozen numbers for each.  The unlabelled ones stay on Spark: a Newton step
needs their gradients and curvatures only, which are summed there.  Together
they weigh as much as the labelled ones at most, with the same shares of both
labels, so that many sure mistakes cannot outvote what is known.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import forget, materialize
from tagloom.llm.words import Words, hash_shingles, hash_words, slices

#: Labelled documents that the model is fitted on, at most: those of the smallest id hashes.
MAX_LABELLED = 20_000
#: Rounds of exchanging labels, Newton steps in each, and the probability from which a classifier is sure.
ROUNDS, STEPS, SURE = 3, 2, 0.98
#: Sums of the unlabelled documents that come to the driver for each step.
SLOTS = 32
#: One labelled document in so many is kept for calibration.
CALIBRATION = 4
SOURCES, LANGUAGES = 32, 8
RIDGE = 1.0

_UPPER, _LOWER, _DIGIT, _PUNCT, _ODD, _HIGH, _NEWLINE = range(7)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, -1, np.int8)
    kinds[65:91], kinds[97:123], kinds[48:58], kinds[128:], kinds[10] = _UPPER, _LOWER, _DIGIT, _HIGH, _NEWLINE
    kinds[[33, 34, 39, 44, 46, 58, 59, 63]] = _PUNCT
    kinds[[c for c in range(33, 127) if kinds[c] < 0]] = _ODD
    return kinds


_KINDS = _byte_kinds()


def text_features(words: Words) -> np.ndarray:
    """A row for each text: shares of kinds of bytes, and how words and word pairs repeat."""
    n = np.diff(words.starts)
    size = np.diff(words.bounds)
    kinds = _KINDS[words.data]
    shares = []
    for kind in range(7):
        total = np.append(0, np.cumsum(kinds == kind))
        shares.append((total[words.bounds[1:]] - total[words.bounds[:-1]]) / np.maximum(size, 1))
    length = np.append(0, np.cumsum(words.end - words.begin))
    mean = (length[words.starts[1:]] - length[words.starts[:-1]]) / np.maximum(n, 1)
    same = np.append(0, np.cumsum(np.append(False, words.hashes[1:] == words.hashes[:-1])))
    repeats = (same[words.starts[1:]] - same[np.minimum(words.starts[:-1] + 1, words.starts[1:])]) / np.maximum(n, 1)
    pairs, pair_starts = hash_shingles(words, 2)
    distinct = np.array([[len(np.unique(words.hashes[a:b])), len(np.unique(pairs[c:d]))]
                         for a, b, c, d in zip(words.starts, words.starts[1:], pair_starts, pair_starts[1:])],
                        float).reshape(-1, 2)
    marks = words.data[words.end - 1] if len(words.end) else np.zeros(0, np.uint8)
    shout = np.append(0, np.cumsum(marks == 33))
    shouts = (shout[words.starts[1:]] - shout[words.starts[:-1]]) / np.maximum(n, 1)
    per_pair = distinct[:, 1] / np.maximum(np.diff(pair_starts), 1)
    out = np.column_stack([*shares, np.minimum(mean, 50) / 10, repeats, distinct[:, 0] / np.maximum(n, 1), per_pair,
                           shouts, np.log1p(n), np.log1p(n) ** 2 / 10])
    return np.column_stack([out, out[:, :12] ** 2, np.sqrt(out[:, :12])])


def page_features(batch: pa.RecordBatch) -> np.ndarray:
    """A row for each document: hashed source and language, and the stated length; NaN where they are not known."""
    n = batch.num_rows
    out = np.zeros((n, SOURCES + LANGUAGES + 2))
    for column, start, size in (("source", 0, SOURCES), ("lang", SOURCES, LANGUAGES)):
        for i, value in enumerate(batch.column(column).to_pylist()):
            if value is None:
                out[i, start:start + size] = np.nan
            else:
                out[i, start + zlib.crc32(value.encode()) % size] = 1
    stated = batch.column("n_chars").to_numpy(zero_copy_only=False).astype(float)
    length = np.log1p(np.maximum(np.where(np.isfinite(stated), stated, np.nan), 0))
    out[:, -2:] = np.column_stack((length, length ** 2 / 10))
    return out


@dataclass(frozen=True)
class Logistic:
    """Ridge-penalised logistic regression on standardised features; an unknown feature (NaN) counts as average."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Logistic:
        known = ~np.isnan(x)
        n = np.maximum(known.sum(axis=0), 1)
        mean = np.where(known, x, 0).sum(axis=0) / n
        scale = np.sqrt((np.where(known, x - mean, 0) ** 2).sum(axis=0) / n) + 1e-6
        model = cls(mean, scale, np.zeros(x.shape[1] + 1))
        for _ in range(30):
            model, moved = model.step(*model.slopes(x, y))
            if moved < 1e-6:
                break
        return model

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack((np.where(np.isnan(x), 0, (x - self.mean) / self.scale), np.ones(len(x))))

    def slopes(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of the loss of rows ``x`` with labels ``y``."""
        design = self.design(x)
        p = 1 / (1 + np.exp(-np.clip(design @ self.weights, -30, 30)))
        return design.T @ (p - y), (design * (p * (1 - p))[:, None]).T @ design

    def step(self, gradient: np.ndarray, curvature: np.ndarray) -> tuple[Logistic, float]:
        """The model after a Newton step, and how far it went."""
        penalty = np.append(np.full(len(self.mean), RIDGE), 1e-3)
        step = np.linalg.solve(curvature + np.diag(penalty), gradient + penalty * self.weights)
        return replace(self, weights=self.weights - np.clip(step, -2, 2)), float(np.abs(step).max())

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.design(x) @ self.weights, -30, 30)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


@dataclass(frozen=True)
class Model:
    text: Logistic
    page: Logistic
    both: Logistic

    def probability(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        return self.both.probability(np.column_stack((self.text.margin(text), self.page.margin(page))))


Views = tuple[np.ndarray, np.ndarray]
#: For each view and label: how many documents the other view is sure of, and their gradient and curvature.
Sums = dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray]]


def sure_sums(views: Views, teachers: list[Logistic], models: list[Logistic]) -> Sums:
    """Sums over rows that ``teachers`` label, each view for the other, of the slopes of ``models``."""
    out: Sums = {}
    for v in (0, 1):
        p = teachers[1 - v].probability(views[1 - v])
        for label, sure in ((0, 1 - p >= SURE), (1, p >= SURE)):
            rows = views[v][sure]
            out[v, label] = (float(len(rows)), *models[v].slopes(rows, np.full(len(rows), label)))
    return out


def co_train(views: Views, labels: np.ndarray, spare: np.ndarray,
             unlabelled: Callable[[list[Logistic], list[Logistic]], Sums]) -> Model:
    """``views`` are the labelled documents' features, ``spare`` marks rows for calibration; ``unlabelled`` gives the
    ``sure_sums`` of all unlabelled documents."""
    known = ~spare
    y = labels[known]
    models = [Logistic.fit(view[known], y) for view in views]
    for _ in range(ROUNDS):
        teachers = models
        for _ in range(STEPS):
            sums, after = unlabelled(teachers, models), []
            for v in (0, 1):
                gradient, curvature = models[v].slopes(views[v][known], y)
                found = [sums[v, label][0] for label in (0, 1)]
                # As many as the labelled documents count in all, in the labelled shares.
                mass = min(sum(found), len(y)) * np.array([np.mean(y == 0), np.mean(y == 1)])
                for label in (0, 1):
                    if found[label]:
                        weight = min(mass[label] / found[label], 1.0)
                        gradient = gradient + weight * sums[v, label][1]
                        curvature = curvature + weight * sums[v, label][2]
                after.append(models[v].step(gradient, curvature)[0])
            models = after
    margins = np.column_stack([m.margin(view) for m, view in zip(models, views)])
    use = spare if len(set(labels[spare])) == 2 else np.ones(len(labels), bool)
    return Model(models[0], models[1], Logistic.fit(margins[use], labels[use]))


def _summed(pool: DataFrame, teachers: list[Logistic], models: list[Logistic]) -> Sums:
    """``sure_sums`` of the rows (text, page) of ``pool``: added up by task, then in SLOTS groups."""
    shared = pool.sparkSession.sparkContext.broadcast((teachers, models))
    keys = [(v, label) for v in (0, 1) for label in (0, 1)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                views = tuple(np.stack(batch.column(c).to_numpy(zero_copy_only=False)).astype(float)
                              for c in ("text", "page"))
                sums = sure_sums(views, *shared.value)
                own = np.concatenate([np.concatenate(([n], g, h.ravel())) for n, g, h in (sums[k] for k in keys)])
                total = own if total is None else total + own
        if total is not None:
            slot = TaskContext.get().partitionId() % SLOTS
            yield pa.record_batch([pa.array([slot], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                  names=["slot", "sums"])

    def join(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x) for x in table.column("sums").to_pylist())
        return pa.table({"sums": pa.array([total.tobytes()], pa.binary())})

    rows = pool.mapInArrow(add, "slot int, sums binary").groupBy("slot").applyInArrow(join, "sums binary").collect()
    sizes = [len(models[v].weights) for v, _ in keys]
    total = sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(sum(1 + n + n * n for n in sizes)))
    out, at = {}, 0
    for key, n in zip(keys, sizes):
        out[key] = (total[at], total[at + 1:at + 1 + n], total[at + 1 + n:at + 1 + n + n * n].reshape(n, n))
        at += 1 + n + n * n
    return out


def _source(documents: DataFrame, id_col: str) -> DataFrame:
    """The columns that features are made of; missing ones are null."""
    have = set(documents.columns)
    return documents.select(
        F.col(id_col).alias("id"), F.col("text").cast("string").alias("text"),
        *((F.col(c) if c in have else F.lit(None)).cast(t).alias(c)
          for c, t in (("lang", "string"), ("source", "string"), ("n_chars", "double"))))


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """A model, or None if the labelled documents don't show both labels."""
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1)).groupBy(id_col).agg(
        F.min(label_col).cast("int").alias("label")).orderBy(F.xxhash64(id_col), id_col).limit(MAX_LABELLED)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = hash_words(batch.column("text"))
            yield pa.record_batch([batch.column("id"), *(
                pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))
                for x in (text_features(words), page_features(batch)))], names=["id", "text", "page"])

    # From here on texts are not moved: a document is its features, a tenth of its size.
    source = _source(documents, id_col).withColumn("id", F.col("id").cast("string"))
    every = materialize(source.mapInArrow(features, "id string, text array<float>, page array<float>"), "features")
    chosen = chosen.withColumn("id", F.col(id_col).cast("string")).select("id", "label")
    # One row for each id, so that what comes to the driver is bounded also where ids repeat.
    rows = every.join(F.broadcast(chosen), "id").groupBy("id").agg(
        F.min(F.struct("label", "text", "page")).alias("row")).select("id", "row.*").toPandas().sort_values("id")
    y = rows["label"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    views = tuple(np.stack(rows[c].to_numpy()).astype(float) for c in ("text", "page"))
    spare = np.array([zlib.crc32(i.encode()) % CALIBRATION == 0 for i in rows["id"]])
    if len(set(y[~spare].tolist())) < 2:
        spare = np.zeros(len(y), bool)
    labelled = labels.select(F.col(id_col).cast("string").alias("id"))
    pool = materialize(every.join(labelled, "id", "left_anti").select("text", "page"), "unlabelled")
    forget(every)
    return co_train(views, y, spare, lambda teachers, models: _summed(pool, teachers, models))


def score_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  label_col: str = "quality") -> DataFrame:
    """``documents`` with the columns score (0 to 1, higher: better) and predicted (1 if score >= 0.5, else 0).

    An id with several labels counts as poor if one says so; null labels
    and labels other than 0 and 1 are ignored.  Null or missing text counts
    as empty; null or missing source, lang and n_chars are unknown and speak
    neither for a document nor against it.  Without labels of both kinds
    every score is 1.  Columns already named score or predicted
    are replaced; equal rows stay.
    """
    shared = documents.sparkSession.sparkContext.broadcast(fit(documents, labels, id_col, label_col))
    documents = documents.drop(*({"score", "predicted"} & set(documents.columns)))
    columns = documents.columns
    extra = {c: F.lit(None).cast(t).alias(c) for c, t in (("lang", "string"), ("source", "string"),
                                                           ("n_chars", "double"), ("text", "string"))
             if c not in columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches):
            score = np.ones(batch.num_rows)
            if model is not None:
                score = model.probability(text_features(hash_words(batch.column("text"))), page_features(batch))
            yield pa.record_batch([*(batch.column(c) for c in columns), pa.array(score),
                                   pa.array((score >= 0.5).astype(np.int32))], names=[*columns, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.select("*", *extra.values()).mapInArrow(run, f"{schema}, score double, predicted int")
