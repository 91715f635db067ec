"""Near-duplicate vectors by product quantisation.

Unit vectors are assigned to coarse cells; the residual is coded by one byte
in each of eight subspaces, and the length of what the code misses is kept.
A vector asks every cell that a vector within reach of it can lie in: those
whose bisecting plane is no further than the reach.  This loses no link,
however the vectors are spread.  With a recall below 1 the planes asked are
those near enough for that share of planted partners at the very threshold;
partners lie in the directions in which vectors of the sample differ.  Where
cells spare little, fewer are made: their number is the cheapest on a part of
the sample.  Within a cell, table lookups give the distance to every code;
since the error of a code is known, what lies further than the reach plus the
error goes without loss.  The rest is compared by the exact cosine in double
precision.

Equal vectors form a class and are compared once.  Lists and queries of a
cell are dealt out in blocks of bounded size; a block counts its links and
returns a spanning forest of them, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.components import connected_components
from tagloom.llm.tables import materialize

#: Vectors that the index is fitted on, at most: those of the smallest id hashes.
SAMPLE = 16_384
SUBSPACES, CODES, ROUNDS = 8, 256, 8
#: Vectors of the sample that numbers of cells are tried on, and how many comparisons the copy of a vector costs.
TRIED, COPY_COST = 1_024, 4_000
LIST_BLOCK, QUERY_BLOCK = 16_384, 16_384
#: Partners planted to find out how far planes have to be asked.
PLANTED = 16_384
#: Queries and list rows whose table sums are made at once: two megabytes, which stay in a processor's cache.
QUERIES, LISTED = 256, 2_048


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def centres(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """``k`` centres of the rows of ``x`` (fewer rows: the distinct rows), by Lloyd's rounds."""
    x = np.unique(x, axis=0)
    if len(x) <= k:
        return x
    out = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        near = _squared(x, out).argmin(1)
        n = np.bincount(near, minlength=k)
        total = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
        out = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], out)
    return out


def reach_of(threshold: float) -> float:
    """How far apart unit vectors of this cosine are."""
    return float(np.sqrt(max(2 - 2 * threshold, 0)) + 1e-6)


def _asked(x: np.ndarray, cells: np.ndarray, own: np.ndarray, reach: float) -> np.ndarray:
    """For each row and cell, whether a vector within reach of the row may be nearest to the cell."""
    distance = _squared(x, cells)
    between = np.sqrt(_squared(cells, cells))[own] + 1e-6  # more than what rounding takes away
    return distance - distance[np.arange(len(x)), own][:, None] <= 2 * between * reach + 1e-9


def fitted_bound(sample: np.ndarray, cells: np.ndarray, threshold: float, recall: float) -> float:
    """How far bisecting planes may be to be asked: so far that ``recall`` of planted partners are found.

    Every partner has the threshold's cosine with a vector of the sample and
    lies towards a difference of two others.  Never more than the reach.
    """
    reach = reach_of(threshold)
    if recall >= 1 or len(cells) < 2:
        return reach
    rng = np.random.default_rng(0)
    x = sample[rng.integers(0, len(sample), PLANTED)]
    to = sample[rng.integers(0, len(sample), PLANTED)] - sample[rng.integers(0, len(sample), PLANTED)]
    to -= np.einsum("ij,ij->i", to, x)[:, None] * x
    length = np.linalg.norm(to, axis=1)
    x, to = x[length > 1e-9], to[length > 1e-9] / length[length > 1e-9][:, None]
    if not len(x):
        return reach
    partner = threshold * x + np.sqrt(max(1 - threshold * threshold, 0)) * to
    distance, row = _squared(x, cells), np.arange(len(x))
    own, there = distance.argmin(1), _squared(partner, cells).argmin(1)
    between = np.sqrt(((cells[own] - cells[there]) ** 2).sum(1)) + 1e-6
    needed = np.where(own == there, 0, (distance[row, there] - distance[row, own]) / (2 * between))
    return float(min(np.quantile(needed, recall) + 1e-6, reach))


def cheapest_cells(sample: np.ndarray, most: int, rows: int, threshold: float,
                   recall: float) -> tuple[np.ndarray, float]:
    """At most ``most`` centres of cells, so many that copying ``rows`` vectors to cells and comparing costs least, and
    the distance up to which planes are asked."""
    best, least = (sample[:1], reach_of(threshold)), np.inf
    k, tried = most, sample[:TRIED]
    while k >= 1:
        cells = centres(sample, k, 1)
        near = _squared(sample, cells).argmin(1)
        share = np.bincount(near, minlength=len(cells)) / len(sample)
        bound = fitted_bound(sample, cells, threshold, recall)
        asked = _asked(tried, cells, near[:len(tried)], bound).mean(0)
        listed = np.ceil(share * rows / LIST_BLOCK)  # a vector goes to every block of a cell's list
        cost = (asked * (COPY_COST * listed + share * rows)).sum()
        if cost < least:
            best, least = (cells, bound), cost
        k //= 4
    return best


@dataclass(frozen=True)
class Index:
    cells: np.ndarray
    codebooks: list[np.ndarray]
    cuts: np.ndarray  # where each subspace begins
    reach: float
    bound: float | None = None  # how far planes are asked, if not as far as the reach

    @classmethod
    def fit(cls, sample: np.ndarray, cells: int, threshold: float, rows: int, recall: float = 1.0) -> Index:
        dims = sample.shape[1]
        coarse, bound = cheapest_cells(sample, cells, rows, threshold, recall)
        rest = sample - coarse[_squared(sample, coarse).argmin(1)]
        cuts = np.linspace(0, dims, min(SUBSPACES, dims) + 1).astype(int)
        books = [centres(rest[:, a:b], CODES, 2 + i) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        return cls(coarse, books, cuts, reach_of(threshold), bound)

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, a:b] for a, b in zip(self.cuts, self.cuts[1:])]

    def coded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code and coding error of each row."""
        cell = _squared(x, self.cells).argmin(1)
        code = np.stack([_squared(p, book).argmin(1).astype(np.uint8)
                         for p, book in zip(self.parts(x - self.cells[cell]), self.codebooks)], axis=1)
        made = np.concatenate([book[code[:, m]] for m, book in enumerate(self.codebooks)], axis=1)
        return cell, code, np.linalg.norm(x - self.cells[cell] - made, axis=1) + 1e-6

    def probes(self, x: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that each row asks; its own is among them."""
        return np.nonzero(_asked(x, self.cells, cell, self.reach if self.bound is None else self.bound))

    def tables(self, x: np.ndarray, cell: int) -> list[np.ndarray]:
        """For each subspace the squared distances of its codes, by row, to the residuals."""
        return [_squared(book, p).astype(np.float32)
                for p, book in zip(self.parts(x - self.cells[cell]), self.codebooks)]


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not zero."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda v: v != 0)


_COLUMNS = "cell", "block", "part", "query", "id", "n", "code", "error", "vector"


def _dealt(classes: DataFrame, shared) -> DataFrame:
    """Each class as a list row in its cell and as a query row in every cell that it asks."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                raw = np.stack(batch.column("vector").to_numpy(zero_copy_only=False)).astype(float)
                x = unit(raw)
                cell, code, error = index.coded(x)
                row, asked = index.probes(x, cell)
                rows = np.concatenate((np.arange(len(x)), row))
                codes = [c.tobytes() for c in code]
                query = np.arange(len(rows)) >= len(x)
                yield pa.record_batch([
                    pa.array(np.concatenate((cell, asked)).astype(np.int32)),
                    pa.array(query), batch.column("id").take(pa.array(rows)), batch.column("n").take(pa.array(rows)),
                    pa.array([codes[r] for r in rows], pa.binary()), pa.array(error[rows]),
                    batch.column("vector").take(pa.array(rows))],
                    names=["cell", "query", "id", "n", "code", "error", "vector"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.mapInArrow(
        deal, f"cell int, query boolean, id long, n long, code binary, error double, vector {kind}")


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join what the links (a, b) join: each end with the smallest id found to be reachable."""
    ids, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = at[:len(a)], at[len(a):]
    label = np.arange(len(ids))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(ids)))
    return list(zip(ids[moved].tolist(), ids[label[moved]].tolist()))


def _near(tables: list[np.ndarray], code: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, list row) of every pair whose sum of table entries is within the row's limit.

    A code picks a whole row of its table, one entry for each query, so sums are made on rows in memory order.
    """
    width, found, space = tables[0].shape[1], [], np.empty((2, LISTED, tables[0].shape[1]), np.float32)
    for at in range(0, len(code), LISTED):
        part = code[at:at + LISTED]
        total, more = space[0, :len(part)], space[1, :len(part)]
        np.take(tables[0], part[:, 0], axis=0, out=total, mode="clip")
        for m, table in enumerate(tables[1:], 1):
            np.take(table, part[:, m], axis=0, out=more, mode="clip")
            total += more
        found.append(np.flatnonzero(total <= limit[at:at + LISTED]) + at * width)
    pairs = np.concatenate(found)
    return pairs % width, pairs // width


def _compare(index: Index, threshold: float, cell: int, lists: list[tuple], queries: list[tuple]) -> Iterator[tuple]:
    """(id, links, other): link counts of the queries in this list, and a forest with links 0."""
    ids, n, code, error, x = lists
    q_ids, q_x = queries
    # Single precision sums a few distances of at most four; the margin is a hundred times what that rounds.
    limit = np.square(error + index.reach + 1e-4).astype(np.float32)[:, None]
    for at in range(0, len(q_ids), QUERIES):
        own, rows = q_ids[at:at + QUERIES], q_x[at:at + QUERIES]
        i, j = _near(index.tables(rows, cell), code, limit)
        keep = own[i] != ids[j]
        i, j = i[keep], j[keep]
        sure = np.concatenate([np.einsum("ij,ij->i", rows[i[s:s + 50_000]], x[j[s:s + 50_000]]) >= threshold
                               for s in range(0, len(i), 50_000)]) if len(i) else np.zeros(0, bool)
        i, j = i[sure], j[sure]
        links = np.bincount(i, n[j], len(own)).astype(np.int64)
        yield from ((int(own[k]), int(links[k]), None) for k in np.flatnonzero(links))
        if len(i):
            yield from ((a, 0, b) for a, b in _forest(own[i], ids[j]))


def _links(dealt: DataFrame, shared, threshold: float) -> DataFrame:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        group, lists, ready = None, [], None
        for whole in batches:
            keys = np.column_stack([whole.column(c).to_numpy() for c in ("cell", "block", "part")])
            query = np.array(whole.column("query"))
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(1) | (query[1:] != query[:-1])) + 1
            for a, b in zip([0, *change], [*change, whole.num_rows]):
                if a == b:
                    continue
                part, key = whole.slice(a, b - a), tuple(keys[a])
                x = unit(np.stack(part.column("vector").to_numpy(zero_copy_only=False)).astype(float))
                ids = part.column("id").to_numpy()
                if key != group:
                    group, lists, ready = key, [], None
                if not query[a]:
                    code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
                    lists.append((ids, part.column("n").to_numpy(), code, part.column("error").to_numpy(), x))
                    continue
                if not lists:
                    continue
                ready = ready or tuple(np.concatenate(c) for c in zip(*lists))
                out = list(_compare(index, threshold, int(key[0]), ready, (ids, x)))
                yield pa.record_batch([pa.array([r[c] for r in out], pa.int64()) for c in range(3)],
                                      names=["id", "links", "other"])

    sizes = dealt.groupBy("cell").agg(
        F.ceil(F.count_if(~F.col("query")) / LIST_BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("query") / QUERY_BLOCK).cast("int").alias("parts")).where("blocks > 0 AND parts > 0")
    own_block = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    own_part = F.pmod(F.xxhash64("id", F.lit(1)), "parts").cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    placed = dealt.join(F.broadcast(sizes), "cell").withColumn(  # one row for each cell of the index
        "block", F.explode(F.when(F.col("query"), every("blocks")).otherwise(F.array(own_block)))).withColumn(
        "part", F.explode(F.when(F.col("query"), F.array(own_part)).otherwise(every("parts"))))
    ordered = placed.select(*_COLUMNS).repartition(
        "cell", "block", "part").sortWithinPartitions("cell", "block", "part", "query")
    return ordered.mapInArrow(search, "id long, links long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    vector_col: str = "embedding", recall: float = 1.0) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Two vectors are linked if their cosine in double precision is at least
    ``threshold``.  Vectors that are null, zero or hold null or non-finite
    components link with nothing; so do vectors of different lengths, and
    rows with a null id, which get a null component and are kept.  Equal
    vectors are linked; n_links counts rows.  Other columns are not read.
    With a ``recall`` below 1 about that share of the links at the very
    threshold is found at least, and more of the closer ones; with 1 all are.
    """
    spark = vectors.sparkSession
    given = vectors.schema[vector_col].dataType.simpleString()
    kind = given if given == "array<float>" else "array<double>"  # floats travel as floats; all sums are in double
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    fit = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    classes = materialize(fit.groupBy(F.col("v").alias("vector")).agg(
        F.min("id").alias("id"), F.count("*").alias("n")), "classes")
    parts = []
    for row in classes.groupBy(F.size("vector").alias("dims")).count().collect():  # vector lengths, few
        own = classes.where(F.size("vector") == row["dims"])
        sample = own.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()["vector"]
        cells = int(np.clip(np.sqrt(row["count"]), 1, SAMPLE // 16))
        index = Index.fit(unit(np.stack(sample.to_numpy()).astype(float)), cells, threshold, row["count"], recall)
        shared = spark.sparkContext.broadcast(index)
        parts.append(_links(materialize(_dealt(own, shared), "dealt"), shared, threshold))
    if parts:
        found = parts[0]
        for p in parts[1:]:
            found = found.unionByName(p)
    else:
        found = spark.createDataFrame([], "id long, links long, other long")
    found = materialize(found, "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = connected_components(found.where("other IS NOT NULL"), "id", "other")
    of_class = classes.join(counts, "id", "left").join(joined, "id", "left").select(
        "vector", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"))
    key = F.when(F.col("id").isNotNull() & usable(F.col("v")), F.col("v"))
    return rows.select("id", key.alias("vector")).join(of_class, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "id") == F.col("id"), F.lit(True)).alias("kept"))
