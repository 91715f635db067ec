"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Items are partitioned by their number of shingles, in powers of two.  An item
of a partition is sketched by its smallest hashes, as many as the partition's
largest item may miss and one more: with at most that many shingles missing,
a document that contains the item holds some hash of the sketch.  A document
looks only into the partitions whose items it is large enough to contain.
What it holds of an item's sketch makes a candidate, which is confirmed by
counting the shared shingles.

A MinHash sketch of the document's side would not do: in a document of
20,000 words an item of 40 has a Jaccard similarity of 0.002, and most such
pairs share no minimum.  Probing all hashes of the document loses none.

Hashes meet by joins, so the benchmark may be as large as the documents.  A
Bloom filter of bounded size spares the shuffle what no item holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import materialize, unused
from tagloom.llm.words import U64, hash_shingles, hash_words, mix, slices

#: Bits of the filter for each hash of the items, and hashes that it has them for: 16 MB.  With more it only lets more
#: of the documents' hashes through.
BITS, BLOCK = 16, 1 << 23
#: Parts that the rows of one hash are dealt into.
SALTS = 16


def size_partition(n: np.ndarray) -> np.ndarray:
    """The partition of items with ``n`` shingles: those of 2**p to 2**(p+1) - 1."""
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def sketch_length(part: int, percent: int) -> int:
    """More hashes than the largest item of a partition may miss."""
    largest = 2 ** (part + 1) - 1
    return largest - -(-percent * largest // 100) + 1


def _least_size(part: np.ndarray, percent: int) -> np.ndarray:
    """Distinct shingles that a document needs to contain the smallest item of a partition."""
    return -(-percent * 2 ** part // 100)


def _items(benchmark: DataFrame, k: int, percent: int, item_col: str, text_col: str) -> DataFrame:
    """(item, row, words, n, part, hash, sketched) of every shingle of every item; ``row`` tells rows of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = hash_words(batch.column("text"))
            hashes, starts = hash_shingles(words, k)
            n_words = np.minimum(np.diff(words.starts), k)
            for i in np.flatnonzero(np.diff(starts) > 0):
                own = np.unique(hashes[starts[i]:starts[i + 1]])
                n, part = len(own), int(size_partition(np.array([len(own)]))[0])
                row = mix(np.array([own.sum(dtype=U64) + U64(n_words[i])], U64)).view(np.int64)[0]
                yield pa.record_batch({
                    "item": pa.array(np.full(n, batch.column("item")[int(i)].as_py())), "row": pa.array(np.full(n, row)),
                    "words": pa.array(np.full(n, n_words[i], np.int32)), "n": pa.array(np.full(n, n)),
                    "part": pa.array(np.full(n, part, np.int32)), "hash": pa.array(own.view(np.int64)),
                    "sketched": pa.array(np.arange(n) < sketch_length(part, percent))})

    source = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(text_col).alias("text")).where(
        "item IS NOT NULL")
    return source.mapInArrow(run, "item long, row long, words int, n long, part int, hash long, sketched boolean")


def _bit(hashes: np.ndarray, words: int, part: int, bits: int) -> np.ndarray:
    """The filter's bit for each hash in a partition; partition -1 stands for all."""
    return (mix(hashes + U64((part + 2) * 64 + words)) & U64(bits - 1)).astype(np.int64)


def _filter(items: DataFrame) -> np.ndarray:
    """The bits of all hashes, by themselves and in their partitions.  At most 16 MB come to the driver."""
    rows = items.count()
    bits = 64
    while bits < BITS * min(rows, BLOCK):
        bits *= 2

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(U64)
            words, parts = (batch.column(c).to_numpy() for c in ("words", "part"))
            found = []
            for w, p in set(zip(words.tolist(), parts.tolist())):
                own = hashes[(words == w) & (parts == p)]
                found += [_bit(own, w, p, bits), _bit(own, w, -1, bits)]
            at = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
            yield pa.record_batch({"at": at >> 6, "mask": (U64(1) << (at & 63).astype(U64)).view(np.int64)})

    found = items.select("words", "part", "hash").mapInArrow(positions, "at long, mask long").groupBy("at").agg(
        F.bit_or("mask").alias("mask")).toPandas()
    out = np.zeros(bits // 64, U64)
    out[found["at"].to_numpy(np.int64)] = found["mask"].to_numpy(np.int64).view(U64)
    return out


def _holds(bits: np.ndarray, hashes: np.ndarray, words: int, part: int) -> np.ndarray:
    at = _bit(hashes, words, part, len(bits) * 64)
    return (bits[at >> 6] >> (at & 63).astype(U64)) & U64(1) > 0


def _hits(source: DataFrame, shared, percent: int) -> DataFrame:
    """(doc, text, words, size, part, hash): the hashes of each text that the filter holds in a partition whose items
    the text can contain.  ``text`` tells texts of one id apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, kinds = shared.value
        for batch in slices(batches):
            words, ids = hash_words(batch.column("text")), batch.column("id")
            rows = []
            for n in sorted({w for w, _ in kinds}):
                parts = [p for w, p in kinds if w == n]
                hashes, starts = hash_shingles(words, n)
                hits = np.cumsum(np.append(0, _holds(bits, hashes, n, -1)))
                for i in np.flatnonzero(hits[starts[1:]] > hits[starts[:-1]]):
                    own = np.unique(hashes[starts[i]:starts[i + 1]])
                    text = mix(np.array([own.sum(dtype=U64)], U64)).view(np.int64)[0]
                    own, size = own[_holds(bits, own, n, -1)], len(own)
                    for p in parts:
                        if size >= _least_size(np.array([p]), percent)[0]:
                            found = own[_holds(bits, own, n, p)]
                            rows.append((i, text, n, size, p, found))
            sizes = [len(r[-1]) for r in rows]
            column = lambda c, kind: pa.array(np.repeat(np.array([r[c] for r in rows], kind), sizes))
            flat = np.concatenate([r[-1] for r in rows]) if rows else np.zeros(0, U64)
            yield pa.record_batch({
                "doc": ids.take(column(0, np.int64)), "text": column(1, np.int64), "words": column(2, np.int32),
                "size": column(3, np.int64), "part": column(4, np.int32), "hash": pa.array(flat.view(np.int64))})

    return source.mapInArrow(run, "doc long, text long, words int, size long, part int, hash long")


def _same(columns: list[str]) -> list[Column]:
    """Columns equal to those of the same name with an underscore, nulls too."""
    return [F.col(c).eqNullSafe(F.col(f"{c}_")) for c in columns]


def contained_items(documents: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) of all documents that hold an item.

    A document holds an item if it has at least ``percent`` of the item's
    distinct ``k``-word shingles; words are runs of other bytes than 0x20
    and 0x09-0x0D, A-Z lower-cased.  An item with fewer than ``k`` words is
    held where its whole sequence of words stands.  Items without words or
    id are held by nothing, and so are items in texts without words.  Rows
    that share an id count as one document if either holds the item; of
    items that share an id the largest counts.  Documents without an id are
    one document.  Empty tables give no rows; other columns are not read.

    The documents are read once; what is shuffled are their hashes that the
    filter of the items holds, each hash dealt into SALTS parts.
    """
    spark = documents.sparkSession
    source = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    items = materialize(_items(benchmark, k, percent, item_col, item_text_col).distinct(), "items")
    # At most k numbers of words and as many partitions as sizes have digits.
    kinds = [tuple(r) for r in items.select("words", "part").distinct().collect()]
    hits = materialize(_hits(source, spark.sparkContext.broadcast((_filter(items), kinds)), percent), "hits")
    key = ["words", "part", "hash", "salt"]
    salted = hits.withColumn("salt", F.pmod(F.xxhash64("doc", "text"), F.lit(SALTS)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    both = salted.join(items.where("sketched").select("item", "row", "n", "words", "part", "hash", every), key)
    pair = ["doc", "text", "item", "row"]
    candidates = materialize(both.where(F.col("size") * 100 >= F.col("n") * percent).select(*pair).distinct(),
                             "candidates")
    # All shingles that candidates share: rows meet by hash, then by document and item.
    texts, rows = (candidates.select(*(F.col(c).alias(f"{c}_") for c in names)).distinct()
                   for names in (pair[:2], pair[2:]))
    left = salted.join(texts, _same(pair[:2]), "left_semi")
    right = items.join(rows, _same(pair[2:]), "left_semi").select("item", "row", "n", "words", "part", "hash", every)
    counts = left.join(right, key).groupBy(*pair, "n").agg(F.count_distinct("hash").alias("shared"))
    held = counts.where(F.col("shared") * 100 >= F.col("n") * percent).join(
        candidates.select(*(F.col(c).alias(f"{c}_") for c in pair)), _same(pair), "left_semi")
    return held.groupBy(F.col("doc").alias(id_col), F.col("item").alias(item_col)).agg(
        F.max("shared").alias("n_shared"), F.max("n").alias("n_item"))


def without_contaminated(documents: DataFrame, benchmark: DataFrame, k: int = 5, percent: int = 80,
                         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that hold no item; rows with a null id stay."""
    name = unused(documents, "held")
    held = contained_items(documents, benchmark, k, percent, id_col, text_col).select(
        F.col(id_col).alias(name)).distinct()
    return documents.join(held, F.col(id_col).cast("long") == F.col(name), "left_anti")
