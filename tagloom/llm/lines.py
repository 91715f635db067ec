"""Removal of lines that repeat across documents.

Two Bloom filters find the suspects: a key's hash enters the first filter
when it is met, and the second when it is met again.  Every task first
reduces its documents to one row for each key, so the filters of a shard
read few rows even of a line that stands everywhere; those rows, a 64-bit hash
and a count, are shuffled once.  Only lines that the second filter holds are
shuffled as 128-bit keys with the document's id,
for the exact count of documents and the choice of the first occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import materialize, unused
from tagloom.llm.words import U64, buffers, mix, slices

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BITS_PER_KEY, PROBES = 16, 6


class Bloom:
    def __init__(self, keys: int):
        self.bits = np.zeros(-(-max(keys, 4) * BITS_PER_KEY // 8), np.uint8)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = mix(hashes + U64(0x632BE59BD9B4E019)) | U64(1)
        return (hashes[:, None] + np.arange(PROBES, dtype=U64) * step[:, None]) % U64(8 * len(self.bits))

    def add(self, hashes: np.ndarray) -> None:
        at = self._places(hashes).reshape(-1)
        np.bitwise_or.at(self.bits, (at >> U64(3)).astype(np.int64), np.uint8(1) << (at & U64(7)).astype(np.uint8))

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        at = self._places(hashes)
        return ((self.bits[(at >> U64(3)).astype(np.int64)] >> (at & U64(7)).astype(np.uint8)) & 1).all(axis=1)


def _line_keys(data: memoryview, low: int, high: int, min_chars: int) -> tuple[list[bytes], list[int | None]]:
    """Lines of a text and the 128-bit hash of each key; None for keys that are too short."""
    lines = bytes(data[low:high]).split(b"\n")
    keys = []
    for line in lines:
        key = line.strip().translate(_LOWER)
        long_enough = len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)
        keys.append(xxhash.xxh3_128_intdigest(key) if long_enough else None)
    return lines, keys


def _halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(k.to_bytes(16, "little") for k in keys), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _keys_by_document(documents: DataFrame, min_chars: int, with_copy: bool = False) -> DataFrame:
    """(lo, hi, id): every key once for each row of ``documents``.

    ``with_copy`` adds ``copy``, a hash of the row's set of keys: equal in copies of a text.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, bounds = buffers(batch.column("text"))
            owners, keys, copies = [], [], []
            for i, (low, high) in enumerate(zip(bounds, bounds[1:])):
                own = set(_line_keys(data.data, low, high, min_chars)[1]) - {None}
                keys += own
                owners += [i] * len(own)
                copies.append(sum(own) % (1 << 64))
            lo, hi = _halves(keys)
            at = pa.array(owners, pa.int64())
            out = {"lo": pa.array(lo), "hi": pa.array(hi), "id": batch.column("id").take(at)}
            if with_copy:
                out["copy"] = pa.array(np.array(copies, U64).view(np.int64)).take(at)
            yield pa.record_batch(list(out.values()), names=list(out))

    return documents.mapInArrow(explode, "lo long, hi long, id long" + ", copy long" * with_copy)


def _suspects(keys: DataFrame) -> DataFrame:
    """(lo) of the keys that the second filter holds: all in two rows or more, and few others."""

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(b.column("lo").to_numpy(), b.column("n").to_numpy()) for b in batches]
        once, twice = (Bloom(sum(len(lo) for lo, _ in rows)) for _ in range(2))
        for lo, n in rows:
            hashes, repeats = np.unique(lo.view(U64), return_counts=True)
            again = np.zeros(len(hashes), bool)
            again[np.searchsorted(hashes, lo.view(U64)[n > 1])] = True
            twice.add(hashes[again | (repeats > 1) | once.holds(hashes)])
            once.add(hashes)
        for lo, _ in rows:
            yield pa.record_batch([pa.array(np.unique(lo[twice.holds(lo.view(U64))]))], names=["lo"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo, n = np.unique(batch.column("lo").to_numpy(), return_counts=True)
            yield pa.record_batch([pa.array(lo), pa.array(n)], names=["lo", "n"])

    return keys.select("lo").mapInArrow(count, "lo long, n long").repartition("lo").mapInArrow(
        flag, "lo long").distinct()


def repeated_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", copied_only: bool = False) -> DataFrame:
    """(lo, hi, id, first) for each document and repeated key in it; ``first`` marks the smallest id.

    With ``copied_only``, it marks nothing for keys in ``min_docs`` different texts or more.
    """
    source = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = materialize(_keys_by_document(source, min_chars, copied_only), "line-keys")
    suspects = materialize(_suspects(keys), "suspects")
    found = keys.join(suspects, "lo", "left_semi")
    if copied_only:
        found = found.groupBy("lo", "hi", "id").agg(F.min("copy").alias("copy"))
        texts = found.groupBy("lo", "hi", "copy").agg(F.count("*").alias("n"), F.min("id").alias("least"))
        repeated = texts.groupBy("lo", "hi").agg(
            F.sum("n").alias("n"), F.min("least").alias("least"), (F.count("*") < min_docs).alias("kept"))
    else:
        found = found.distinct()
        repeated = found.groupBy("lo", "hi").agg(F.count("*").alias("n"), F.min("id").alias("least"),
                                                 F.lit(True).alias("kept"))
    return found.join(repeated.where(F.col("n") >= min_docs).select("lo", "hi", "least", "kept"), ["lo", "hi"]).select(
        "lo", "hi", "id", (F.col("kept") & F.col("id").eqNullSafe(F.col("least"))).alias("first"))


def drop_repeated_lines(documents: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False,
                        id_col: str = "doc_id", text_col: str = "text", keep_copied: bool = False) -> DataFrame:
    """``documents`` with new texts, and the columns n_lines and n_dropped (long).

    A text is split at \\n; null and empty are one empty line.  A line's key
    is the line without bytes 0x20 and 0x09-0x0D at both ends, A-Z
    lower-cased.  Keys of at least ``min_chars`` code points in at least
    ``min_docs`` documents lose all their lines; with ``keep_first``, the
    first line of each key in the document with the smallest id stays.
    ``keep_copied`` does so only for keys in fewer than ``min_docs``
    different texts: what repeats by copies of a text stays once, what
    stands in many texts goes everywhere.  Texts with the same set of keys
    are copies.  Other lines stay as they are, joined by \\n.

    Rows that share an id, or have none, count as one document.  Columns
    that are already named n_lines or n_dropped are replaced.
    """
    documents = documents.drop(*({"n_lines", "n_dropped"} & set(documents.columns)))
    copied_only = keep_copied and not keep_first
    keep_first = keep_first or keep_copied
    name, owner = unused(documents, "drops"), unused(documents, "drop_id")
    drops = repeated_lines(documents, min_docs, min_chars, id_col, text_col, copied_only).groupBy("id").agg(
        F.collect_list(F.struct("lo", "hi", "first")).alias(name)).withColumnRenamed("id", owner)
    joined = documents.join(drops, F.col(id_col).cast("long").eqNullSafe(F.col(owner)), "left").drop(owner)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            data, bounds = buffers(batch.column(text_col))
            drops = batch.column(name).to_pylist()
            texts, counts, dropped = [], [], []
            for i, own in enumerate(drops):
                text = bytes(data[bounds[i]:bounds[i + 1]])
                counts.append(text.count(b"\n") + 1)
                gone = 0
                if own:
                    lines, keys = _line_keys(memoryview(text), 0, len(text), min_chars)
                    first = {}
                    for d in own:
                        key = int.from_bytes(d["lo"].to_bytes(8, "little", signed=True)
                                             + d["hi"].to_bytes(8, "little", signed=True), "little")
                        first[key] = keep_first and d["first"]
                    kept = []
                    for line, key in zip(lines, keys):
                        if key not in first or first[key]:
                            kept.append(line)
                            if key in first:
                                first[key] = False
                    gone, text = len(lines) - len(kept), b"\n".join(kept)
                texts.append(text.decode())
                dropped.append(gone)
            new = {text_col: pa.array(texts, pa.string())}
            names = [n for n in batch.schema.names if n != name]
            yield pa.record_batch([new.get(n, batch.column(n)) for n in names]
                                  + [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())],
                                  names=[*names, "n_lines", "n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return joined.mapInArrow(rewrite, f"{schema}, n_lines long, n_dropped long")
