"""Near-duplicate documents by HyperMinHash.

The hashes of a document's distinct shingles are dealt into 256 buckets by
their first bits.  A bucket's register keeps the smallest hash in it as a
count of leading zeros and ten mantissa bits: two bytes, whatever the text.

1. Documents with equal shingle sets (equal size and 128-bit fingerprint)
   form a class; its smallest id stands for it.
2. 42 bands of six registers give 42 keys for each class.  Within a key, each class is a candidate partner of
   the smallest one: rows grow with classes, not with pairs.
3. Candidates whose collision-corrected Jaccard estimate lies more than
   five standard errors below the threshold go; the others are confirmed
   on the full shingle sets of both texts.
4. Keys whose classes are still in several components are searched again,
   all plausible pairs across components.  No candidate that could join two
   components stays unconfirmed.

At similarity 0.8 a band agrees with probability 0.26, so two documents
share no key with probability 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.components import connected_components
from tagloom.llm.tables import materialize
from tagloom.llm.words import U64, hash_shingles, hash_words, mix, slices

BUCKETS, MANTISSA, ROWS = 256, 10, 6
BANDS = BUCKETS // ROWS
#: Standard errors that an estimate may lie below the threshold.
SLACK = 5.0


_FIRST = np.arange(BUCKETS, dtype=U64) << U64(56)
#: Of a 64-bit place: 8 bits of bucket, 11 of round, 45 of the hash's further bits.
_VALUE = 45


def smallest(shingles: np.ndarray) -> np.ndarray:
    """For each bucket the 45 bits of the smallest hash dealt to it, of an array of distinct hashes.

    Buckets that the first round leaves empty are filled by further rounds,
    in which every hash is dealt out anew: a short text has as many
    independent registers as a long one.
    """
    n = len(shingles)
    begin, rounds = 0, max(1, 2048 // n)
    out, empty = np.zeros(BUCKETS, U64), np.ones(BUCKETS, bool)
    while True:
        numbers = np.arange(begin, begin + rounds, dtype=U64)[:, None]
        dealt = mix(shingles[None, :] + numbers * U64(0x9E3779B97F4A7C15))
        place = (dealt >> U64(56) << U64(56)) | (numbers << U64(_VALUE)) | (dealt << U64(8) >> U64(64 - _VALUE))
        place = np.sort(place.reshape(-1))
        at = np.minimum(np.searchsorted(place, _FIRST), len(place) - 1)
        fill = empty & (place[at] >> U64(56) << U64(56) == _FIRST)
        out[fill] = place[at[fill]] & U64((1 << _VALUE) - 1)
        empty &= ~fill
        if not empty.any():
            return out
        begin += rounds


def registers(value: np.ndarray) -> np.ndarray:
    """Two bytes for each smallest value: its leading zeros, plus one, and the ten bits after them."""
    _, exponent = np.frexp(value.astype(np.float64))
    zeros = np.where(value == 0, _VALUE, _VALUE - exponent).astype(U64)
    mantissa = (value << (zeros + U64(65 - _VALUE))) >> U64(64 - MANTISSA)
    return (((zeros + U64(1)) << U64(MANTISSA)) | mantissa).astype(np.uint16)


def band_keys(table: np.ndarray) -> np.ndarray:
    """42 keys for each row of registers."""
    n = len(table)
    value = table[:, :BANDS * ROWS].reshape(n, BANDS, ROWS).astype(U64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=U64), (n, BANDS)).copy()
    for r in range(ROWS):
        key = mix(key * U64(0x9FB21C651E98DF25) + value[:, :, r])
    return key.view(np.int64)


_LEVELS = np.arange(_VALUE)


def expected_collisions(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Buckets that agree by chance for independent sets of ``n`` and ``m`` hashes.

    A bucket's smallest hash is about exponentially distributed, with rates
    a and b, but at least one for sets too small to fill all buckets; a cell
    of width w at x holds both with probability a * b * w**2 *
    exp(-(a + b) * x), summed over the cells of all levels.
    """
    a, b = (np.maximum(np.asarray(x, float)[:, None] / BUCKETS, 1) for x in (n, m))
    low, width = 2.0 ** -(_LEVELS + 1.0), 2.0 ** -(_LEVELS + 1.0 + MANTISSA)
    rate = a + b
    share = a * b * width / rate * (np.exp(-rate * low) - np.exp(-rate * 2 * low))
    return BUCKETS * share.sum(axis=1)


def plausible(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether the similarity may reach ``percent``, by sizes and by the estimate.

    ``x`` may be one row of registers for all of ``y``.
    """
    t = percent / 100
    out = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    at = np.flatnonzero(out)
    x = x if x.ndim == 1 else x[at]
    used = np.maximum(((x != 0) | (y[at] != 0)).sum(axis=1), 1)
    least = t - SLACK * (np.sqrt(t * (1 - t) / used) + 1 / used)
    same = ((x == y[at]) & (x != 0)).sum(axis=1)
    out[at] = same >= least * used
    close = np.flatnonzero(out[at])  # the correction only lowers an estimate
    at, same, used, least = at[close], same[close], used[close], least[close]
    out[at] = (same - expected_collisions(n[at], m[at])) / used >= least
    return out


_SIGNATURE = "id long, n long, f1 long, f2 long, registers binary, bands array<long>"


def signatures(documents: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n, f1, f2, registers, bands) of every row; a text without words has n 0 and no bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, starts = hash_shingles(hash_words(batch.column("text")), k)
            size = batch.num_rows
            n, f1, f2 = (np.zeros(size, U64) for _ in range(3))
            table = np.zeros((size, BUCKETS), np.uint16)
            sets = [np.unique(hashes[a:b]) for a, b in zip(starts, starts[1:])]
            n[:] = [len(x) for x in sets]
            for i in np.flatnonzero(n):
                table[i] = registers(smallest(sets[i]))
                f1[i] = mix(sets[i]).sum(dtype=U64)
                f2[i] = np.bitwise_xor.reduce(mix(sets[i] + U64(0x632BE59BD9B4E019)))
            some = n > 0
            keys = band_keys(table[some]).reshape(-1)
            bounds = np.concatenate(([0], np.cumsum(np.where(some, BANDS, 0)))).astype(np.int32)
            yield pa.record_batch([
                batch.column("id"), *(pa.array(v.view(np.int64)) for v in (n, f1, f2)),
                pa.array([r.tobytes() for r in table], pa.binary()),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys))],
                names=["id", "n", "f1", "f2", "registers", "bands"])

    return documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        sketch, _SIGNATURE)


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows (a, b) of ``pairs`` whose full shingle sets reach ``percent``.

    Both joins are plain shuffles, which adaptive execution splits when one
    id has many partners; the set of a text is kept while its rows follow each other.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, np.ndarray] = {}
        for whole in batches:
            for batch in slices(iter([whole]), "text_b"):
                a = batch.column("a").to_numpy()
                hashes, starts = hash_shingles(hash_words(batch.column("text_b")), k)
                keep = np.zeros(len(a), bool)
                for i, one in enumerate(a):
                    if one not in kept:
                        own, _ = hash_shingles(hash_words(batch.column("text_a").slice(i, 1)), k)
                        kept = {one: np.unique(own)}
                    first, second = kept[one], np.unique(hashes[starts[i]:starts[i + 1]])
                    both = _common(first, second)
                    keep[i] = 100 * both >= percent * (len(first) + len(second) - both)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(
        compare, "a long, b long")


def _common(first: np.ndarray, second: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    if len(first) == 0 or len(second) == 0:
        return 0
    at = np.minimum(np.searchsorted(first, second), len(first) - 1)
    return int((first[at] == second).sum())


def _estimated(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that may reach ``percent``."""

    def passing(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, y = (np.frombuffer(b"".join(f[c]), np.uint16).reshape(-1, BUCKETS) for c in ("r_a", "r_b"))
            yield f.loc[plausible(x, y, f["n_a"].to_numpy(), f["n_b"].to_numpy(), percent), ["a", "b"]]

    for side in ("a", "b"):
        pairs = pairs.join(sketches.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"),
                                           F.col("registers").alias(f"r_{side}")), side)
    return pairs.mapInPandas(passing, "a long, b long")


#: Members of a key that are held together, and shingles of theirs (64 MB), about; larger keys are searched block by
#: block.
BLOCK, BLOCK_SHINGLES = 2048, 1 << 23


def _open_keys(members: DataFrame, components: DataFrame) -> DataFrame:
    """(key, i, j, side, id, component_id) of those keys whose classes lie in several components.

    Keys of up to BLOCK members are one group (0, 0); in larger ones every
    pair of blocks is a group, and a member is in the groups of its block.
    Both inputs of the join are plain shuffles, which adaptive execution
    splits where one key holds many members.
    """
    labelled = members.join(components, "id", "left").withColumn(
        "component_id", F.coalesce("component_id", "id"))
    open_keys = labelled.groupBy("key").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high"),
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("blocks")).where(
        "low <> high").select("key", "blocks")
    open_keys = materialize(open_keys, "open-keys")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = labelled.join(open_keys, "key").withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                        (F.col("block") > F.col("other")).cast("int").alias("side"), "id", "component_id")


def _search(members: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links (a, b) that join components within each group of members.

    Every plausible pair of a group across components is confirmed on its
    full sets, unless links of the group have joined the two before; so the
    result grows with components and not with pairs.
    """

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in slices(batches):
            hashes, starts = hash_shingles(hash_words(batch.column("text")), k)
            columns = [batch.column(c).to_numpy() for c in ("key", "i", "j", "side", "id", "component_id")]
            for i, row in enumerate(zip(*columns)):
                if row[:3] != group:
                    yield _pairs(_join_group(rows, percent))
                    group, rows = row[:3], []
                own = np.unique(hashes[starts[i]:starts[i + 1]])
                rows.append((*row[3:], own, registers(smallest(own))))
        yield _pairs(_join_group(rows, percent))

    return members.join(texts, "id").select(
        "key", "i", "j", "side", "id", "component_id", "text").repartition("key", "i", "j").sortWithinPartitions(
        "key", "i", "j", "id").mapInArrow(links, "a long, b long").distinct()


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array([min(p) for p in pairs], pa.int64()),
                            pa.array([max(p) for p in pairs], pa.int64())], names=["a", "b"])


def _join_group(rows: list[tuple], percent: int) -> list[tuple[int, int]]:
    if len(rows) < 2:
        return []
    sides, ids, components, sets, tables = zip(*rows)
    within = len(set(sides)) == 1
    sides, labels, table = np.array(sides), np.array(components), np.array(tables)
    sizes = np.array([len(x) for x in sets])
    found = []
    for i in range(1, len(ids)):
        other = labels[:i] != labels[i]
        if not within:
            other &= sides[:i] != sides[i]
        use = np.flatnonzero(other)
        if len(use) == 0:
            continue
        use = use[plausible(table[i], table[use], np.full(len(use), sizes[i]), sizes[use], percent)]
        for j in use[np.argsort(-(table[use] == table[i]).sum(axis=1), kind="stable")]:
            if labels[j] != labels[i]:
                both = _common(sets[i], sets[j])
                if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                    found.append((ids[i], ids[j]))
                    labels[labels == labels[j]] = labels[i]
    return found


def near_duplicates(documents: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``documents``.

    Words are runs of other bytes than 0x20 and 0x09-0x0D, A-Z lower-cased.
    Two documents are linked if 100 * |A and B| >= percent * |A or B| for
    their sets of ``k``-word shingles; with fewer words the whole sequence
    is the only shingle.  component_id is the smallest id reachable.

    A null or wordless text has n_shingles 0 and its own id.  A row with a
    null id is linked with nothing, gets a null component and is kept.
    Rows that share an id are one document: they get the smallest component
    of their texts.  Other columns are not read.
    """
    sketches = materialize(signatures(documents, k, id_col, text_col), "signatures")
    with_words = sketches.where("n > 0 AND id IS NOT NULL")
    classes = with_words.groupBy("n", "f1", "f2").agg(
        F.min("id").alias("class_id"))
    rows = with_words.select("id", "n", "f1", "f2").join(classes, ["n", "f1", "f2"]).select("id", "class_id", "n")
    rows = materialize(rows, "classes")
    found = _components(documents, sketches, rows, k, percent, id_col, text_col)
    return sketches.select("id", "n").join(found, "id", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))


def _components(documents: DataFrame, sketches: DataFrame, rows: DataFrame, k: int, percent: int,
                id_col: str, text_col: str) -> DataFrame:
    """(id, component_id) of the documents that are linked with any."""
    chosen = rows.where("id = class_id").select("id").distinct()
    sketches = sketches.join(chosen, "id", "left_semi").dropDuplicates(["id", "n", "f1", "f2"])
    keys = sketches.select(F.explode("bands").alias("key"), "id", "n")
    # Keys with the same members say the same; one of them is enough.
    heads = keys.groupBy("key").agg(
        F.min("id").alias("head"), F.max("id").alias("last"), F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("y"),
    ).where("head <> last").groupBy("head", "last", "size", "x", "y").agg(F.min("key").alias("key"))
    heads = materialize(heads.select("key", "head"), "heads")
    members = materialize(keys.join(heads, "key"), "members")
    first = members.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    pairs = materialize(_estimated(first, sketches, percent), "pairs")
    in_keys = materialize(members.select("id").distinct(), "ids")
    texts = materialize(documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(
        in_keys, "id", "left_semi"), "texts")
    same = rows.where("id <> class_id").select(F.col("id").alias("a"), F.col("class_id").alias("b"))
    links = materialize(same.unionByName(confirm(pairs, texts, k, percent)), "links")
    components = materialize(connected_components(links), "components")
    more = materialize(_search(_open_keys(members, components), texts, k, percent), "links")
    return connected_components(links.unionByName(more))
