"""Phrase collocations, counted by direct-address tiles.

Words get ids by falling frequency, so frequent pairs of neighbours lie in
few tiles of the id plane.  A task counts the well-filled tiles in dense
arrays with ``numpy.bincount`` and all others as sorted coordinates; only its
sums are shuffled.  Frequent pairs then get ids by frequency themselves: a
phrase of three words is a pair and a word, one of four is two pairs, counted
in tiles again.  Every part of a phrase is at least as frequent as the phrase,
so nothing that reaches ``min_count`` is passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.tables import materialize
from tagloom.llm.words import U64, hash_words, mix, slices

#: Ids go to the most frequent symbols only, which bounds what is broadcast (8 bytes each); others count by hash.
MOST_WORDS, MOST_PAIRS = 1 << 20, 1 << 22
#: Ids along a side of a tile; how full a tile has to be to get a dense array; dense arrays of a counter (4 MB each).
SIDE, FILLED, MOST_DENSE = 1 << 10, 1 / 8, 12
#: Coordinates that a task collects before sorting them, and sorted ones that it keeps before handing them on; bytes of
#: text that it takes at once.
PENDING, KEPT, SLICE = 1 << 19, 1 << 22, 1 << 19
#: Pairs after which a task hands all counts on, as they have 32 bits; rows of a batch that it hands on.
MOST_ADDED, ROWS = 1 << 30, 1 << 16

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_WORD = ~_BREAK
_WORD[[0x20, 0x09]] = False


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit key for each pair of keys, in order."""
    return mix(a * U64(0x9FB21C651E98DF25) + mix(b ^ U64(0xD1342543DE82EF95)))


class Ranks:
    """Ids of symbols by falling frequency, found by binary search over their sorted keys.

    Only the keys are sent; they are sorted where one is first looked for.
    """

    def __init__(self, keys: np.ndarray, complete: bool):
        self.keys, self.complete = keys, complete
        self._sorted = None

    def __reduce__(self):
        return Ranks, (self.keys, self.complete)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The id of every key, or -1."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int64)
        if self._sorted is None:
            self._order = np.argsort(self.keys).astype(np.int32)
            self._sorted = self.keys[self._order]
        at = np.minimum(np.searchsorted(self._sorted, keys), len(self._sorted) - 1)
        return np.where(self._sorted[at] == keys, self._order[at], -1).astype(np.int64)


class TileCounter:
    """Counts of pairs of ids: dense arrays for filled tiles, sorted coordinates for the others."""

    def __init__(self) -> None:
        self._dense: dict[int, np.ndarray] = {}
        self._pending: list[np.ndarray] = []
        self._waiting = self._added = 0
        self._keys, self._counts = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self._added += len(a)
        if self._dense:
            tile = (a // SIDE) << 32 | b // SIDE
            rest = np.ones(len(a), bool)
            for number, cells in self._dense.items():
                inside = tile == number
                cells += np.bincount((a[inside] % SIDE) * SIDE + b[inside] % SIDE, minlength=SIDE * SIDE)
                rest &= ~inside
            a, b = a[rest], b[rest]
        self._pending.append(a << 32 | b)
        self._waiting += len(a)
        if self._waiting > PENDING:
            self._sort()

    def _sort(self) -> None:
        """Take in the waiting coordinates; tiles that have filled up become dense."""
        found = np.concatenate([np.zeros(0, np.int64), *self._pending])
        self._pending, self._waiting = [], 0
        found.sort()
        first = np.flatnonzero(np.diff(found, prepend=-1))
        found, counts = found[first], np.diff(first, append=len(found))
        at = np.searchsorted(self._keys, found)
        old = np.zeros(len(found), bool)
        inner = at < len(self._keys)
        old[inner] = self._keys[at[inner]] == found[inner]
        self._counts[at[old]] += counts[old]
        self._counts = np.insert(self._counts, at[~old], counts[~old])
        self._keys = np.insert(self._keys, at[~old], found[~old])
        self._fill()

    def _fill(self) -> None:
        """Move the fullest tiles into dense arrays, as far as there are any left."""
        free, least = MOST_DENSE - len(self._dense), SIDE * SIDE * FILLED
        if free <= 0 or len(self._keys) < least:
            return
        cells = []
        rows = np.searchsorted(self._keys, np.arange((int(self._keys[-1]) >> 32) // SIDE + 2) * SIDE << 32)
        for row in np.flatnonzero(np.diff(rows) >= least).tolist():
            n = np.bincount((self._keys[rows[row]:rows[row + 1]] & 0xFFFFFFFF) // SIDE)
            cells += [(int(n[column]), row << 32 | column) for column in np.flatnonzero(n >= least).tolist()]
        for _, number in sorted(cells, reverse=True)[:free]:
            low, high = np.searchsorted(self._keys, np.array([number >> 32, (number >> 32) + 1]) * SIDE << 32)
            inside = np.zeros(len(self._keys), bool)
            inside[low:high] = (self._keys[low:high] & 0xFFFFFFFF) // SIDE == number & 0xFFFFFFFF
            moved = self._keys[inside]
            cell = (moved >> 32) % SIDE * SIDE + (moved & 0xFFFFFFFF) % SIDE
            self._dense[number] = np.bincount(cell, self._counts[inside], SIDE * SIDE).astype(np.int32)
            self._keys, self._counts = self._keys[~inside], self._counts[~inside]

    @property
    def full(self) -> bool:
        return len(self._keys) > KEPT or self._added >= MOST_ADDED

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(a, b, count) of everything counted, in parts; the counter starts over, with the same dense tiles."""
        self._sort()
        self._added = 0
        for low in range(0, len(self._keys), ROWS):
            keys = self._keys[low:low + ROWS]
            yield keys >> 32, keys & 0xFFFFFFFF, self._counts[low:low + ROWS]
        self._keys, self._counts = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for number, cells in self._dense.items():
            counted = np.flatnonzero(cells)
            for low in range(0, len(counted), ROWS):
                at = counted[low:low + ROWS]
                yield (number >> 32) * SIDE + at // SIDE, (number & 0xFFFFFFFF) * SIDE + at % SIDE, cells[at]
            cells[:] = 0


def _symbols(batch: pa.RecordBatch):
    """Words of a batch, a key of language and word for each, and whether the next word continues its piece."""
    words = hash_words(batch.column("text"), _WORD)
    langs = batch.column("lang").dictionary_encode()
    salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little")
                      for x in langs.dictionary.to_pylist()], U64)
    text = np.repeat(np.arange(len(words.starts) - 1), np.diff(words.starts))
    lang = langs.indices.to_numpy(zero_copy_only=False)[text]
    keys = mix(words.hashes ^ salts[lang]) if len(text) else np.zeros(0, U64)
    breaks = np.concatenate(([0], np.cumsum(_BREAK[words.data], dtype=np.int32)))
    joined = np.zeros(len(text), bool)
    joined[:-1] = (text[1:] == text[:-1]) & (breaks[words.begin[1:]] == breaks[words.end[:-1]])
    return words, keys, lang, langs.dictionary, joined


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        words, keys, lang, names, _ = _symbols(batch)
        keys, first, counts = np.unique(keys, return_index=True, return_counts=True)
        text = [words.data[b:e].tobytes().lower().decode() for b, e in zip(words.begin[first], words.end[first])]
        yield pa.record_batch({"key": keys.view(np.int64), "lang": names.take(pa.array(lang[first])),
                               "word": pa.array(text, pa.string()), "n": counts.astype(np.int64)})


def _counts(level: int, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({"level": np.full(len(a), level, np.int32), "a": a.view(np.int64), "b": b.view(np.int64),
                            "n": n.astype(np.int64)})


def _count_rest(level: int, a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs with a symbol that has no id, as coordinates of hashes."""
    _, first, n = np.unique(pair_keys(a, b), return_index=True, return_counts=True)
    for low in range(0, len(n), ROWS):
        at = first[low:low + ROWS]
        yield _counts(level, a[at], b[at], n[low:low + ROWS])


def _count_tiles(level: int, counter: TileCounter, left: Ranks, right: Ranks) -> Iterator[pa.RecordBatch]:
    for a, b, n in counter.take():
        yield _counts(level, left.keys[a], right.keys[b], n)


def _pair_counter(ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of neighbouring words (level 2)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counter = ranks.value, TileCounter()
        for batch in slices(batches, size=SLICE):
            _, keys, _, _, joined = _symbols(batch)
            ids, at = words.find(keys), np.flatnonzero(joined)
            known = (ids[at] >= 0) & (ids[at + 1] >= 0)
            counter.add(ids[at[known]], ids[at[known] + 1])
            if not words.complete:
                yield from _count_rest(2, keys[at[~known]], keys[at[~known] + 1])
            if counter.full:
                yield from _count_tiles(2, counter, words, words)
        yield from _count_tiles(2, counter, words, words)
    return count


def _phrase_counter(ranks, pair_ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of a pair and the word after it (level 3) and of two neighbouring pairs (level 4)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs = ranks.value, pair_ranks.value
        three, four = TileCounter(), TileCounter()

        def tiles() -> Iterator[pa.RecordBatch]:
            yield from _count_tiles(3, three, pairs, words)
            yield from _count_tiles(4, four, pairs, pairs)

        for batch in slices(batches, size=SLICE):
            _, keys, _, _, joined = _symbols(batch)
            ids, at = words.find(keys), np.flatnonzero(joined)
            if words.complete:
                at = at[(ids[at] >= 0) & (ids[at + 1] >= 0)]
            both, pair = np.zeros(len(keys), U64), np.full(len(keys), -1, np.int64)
            both[at] = pair_keys(keys[at], keys[at + 1])
            pair[at] = pairs.find(both[at])
            # Where a pair starts that may be frequent.
            open_ = np.zeros(len(keys) + 2, bool)
            open_[at] = True if not pairs.complete else pair[at] >= 0
            for level, counter, symbols, ranked in ((3, three, keys, ids), (4, four, both, pair)):
                runs = open_[:-2] & open_[1:-1] & (open_[2:] if level == 4 else True)
                start = np.flatnonzero(runs)
                known = (pair[start] >= 0) & (ranked[start + 2] >= 0)
                counter.add(pair[start[known]], ranked[start[known] + 2])
                if not known.all():
                    rest = start[~known]
                    yield from _count_rest(level, both[rest], symbols[rest + 2])
            if three.full or four.full:
                yield from tiles()
        yield from tiles()
    return count


_PAIR = "level int, a long, b long, n long"


def _with_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (batch.column(c).to_numpy().view(U64) for c in ("a", "b"))
        yield batch.append_column("key", pa.array(pair_keys(a, b).view(np.int64)))


def _ranks(counted: DataFrame, most: int) -> Ranks:
    """Ids for the most frequent of (key, f), at most ``most`` of them.

    Frequencies are first counted in steps of a 64th of a power of two, so
    that only what gets an id comes to the driver: its key alone, 8 bytes in
    Arrow batches that Spark has sorted.
    """
    step = F.floor(F.log2("f") * 64)
    sizes = counted.groupBy(step.alias("step")).agg(F.count("*").alias("n")).orderBy(F.desc("step")).collect()
    so_far, least = 0, None
    for row in sizes:
        if so_far + row["n"] > most:
            break
        so_far, least = so_far + row["n"], row["step"]
    if least is None:
        return Ranks(np.zeros(0, U64), not sizes)
    keys = counted.where(step >= least).orderBy(F.desc("f"), "key").select("key").toArrow().column("key").to_numpy()
    return Ranks(keys.view(U64), so_far == sum(row["n"] for row in sizes))


def count_phrases(docs: DataFrame, min_count: int = 30) -> tuple[DataFrame, DataFrame]:
    """Phrases of one to four words with at least ``min_count`` occurrences, as (lang, words, f), and (lang, n)."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    every = materialize(texts.mapInArrow(_count_words, "key long, lang string, word string, n long")
                        .groupBy("key", "lang", "word").agg(F.sum("n").alias("f")), "phrases-1")
    words = every.where(F.col("f") >= min_count)
    ranked = context.broadcast(_ranks(words, MOST_WORDS))

    def frequent(counts: DataFrame, name: str) -> DataFrame:
        sums = counts.groupBy("level", "a", "b").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count)
        return materialize(sums, name)

    pairs = frequent(texts.mapInArrow(_pair_counter(ranked), _PAIR), "phrases-2")
    pairs = materialize(pairs.mapInArrow(_with_key, "level int, a long, b long, f long, key long"), "phrases-2-keys")
    ranked_pairs = context.broadcast(_ranks(pairs, MOST_PAIRS))
    longer = frequent(texts.mapInArrow(_phrase_counter(ranked, ranked_pairs), _PAIR), "phrases-4")

    one = words.select("key", "lang", F.array("word").alias("words"), "f")

    def spelled(counts: DataFrame, left: DataFrame, right: DataFrame, *keep: str) -> DataFrame:
        first = left.select(F.col("key").alias("a"), "lang", F.col("words").alias("first"))
        last = right.select(F.col("key").alias("b"), F.col("words").alias("last"))
        return counts.join(first, "a").join(last, "b").select(*keep, "lang", F.concat("first", "last").alias("words"), "f")

    two = materialize(spelled(pairs, one, one, "key"), "phrases-2-words")
    rest = [two, spelled(longer.where("level = 3"), two, one), spelled(longer.where("level = 4"), two, two)]
    phrases = one.drop("key")
    for part in rest:
        phrases = phrases.unionByName(part.select("lang", "words", "f"))
    return materialize(phrases, "phrases"), every.groupBy("lang").agg(F.sum("f").alias("n"))


def _part(start: Column | int, size: Column | int) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def collocations(docs: DataFrame, min_count: int = 30, top: int = 2000, covered: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of every language in ``docs`` (lang, text).

    A, l and r count the phrase and the two parts of its lowest-scoring cut, n all words of the language.  A phrase
    goes if a longer one that holds it has at least ``covered`` percent of its occurrences.  A null language is
    ``und``, a null text is empty; repeated rows count as often as they occur; equal scores go by a and then by the
    phrase's bytes.  An empty table gives no rows.  Other columns of ``docs`` are not read.
    """
    phrases, sizes = count_phrases(docs, min_count)
    parts = phrases.select("lang", F.array_join("words", " ").alias("part"), F.col("f").alias("n_part"))
    several = phrases.where(F.size("words") > 1)
    cuts = several.select("lang", F.array_join("words", " ").alias("phrase"), "words", F.col("f").alias("a"),
                          F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(1, F.col("k")).alias("head"),
                       _part(F.col("k") + 1, F.size("words") - F.col("k")).alias("tail"))
    for side, name in (("head", "l"), ("tail", "r")):
        cuts = cuts.join(parts.select("lang", F.col("part").alias(side), F.col("n_part").alias(name)), ["lang", side])
    score = F.expr("cast(a AS decimal(20,0)) * 2000000 div (cast(l AS decimal(20,0)) + r)")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))

    held = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size("words") - 1), lambda size: F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1), lambda i: _part(i, size)))))
    longer = phrases.where(F.size("words") > 2).select("lang", "f", held.alias("phrase"))
    longest = longer.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = best.join(longest, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("f").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * covered, F.lit(True)))
    kept = materialize(kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"), "scores")
    # Only scores that can be among the first meet by language: their counts, in steps, say down to which.
    step = F.floor(F.log2(F.col("score") + 1) * 64)
    steps = kept.groupBy("lang", step.alias("step")).agg(F.count("*").alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(
        Window.unboundedPreceding, -1))
    least = steps.withColumn("above", above).where(F.coalesce("above", F.lit(0)) < top).groupBy("lang").agg(
        F.min("step").alias("least"))
    kept = kept.join(least, "lang").where(step >= F.col("least")).drop("least")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             "n", "score")
