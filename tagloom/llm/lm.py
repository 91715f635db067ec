"""Language-model scores from an Elias-Fano n-gram trie, sharded by predicted word.

The trie is kept in reverse order: a first level of words, and below each
word the contexts it was seen after.  With Dirichlet smoothing,

    P(w | h) = (c(h, w) + MU * P(w)) / (c(h) + MU),

the numerator belongs to the word's own subtree and the denominator to the
context word's entry, so a text's score is a sum of parts that each shard
answers from its own levels.  A batch of texts sends its distinct (word,
context) pairs once to the shards of the words, with their counts; a shard
counts the training part, builds its levels, and answers every pair of every
batch by two bytes.  The batch has kept which tokens are which pair and adds
up its own texts, so what is shuffled does not grow with the number of shards
that a text's words lie in.  Very frequent words are dealt out by context as
well, and very frequent pairs by batch: these are counted beforehand, and
every shard that looks one up gets its total count.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.tables import bucket_of, materialize
from tagloom.llm.words import PIECE, U64, Words, hash_words, mix, slices

START, END = (mix(np.array([x], U64))[0] for x in (11, 13))
#: Weight of the unigram prior, in tokens.
MU = 500.0
#: Added to every count of the unigram model.
ADD = 0.1
#: Levels of quantised values: 12 bits.
STEPS = 4095
#: Tokens of a shard, about.
SHARD_TOKENS = 2_000_000


class EliasFano:
    """A sorted array of integers: low bits packed, high bits as unary gaps, both in a memory-mapped file.

    A directory of the ones before every 64 gap bits, mapped as well, finds
    the n-th one or zero of the gaps.
    """

    def __init__(self, values: np.ndarray, universe: int, folder: str, name: str):
        self.n = len(values)
        self.low_bits = max(0, (max(universe, 1) // max(self.n, 1)).bit_length() - 1)
        width, n = self.low_bits, self.n
        high = (values >> U64(width)).astype(np.int64)
        self.zeros = (int(universe) >> width) + 2
        bits = np.zeros(-(-(self.zeros + n) // 64) * 64, np.uint8)
        bits[high + np.arange(n)] = 1
        places = np.arange(n, dtype=U64) * U64(width)
        packed = np.zeros(n * width // 64 + 2, U64)
        if width:
            low = values & U64((1 << width) - 1)
            word, shift = (places >> U64(6)).astype(np.int64), places & U64(63)
            np.bitwise_or.at(packed, word, low << shift)
            over = shift + U64(width) > 64
            np.bitwise_or.at(packed, word[over] + 1, low[over] >> (U64(64) - shift[over]))
        gaps = np.packbits(bits, bitorder="little").view(U64)
        ones = np.append(0, np.cumsum(np.bitwise_count(gaps), dtype=np.int64))
        self.gaps = _mapped(gaps, f"{folder}/{name}.high")
        self.ones = _mapped(ones.astype(np.uint32 if n < 1 << 32 else np.int64), f"{folder}/{name}.ones")
        self.low = _mapped(packed, f"{folder}/{name}.low")

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(at), U64)
        place = at.astype(U64) * U64(self.low_bits)
        word, shift = (place >> U64(6)).astype(np.int64), place & U64(63)
        value = self.low[word] >> shift
        over = shift > U64(64 - self.low_bits)
        value[over] |= self.low[word[over] + 1] << (U64(64) - shift[over])
        return value & U64((1 << self.low_bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at some places: the place of the at-th one among the gaps, less the ones before it."""
        block = np.searchsorted(self.ones, at, "right") - 1
        place = 64 * block + _nth_one(self.gaps[block], at - self.ones[block].astype(np.int64))
        return ((place - at).astype(U64) << U64(self.low_bits)) | self._low(at)

    def _start(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part: the ones before the gaps' zero of that number."""
        zero = np.maximum(high - 1, 0)
        before = 64 * np.arange(len(self.ones)) - self.ones
        block = np.searchsorted(before, zero, "right") - 1
        place = 64 * block + _nth_one(~self.gaps[block], zero - before[block])
        return np.where(high > 0, place - zero, 0)

    def find(self, wanted: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The place of each wanted value, or -1: the successor among the values of its high part, searched between
        the places ``begin`` and ``end`` if they are given."""
        out = np.full(len(wanted), -1, np.int64)
        if self.n == 0 or len(wanted) == 0:
            return out
        high, low = (wanted >> U64(self.low_bits)).astype(np.int64), wanted & U64((1 << self.low_bits) - 1)
        inside = np.flatnonzero(high < self.zeros - 1)
        at, stop = self._start(high[inside]), self._start(high[inside] + 1)
        if begin is not None:
            at, stop = np.maximum(at, begin[inside]), np.minimum(stop, end[inside])
        while len(inside):
            more = at < stop
            inside, at, stop = inside[more], at[more], stop[more]
            value = self._low(at)
            same = value == low[inside]
            out[inside[same]] = at[same]
            later = value < low[inside]
            inside, at, stop = inside[later], at[later] + 1, stop[later]
        return out


def _nth_one(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The place of the n-th set bit of each 64-bit word, counted from zero, by halves."""
    words, n, place = words.copy(), n.copy(), np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        low = words & U64((1 << half) - 1)
        count = np.bitwise_count(low)
        upper = n >= count
        n -= np.where(upper, count, 0)
        words = np.where(upper, words >> U64(half), low)
        place += half * upper
    return place


def _mapped(values: np.ndarray, path: str) -> np.ndarray:
    values.tofile(path)
    return np.memmap(path, values.dtype, "r")


class Quantised:
    """Values in 12 bits between the least and the largest, memory-mapped."""

    def __init__(self, values: np.ndarray, path: str):
        self.least = float(values.min(initial=0.0))
        self.step = (float(values.max(initial=0.0)) - self.least) / STEPS or 1.0
        codes = np.rint((values - self.least) / self.step).astype(np.uint16)
        self.codes = _mapped(np.append(codes, np.uint16(0)), path)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.least + self.step * self.codes[at]


class Trie:
    """Words, below each word its contexts, and monotone pointers to where the contexts of each word begin."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, word_at: np.ndarray, contexts: np.ndarray,
                 pair_counts: np.ndarray, totals: Totals, folder: str):
        prior = (counts + ADD) * (MU / totals.weight)
        # Hashes are spread evenly; their upper 56 bits tell the words of a shard apart.
        self.words = EliasFano(words >> U64(8), 1 << 56, folder, "words")
        keys = (word_at.astype(U64) << U64(32)) | contexts
        self.contexts = EliasFano(keys, max(len(words), 1) << 32, folder, "contexts")
        starts = np.searchsorted(word_at, np.arange(len(words) + 1)).astype(U64)
        self.pointers = EliasFano(starts, len(keys) + 1, folder, "pointers")
        self.counts = _mapped(np.append(counts, 0.0), f"{folder}/counts")
        self.seen = Quantised(np.log10(pair_counts + prior[word_at]), f"{folder}/seen")

    def look_up(self, words: np.ndarray, word_of: np.ndarray, contexts: np.ndarray) -> tuple[np.ndarray, ...]:
        """The count of each word, and the place of each pair (word_of, context), -1 if it was not seen."""
        place = self.words.find(words >> U64(8))
        known = place >= 0
        counts = np.where(known, self.counts[place], 0.0)
        at = place[word_of]
        found = np.full(len(word_of), -1, np.int64)
        ask = np.flatnonzero(at >= 0)
        begin, end = (self.pointers.get(at[ask] + k).astype(np.int64) for k in (0, 1))
        found[ask] = self.contexts.find((at[ask].astype(U64) << U64(32)) | contexts[ask], begin, end)
        return counts, found


@dataclass(frozen=True)
class Totals:
    tokens: int
    distinct: int
    documents: int
    hot: np.ndarray  # sorted hashes of very frequent words
    hot_counts: np.ndarray
    pairs: np.ndarray  # sorted hashes of very frequent pairs
    pair_counts: np.ndarray
    shards: int

    @property
    def weight(self) -> float:
        return self.tokens + ADD * (self.distinct + 1)


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before, text) of all tokens; every text ends with END and begins after START."""
    ends = words.starts[1:] + np.arange(len(words.starts) - 1)
    n = len(words.hashes) + len(ends)
    is_end = np.zeros(n, bool)
    is_end[ends] = True
    token = np.empty(n, U64)
    token[is_end], token[~is_end] = END, words.hashes
    before = np.append(START, token[:-1])
    before[np.append(0, ends[:-1] + 1)] = START
    return token, before, np.repeat(np.arange(len(ends)), np.diff(words.starts) + 1)


def _pair(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """A hash of the word and the 32 bits of its context."""
    return mix(word ^ context)


def _counts(documents: DataFrame, hot: np.ndarray | None = None) -> DataFrame:
    """(key, n, uses) of all words, or of the pairs of ``hot`` words: tokens of the training part, and all tokens."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            key, before, text = _tokens(hash_words(batch.column("text")))
            trained = ~np.array(batch.column("held"), bool)[text]
            if hot is not None:
                own = np.isin(key, hot)
                key, trained = _pair(key[own], before[own] >> U64(32)), trained[own]
            keys, at, uses = np.unique(key, return_inverse=True, return_counts=True)
            n = np.bincount(at, trained, len(keys)).astype(np.int64)
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n), pa.array(uses)],
                                  names=["key", "n", "uses"])

    return documents.mapInArrow(count, "key long, n long, uses long").groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("uses").alias("uses"))


def _frequent(counts: DataFrame, more_than: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of more than so many uses, and their training counts."""
    rows = counts.where(F.col("uses") > more_than).collect()
    keys = np.array([r["key"] for r in rows], np.int64).view(U64)
    order = np.argsort(keys)
    return keys[order], np.array([r["n"] for r in rows], float)[order]


def _listed(keys: np.ndarray, counts: np.ndarray, wanted: np.ndarray, otherwise: np.ndarray) -> np.ndarray:
    """``otherwise``, and the listed counts where a wanted key is among the sorted ``keys``."""
    if not len(keys):
        return otherwise
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, counts[at], otherwise)


def totals_of(documents: DataFrame) -> Totals:
    """Counts over the training part of ``documents``; listed words and pairs are fewer than four each for a shard."""
    counts = materialize(_counts(documents), "unigrams")
    row = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count_if(F.col("n") > 0).alias("v"),
                     F.coalesce(F.sum("uses"), F.lit(0)).alias("uses")).first()
    shards = int(row["n"] // SHARD_TOKENS + 1)
    end = counts.where(F.col("key") == int(END.view(np.int64))).first()
    often = row["uses"] / (4 * shards)
    hot, hot_counts = _frequent(counts, often)
    pairs, pair_counts = _frequent(_counts(documents, hot), often)
    return Totals(row["n"], row["v"], end["n"] if end else 0, hot, hot_counts, pairs, pair_counts, shards)


_PAIRS = "shard int, batch long, check long, words binary, pairs binary, contexts binary, uses binary, held binary"
_TEXTS = "batch long, check long, ids binary, flags binary, sizes binary, tokens binary, per_word binary"
_ANSWERS = "shard int, batch long, check long, counts binary, codes binary, least double, step double"
_SUMS = "id long, held boolean, n long, known long, base double, numerator double"


def _split(documents: DataFrame, totals: Totals, schema: str) -> DataFrame:
    """For each batch of texts either (_PAIRS) a row for every shard, with words, their contexts, and the uses of each
    pair in all and in held-out texts; or (_TEXTS) what adding up needs: the pair of every token.

    Pairs are in order of shard, word and context, so the shards' answers one
    after the other are those of pairs 0, 1, ...  ``check`` tells whether two
    passes have cut the same batch.
    """
    to_shards = schema == _PAIRS

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            token, before, text = _tokens(hash_words(batch.column("text")))
            context = (before >> U64(32)).astype(U64)
            words, at = np.unique(token, return_inverse=True)
            shard = (words % U64(totals.shards)).astype(np.int64)[at]
            hot = np.isin(words, totals.hot)[at]
            pair = _pair(token[hot], context[hot])
            salt = np.where(np.isin(pair, totals.pairs), mix(np.array([row], U64))[0], U64(0))
            shard[hot] = (mix(pair ^ salt) % U64(totals.shards)).astype(np.int64)
            key = ((shard * len(words) + at).astype(U64) << U64(32)) | context
            order = np.argsort(key, kind="stable")
            key = key[order]
            new_pair = np.append(True, key[1:] != key[:-1])
            pair = np.flatnonzero(new_pair)
            number = np.empty(len(key), np.uint32)
            number[order] = np.cumsum(new_pair) - 1
            check = zlib.crc32(number.tobytes(), zlib.crc32(words.tobytes()))
            flags = np.array(batch.column("held")).astype(np.uint8)
            unit = (key[pair] >> U64(32)).astype(np.int64)
            word = np.flatnonzero(np.append(True, unit[1:] != unit[:-1]))
            contexts_of = np.diff(np.append(word, len(unit))).astype(np.uint32)
            if to_shards:
                uses = np.diff(np.append(pair, len(key)))
                held = np.bincount(number, flags[text], len(pair)).astype(np.uint32)
                shard_of_word = unit[word] // len(words)
                out = []
                for s in np.unique(shard_of_word):
                    a, b = np.searchsorted(shard_of_word, (s, s + 1))
                    p, q = word[a], word[b] if b < len(word) else len(pair)
                    out.append((int(s), row, check, words[unit[word[a:b]] % len(words)].tobytes(),
                                contexts_of[a:b].tobytes(),
                                (key[pair[p:q]] & U64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                                uses[p:q].astype(np.uint32).tobytes(), held[p:q].tobytes()))
            else:
                ids = batch.column("id").fill_null(0).to_numpy().astype(np.int64)
                flags |= np.array(batch.column("id").is_null()).astype(np.uint8) << 1
                sizes = np.bincount(text, minlength=len(ids)).astype(np.uint32)
                out = [(row, check, ids.tobytes(), flags.tobytes(), sizes.tobytes(),
                        zlib.compress(number.tobytes(), 1), contexts_of.tobytes())]
            row += batch.num_rows
            fields = [f.split() for f in schema.split(", ")]
            kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
            yield pa.record_batch([pa.array(column, kinds[kind]) for column, (_, kind) in zip(zip(*out), fields)],
                                  names=[name for name, _ in fields])

    return documents.mapInArrow(split, schema)


def _pairs_by_shard(documents: DataFrame, totals: Totals) -> DataFrame:
    return _split(documents, totals, _PAIRS)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes that hold them all."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // max(n, 1) or 1}")


def _score_shard(table: pa.Table, totals: Totals) -> pa.Table:
    """The answers of one shard: for each batch the counts of its words and the codes of its pairs."""
    def column(name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
        parts = [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        return np.concatenate(parts), np.array([len(p) for p in parts])

    words, words_of = column("words", U64)
    per_word, _ = column("pairs", np.uint32)
    contexts, pairs_of = column("contexts", np.uint32)
    uses, _ = column("uses", np.uint32)
    held, _ = column("held", np.uint32)
    distinct, word_at = np.unique(words, return_inverse=True)
    key = (np.repeat(word_at, per_word).astype(U64) << U64(32)) | contexts
    keys, key_at = np.unique(key, return_inverse=True)
    del key, contexts, words
    pair_counts = np.bincount(key_at, uses - held, len(keys))
    word_of = (keys >> U64(32)).astype(np.int64)
    counts = np.bincount(word_of, pair_counts, len(distinct))
    counts = _listed(totals.hot, totals.hot_counts, distinct, counts)
    pair_counts = _listed(totals.pairs, totals.pair_counts, _pair(distinct[word_of], keys & U64(0xFFFFFFFF)), pair_counts)
    known, seen = counts > 0, pair_counts > 0
    place = np.cumsum(known) - 1
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(distinct[known], counts[known], place[word_of[seen]], keys[seen] & U64(0xFFFFFFFF),
                    pair_counts[seen], totals, folder)
        count, found = trie.look_up(distinct, word_of, keys & U64(0xFFFFFFFF))
        # Code 0 says that the pair was not seen; the prior follows from the word's count.
        codes = np.where(found >= 0, trie.seen.codes[found].astype(np.int32) + 1, 0).astype(np.uint16)[key_at]
        least, step = trie.seen.least, trie.seen.step
    count = count.astype(np.uint64)[word_at]
    word_ends, pair_ends = np.cumsum(words_of), np.cumsum(pairs_of)
    n = table.num_rows
    return pa.table([*(table.column(c) for c in ("shard", "batch", "check")),
                     pa.array([_packed(count[b - k:b]) for b, k in zip(word_ends, words_of)], pa.binary()),
                     pa.array([codes[b - k:b].tobytes() for b, k in zip(pair_ends, pairs_of)], pa.binary()),
                     pa.array(np.full(n, least)), pa.array(np.full(n, step))],
                    names=[x.split()[0] for x in _ANSWERS.split(", ")])


def _add_up(texts: pa.Table, answers: pa.Table, totals: Totals) -> pa.Table:
    """The sums of each text of one batch from the answers of its shards."""
    row = texts.to_pylist()[0]
    answers = answers.sort_by("shard").to_pylist()
    if any(answer["check"] != row["check"] for answer in answers):
        raise ValueError("the documents came in another order when they were read again; write them to a table first")
    per_word = np.frombuffer(row["per_word"], np.uint32)
    so_far = np.cumsum(per_word, dtype=np.int64)
    counts, numerators, word, pairs = [], [], 0, 0
    for answer in answers:
        codes = np.frombuffer(answer["codes"], np.uint16)
        pairs += len(codes)
        after = int(np.searchsorted(so_far, pairs)) + 1
        count = _unpacked(answer["counts"], after - word).astype(float)
        prior = np.log10((count + ADD) * (MU / totals.weight))
        numerators.append(np.where(codes > 0, answer["least"] + answer["step"] * (codes - 1.0),
                                   np.repeat(prior, per_word[word:after])))
        counts.append(count)
        word = after
    count = np.concatenate(counts)
    number = np.frombuffer(zlib.decompress(row["tokens"]), np.uint32)
    word_of = np.repeat(np.arange(len(per_word)), per_word)[number]
    sizes = np.frombuffer(row["sizes"], np.uint32)
    first = np.cumsum(sizes, dtype=np.int64) - sizes  # every text has its end token at least
    normaliser = np.log10(count + MU)[word_of]
    normaliser[first + sizes - 1] = 0.0  # the end is no word's context
    flags = np.frombuffer(row["flags"], np.uint8)
    sums = (np.add.reduceat(x, first) for x in (
        (count > 0)[word_of].astype(np.int64), np.log10(count + ADD)[word_of],
        np.concatenate(numerators)[number] - normaliser))
    return pa.table([pa.array(np.frombuffer(row["ids"], np.int64), mask=(flags & 2) > 0), pa.array((flags & 1) > 0),
                     pa.array(sizes.astype(np.int64)), *(pa.array(x) for x in sums)],
                    names=[x.split()[0] for x in _SUMS.split(", ")])


def score_documents(documents: DataFrame, folds: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Tokens are runs of other bytes than 0x20 and 0x09-0x0D, A-Z
    lower-cased, and one end for each text (null: empty).  Texts with
    crc32(id as text) % folds = 0 are held out; the others are counted.
    base_score is the sum of log10((c + 0.1) / (N + 0.1 * (V + 1))), score
    the log10 probability under the smoothed bigrams of the trie.  Equal
    rows stay; a null id counts as empty text.  Other columns are not read.
    ``documents`` is read three times and has to come in the same batches the
    last two times, as tables do; the operator fails if it does not.
    """
    source = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                              (bucket_of(F.col(id_col), folds) == 0).alias("held"))
    totals = totals_of(source)
    texts = _split(source, totals, _TEXTS)
    answers = _pairs_by_shard(source, totals).groupBy("shard").applyInArrow(lambda table: _score_shard(table, totals), _ANSWERS)
    whole = texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        lambda left, right: _add_up(left, right, totals), _SUMS).select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
        F.col("known").alias("n_known"), "base", "numerator")
    start = float(np.log10(totals.documents + MU))
    return whole.select(
        id_col, "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * float(np.log10(totals.weight))).alias("base_score"),
        (F.col("numerator") - start).alias("score"))
