"""BPE encoding and decoding in batches of words.

A text is cut at white space.  New pieces are normalised, cut into words by
the vocabulary's pattern and merged together: the symbols of all their words
lie in one flat array, and each round finds every neighbouring pair by
binary search over the sorted pair keys and merges each word's pair of
lowest rank.  Known pieces are looked up.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.words import slices

# Unicode's White_Space, and the byte ranges that byte-level vocabularies write as themselves.
_SPACE = r"\t-\r \x85\xa0  -     　"
_PLAIN = [(33, 126), (161, 172), (174, 255)]
#: White space for str.split() only.
_SPLIT_ONLY = regex.compile(r"[\x1c-\x1f]")
_SPLIT = regex.compile(f"[{_SPACE}]+")
_NO_RANK = np.int64(2**40)
#: Pieces that a task remembers.
CACHE = 60_000


def byte_characters() -> list[str]:
    """For each byte, the character that stands for it in a byte-level vocabulary."""
    plain = {b for low, high in _PLAIN for b in range(low, high + 1)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """Arrays of a BPE tokenizer file with word ends, lower-casing and byte-level symbols."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = split.replace(r"\s", _SPACE)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in [*ids.items(), *self.added.items()]}
        self.tokens = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.inner = np.array([ids[c] for c in byte_characters()])
        self.last = np.array([ids[c + suffix] for c in byte_characters()])
        left, right = (np.array([ids[m[side]] for m in merges], np.int64) for side in (0, 1))
        made = np.array([ids[a + b] for a, b in merges], np.int64)
        first_use = np.full(len(self.tokens), _NO_RANK)
        for side in (left, right):
            np.minimum.at(first_use, side, np.arange(len(merges)))
        order = np.argsort(left << 32 | right, kind="stable")
        self.keys, self.ranks, self.made = (left << 32 | right)[order], order, made[order]
        #: Whether no merge of what the pair makes ranks before the pair itself.
        self.in_turn = (first_use[made] > np.arange(len(merges)))[order]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after the other, and where each begins."""
        lengths = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[data]
        symbols[ends - 1] = self.last[data[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_symbols, done_owner = [], []
        while len(symbols):
            pair = np.append(symbols[:-1] << 32 | symbols[1:], -1)
            pair[:-1][owner[:-1] != owner[1:]] = -1
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where(self.keys[at] == pair, self.ranks[at], _NO_RANK)
            starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            size = np.diff(np.append(starts, len(owner)))
            best = np.repeat(np.minimum.reduceat(rank, starts), size)
            over = best == _NO_RANK
            if over.any():  # words without a pair to merge are complete
                done_symbols.append(symbols[over])
                done_owner.append(owner[over])
                symbols, owner, at, rank, best = (x[~over] for x in (symbols, owner, at, rank, best))
                if not len(symbols):
                    break
            hit = self._chosen(rank == best, owner, at)
            symbols[hit] = self.made[at[hit]]
            gone = np.zeros(len(symbols), bool)
            gone[hit + 1] = True
            symbols, owner = symbols[~gone], owner[~gone]
        symbols, owner = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_symbols, done_owner))
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.searchsorted(owner[order], np.arange(len(words) + 1))

    def _chosen(self, hit: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Places to merge: from left to right without overlap, or each word's first if others must wait."""
        places = np.flatnonzero(hit)
        run = np.flatnonzero(np.append(True, np.diff(places) != 1))
        offset = np.arange(len(places)) - np.repeat(run, np.diff(np.append(run, len(places))))
        first = np.append(True, owner[places][1:] != owner[places][:-1])
        return places[(offset % 2 == 0) & (self.in_turn[at[places]] | first)]


class Encoder:
    """Encodes texts; remembers the pieces it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.words = regex.compile(vocabulary.pattern)
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.added)) + ")")
        self.index: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.index.clear()
        self.ids, self.starts = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self, pieces: list[str]) -> None:
        plans, words = [], {}
        for piece in pieces:
            plan: list = []
            for part in self.special.split(piece) if self.special.search(piece) else (piece,):
                if part in self.vocabulary.added:
                    plan.append(-self.vocabulary.added[part] - 1)
                else:
                    lowered = "".join(c.lower() for c in unicodedata.normalize("NFC", part))
                    plan += [words.setdefault(w.encode(), len(words)) for w in self.words.findall(lowered)]
            plans.append(plan)
        ids, starts = self.vocabulary.merge(list(words)) if words else (np.zeros(0, np.int64), np.zeros(1, np.int64))
        rows = [np.concatenate([ids[starts[p]:starts[p + 1]] if p >= 0 else [-p - 1] for p in plan])
                if plan else np.zeros(0, np.int64) for plan in plans]
        self.index.update(zip(pieces, range(len(self.starts) - 1, len(self.starts) - 1 + len(pieces))))
        self.ids = np.concatenate([self.ids, *rows]).astype(np.uint32)
        self.starts = np.append(self.starts, self.starts[-1] + np.cumsum([len(r) for r in rows]))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each begins."""
        if len(self.index) > CACHE:
            self._forget()
        pieces = [[p for p in _SPLIT.split(t) if p] if _SPLIT_ONLY.search(t) else t.split() for t in texts]
        new = {p for own in pieces for p in own if p not in self.index}
        if new:
            self._learn(sorted(new))
        index = self.index
        at = np.fromiter((index[p] for own in pieces for p in own), np.int64)
        sizes = self.starts[at + 1] - self.starts[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        flat = self.ids[np.arange(total) + np.repeat(self.starts[at] - ends + sizes, sizes)]
        bounds = np.concatenate(([0], np.cumsum([len(own) for own in pieces]))).astype(np.int64)
        return flat, np.concatenate(([0], ends))[bounds]


def _texts(batch: pa.RecordBatch, column: str) -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def encode(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>) of every row; a null or blank text has no ids.

    ``path`` is a tokenizer file, read by the driver; its arrays (two
    numbers for each merge) go to the executors as a broadcast.
    """
    shared = documents.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches):
            flat, starts = encoder.encode(_texts(batch, "text"))
            ids = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.view(np.int32)))
            yield pa.record_batch([batch.column("id"), ids], names=[id_col, "ids"])

    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, ids array<int>")


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> str:
    """Tokens joined by spaces: the tokenizer file names no decoder, and special tokens stay."""
    return " ".join(map(vocabulary.tokens.__getitem__, ids.tolist()))


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, text) for rows (id, ids); null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode_ids(shared.value, np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            yield pa.record_batch([batch.column("id"), pa.array(texts, pa.string())], names=[id_col, "text"])

    source = encoded.select(F.col(id_col).alias("id"), "ids")
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, text string")


def round_trip(documents: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of what encode and decode give, in one pass."""
    shared = documents.sparkSession.sparkContext.broadcast(Vocabulary(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in slices(batches):
            flat, starts = encoder.encode(_texts(batch, "text"))
            rows = [flat[a:b] for a, b in zip(starts, starts[1:])]
            yield pa.record_batch([
                batch.column("id"), pa.array(np.diff(starts)),
                pa.array([hashlib.sha256(r.astype("<u4").tobytes()).hexdigest() for r in rows], pa.string()),
                pa.array([hashlib.sha256(decode_ids(shared.value, r).encode()).hexdigest() for r in rows], pa.string())],
                names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema['id'].dataType.simpleString()}, "
                                  "n_tokens long, ids_sha256 string, decoded_sha256 string")
