"""Words of whole texts as 64-bit hashes, computed on Arrow's byte buffers.

A word is a longest run of bytes of one kind.  The hash is polynomial in
random byte values modulo 2**64, taken from one running sum over the
buffer, and then mixed; equal words have equal hashes in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes handled at once; a longer text is cut between words.
PIECE = 1 << 20

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Letters and digits of ASCII and every byte of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _byte_values() -> np.ndarray:
    lowered = np.arange(256, dtype=U64)
    lowered[65:91] += U64(32)
    return mix((lowered + U64(1)) * U64(0xD1342543DE82EF95))


_VALUES = _byte_values()
_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + 4096)
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, U64)
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[:] = both
    return _powers[0], _powers[1]


@dataclass
class Words:
    """Hashes of all words; those of text i are ``hashes[starts[i]:starts[i + 1]]``.

    ``begin`` and ``end`` are byte positions in ``data``; text i begins at
    byte ``bounds[i]``.
    """

    hashes: np.ndarray
    starts: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray
    bounds: np.ndarray


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and text bounds of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[bounds[0]:bounds[-1]], bounds - bounds[0]


def _cuts(inside: np.ndarray, bounds: np.ndarray) -> list[int]:
    """Positions between words, about PIECE bytes apart."""
    cuts, at, size = [0], 0, len(inside)
    while size - at > PIECE:
        target = at + PIECE
        bound = int(bounds[np.searchsorted(bounds, target, "right") - 1])
        if bound <= at:
            gaps = np.flatnonzero(~inside[at + 1:target])
            if len(gaps):
                bound = at + 1 + int(gaps[-1])
            else:
                later = np.flatnonzero(~inside[target:])
                following = int(bounds[np.searchsorted(bounds, target, "left")])
                bound = min(following, target + int(later[0]) if len(later) else size)
        cuts.append(bound)
        at = bound
    return [*cuts, size]


def hash_words(column: pa.Array, kind: np.ndarray | None = None) -> Words:
    """Words of every text, A-Z lower-cased: runs of bytes that ``kind`` marks.

    Without ``kind``, words are runs of other bytes than 0x20 and 0x09-0x0D.
    """
    data, bounds = buffers(column)
    inside = ~SPACES[data] if kind is None else kind[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    first = inside & ~before
    first[edges] = inside[edges]
    begin = np.flatnonzero(first)
    last = before & ~inside
    last[edges] = before[edges]
    end = np.flatnonzero(last)
    if len(data) and inside[-1]:
        end = np.append(end, len(data))
    hashes = np.empty(len(begin), U64)
    cuts = _cuts(inside, bounds)
    for low, high in zip(cuts, cuts[1:]):
        a, b = np.searchsorted(begin, (low, high))
        if a == b:
            continue
        power, inverse = _tables(high - low)
        total = np.empty(high - low + 1, U64)
        total[0] = 0
        np.cumsum(_VALUES[data[low:high]] * power[:high - low], out=total[1:])
        s, e = begin[a:b] - low, end[a:b] - low
        hashes[a:b] = mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U64) * U64(0xA0761D6478BD642F))
    return Words(hashes, np.searchsorted(begin, bounds), begin, end, data, bounds)


def hash_shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words, text after text, and where each text begins.

    A text with fewer words, but at least one, has its whole sequence as one shingle.
    """
    counts = np.diff(words.starts)
    per_text = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    starts = np.concatenate(([0], np.cumsum(per_text)))
    out = np.empty(starts[-1], U64)
    n = len(words.hashes)
    if n >= k:
        run = words.hashes[:n - k + 1].copy()
        for j in range(1, k):
            run *= U64(0x9FB21C651E98DF25)
            run += words.hashes[j:n - k + 1 + j]
        keep = np.ones(len(run), bool)
        for j in range(1, k):  # runs that reach over the end of a text
            over = words.starts[1:-1] - j
            keep[over[(over >= 0) & (over < len(keep))]] = False
        full = np.repeat(counts >= k, per_text)
        out[full] = mix(run[keep] + U64(k))
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        run = U64(0)
        for h in words.hashes[words.starts[i]:words.starts[i + 1]]:
            run = U64((int(run) * 0x9FB21C651E98DF25 + int(h)) & (2**64 - 1))
        out[starts[i]] = mix(np.array([run]) + U64(counts[i]))[0]
    return out, starts


def slices(batches: Iterator[pa.RecordBatch], text: str = "text",
           size: int = 4 * PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        column = batch.column(text)
        _, bounds = buffers(column)
        at = 0
        while at < len(column):
            to = int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1
            to = min(max(to, at + 1), len(column))
            yield batch.slice(at, to - at)
            at = to
