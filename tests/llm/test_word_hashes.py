import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tagloom.llm import words


def plain(texts, pattern=rb"[^\x20\x09-\x0D]+"):
    lower = [(t or "").encode().translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
             for t in texts]
    return [re.findall(pattern, t) for t in lower]


TEXTS = ["", None, "a", "A b  c", "\x0b\x0c\r\n", "Ünï cöde ÄÖ", "x" * 50, " tail ", "no break here", "a b a b a b"]


@pytest.mark.parametrize("piece", [7, 64, 1 << 20])
def test_words_and_shingles_equal_plain_python(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE", piece)
    rng = random.Random(piece)
    texts = TEXTS + ["".join(rng.choice("abC \n\té") for _ in range(rng.randrange(200))) for _ in range(50)]
    found = words.hash_words(pa.array(texts, pa.string()))
    expected = plain(texts)
    assert np.diff(found.starts).tolist() == [len(x) for x in expected]
    flat = [w for x in expected for w in x]
    assert [found.data[b:e].tobytes().lower() for b, e in zip(found.begin, found.end)] == [w.lower() for w in flat]
    by_word = dict(zip(flat, found.hashes))
    assert all(by_word[w] == h for w, h in zip(flat, found.hashes)) and len(set(by_word.values())) == len(by_word)
    for k in (1, 2, 5):
        hashes, starts = words.hash_shingles(found, k)
        runs = [[tuple(x[i:i + k]) for i in range(len(x) - k + 1)] if len(x) >= k else [tuple(x)][:len(x)]
                for x in expected]
        assert np.diff(starts).tolist() == [len(x) for x in runs]
        flat_runs = [r for x in runs for r in x]
        by_run = dict(zip(flat_runs, hashes))
        assert all(by_run[r] == h for r, h in zip(flat_runs, hashes)) and len(set(by_run.values())) == len(by_run)


def test_slices_keep_rows_and_bound_bytes():
    batch = pa.record_batch({"text": pa.array(["ab", None, "c" * 90, "", "d" * 30, "e" * 30])})
    parts = list(words.slices([batch.slice(1)], size=50))
    assert [x for p in parts for x in p.column("text").to_pylist()] == batch.column("text").to_pylist()[1:]
    assert len(parts) >= 3
