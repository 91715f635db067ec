"""Phrase collocations against plain Python."""

import pickle
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from tagloom.llm import collocations
from tagloom.llm.words import U64

SCHEMA = "doc_id long, text string, lang string, words array<string>, key long, f long, a long, n long, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, docs):
    return spark.createDataFrame([(i, t, g, ["x"], 1, 1, 1, 1, "x") for i, (g, t) in enumerate(docs)], SCHEMA).repartition(3)


def plain(docs, least, top, covered=80):
    counts, sizes = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for size in range(1, 5):
                counts.update((lang, tuple(words[i:i + size])) for i in range(len(words) - size + 1))
    often = {k: f for k, f in counts.items() if f >= least}
    most = Counter()
    for (lang, words), f in often.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                most[lang, words[i:i + size]] = max(most[lang, words[i:i + size]], f)
    rows = []
    for (lang, words), a in often.items():
        if len(words) > 1 and not 100 * most[lang, words] >= covered * a:
            score, _, left, right = min(
                (2_000_000 * a // (often[lang, words[:k]] + often[lang, words[k:]]), k,
                 often[lang, words[:k]], often[lang, words[k:]]) for k in range(1, len(words)))
            rows.append((lang, " ".join(words), a, left, right, sizes[lang], score))
    out = []
    for lang in sizes:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        out += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own)]
    return sorted(out)


RNG = random.Random(13)
VOCABULARY = ["the", "of", "New", "york", "CITY", "é", "\U0001F600", "a-b", "x\x0by", "\x00z", "hall", "ÄB", "it's"]
DOCS = [(RNG.choice(["en", "de", None, "und", ""]),
         "".join(RNG.choices(VOCABULARY, [9, 7, 4, 4, 4, 2, 1, 1, 1, 1, 3, 2, 1])[0]
                 + RNG.choice([" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", " ; ", "\r\n", "!?"])
                 for _ in range(RNG.randrange(60)))) for _ in range(120)]
EDGES = [("en", None), ("en", ""), (None, " \t \n ... "), ("de", "new york city hall " * 3_000), ("xx", "lone"),
         ("en", "w" * 20_000), *[("en", "New York City Hall\nnew york")] * 5]


@pytest.mark.parametrize("words, pairs", [(1 << 20, 1 << 22), (4, 1 << 22), (1 << 20, 5), (3, 2), (0, 0)])
@pytest.mark.parametrize("least, top", [(4, 1000), (9, 7)])
def test_collocations(spark, monkeypatch, words, pairs, least, top):
    """Symbols beyond those with ids are counted all the same."""
    monkeypatch.setattr(collocations, "MOST_WORDS", words)
    monkeypatch.setattr(collocations, "MOST_PAIRS", pairs)
    found = collocations.collocations(table(spark, DOCS + EDGES), least, top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain(DOCS + EDGES, least, top)


def test_empty_tables(spark):
    assert collocations.collocations(table(spark, [])).count() == 0
    assert collocations.collocations(table(spark, [("en", None), (None, "")]), 1).count() == 0


@pytest.mark.parametrize("side, dense", [(4, 3), (8, 100), (1 << 10, 0)])
def test_tiles(monkeypatch, side, dense):
    for name, value in (("SIDE", side), ("MOST_DENSE", dense), ("PENDING", 300), ("KEPT", 400)):
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(3)
    counter, expected, found = collocations.TileCounter(), Counter(), Counter()
    for _ in range(30):
        a, b = (np.minimum(rng.zipf(1.3, 200), 5_000) for _ in range(2))
        expected.update(zip(a.tolist(), b.tolist()))
        counter.add(a, b)
        if counter.full or rng.random() < 0.1:
            for x, y, n in counter.take():
                found.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    for x, y, n in counter.take():
        found.update(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert found == expected
    assert bool(counter._dense) == bool(dense) and len(counter._dense) <= dense


def test_counts_are_handed_on_in_small_parts(monkeypatch):
    """Dense tiles and coordinates alike, and after so many pairs as 32 bits surely hold."""
    for name, value in (("SIDE", 8), ("MOST_DENSE", 2), ("PENDING", 100), ("ROWS", 7), ("MOST_ADDED", 1_000)):
        monkeypatch.setattr(collocations, name, value)
    rng = np.random.default_rng(4)
    counter, expected, found = collocations.TileCounter(), Counter(), Counter()
    for i in range(12):
        a, b = (np.minimum(rng.zipf(1.5, 200), 40) for _ in range(2))
        expected.update(zip(a.tolist(), b.tolist()))
        counter.add(a, b)
        assert counter.full == (i % 5 == 4)
        if counter.full or i == 11:
            parts = list(counter.take())
            assert max(len(n) for _, _, n in parts) == 7 and not counter.full
            for x, y, n in parts:
                found += Counter(dict(zip(zip(x.tolist(), y.tolist()), n.tolist())))
    assert found == expected and counter._dense


def test_ranks():
    keys = np.array([5, 2**63 + 1, 7, 0], U64)
    ranks = collocations.Ranks(keys, True)
    assert ranks.find(np.array([0, 7, 8, 5, 2**63 + 1, 2**64 - 1], U64)).tolist() == [3, 2, -1, 0, 1, -1]
    assert collocations.Ranks(keys[:0], True).find(keys).tolist() == [-1] * 4


@pytest.mark.parametrize("most, named", [(200_000, 200_000), (150_000, 100_000), (10, 0)])
def test_ids_come_to_the_driver_as_bare_keys(spark, most, named):
    """Half of the symbols are twice as frequent; what the driver holds and sends is 8 bytes for each id."""
    counted = spark.range(0, 200_000, 1, 5).selectExpr("xxhash64(id) AS key", "30 * (1 + id % 2) AS f")
    collocations._ranks(counted.limit(10), most)
    tracemalloc.start()
    try:
        ranks = collocations._ranks(counted, most)
        sent = pickle.dumps(ranks, 5)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(sent) < 8 * named + 1_000 and peak < 40 * 200_000
    f = {key % 2**64: n for key, n in counted.collect()}
    keys = pickle.loads(sent).keys.tolist()
    assert [f[k] for k in keys] == sorted(f.values(), reverse=True)[:named] and len(set(keys)) == named
    assert ranks.complete == (named == 200_000)
    assert pickle.loads(sent).find(np.array([*keys[-3:], 1], U64)).tolist() == [*range(named)[-3:], -1]


def test_counts_past_64_bits(spark, monkeypatch):
    """2,000,000 times a and 100 times f do not fit 64 bits here."""
    big = 9 * 10**18
    phrases = spark.createDataFrame(
        [("en", ["a"], big), ("en", ["b"], big), ("en", ["c"], big), ("en", ["a", "b"], big - 1),
         ("en", ["b", "c"], big // 2), ("en", ["a", "b", "c"], big // 2)], "lang string, words array<string>, f long")
    sizes = spark.createDataFrame([("en", 5)], "lang string, n long")
    monkeypatch.setattr(collocations, "count_phrases", lambda docs, least: (phrases, sizes))
    found = collocations.collocations(None).orderBy("rank").collect()
    assert [(r.phrase, r.score) for r in found] == [
        ("a b", 2_000_000 * (big - 1) // (2 * big)), ("a b c", 2_000_000 * (big // 2) // (big + big - 1))]
