"""Decontamination with a benchmark as large as the documents, and columns with clashing names."""

import random
import re

import numpy as np
import pytest

from tagloom.llm import contamination


def runs(text, size):
    own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}


@pytest.mark.parametrize("percent, block", [(80, 1 << 23), (80, 50), (50, 1 << 23), (100, 1 << 23)])
def test_a_benchmark_as_large_as_the_documents(spark, monkeypatch, percent, block):
    monkeypatch.setattr(contamination, "BLOCK", block)
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 5, 6, 9, 17, 40, 150])))) for i in range(150)]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60)))]
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2, len(own) // 10])):
                own[rng.randrange(len(own))] = "changed"
            parts.append(" ".join(own))
        docs.append((i, " ".join(parts)))
    expected = set()
    for item, text in items:
        size = min(5, len(text.split()))
        wanted = runs(text, size)
        for doc, t in docs:
            shared = len(wanted & runs(t, size))
            if 100 * shared >= percent * len(wanted):
                expected.add((doc, item, shared, len(wanted)))
    found = contamination.contained_items(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                                          spark.createDataFrame(items, "item_id long, text string").repartition(4),
                                          percent=percent)
    assert {tuple(r) for r in found.collect()} == expected and len(expected) > 50


def test_sketches_are_long_enough_for_their_partition():
    for n in range(1, 3000):
        part = int(contamination.size_partition(np.array([n]))[0])
        assert 2 ** part <= n < 2 ** (part + 1)
        for percent in (50, 80, 100):
            missing = n - -(-percent * n // 100)
            assert contamination.sketch_length(part, percent) > missing
            assert contamination._least_size(np.array([part]), percent)[0] <= -(-percent * n // 100)


def test_clashing_columns_and_repeated_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g", 1, 1), (1, "x", 2, 2), (None, "a b c d e f g", 3, 3), (2, "q", 4, 4)],
                                 "doc_id long, text string, held long, _held long")
    items = spark.createDataFrame([(7, "a b c d e f"), (7, "a b c d e f g")], "item_id long, text string")
    assert [tuple(r) for r in contamination.contained_items(docs, items).orderBy("doc_id").collect()] == [
        (None, 7, 3, 3), (1, 7, 3, 3)]
    kept = contamination.without_contaminated(docs, items)
    assert kept.columns == docs.columns and {r.held for r in kept.collect()} == {3, 4}
