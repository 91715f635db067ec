"""Keys with many or long members."""

import pytest
from pyspark.sql import functions as F

from tagloom.llm import minhash


@pytest.mark.parametrize("block, shingles", [(2048, 1 << 23), (4, 1 << 23), (2048, 300)])
def test_long_texts_in_one_key_are_searched_in_blocks(spark, monkeypatch, block, shingles):
    """Chains of texts, each near to the next only, in keys that are cut by members or by their shingles."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
    words = [f"w{i}" for i in range(400)]
    docs = [(100 * c + i, " ".join(words[20 * c + 4 * i:20 * c + 4 * i + 120])) for c in range(3) for i in range(12)]
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()
    sets = {i: {tuple(t.split()[j:j + 2]) for j in range(119)} for i, t in docs}
    root = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id: r.component_id for r in found} == root


def test_blocks_follow_the_bytes_of_a_key(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 1000)
    members = spark.createDataFrame([(k, i, 400 if k == 2 else 10) for k in (1, 2) for i in range(20)],
                                    "key long, id long, n long")
    dealt = minhash._open_keys(members, spark.createDataFrame([], "id long, component_id long"))
    blocks = {r.key: r.m for r in dealt.groupBy("key").agg((F.max("j") + 1).alias("m")).collect()}
    assert blocks == {1: 1, 2: 8}
    # Every pair of members meets in one group.
    rows = dealt.collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.key, r.i, r.j), set()).add(r.id)
    for key in (1, 2):
        assert {(a, b) for (k, _, _), ids in groups.items() if k == key for a in ids for b in ids if a < b} == {
            (a, b) for a in range(20) for b in range(20) if a < b}
