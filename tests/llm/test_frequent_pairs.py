"""Very frequent word pairs are shared among the shards of the language model, with their total counts."""

from collections import Counter
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import lm
from tagloom.llm.tables import bucket_of


def test_a_frequent_pair_is_dealt_out_by_batch(spark, monkeypatch):
    texts = [f"again and again x{i % 50} y{i % 70} z{i % 90} w{i}" for i in range(1600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(16)
    whole = {r.doc_id: r for r in lm.score_documents(docs).collect()}  # one shard

    monkeypatch.setattr(lm, "SHARD_TOKENS", 1_000)
    source = docs.select(F.col("doc_id").alias("id"), "text", (bucket_of(F.col("doc_id"), 10) == 0).alias("held"))
    totals = lm.totals_of(source)
    words = lm.hash_words(pa.array(["again and again"])).hashes
    word, context = words[1], words[0] >> np.uint64(32)
    at = np.searchsorted(totals.pairs, lm._pair(words[1:2], words[:1] >> np.uint64(32))[0])
    assert totals.pair_counts[at] == sum(not r.held_out for r in whole.values())

    def uses_by_shard(totals):
        out = Counter()
        for r in lm._pairs_by_shard(source, totals).collect():
            own = np.repeat(np.frombuffer(r.words, np.uint64), np.frombuffer(r.pairs, np.uint32))
            same = (own == word) & (np.frombuffer(r.contexts, np.uint32) == context)
            out[r.shard] += int(np.frombuffer(r.uses, np.uint32)[same].sum())
        return out

    assert max(uses_by_shard(replace(totals, pairs=totals.pairs[:0])).values()) == len(texts)  # all uses in one shard
    dealt = uses_by_shard(totals)
    assert totals.shards > 10 and sum(dealt.values()) == len(texts) and max(dealt.values()) < len(texts) // 2
    for r in lm.score_documents(docs).collect():
        same = whole[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (same.n_tokens, same.n_known, same.train_tokens)
        assert r.base_score == pytest.approx(same.base_score) and r.score == pytest.approx(same.score, rel=2e-3, abs=0.02)
