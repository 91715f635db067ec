"""Operators on tables whose other columns have the names that the operators use."""

import pytest

import corpus_pipeline
from tagloom.llm import lines


@pytest.mark.parametrize("names", [("drops", "drop_id"), ("_drops", "_drop_id"), ("DROPS", "drops_"), ("lo", "first")])
def test_line_dedup_keeps_clashing_columns(spark, names):
    docs = spark.createDataFrame([(i, "same\nown %d" % i, i, "x") for i in range(12)],
                                 f"doc_id long, text string, {names[0]} long, {names[1]} string")
    found = lines.drop_repeated_lines(docs)
    assert found.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert {(r.doc_id, r.text, r[names[0]]) for r in found.collect()} == {(i, f"own {i}", i) for i in range(12)}


@pytest.mark.parametrize("name", ["gone", "_gone", "id", "component_id"])
def test_one_of_each_group_keeps_clashing_columns(spark, name):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text, 5), (2, text, 6), (3, "other words here", 7), (None, text, 8)],
                                 f"doc_id long, text string, {name} long")
    found = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert found.columns == docs.columns and sorted(r[name] for r in found.collect()) == [5, 7, 8]
