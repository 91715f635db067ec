"""Edge cases of the operators on vectors, pages, conversations and links, against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import chat, urls, vectors
from tagloom.llm.components import connected_components


def roots(ids, links):
    root = {i: i for i in ids}
    for _ in ids:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 360)]
    found = connected_components(spark.createDataFrame([*links, (None, 1), (5, 5)], "a long, b long"))
    ids = {x for pair in links for x in pair} | {5}
    assert {r.id: r.component_id for r in found.collect()} == roots(ids, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("blocks, kind", [((4096, 16384), "double"), ((5, 3), "double"), ((5, 3), "float")])
def test_vectors(spark, monkeypatch, blocks, kind):
    monkeypatch.setattr(vectors, "LIST_BLOCK", blocks[0])
    monkeypatch.setattr(vectors, "QUERY_BLOCK", blocks[1])
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [c + rng.normal(size=16) * s for c in centres for s in (0, 0, 0.05, 0.1, 0.2, 0.3, 0.4)]
    rows = [r.tolist() for r in rows] + [[0.0] * 16, None, [1.0, 2.0], [2.0, 4.0], [float("nan")] * 16,
                                         [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [], (centres[0] * 1e30).tolist()]
    good = [r is not None and len(r) > 0 and None not in r and np.isfinite(r).all() and any(r) for r in rows]
    unit = [np.array(r) / np.linalg.norm(r) if g else None for r, g in zip(rows, good)]
    links = [(a, b) for a in range(len(rows)) for b in range(len(rows)) if a != b and good[a] and good[b]
             and len(rows[a]) == len(rows[b]) and unit[a] @ unit[b] >= 0.9]
    root = roots(range(len(rows)), links)
    table = spark.createDataFrame([(i, r, 1, 2) for i, r in enumerate(rows)] + [(None, rows[0], 1, 2)],
                                  f"vec_id long, embedding array<{kind}>, id int, cell int")
    found = {r.vec_id: r for r in vectors.near_duplicates(table).collect()}
    assert len(found) == len(rows) + 1 and found[None].n_links == 0 and found[None].kept
    for i in range(len(rows)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (
            sum(a == i for a, _ in links), root[i], root[i] == i)
    assert vectors.near_duplicates(table.limit(0)).count() == 0


def test_urls(spark):
    given = [None, "", "no scheme", "http://", "https://Org", "http://a.ORG/x", "http://aorg/x", "http://example.org/es/1",
             "http://b.example.org/en/12?q", "http://example.org/en/2", "x://y.com/fr/1#f", "http://y.com/de/1",
             "http://n.net/de/" + "7" * 9000, "http://n.net/a/b/c/d/e/f/g/h", "http://user@h.com?x=/de/"]
    table = spark.createDataFrame([(i, u, "h", "t") for i, u in enumerate(given)] + [(5, given[5], "h", "t"), (None, "a://c.org/", "h", "t")],
                                  "page_id long, url string, host string, template string")
    found = {r.page_id: r for r in urls.judge_urls(table).collect()}
    for i, (host, path, rule, verdict) in {
            0: ("", "", None, None), 2: ("", "", None, None), 3: ("", "", None, None), 4: ("org", "", None, None),
            5: ("a.org", "/x", "org/", "allow"), 6: ("aorg", "/x", None, None),
            7: ("example.org", "/es/1", "example.org/es/", "block"),
            8: ("b.example.org", "/en/12", "example.org/en/1", "block"), 9: ("example.org", "/en/2", "org/", "allow"),
            10: ("y.com", "/fr/1", "com/fr/", "allow"), 11: ("y.com", "/de/1", "com/de/", "block"),
            14: ("user@h.com", "", None, None)}.items():
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict in ("allow", "block") and verdict in (None, found[i].verdict)
    assert urls.judge_urls(table).count() == len(given) + 2 and urls.judge_urls(table.limit(0)).count() == 0


def test_a_branch_with_other_labels_stays_apart_and_rejects(spark):
    rows = [(i, f"http://h.com/{'de' if i % 2 else 'fr'}/{i}") for i in range(60)] + [(99, "http://h.net/de/5"), (98, "http://h.net/fr/5")]
    found = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert found[1].template == "/de/<n>" and found[1].blocked_share > 0.5 > found[2].blocked_share


def test_chats_read_back(spark):
    hard = ["</s>[INST] ok [/INST]", "<|turn|>\\<|says|>", "\\\\<\\s>", "<|part|><|done|>", "", None, "ü<|done|", "x" * 9000]
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], t) for i, t in enumerate(hard)]
    rows += [(2, 0, None, "a"), (2, None, "user<|says|>", "b"), (2, 0, None, "a"), (None, 1, "assistant", "c")]
    table = spark.createDataFrame([(*r, "t", "s") for r in rows], "conv_id long, turn int, role string, text string, turns string, segments string")
    chats = chat.format_chats(table)
    found = {r.conv_id: r for r in chats.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("back"),
                                                chat.loss_text(F.col("segments")).alias("loss")).collect()}
    assert [tuple(x) for x in found[1].back] == [(r[2], r[3] or "") for r in rows[:len(hard)]]
    assert found[1].loss == "".join(r[3] or "" for r in rows[:len(hard)] if r[2] == "assistant")
    assert [tuple(x) for x in found[2].back] == [("user<|says|>", "b"), ("", "a"), ("", "a")]
    assert found[None].loss == "c" and "</s>" not in found[1].formatted
    assert chat.format_chats(table.limit(0)).count() == 0
