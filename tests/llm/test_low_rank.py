"""Every link of vectors that lie near a few directions, against brute force."""

import numpy as np
import pytest

from tagloom.llm import vectors


def low_rank(n, dims, rank, seed=3):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, rank)) @ rng.normal(size=(rank, dims)) + 0.01 * rng.normal(size=(n, dims))


@pytest.mark.parametrize("dims, rank", [(64, 4), (64, 8), (384, 4), (384, 8)])
def test_the_cells_asked_hold_every_link(dims, rank, monkeypatch):
    x = vectors.unit(low_rank(2000, dims, rank))
    index = vectors.Index.fit(x, 45, 0.9, len(x))
    for cells in (index.cells, vectors.centres(x, 45, 1)):
        own = vectors._squared(x, cells).argmin(1)
        asked = np.zeros((len(x), len(cells)), bool)
        asked[vectors.Index(cells, [], index.cuts, index.reach).probes(x, own)] = True
        a, b = np.nonzero(x @ x.T >= 0.9)
        assert asked[a, own[b]].all()


def test_links_of_low_rank_vectors_equal_brute_force(spark):
    raw = low_rank(1500, 96, 4)
    x = vectors.unit(raw)
    links = (x @ x.T >= 0.9).sum(1) - 1
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(raw)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(table).collect()}
    assert sum(links) > 1000 and [found[i] for i in range(len(raw))] == links.tolist()


def planted(kind, n=6000, seed=7):
    """Vectors with partners at cosines from the threshold upwards."""
    rng = np.random.default_rng(seed)
    if kind == "random":
        x = rng.normal(size=(n, 64))
    elif kind == "rank 4":
        x = low_rank(n, 96, 4)
    else:
        x = rng.normal(size=(40, 64))[rng.integers(0, 40, n)] + 0.6 * rng.normal(size=(n, 64))
    x = vectors.unit(x)
    a, to = x[: n // 3], x[n // 3: 2 * (n // 3)] - x[2 * (n // 3): 3 * (n // 3)]
    to -= (to * a).sum(1)[:, None] * a
    cosine = rng.uniform(0.9, 1, len(a))[:, None]
    return np.concatenate((x, cosine * a + np.sqrt(1 - cosine ** 2) * vectors.unit(to)))


@pytest.mark.parametrize("kind", ["random", "rank 4", "clustered"])
@pytest.mark.parametrize("cells", [16, 80, 400])
def test_a_fitted_bound_finds_its_share(kind, cells):
    """Recall of the cells asked, against all pairs, and what they spare."""
    x = planted(kind)
    sample = x[np.random.default_rng(1).permutation(len(x))[:4096]]
    centres = vectors.centres(sample, cells, 1)
    bound = vectors.fitted_bound(sample, centres, 0.9, 0.999)
    own = vectors._squared(x, centres).argmin(1)
    asked = np.zeros((len(x), len(centres)), bool)
    asked[vectors.Index(centres, [], np.array([0]), vectors.reach_of(0.9), bound).probes(x, own)] = True
    a, b = np.nonzero(np.triu(x @ x.T >= 0.9, 1))
    assert len(a) > 1500 and asked[a, own[b]].mean() >= 0.99 and asked[b, own[a]].mean() >= 0.99
    exact = vectors._asked(x, centres, own, vectors.reach_of(0.9))
    assert asked.mean() <= exact.mean()
    if kind == "random" and cells == 400:  # near few directions the exact bound spares as much
        assert asked.mean() < 0.6 * exact.mean()


@pytest.mark.parametrize("kind", ["random", "rank 4", "clustered"])
def test_recall_of_the_whole_search(spark, monkeypatch, kind):
    """Many cells whatever they cost; queries are the ids divisible by 50."""
    monkeypatch.setattr(vectors, "COPY_COST", 0)
    x = planted(kind, 3000)
    links = (x @ x.T >= 0.9).sum(1) - 1
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in vectors.near_duplicates(table, recall=0.999).collect()}
    assert all(found[i] <= links[i] for i in found)
    asked = range(0, len(x), 50)
    assert sum(found.values()) >= 0.99 * links.sum()
    assert sum(found[i] for i in asked) >= 0.97 * sum(links[i] for i in asked)
