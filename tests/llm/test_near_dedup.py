import random

import numpy as np
import pytest

from bourse.llm import near_dedup as N
from bourse.llm.components import connected


def sets_of(rows, k):
    out = []
    for i, t, *_ in rows:
        w = (t or "").encode().lower().split()
        out.append((i, frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])))
    return out


def brute(rows, k, percent):
    sets = [(i, s) for i, s in sets_of(rows, k)]
    least = {i: i for i, _ in sets if i is not None}

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    ok = [(i, s) for i, s in sets if i is not None and s]
    for a, (i, s) in enumerate(ok):
        for j, t in ok[a + 1:]:
            both = len(s & t)
            if 100 * both >= percent * (len(s) + len(t) - both):
                x, y = root(i), root(j)
                least[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else root(i), i is None or root(i) == i) for i, s in sets), key=repr)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_match_all_pairs(make_docs, corpus, k, percent):
    got = N.link(make_docs(corpus), k, percent).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(corpus, k, percent)


def test_group_below_the_threshold(make_docs):
    """Edited copies that link with their text only, with each other only, or with nothing."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = [(i + 1, " ".join(w if rng.random() > 0.02 * (i % 5) else f"x{rng.randrange(10 ** 6)}" for w in base)) for i in range(60)] + [(70, " ".join(base))]
    got = N.link(make_docs(rows), 3, 85).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 3, 85)


def test_empty_table(make_docs):
    assert N.link(make_docs([])).count() == 0


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(1)
    one = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 2, 7, 100, 3000)]
    s = N.sketch(one, 160)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    assert (N.sketch([np.zeros(0, np.uint64)], 160) == np.uint64(0xFFFFFFFFFFFFFFFF)).all()
    common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (800, 100, 100))
    x, y = N.sketch([np.unique(np.r_[common, a]), np.unique(np.r_[common, b])], 512)
    assert abs((x == y).mean() - 0.8) < 0.08


def test_parity_bitmaps_never_differ_more_than_the_sets():
    rng = np.random.default_rng(2)
    for _ in range(50):
        c, a, b = (rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64) for _ in range(3))
        x, y = N.parity([np.unique(np.r_[c, a]), np.unique(np.r_[c, b])])
        assert sum(bin(int(v) & (1 << 64) - 1).count("1") for v in x ^ y) <= len(a) + len(b)


def test_bands_miss_little():
    for percent in (80, 85, 90):
        bands, rows = N.bands_for(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= N.MISS


def test_connected_matches_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500, i) for i in range(600, 640)] + [(i, i + 1) for i in range(700, 730)]
    least = {}

    def root(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for u, v in edges:
        x, y = root(u), root(v)
        least[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for u, v in edges for x in (u, v) if u != v}


def test_settled_edges_take_no_iteration_and_few_edges_no_shuffle_join(spark, monkeypatch):
    """Stars are seen to be settled without another iteration; the joins of a few edges are by broadcast, whatever Spark would choose."""
    import bourse.llm.components as C
    monkeypatch.setattr(C, "MAX_ITERATIONS", 2)
    stars = spark.createDataFrame([(5, 1), (1, 6), (9, 2), (9, 2), (7, 7)], "u long, v long")
    assert sorted(map(tuple, connected(stars).collect())) == [(1, 1), (2, 2), (5, 1), (6, 1), (9, 2)]
    with pytest.raises(RuntimeError):
        connected(spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "u long, v long"))
    assert "broadcast" in C.broadcast_few(stars, 5)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in C.broadcast_few(stars, C.FEW + 1)._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("few", [0, 50_000])
def test_components_are_the_same_with_and_without_broadcasts(spark, monkeypatch, few):
    import bourse.llm.components as C
    monkeypatch.setattr(C, "FEW", few)
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(40, 60)] + [(59, 20)]
    assert {tuple(r) for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()} == {(i, 0) for i in [*range(21), *range(40, 60), 100]}
