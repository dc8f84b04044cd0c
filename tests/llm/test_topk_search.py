import math
from collections import Counter

import numpy as np

from bourse.llm import topk_search as T


def brute(rows, k=20):
    good = [(i, [math.floor(64 * float(x)) for x in e]) for i, e in rows
            if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in good if j != q)[:k]
            out += [(q, r + 1, j, -v) for r, (v, j) in enumerate(s)]
    return Counter(out)


def test_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "SLICE_ROWS", 100)
    monkeypatch.setattr(T, "QUERY_ROWS", 7)
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=40) * rng.choice([0.1, 1.0]))]) for i in range(-40, 400)]
    rows += [(1000 + i, rows[60][1]) for i in range(30)]                                          # many ties
    rows += [(2000, None), (2020, [1.0, None]), (2040, [float("nan")] * 40), (2060, [float("inf")] * 40), (2080, []), (2081, [1.0, 2.0]), (None, [1.0])]
    df = spark.createDataFrame([(i, e, 1, "x") for i, e in rows], "vec_id long, embedding array<float>, rank int, score string")
    assert Counter(tuple(r) for r in T.top_k(df).collect()) == brute(rows)


def test_few_rows_and_empty(spark):
    schema = "vec_id long, embedding array<double>"
    assert T.top_k(spark.createDataFrame([], schema)).count() == 0
    assert T.top_k(spark.createDataFrame([(20, [1.0])], schema)).count() == 0
    assert [tuple(r) for r in T.top_k(spark.createDataFrame([(20, [1.0]), (3, [-0.5])], schema)).collect()] == [(20, 1, 3, -2048)]


def test_bounds_save_work_and_lose_nothing(monkeypatch):
    monkeypatch.setattr(T, "CHUNK", 200)
    rng = np.random.default_rng(3)
    weight = np.r_[np.full(8, 60), np.full(56, 4)]
    c = (rng.normal(size=(64, 4000)) * weight[:, None]).astype(np.int64)
    q = (rng.normal(size=(64, 15)) * weight[:, None]).astype(np.int64)
    for scale in (1, 1 << 24):                                      # the second leaves exact doubles
        stats = {}
        owner, score, ids = T.search(np.arange(15) + 10_000, q * scale, np.arange(4000), c, 20, stats)
        full = (q * scale).T @ c
        for i in range(15):
            want = sorted(zip(-full[i], range(4000)))[:20]
            assert [(-s, j) for s, j in want] == list(zip(score[owner == i].tolist(), ids[owner == i].tolist()))
        assert stats["work"] < 0.7 * 64 * 4000 * 15


def test_other_k(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for k in (3, 35, 100):
        assert Counter(tuple(r) for r in T.top_k(df, k).collect()) == brute(rows, k)
