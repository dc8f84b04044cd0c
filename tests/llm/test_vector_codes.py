import hashlib
import math
import random

import numpy as np
import pytest

from bourse.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, label_error string, ids int"


def brute(rows, entries, rounds):
    kept = [(i, [float(np.float32(x)) for x in e], lab) for i, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    dims = -(-max((len(e) for _, e, _ in kept), default=0) // 4) * 4
    limit = V.bound(dims)
    ints = [[max(-limit, min(limit, math.floor(1024 * x))) for x in e] + [0] * (dims - len(e)) for _, e, _ in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))
    size = dims // 4
    books = [[ints[k][p * size:(p + 1) * size] for k in order[:entries]] for p in range(4)]

    def best(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * size:(p + 1) * size], e)), n) for n, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(4):
            groups = {}
            for v in ints:
                groups.setdefault(best(p, v)[1], []).append(v[p * size:(p + 1) * size])
            new.append([[sum(c) // len(groups[n]) for c in zip(*groups[n])] if n in groups else e for n, e in enumerate(books[p])])
        books = new
    out = []
    for (i, _, lab), v in zip(kept, ints):
        found = [best(p, v) for p in range(4)]
        out.append((i, lab, "".join("%02x" % n for _, n in found), sum(d for d, _ in found)))
    return out, hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(i, e, lab, "c", "e", "l", 1) for i, e, lab in rows], SCHEMA)


@pytest.mark.parametrize("entries", [5, 64])
def test_equals_brute_force(spark, entries):
    rng = random.Random(3)
    rows = [(rng.randrange(60), [rng.choice([rng.uniform(-1, 1), 0.5, -0.25]) for _ in range(12)], rng.choice([None, 1, 2])) for _ in range(90)]
    rows += [(None, [0.1] * 12, 1), (61, None, 1), (62, [0.1, None] + [0.0] * 10, 1), (63, [float("nan")] * 12, None), (64, [float("inf")] * 12, 2),
             (65, [0.3] * 7, 2), (66, [], None), (67, [3e38, -3e38] + [1.0] * 10, 1), (68, [2.0] * 12, 3), (68, [2.0] * 12, 3)]
    got, books = V.compress(frame(spark, rows).repartition(5), entries, 3)
    want, digest = brute(rows, entries, 3)
    assert sorted(map(tuple, got.select("vec_id", "label", "code", "error").collect()), key=repr) == sorted(want, key=repr)
    assert V.digest(books) == digest


def test_wide_numbers_take_the_wide_table():
    rng = np.random.default_rng(1)
    for high in (30, 1 << 20):
        m = rng.integers(-high, high, (4, 700))
        book = rng.integers(-high, high, (9, 4))
        pairs = [np.unique(r, return_inverse=True) for r in m]
        index, least = V.nearest([u for u, _ in pairs], [c for _, c in pairs], book)
        d = ((m.T[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (index == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()


def test_label_errors_and_empty_table(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(300)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = V.query(spark, str(tmp_path)).collect()
    want, digest = brute(rows, 256, 4)
    sums = {}
    for _, lab, _, e in want:
        sums[lab] = sums.get(lab, 0) + e
    assert sorted(map(tuple, got), key=repr) == sorted(((i, c, e, sums[lab], digest) for i, lab, c, e in want), key=repr)
    frame(spark, []).write.parquet(f"{tmp_path}/none/embeddings.parquet")
    assert V.query(spark, f"{tmp_path}/none").count() == 0
    frame(spark, [(1, [], None), (2, None, 1)]).write.parquet(f"{tmp_path}/bare/embeddings.parquet")
    assert [r["code"] for r in V.query(spark, f"{tmp_path}/bare").collect()] == ["00000000"]
