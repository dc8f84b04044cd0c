import math
import zlib
from collections import Counter

import numpy as np
import pytest

from bourse.llm import lm_scoring as L


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


@pytest.fixture(scope="module")
def scored(make_docs, corpus):
    return L.score(make_docs(corpus)).collect()


def test_counts_and_base_scores(scored, corpus):
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t, *_ in corpus]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens), key=repr)
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in scored), key=repr) == want


def test_model_beats_the_base_on_held_out_texts(scored):
    rows = [r for r in scored if r["held_out"]]
    assert rows and sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in scored)


def test_probabilities_sum_to_one():
    words = [b"the", b"a", b"rain", b"train", b"once", b"twice", b"twice."] + [b"w%d" % i for i in range(40)]
    c = np.array([50, 30, 7, 5, 1, 2, 2] + [1 + i % 4 for i in range(40)])
    ends = np.array([L.ending(w) for w in words])
    by = [(int(e), int(c[ends == e].sum()), int((ends == e).sum()), int((c[ends == e] == 1).sum())) for e in np.unique(ends)]
    classes = L.Classes(by, [(b"the", 50), (b"a", 30)], 12)
    k, share = classes.of(words + [b"unseen"], np.r_[c, 0])
    mass = np.bincount(k, np.exp(share), L.CLASSES)
    mass[L.END_CLASS] += 1                                    # the end is its class's only member
    assert mass[k] == pytest.approx(np.ones(len(k)))           # within each class that has words
    rng = np.random.default_rng(0)
    w = rng.normal(size=(sum(L.ROWS), L.CLASSES)).astype(np.float32)
    features = rng.integers(0, sum(L.ROWS), (3, 20))
    assert np.exp(L.log_softmax(w, L.start_bias(classes), features)).sum(1) == pytest.approx(np.ones(20), rel=1e-4)


def test_gradient_step_lowers_the_loss():
    rng = np.random.default_rng(1)
    learner = L.Learner(np.zeros(L.CLASSES, np.float32))
    features = rng.integers(0, 40, (3, 4000))
    target = features[0] % L.CLASSES
    loss = lambda: -L.log_softmax(learner.w, learner.bias, features)[np.arange(4000), target].mean()
    first = loss()
    for _ in range(10):
        learner.step(features, target)
    assert loss() < 0.5 * first


def test_no_training_text_and_empty_table(make_docs):
    only = next(i for i in range(100) if held(i))
    r = L.score(make_docs([(only, "some words here")])).first()
    assert (r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (0, 0, 0.0, 0.0)
    assert L.score(make_docs([])).count() == 0


def test_a_step_sorts_short_numbers_and_follows_the_gradient(monkeypatch):
    """Rows of a feature kind are sorted as 16-bit numbers; each moves by the sum of its tokens' gradients."""
    import numpy as np

    from bourse.llm import lm_scoring as L
    rng = np.random.default_rng(2)
    n = 500
    features = np.stack([rng.integers(0, 40, n) + sum(L.ROWS[:i]) + (L.ROWS[i] - 40) * (i == 2) for i in range(3)]).astype(np.int32)
    target = rng.integers(0, L.CLASSES, n).astype(np.uint8)
    sorted_sizes, plain = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **k: (sorted_sizes.append(a.dtype.itemsize), plain(a, **k))[1])
    learner = L.Learner(np.zeros(L.CLASSES, np.float32))
    learner.step(features, target)
    assert sorted_sizes == [2, 2, 2]
    g = np.full((n, L.CLASSES), 1 / L.CLASSES)
    g[np.arange(n), target] -= 1
    for f in features:
        for row in np.unique(f):
            total = g[f == row].sum(axis=0)
            assert np.allclose(learner.w[row], -L.RATE * total / np.sqrt(1e-2 + total ** 2), atol=1e-4)
            assert learner.steps[row] == (f == row).sum()


def test_short_and_long_stretches_are_summed_as_reduceat_does():
    rng = np.random.default_rng(3)
    sizes = np.r_[rng.integers(1, 2 * L.SHORT + 2, 400), 900, 1, 1]
    order, first = rng.permutation(int(sizes.sum())), np.cumsum(sizes) - sizes
    g = rng.normal(size=(len(order), L.CLASSES)).astype(np.float32)
    got = L.stretch_sums(g, order, first, np.empty_like(g))
    assert (got == np.add.reduceat(g[order], first, axis=0)).all()
    assert (L.stretch_sums(g[:5], np.arange(5), np.arange(5), g) == g[:5]).all()


def test_probabilities_do_not_depend_on_the_rows_computed_at_a_time():
    rng = np.random.default_rng(4)
    w, bias = rng.normal(size=(sum(L.ROWS), L.CLASSES)).astype(np.float32), rng.normal(size=L.CLASSES).astype(np.float32)
    f = rng.integers(0, sum(L.ROWS), (3, 2 * L.BLOCK + 7))
    z = w[f[0]] + w[f[1]]
    z += w[f[2]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    assert (L.log_softmax(w, bias, f) == z).all()
    assert (L.log_softmax(w, bias, f, np.empty((L.CHUNK, L.CLASSES), np.float32)) == z).all() and L.log_softmax(w, bias, f[:, :0]).shape == (0, L.CLASSES)
