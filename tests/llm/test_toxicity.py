import random
import tracemalloc
import zlib

import numpy as np
import pytest

from bourse.llm import toxicity as T

INSULTS = ["blockhead", "nitwit", "scoundrel", "dunderklotz", "lumpenpack"]
LABELS = "doc_id long, quality int, toxic int, text string"


def rows(n, rng):
    out, labels = [], []
    for i in range(n):
        w = ["".join(rng.choice(["ta", "re", "mi", "no", "sel", "ku", "dra"]) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                x = rng.choice(INSULTS)
                if rng.random() < 0.3:      # gapped or with an inserted character
                    k = rng.randrange(2, len(x) - 2)
                    x = x[:k] + rng.choice(".*-x") + x[k:]
                w.insert(rng.randrange(len(w)), x + rng.choice(["", ",", "s"]))
        out.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic), "clash"))
    return out, labels


def test_held_out_accuracy(spark, make_docs):
    docs, labels = rows(600, random.Random(1))
    got = T.score(make_docs(docs + [(5000, None), (5001, ""), (None, "blockhead"), (3, docs[3][1])]), T.train(make_docs(docs), spark.createDataFrame(labels, LABELS))).collect()
    assert len(got) == 604
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["held_out"], r["score"], r["predicted"]))
    assert all(len(x) == 1 for x in by.values())
    right = n = 0
    for i, _, toxic, _ in labels:
        (held, score, predicted), = by[i]
        assert held == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= score <= 1 and predicted == int(score >= 0.5)
        if held:
            n += 1
            right += predicted == toxic
    assert n > 80 and right / n > 0.95
    (_, s0, p0), = by[5000]
    (_, s1, p1), = by[5001]
    assert (s0, p0) == (s1, p1) and p0 == 0 and next(iter(by[None]))[2] == 1


def plain_kernel(a, b):
    def features(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, min(len(w), i + 2 + T.GAP)):
                for k in range(j + 1, min(len(w), j + 2 + T.GAP)):
                    f = w[i] + w[j] + w[k]
                    out[f] = out.get(f, 0) + T.DECAY ** (k - i - 2)
        return out
    x, y = features(a), features(b)
    return sum(v * y.get(f, 0) for f, v in x.items())


def test_kernel_values(monkeypatch):
    monkeypatch.setattr(T, "FLOOR", 0.0)
    marks = ["^scoundrel$", "^nitwit$", "^dunder"]
    words = ["^scoundrel$", "^scou.ndrel$", "^nit-wit$", "^ñandú$", "^dunderklotz$", "^a$", "^nitnitwit$"]
    v = T.Kernel(marks).values(words)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            share = plain_kernel(w, m) / max(plain_kernel(m, m), 1e-9)
            assert v[i, len(marks) + j] == pytest.approx(min(1.0, share), rel=1e-4, abs=1e-5)
    assert v[1, 0] > 0.5 and v[2, 1] > 0.4            # an inserted character leaves most of the similarity


def test_one_class_no_label_and_empty(spark, make_docs):
    docs = make_docs([(i, "some plain words") for i in range(20)])
    for toxic, want in ((0, 0.0), (1, 1.0), (None, 0.0)):
        labels = spark.createDataFrame([(i, 1, toxic, "") for i in range(20)], LABELS)
        assert {r["score"] for r in T.score(docs, T.train(docs, labels)).collect()} == {want}
    empty = make_docs([])
    assert T.score(empty, T.train(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_svm_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0.3).astype(int)
    w = T.fit_svm(x, y)
    assert ((x @ w[:-1] + w[-1] > 0) == y).mean() > 0.97


def test_gapped_insults_at_the_production_setting(spark, make_docs):
    """Insults gapped throughout, or with two inserted characters, are found where no plain one stands beside them."""
    docs, labels = rows(600, random.Random(1))
    model = T.train(make_docs(docs), spark.createDataFrame(labels, LABELS))
    forms = [f for x in INSULTS for f in (".".join(x), "-".join(x), x[0] + "q" + x[1:-2] + "z" + x[-2:])]
    clean = ["ta re mi no", "selku drata mimi renosel", "dra-ta re.mi.no sel.ku.dra"]
    got = T.scorer(model)([f"ta {f} mire selku".encode() for f in forms] + [c.encode() for c in clean])
    assert (got[len(forms):] < 0.5).all() and got[:len(forms)].min() > got[len(forms):].max()
    assert (got[:len(forms)] >= 0.5).sum() >= len(forms) - 1, dict(zip(forms, got))      # a learnt model: one may be missed


def test_small_values_count():
    marks = ["^idiot$", "^moron$", "^scum$"]
    words = ["^i.d.i.o.t$", "^m-o-r-o-n$", "^sxcuym$"]
    v = T.Kernel(marks).values(words)
    for i in range(3):
        assert 0 < v[i, i] < 0.5 and 0 < v[i, 3 + i] < 0.5 and v[i, 6 + i] == pytest.approx(1.0, abs=1e-5)
        assert (np.delete(v[i, 6:], i) < 0.1).all()


def test_a_worker_holds_what_its_words_need():
    """Values that are not 0, and the words of a stretch of texts: not a full row for each word that may come."""
    rng = random.Random(4)
    marks = [f"^{x}$" for x in INSULTS] + [f"^q{i}zx" for i in range(T.LANDMARKS - len(INSULTS))]
    texts = [" ".join("".join(rng.choice("abcdeilnorstu") for _ in range(7)) for _ in range(200)).encode() for _ in range(150)]
    tracemalloc.start()
    together = T.Describer(marks)(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    alone = T.Describer(marks)
    assert (together == np.concatenate([alone([t]) for t in texts])).all() and together.any()
    words = [set(t.decode().split()) for t in texts[:5]]
    for got, own in zip(together, words):
        want = T.Kernel(marks).values([f"^{w}$" for w in sorted(own)]).max(axis=0)
        assert np.abs(got - want).max() <= 1 / T.STEPS
