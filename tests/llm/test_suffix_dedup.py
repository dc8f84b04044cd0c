import hashlib

import numpy as np
import pytest

from bourse.llm import suffix_dedup as S


def brute(rows):
    first = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        for j in range(len(b) - S.LENGTH + 1):
            w = b[j:j + S.LENGTH]
            k = S.NULL_ID if i is None else i
            first[w] = min(first.get(w, k), k)
    out = []
    for i, t, *_ in rows:
        b, k = (t or "").encode(), S.NULL_ID if i is None else i
        gone = bytearray(len(b))
        for j in range(len(b) - S.LENGTH + 1):
            if first[b[j:j + S.LENGTH]] < k:
                gone[j:j + S.LENGTH] = b"\1" * S.LENGTH
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (not j or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batch,bucket,step", [(8 << 20, 16 << 20, 1 << 20), (3000, 20_000, 700)])
def test_matches_brute_force(make_docs, corpus, monkeypatch, batch, bucket, step):
    monkeypatch.setattr(S, "BATCH", batch)
    monkeypatch.setattr(S, "BUCKET", bucket)
    got = S.remove(make_docs(corpus)).collect()
    assert sorted(map(tuple, got), key=repr) == brute(corpus)


def test_anchors_do_not_depend_on_the_step(monkeypatch):
    text = np.random.default_rng(4).integers(97, 101, 5000, dtype=np.uint8)
    ends = np.array([0, 40, 40, 49, 99, 2500, 5000])
    starts = np.r_[0, ends[:-1]]

    def owners():
        h, p, lo, hi, doc = S.anchors(text, starts, ends)
        return {(j, int(a), int(x), int(d)) for x, a, b, e, d in zip(h, p, lo, hi, doc) for j in range(b, e + 1)}

    whole = owners()
    monkeypatch.setattr(S, "STEP", 333)
    assert owners() == whole
    assert {j for j, *_ in whole} == {j for s, e in zip(starts, ends) for j in range(s, e - S.LENGTH + 1)}
    assert all(0 <= a - j <= S.LENGTH - S.KMER for j, a, *_ in whole)


def test_column_wise_against_plain_comparison():
    rng = np.random.default_rng(6)
    pool = [rng.integers(0, 3, S.WIDTH, dtype=np.uint8) for _ in range(4)]
    m = 60
    before = rng.integers(0, S.SPAN, m)
    tail = rng.integers(0, 4, m)
    rows, size = [], np.empty(m, np.int64)
    for i in range(m):
        s = pool[i % 4].copy()
        if i % 5 == 0:
            s[rng.integers(0, S.WIDTH)] = 9
        begin, end = S.SPAN - 1 - before[i], S.WIDTH - tail[i]
        end = max(end, begin + S.LENGTH)
        rows.append(s[begin:end])
        size[i] = end - begin
    ids = rng.integers(0, 20, m)
    got = S.column_wise(np.concatenate(rows), np.cumsum(size) - size, before, size, ids)
    windows = {}
    for i, r in enumerate(rows):
        for j in range(len(r) - S.LENGTH + 1):
            key = (S.SPAN - 1 - before[i] + j, r[j:j + S.LENGTH].tobytes())
            windows[key] = min(windows.get(key, 99), ids[i])
    for i, r in enumerate(rows):
        want = 0
        for j in range(len(r) - S.LENGTH + 1):
            c = S.SPAN - 1 - before[i] + j
            want |= (1 << c) * bool(windows[(c, r[j:j + S.LENGTH].tobytes())] < ids[i])
        assert int(got[i]) == want


def test_texts_and_carried_columns(make_docs):
    p = "é" * 60
    rows = [(1, p + "xyz", "a"), (2, "q" + p + "w", "b"), (3, None, None)]
    got = {r["doc_id"]: r for r in S.remove(make_docs(rows), carry=["source", "n_bytes"], texts=True).collect()}
    assert [got[i]["kept_text"] for i in (1, 2, 3)] == [p + "xyz", "qw", ""]
    assert [got[i]["carried"]["source"] for i in (1, 2, 3)] == ["a", "b", None]
    assert got[1]["carried"]["n_bytes"] == 3


def test_empty_table(make_docs):
    assert S.remove(make_docs([])).count() == 0
