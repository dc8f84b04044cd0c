import re
from collections import defaultdict

import pytest

from bourse.llm import mixing as M


def shares(sizes):
    """Targets by repeated resharing, as the contract says it."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * left / total > 2 * sizes[s]]
        if not over:
            return target | {s: weight[s] * left / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def check(docs, rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    got = [r.asDict() for r in M.mix(docs).collect()]
    assert len(got) == len(rows)
    by = defaultdict(int)
    for r in rows:
        by[r[2]] += size(r[1])
    want, taken, largest = shares(by), defaultdict(int), defaultdict(int)
    for r in got:
        assert r["source_size"] == by[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], rel=1e-12)
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    return want, taken, largest, got


def test_targets_and_thresholds(make_docs, corpus):
    want, taken, largest, got = check(make_docs(corpus), corpus)
    copies = defaultdict(int)   # rows with one id and text share a hash and go together
    for r in got:
        copies[r["doc_id"]] += 1
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * largest[s]
    again = M.mix(make_docs(list(reversed(corpus)))).collect()
    assert sorted((r["doc_id"] or -1, r["taken"]) for r in again) == sorted((r["doc_id"] or -1, r["taken"]) for r in got)


def test_hot_source_and_many_small_documents(make_docs):
    rows = [(i, "w " * (1 + i % 7), "hot" if i % 3 else f"s{i % 5}") for i in range(3000)]
    want, taken, largest, _ = check(make_docs(rows), rows)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_nested_budgets(make_docs):
    rows = [(i, "w " * (1 + i % 9), f"s{i % 2}") for i in range(400)]
    docs = make_docs(rows)
    small = {r["doc_id"]: r["taken"] for r in M.mix(docs, share_percent=40).collect()}
    large = {r["doc_id"]: r["taken"] for r in M.mix(docs, share_percent=60).collect()}
    assert all(large[i] >= small[i] for i in small) and sum(large.values()) > sum(small.values())


def test_empty_and_wordless(make_docs):
    assert M.mix(make_docs([])).count() == 0
    assert {(r["target"], r["taken"]) for r in M.mix(make_docs([(1, "", "a"), (2, None, None)])).collect()} == {(0.0, 0)}


def test_mixed_repeats_rows(make_docs, corpus):
    docs = make_docs(corpus)
    taken = {r["doc_id"]: r["copies"] for r in M.mix(docs).where("doc_id < 140").collect()}
    out = M.mixed(docs)
    assert out.columns == docs.columns
    n = {r["doc_id"]: r["count"] for r in out.where("doc_id < 140").groupBy("doc_id").count().collect()}
    assert n == {i: c for i, c in taken.items() if c}
