import hashlib
import re
from collections import Counter

from bourse.llm import weighted_fingerprint as W

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    least = sum((a & b).values())
    return least / (sum(a.values()) + sum(b.values()) - least) if a or b else 1.0


def pairs_of(rows):
    """(id, text, edited text, next text) by brute force; rows of one id must have one text here."""
    rows = sorted(((i, t or "") for i, t, *_ in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        out.append((i, t, t[:len(t) - cut] + nxt[:cut], nxt))
    return out


def run(spark, make_docs, rows, path):
    make_docs(rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    return W.query(spark, path).collect()


def test_equals_brute_force(spark, make_docs, corpus, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "PART_CHARS", 10_000)
    rows = [r for r in corpus if r[0] is not None] + [(None, "last of all, without an id"), (500, "😀é " * 50)]
    got = run(spark, make_docs, rows, str(tmp_path))
    want = pairs_of(rows)
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == Counter(
        (i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want)
    # likeness estimates the generalised Jaccard similarity
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] != 149}
    off = []
    for i, t, e, nxt in want:
        if i != 149 and WORD.findall(t) and WORD.findall(e) and WORD.findall(nxt):
            off += [by_id[i]["near_edited"] - jaccard(t, e), by_id[i]["near_next"] - jaccard(t, nxt)]
    assert max(map(abs, off)) < 0.35 and abs(sum(off) / len(off)) < 0.015
    assert sum(x * x for x in off) / len(off) < 1.5 * 0.25 / W.SAMPLES
    # equal texts, equal fingerprints; different ones differ
    texts = {i: t for i, t, *_ in want}
    prints = {}
    for r in got:
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
        assert len(r["fingerprint"]) in (0, 4 * W.SAMPLES)
    assert all(len(v) == 1 for v in prints.values())
    assert by_id[140]["fingerprint"] == by_id[141]["fingerprint"] == by_id[142]["fingerprint"] == ""
    assert by_id[142]["near_next"] == 1.0 and by_id[143]["near_next"] == 0.0       # empty next to empty, and to words


def test_weights_count(spark):
    rows = [("a a a a b", "a b b b b"), ("a b", "a b"), ("a " * 50 + "b", "a " * 100 + "b"), ("x y z", "p q r")]
    texts = sorted({t for r in rows for t in r})
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    codes = {r["doc_id"]: r["codes"] for r in W.fingerprints(docs).select("doc_id", "codes").collect()}
    for a, b in rows:
        x, y = codes[texts.index(a)], codes[texts.index(b)]
        same = sum((p ^ q) >> (16 * i) & 65535 == 0 for p, q in zip(x, y) for i in range(4))
        assert abs(same / W.SAMPLES - jaccard(a, b)) < 0.22


def test_copies_clashing_ids_one_row_and_none(spark, make_docs, tmp_path):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = run(spark, make_docs, [(7, "abcdef")] * 3 + [(5, "uvwxyz")], f"{tmp_path}/a")
    assert Counter((r["doc_id"], r["edited_sha256"], r["near_next"]) for r in got) == Counter(
        [(7, sha("abcdab"), 1.0)] * 2 + [(7, sha("abcduv"), 0.0), (5, sha("uvwxab"), 0.0)])
    got = run(spark, make_docs, [(7, "one two three"), (7, "four five six"), (None, None), (0, None)], f"{tmp_path}/b")
    assert len(got) == 4 and Counter(r["doc_id"] for r in got) == Counter([7, 7, None, 0])
    got = run(spark, make_docs, [(1, "abcdef")], f"{tmp_path}/c")
    assert [(r["edited_sha256"], r["near_next"]) for r in got] == [(sha("abcdab"), 1.0)]
    assert run(spark, make_docs, [], f"{tmp_path}/d") == []


def test_no_python_in_the_plan(spark, make_docs, tmp_path):
    make_docs([(1, "a b c")]).write.parquet(f"{tmp_path}/documents.parquet")
    df = W.query(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_terms_that_occur_once_are_drawn_without_a_division(spark):
    """t is 0 for them, whatever was drawn: the same least value as by the formula."""
    import math
    from pyspark.sql import functions as F
    df = spark.range(300).select(F.xxhash64("id").alias("term"), F.ln((F.col("id") % 3).cast("double")).alias("log"))
    with_one, = W.sample(F.col("term"), 5, [F.col("log")])
    plain, = W.sample(F.col("term"), 5, [F.col("log") + F.lit(1e-300)])      # never 0, and as good as 0
    rows = df.select("log", with_one.alias("a"), plain.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and sum(r["log"] == 0.0 for r in rows) == 100
    assert all((r["a"] is None) == (r["log"] is None) for r in rows)
    assert "CASE WHEN" in str(with_one)
