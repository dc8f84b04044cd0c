import re
from collections import Counter

import pytest

from bourse.llm import quality_rules as Q


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    c = Counter(tri)
    marked = {i + k for i, t in enumerate(tri) if c[t] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(marked))


CASES = ["", " \n ", "a", "a b", "a b c", "a b c a b c", "x x x x x", "l1\nl1\n\n l1\nl1", "é # $ ñ|<>", "日本 語 日本 語 日本 語",
         "a\x0bb\x0cc\r\nd", "a\x85b\xa0c"] + ["w%d " % i * 3 for i in range(5)]


def test_measure_matches_plain_version():
    for t in CASES:
        assert Q.measure(t.encode()) == plain(t), t


def test_ledger_policy_and_ablation(make_docs, corpus):
    led = Q.ledger(make_docs(corpus)).persist()
    got = Counter(tuple(r)[:7] for r in led.drop("fail_bits").collect())
    assert got == Counter((i, *plain(t or "")) for i, t, _ in corpus)
    rows = [r.asDict() for r in Q.apply_policy(led).collect()]
    bits = Counter(r["fail_bits"] for r in rows)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["fail_bits"] == 0)
    for r in Q.ablations(led).collect():
        bit = Q.mask_of([r["rule"]])
        assert r["n_fail"] == sum(n for b, n in bits.items() if b & bit)
        assert r["n_fail_alone"] == bits.get(bit, 0)
        assert r["kept_without"] == sum(n for b, n in bits.items() if not b & ~bit)
    led.unpersist()


def test_sql_on_the_same_rows(make_docs, corpus):
    import duckdb
    docs = make_docs(corpus)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    want = Counter(tuple(r) for r in con.execute(Q.SQL).fetchall())
    got = Q.apply_policy(Q.ledger(docs)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")
    assert Counter(tuple(r) for r in got.collect()) == want


def test_empty_table(make_docs):
    assert Q.apply_policy(Q.ledger(make_docs([]))).count() == 0


def test_a_stored_ledger_survives_new_changed_and_dropped_rules(spark, make_docs, corpus, tmp_path):
    path = str(tmp_path / "l")
    old = {"gone": Q.Rule(9, 1, "n_words > 3"), "symbols": Q.Rule(2, 1, "n_symbols > 0"), "few_words": Q.RULES["few_words"]}
    Q.store(Q.ledger(make_docs(corpus), old), path, old)
    # the stored bits are taken: the texts are not there any more, and one row's bit is set by hand
    led = spark.read.parquet(f"{path}/ledger").collect()
    now = {"few_words": Q.RULES["few_words"], "symbols": Q.Rule(2, 2, "n_symbols > 1"), "long": Q.Rule(9, 1, "n_words > 100")}
    got = {tuple(r[:7]): r["fail_bits"] for r in Q.open_ledger(spark, path, now).collect()}
    for r in led:
        want = (r["fail_bits"] & 1) | (4 if r["n_symbols"] > 1 else 0) | (512 if r["n_words"] > 100 else 0)
        assert got[tuple(r[:7])] == want
    with pytest.raises(ValueError, match="same version"):
        Q.open_ledger(spark, path, {"symbols": Q.Rule(2, 1, "n_symbols > 5")})
    with pytest.raises(ValueError, match="bit of its own"):
        Q.store(Q.ledger(make_docs(corpus)), path, {"a": Q.Rule(1, 1, "true"), "b": Q.Rule(1, 1, "true")})


def test_stored_ledger_gives_the_same_verdicts(spark, make_docs, corpus, tmp_path):
    led = Q.ledger(make_docs(corpus))
    Q.store(led, str(tmp_path / "l"))
    read = Q.apply_policy(Q.open_ledger(spark, str(tmp_path / "l")))
    assert Counter(map(tuple, read.collect())) == Counter(map(tuple, Q.apply_policy(led).collect()))
