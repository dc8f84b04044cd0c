import re

import pytest

import corpus_pipeline as C
from bourse.llm import mixing, near_dedup, toxicity


@pytest.fixture()
def sf(spark, tmp_path, make_docs, corpus):
    labels = [(i, 1, int(i % 9 == 0)) for i in range(60)]
    rows = [(i, (t + " blockhead nitwit" if i is not None and i < 60 and i % 9 == 0 else t), s) for i, t, s in corpus]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["toxicity", "near_dedup", "suffix_dedup", "mixing", "byte_bpe"]
    out, before = {}, docs
    for name, stage in C.STAGES:
        stage(spark, before, sf).write.parquet(f"{tmp_path}/{name}")
        out[name] = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert out[name].columns == docs.columns and out[name].dtypes == docs.dtypes
        before = out[name]
    # toxicity: exactly the rows that the operator calls toxic go
    verdict = toxicity.score(docs, toxicity.train(docs, spark.read.parquet(f"{sf}/labels.parquet")))
    bad = {r["doc_id"] for r in verdict.where("predicted = 1").collect()}
    assert {0, 9, 18} <= bad and {r["doc_id"] for r in out["toxicity"].collect()} == {r["doc_id"] for r in docs.collect()} - bad
    assert out["toxicity"].count() == docs.where(~docs.doc_id.isin(list(bad)) | docs.doc_id.isNull()).count()
    # near-dedup: one document of each group, all of it
    kept = {r["doc_id"] for r in near_dedup.link(out["toxicity"]).where("kept").collect()}
    assert {r["doc_id"] for r in out["near_dedup"].collect()} == kept
    ids = [r["doc_id"] for r in out["near_dedup"].where("doc_id is not null").collect()]
    assert len(ids) == len(set(ids))
    # suffix dedup: no 50 bytes of a later document start in an earlier one's input; other columns stay
    a = {r["doc_id"]: r for r in out["near_dedup"].where("doc_id is not null").collect()}
    b = {r["doc_id"]: r for r in out["suffix_dedup"].where("doc_id is not null").collect()}
    assert a.keys() == b.keys()
    seen = set()
    for i in sorted(a):
        raw = (a[i]["text"] or "").encode()
        windows = {raw[j:j + 50] for j in range(len(raw) - 49)}
        if not windows & seen:
            assert b[i]["text"] == (a[i]["text"] or "")
        else:
            assert len(b[i]["text"]) < len(a[i]["text"])
        assert b[i]["n_chars"] == len(b[i]["text"]) and b[i]["source"] == a[i]["source"] and b[i]["n_bytes"] == a[i]["n_bytes"]
        seen |= windows
    # mixing and encoding
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(out["suffix_dedup"]).where("doc_id is not null").collect()}
    n = {r["doc_id"]: r["count"] for r in out["mixing"].groupBy("doc_id").count().collect()}
    assert {i: c for i, c in copies.items() if c} == {i: c for i, c in n.items() if i is not None}
    assert out["byte_bpe"].count() == out["mixing"].count()
    assert rows(C.run(spark, sf)) == rows(out["byte_bpe"])


def test_empty_documents(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0


def test_only_the_entry_asks_whether_the_package_is_there():
    import pathlib
    top = pathlib.Path(C.__file__).parent
    for f in [*top.glob("bourse/**/*.py"), top / "bench.py"]:
        if "llm" not in f.relative_to(top).parts:
            assert not re.search(r"\bllm\b|corpus_pipeline", f.read_text()), f


def test_near_duplicates_drops_exactly_the_rejected_rows(spark, make_docs):
    """A repeated id's other text stays, and so do all rows without an id."""
    copied, other, plain = (" ".join(f"{w}{i}" for i in range(40)) for w in ("a", "b", "c"))
    given = [(2, copied), (5, copied + " "), (5, other), (7, plain), (7, plain), (None, plain), (None, plain), (None, None), (None, None)]
    got = C.near_duplicates(spark, make_docs(given), "")
    want = [(2, copied), (5, other), (7, plain), (None, plain), (None, plain), (None, None), (None, None)]
    assert rows(got.select("doc_id", "text")) == sorted(want, key=repr)
