import zlib

import numpy as np
import pytest

from bourse.llm import token_files as F
from bourse.session import scratch_path

P = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("shard_ids", [1 << 20, 300])
def test_files_match_the_tokenizer(spark, make_docs, corpus, monkeypatch, shard_ids):
    from tokenizers import Tokenizer
    monkeypatch.setattr(F, "PART_BYTES", 20_000)
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    rows = [r for r in corpus if r[0] is not None and r[0] != 149] + [(200, "# ## #top <|endoftext|> don't DON'T Ünïcödé café a\x85b\x1cc　d"), (201, "#")]
    path = scratch_path(spark, "test-token-files")
    F.write(make_docs(rows), path, P.path("word_bpe_49k.json"), shard_ids=shard_ids)
    got = sorted(map(tuple, F.read(spark, path).collect()))
    want, at = [], 0
    by_doc = {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [F.END]
        by_doc[i] = ids
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    files = spark.read.parquet(path).orderBy("part", "shard").collect()
    order = [i for r in files for i in F.Shard(r.asDict()).doc_ids.tolist()]
    assert order == sorted(by_doc)
    for r in files[:3]:                                   # documents decoded on their own
        s = F.Shard(r.asDict())
        for k, i in enumerate(s.doc_ids.tolist()):
            assert s.document(k).tolist() == by_doc[i]


def test_nulls_and_repeated_rows(spark, make_docs):
    path = scratch_path(spark, "test-token-files")
    F.write(make_docs([(None, "b"), (5, "x y"), (5, "x y"), (2, None)]), path, P.path("word_bpe_49k.json"))
    got = F.read(spark, path).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in got] == [(None, 0, 2), (2, 2, 1), (5, 3, 3), (5, 6, 3)]


def test_empty_table(spark, make_docs):
    path = scratch_path(spark, "test-token-files")
    F.write(make_docs([]), path, P.path("word_bpe_49k.json"))
    assert F.read(spark, path).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(0)
    for n, top in ((1, 5), (50, 2), (20_000, 3), (30_000, 200)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        last = rng.random(n) < 0.05
        last[-1] = True
        s, ends, left, right, lengths = F.repair(ids, last, 300)
        assert F.expand(s, left, right, 300).tolist() == ids.tolist()
        sizes = np.r_[np.ones(300, np.int64), lengths][s]
        assert np.cumsum(sizes)[ends].tolist() == (np.flatnonzero(last) + 1).tolist()   # no symbol reaches across an end
        assert n < 1000 or top > 3 or len(s) < n / 2


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 200, 3000)                      # a long document, copied 40 times among others
    parts = [x for _ in range(40) for x in (passage, rng.integers(0, 200, 50))]
    ids = np.concatenate(parts).astype(np.uint32)
    last = np.zeros(len(ids), bool)
    last[np.cumsum([len(x) for x in parts]) - 1] = True
    ends_before = last.copy()
    s, ends, left, right, lengths = F.repair(ids, last, 300)
    assert (last == ends_before).all() and F.expand(s, left, right, 300).tolist() == ids.tolist()
    least = max(4, F.LEVELS[-1] * len(ids) // F.SHARD_IDS)
    pairs = np.unique((s[:-1] * 10 ** 6 + s[1:])[~ends[:-1]], return_counts=True)[1]
    assert not len(pairs) or pairs.max() < least
    assert lengths.max() > 16 ** 2                            # symbols grow with the passage, not with the number of levels


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_odd_texts_equal_the_library_for_either_file(name):
    """Letters that change their form, marks, white space, digits and scripts in any order."""
    from tokenizers import Tokenizer
    import random
    config = open(P.path(name), encoding="utf-8").read()
    library = Tokenizer.from_str(config)
    library.encode_special_tokens = True
    rng = random.Random(7)
    signs = ["İ", "ı", "Σ", "ς", "é", "e\u0301", "\u0307", "ß", "K", "Ω", "Å", "x", "Ab", "don't", "1", "23", ".", "!", ",", ";", ":", "?", "..", " ", "  ",
             "\n", "\t", "日", "ا", "😀", "\u00a0", "-", "'s", "ﬁ", "Ǆ", "ͅ"]
    texts = ["İ!", "x İ. y", "DİYARBAKIRİ.", "", " "] + ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 9))) for _ in range(15_000)]
    flat, counts = F.words_of(config, 2)([t.encode() for t in texts])
    want = [[*e.ids, 2] for e in library.encode_batch(texts, add_special_tokens=False)]
    got = [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]
    wrong = [(t, g, w) for t, g, w in zip(texts, got, want) if g != w]
    assert not wrong, (len(wrong), wrong[:5])
