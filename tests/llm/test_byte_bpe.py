import hashlib
import random

import pytest

from bourse.llm import byte_bpe as B

P = pytest.importorskip("public_tokenizers")
FILE = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=B.load_ranks(FILE), special_tokens={})


ODD = ["", " ", "  ", "a  b", "x\n\n  y \n", "\n b", "don't we'll I'M", "tab\tnew\x0bline\x0c", "a\x85b\xa0 c　 d e", "\x1c\x1d x", "日本語のテキスト 한국어 العربية",
       "é ünï 😀😀 👩‍👩‍👧", "1234567 89,0", "===== ----- !!!", "z" * 255 + " " + "ab" * 200, "�​‍", "trailing   "]


def test_matches_the_library(make_docs, corpus, reference, monkeypatch):
    monkeypatch.setattr(B, "BUCKET", 30_000)
    rows = corpus + [(300 + i, t) for i, t in enumerate(ODD)]
    got = sorted(map(tuple, B.encode(make_docs(rows), FILE, P.PATTERN, carry=["source"], ids=True).collect()), key=repr)
    want = []
    for i, t, *s in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(),
                     ids, (s[0] if s else "src",)))
    assert [(*g[:5], tuple(g[5])) for g in got] == sorted(want, key=repr)


def test_empty_table(make_docs):
    assert B.encode(make_docs([]), FILE, P.PATTERN).count() == 0


def test_heap_merges_like_the_library(reference):
    ranks = B.load_ranks(FILE)
    rng = random.Random(2)
    for n in (1, 2, 5, 300, 2000):
        for letters in ("ab", "abcdefgh", "the and ing"):
            word = "".join(rng.choice(letters.replace(" ", "")) for _ in range(n))
            assert B.heap_merge(word.encode(), ranks) == reference.encode_ordinary(word)


def test_chunks_are_cut_where_pieces_end():
    s = B.Splitter(P.PATTERN)
    import regex
    whole = regex.compile(B.spelled_out(P.PATTERN)).findall
    rng = random.Random(4)
    for _ in range(300):
        t = "".join(rng.choice(["a", "Bc", "1", " ", "  ", "\n", "\t", "'s", "!", "　", "é", "\x1c"]) for _ in range(rng.randrange(12)))
        chunks = s.chunks(t.encode())
        pieces, counts = s.pieces(chunks)
        assert pieces == whole(t) and [whole(c) for c in chunks] == [pieces[e - n:e] for n, e in zip(counts, counts.cumsum())], repr(t)


def test_slots_find_every_pair_and_no_other():
    rng = random.Random(5)
    pairs = {B.pair_key(rng.randrange(1 << 20), rng.randrange(1 << 20)): rng.randrange(1 << 20) for _ in range(3000)}
    slots, moves = B.pair_slots(pairs)
    for key, rank in pairs.items():
        h = B.hash_key(key)
        assert slots[B.slot_of(h, moves[h & (len(moves) - 1)], len(slots))] == key << B.ID_BITS | rank
    assert sum(e != B.NO_PAIR for e in slots) == len(pairs)


def test_ids_beyond_two_bytes_and_ranks_no_merge_reaches(make_docs, tmp_path):
    """Ids far apart that agree in their lower bits, and a piece that has a rank but no pair of parts."""
    import base64
    import tiktoken
    own = {bytes([i]): i for i in range(256)}
    for k, w in enumerate([b"ab", b"cd", b"abcd", b"ef", b"efab", b"xy"]):
        own[w] = 256 + k + 65536 * (k % 3)
    own |= {b"cdef": 70_000, b"qrstu": 131_072 + 300}
    file = tmp_path / "own.tiktoken"
    file.write_bytes(b"".join(base64.b64encode(k) + b" %d\n" % v for k, v in own.items()))
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=own, special_tokens={})
    rng = random.Random(6)
    texts = ["qrstu", "xqrstu qrstu", *(" ".join("".join(rng.choice(["ab", "cd", "ef", "xy", "q"]) for _ in range(rng.randrange(1, 8))) for _ in range(6))
                                        for _ in range(20))]
    got = {r["doc_id"]: r["token_ids"] for r in B.encode(make_docs(list(enumerate(texts))), str(file), P.PATTERN, ids=True).collect()}
    assert got == {i: theirs.encode_ordinary(t) for i, t in enumerate(texts)}


def test_each_literal_stands_once_in_the_expression(spark):
    from pyspark.sql import functions as F
    lit = B.literals({bytes([i]): i for i in range(256)} | {b"ab": 256})
    word = str(B.encode_word(F.col("word"), lit))
    assert word.count("from_json") == 3 and str(B.decode_ids(F.col("ids"), lit)).count("from_json") == 1


def test_one_pair_a_rank_gives_the_merges_of_the_library(spark, reference):
    """The literal map holds one pair a rank: half the slots, and as many characters, that printed plans had."""
    from pyspark.sql import functions as F
    ranks = B.load_ranks(FILE)
    lit = B.literals(ranks)
    assert lit["n_slots"] <= 1 << 16 and lit["whole"] is None
    rng = random.Random(8)
    parts = sorted(ranks)
    words = {b"".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) for _ in range(1500)}
    words |= {bytes(rng.choice(b"aab th\xc3\xa9") for _ in range(rng.randrange(1, 40))) for _ in range(1500)} | {b"a" * n for n in range(1, 40)}
    got = spark.createDataFrame([(bytearray(w),) for w in sorted(words)], "word binary").select("word", B.encode_word(F.col("word"), lit).alias("ids")).collect()
    wrong = [(bytes(r["word"]), r["ids"]) for r in got if r["ids"] != reference._encode_single_piece(bytes(r["word"]))]
    assert len(got) == len(words) and not wrong, wrong[:5]


def test_ties_of_a_rank_and_bytes_without_an_id(spark):
    """aaa is aa + a in any text, never a + aa; a byte that the vocabulary lacks is -1."""
    from pyspark.sql import functions as F
    ranks = {b"a": 0, b"b": 1, b"aa": 2, b"aaa": 3, b"ab": 4, b"aab": 5}
    assert B.halves(b"aaa", ranks) == (b"aa", b"a") and B.halves(b"aab", ranks) == (b"aa", b"b")
    lit = B.literals(ranks)
    rng = random.Random(9)
    words = sorted({bytes(rng.choice(b"aab") for _ in range(rng.randrange(1, 12))) for _ in range(400)})
    got = spark.createDataFrame([(bytearray(w),) for w in [*words, b"axb"]], "word binary").select("word", B.encode_word(F.col("word"), lit).alias("ids")).collect()
    assert {bytes(r["word"]): r["ids"] for r in got} == {w: B.heap_merge(w, ranks) for w in words} | {b"axb": [0, -1, 1]}


def test_the_plan_holds_no_vocabulary(make_docs):
    """The driver keeps and prints many copies of a plan: the vocabulary's arrays are in rows, of which a bucket may need several."""
    out = B.encode(make_docs([(1, "plain words, some 12345 of them"), (2, None)]), FILE, P.PATTERN)
    assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 100_000
    assert out.count() == 2


def test_rows_of_few_pieces_give_the_same_answers(make_docs, reference, monkeypatch):
    rng = random.Random(10)
    texts = [" ".join("".join(rng.choice("abcdeé中,1") for _ in range(rng.randrange(1, 9))) for _ in range(50)) for _ in range(8)]
    monkeypatch.setattr(B, "ROW_WORDS", 7)
    got = {r["doc_id"]: r["token_ids"] for r in B.encode(make_docs(list(enumerate(texts))), FILE, P.PATTERN, ids=True).collect()}
    assert got == {i: reference.encode_ordinary(t) for i, t in enumerate(texts)}
