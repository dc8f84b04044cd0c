import random

import pytest

WORDS = ("the of and alpha beta gamma delta river stone house green blue paper window garden letter morning evening silver copper "
         "mountain valley bridge castle forest meadow harbor island sailor captain doctor teacher student farmer miller baker").split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", str(rng.randrange(50))]) for _ in range(n))


SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, kept boolean, size long, batch string, n_bytes int, token_ids string")


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text[, source]) tuples -> a documents table with extra columns whose names clash with the operators' own."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", len(r[1]) if r[1] is not None else None,
                 0.5, True, 7, "b", 3, "t") for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared passages, a hot group, nulls, empty and long texts and repeated rows."""
    rng = random.Random(5)
    rows = [(i, sentence(rng, rng.randrange(4, 120)), f"s{i % 4}") for i in range(60)]
    base = sentence(rng, 90).split()
    for i in range(60, 100):                       # a large group of near copies
        w = list(base)
        for _ in range(rng.randrange(0, 6)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w), "s0"))
    rows += [(i, rows[i - 100][1].upper(), "s1") for i in range(100, 115)]      # copies up to case
    rows += [(i, rows[3][1], None) for i in range(115, 130)]                    # exact copies
    passage = sentence(rng, 60)
    rows += [(i, sentence(rng, 10) + " " + passage + " " + sentence(rng, 10), "s2") for i in range(130, 140)]
    rows += [(140, "", "s3"), (141, None, "s3"), (142, " \t\n ", "s3"), (143, "one two", "s3"), (144, "one two", "s3"),
             (145, "héé ñandú " * 40 + "日本語のテキスト", "s3"), (146, sentence(rng, 6000), "s3"), (147, "a" * 3000, "s3"),
             (148, "b" + "a" * 400, "s3"), (149, rows[7][1], "s3"), (149, rows[7][1], "s3"), (None, rows[8][1], "s3"), (None, None, None)]
    return rows
