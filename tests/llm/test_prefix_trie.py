import hashlib
import random
import re
import zlib

import pytest

from bourse.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs int, part string, nr string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own.setdefault(c, []).append(((turn is not None, turn or 0), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), (role, text)))
    own = {c: [m for *_, m in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        b = c - int(c / 20) * 20 if c < 0 else c % 20
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(own.get(c - b, [])[:h] + v[h:])
    nodes = {}
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    kids = {k: [n for n in nodes if len(n) == len(k) + 1 and n[:-1] == k] for k in nodes}

    def below(k):
        return [k] + [n for x in kids[k] for n in below(x)]

    out = []
    for k, v in nodes.items():
        sub = below(k)
        ids = ",".join(map(str, sorted(c for c in v if len(rebuilt[c]) == len(k))))
        out.append((min(v), len(k), min(nodes[k[:-1]]) if k else None, len(v), len(kids[k]), sum(not kids[n] for n in sub),
                    sum((len(nodes[n]) - 1) * len(WORD.findall(n[-1][1])) for n in sub if n), hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "p", "n") for r in rows], SCHEMA)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def conversations(rng):
    texts = ["", "a", "a b", "hello there", "one two three", "  ", None, "日本 語", "x\ty\nz"]
    rows = []
    for c in [*range(0, 45), *range(-25, 0, 3), 4099, 4100, 8200, 8203]:
        if c in (20, -20):       # a block without base
            continue
        for turn in range(rng.randrange(0, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(texts[:3] if turn < 2 else texts)))
    rows += [(50, None, "user", "late"), (50, None, "user", "late"), (50, 3, "b", "x"), (50, 3, "a", "y"), (None, 1, "user", "x")]
    for c in (4101, 4120, 12, 9000):       # copies, many blocks apart
        rows += [(c, 7, "user", "same"), (c, 8, "assistant", "copy of it")]
    rows += [(61, i, "user", f"turn {i % 9}") for i in range(150)]          # one long conversation, and a copy that leaves it late
    rows += [(62, i, "user", f"turn {i % 9}") for i in range(140)] + [(62, 999, "user", "other end")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = conversations(random.Random(seed))
    assert got(T.trie(frame(spark, rows).repartition(3))) == brute(rows)


def test_collisions_are_found_and_tried_again(spark, monkeypatch):
    rows = [(20, 0, "u", "a"), (20, 1, "u", "b"), (40, 0, "u", "b"), (40, 1, "u", "a")]
    monkeypatch.setattr(T, "BASES", ((1, 1, 1, 1),))            # sums without order
    with pytest.raises(RuntimeError):
        T.trie(frame(spark, rows))
    monkeypatch.undo()
    monkeypatch.setattr(T, "BASES", ((1, 1, 1, 1), T.BASES[1]))
    assert got(T.trie(frame(spark, rows))) == brute(rows)


def test_empty_table_and_own_heads(spark):
    assert T.trie(frame(spark, [])).count() == 0
    assert T.trie(frame(spark, [(None, 1, "u", "x")])).count() == 0
    from pyspark.sql import functions as F
    rows = [(c, t, "u", f"w {t}" if t < 2 else f"{c}") for c in range(6) for t in range(4)]
    nodes = T.trie(frame(spark, rows), base=lambda c: F.lit(0).cast("long"), head=lambda c: F.lit(3))
    assert sorted((r["depth"], r["n_convs"]) for r in nodes.collect()) == [(0, 6), (1, 6), (2, 6), (3, 6), (4, 1), (4, 1), (4, 1), (4, 1), (4, 1), (4, 1)]
