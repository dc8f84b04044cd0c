r"""Operator 4: language-model scores from a hashed, class-factored maximum-entropy model.

P(word | history) = P(class | history) * P(word | class).  The first factor is a
softmax over ``CLASSES`` classes whose logits add up a bias and one hashed weight
row per feature: the word before (n-gram), the word two before (skip), and both
together.  The second is the word's share of its class's training mass.  Classes:
the end of a text, the most frequent words one by one, all other words by their
ending (endings dealt out to classes of like mass), and unknown words, for which
half of the words seen once stand in.  The vocabulary's probabilities, with one
unknown type, sum to one.

All training texts count: word counts are exact, and every training token takes
part in the gradient updates.  Each task runs adaptive gradient steps over its
batches from a common start; the rows of the weight table are then averaged over
tasks, weighted by how often each task updated a row (a shuffle by table block).
Texts are scored in numpy, a stretch of tokens at a time.

Only tables of fixed size reach the driver: the weights, mass by hashed ending,
and the few most frequent words.

Defined cases: NULL and empty texts have one token, the end; rows without an id
are never held out; without any training text all scores equal the base score,
0; repeated rows count and are scored one by one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.blobs import pack, unpack
from bourse.llm.common import NULL_ID, input_bytes, table
from bourse.llm.dictionary import REQUEST_DDL, REQUEST_SCHEMA, batches, by_bucket, cut, requests, rows, unpack_strings
from bourse.session import scratch_path

HELD_MOD, HELD = 7, 2
CLASSES, TOP_WORDS = 48, 11
END_CLASS, UNKNOWN = 0, CLASSES - 1
ENDINGS = 4096                       # hashed word endings that mass is counted by
ROWS = (1 << 13, 1 << 13, 1 << 14)   # weight rows of each feature kind
FIRST_ROWS = (0, ROWS[0], ROWS[0] + ROWS[1])
BLOCKS = 16                          # parts that the weight table is averaged in
CHUNK = 1 << 14                      # tokens of a gradient step
BLOCK = 1 << 10                      # tokens whose probabilities are computed at a time
SHORT = 6                            # rows of a stretch that is added row by row
RATE = 0.25
BUCKET = 32 << 20
END_HASH = np.uint64(0x5BD1E9955BD1E995)
_EDGE = b".,;:!?\"'()[]{}<>|*#$%&-_+=/\\~`"


def held_out(doc_id: int) -> bool:
    return doc_id != NULL_ID and zlib.crc32(str(doc_id).encode()) % HELD_MOD == HELD


def ending(word: bytes) -> int:
    return zlib.crc32(word.rstrip(_EDGE)[-3:]) % ENDINGS


# --- counts ------------------------------------------------------------------

COUNT_SCHEMA = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary()), ("ending", pa.int32()),
                          ("word", pa.binary()), ("c", pa.int64()), ("types", pa.int64()), ("ones", pa.int64())])
COUNT_DDL = "batch long, bucket int, data binary, ending int, word binary, c long, types long, ones long"


def _ask(n: int):
    def run(arrow):
        for b in arrow:
            for r in b.to_pylist():
                words, tokens, counts = unpack_strings(r["words"]), unpack(r["tokens"])[0], unpack(r["counts"])[0].astype(np.int64)
                trains = ~np.array([held_out(i) for i in unpack(r["ids"])[0].tolist()], bool)
                count = np.bincount(tokens[np.repeat(trains, counts)], minlength=len(words)).astype(np.uint32)
                asked = [(k, r["batch"], blob) for k, blob in requests(words, n, lambda at: [count[at]])]
                if asked:
                    yield from rows(REQUEST_SCHEMA, asked).to_batches()
    return run


def _count(key: tuple, t: pa.Table) -> pa.Table:
    """Answers (total training count of each word asked for), mass by ending, and the bucket's most frequent words."""
    number: dict[bytes, int] = {}
    asked, counts = [], []
    for blob in t.column("data").to_pylist():
        sizes, data, count = unpack(blob)
        asked.append(np.fromiter((number.setdefault(w, len(number)) for w in cut(sizes, data)), np.int64, len(sizes)))
        counts.append(count.astype(np.int64))
    total = np.bincount(np.concatenate(asked), np.concatenate(counts), len(number)).astype(np.int64)
    k = key[0].as_py()
    out = [(b, k, pack(total[a]), None, None, None, None, None) for b, a in zip(t.column("batch").to_pylist(), asked)]
    words = list(number)
    ends = np.fromiter(map(ending, words), np.int64, len(words))
    sums = [np.bincount(ends, x, ENDINGS).astype(np.int64) for x in (total, total > 0, total == 1)]
    out += [(None, None, None, int(e), None, *(int(s[e]) for s in sums)) for e in np.flatnonzero(sums[0])]
    top = np.lexsort((np.arange(len(words)), -total))[:TOP_WORDS]
    out += [(None, None, None, None, words[i], int(total[i]), 1, int(total[i] == 1)) for i in top if total[i]]
    return rows(COUNT_SCHEMA, out)


class Classes:
    """Class of each word and its share of the class's mass, from counts by ending and the most frequent words."""

    def __init__(self, by_ending: list[tuple], top: list[tuple], ends: int):
        """by_ending: (ending, c, types, ones); top: (word, c); ends: training texts."""
        self.tokens = sum(c for _, c, _, _ in by_ending) + ends
        self.types = sum(t for _, _, t, _ in by_ending) + (ends > 0)
        self.end_count = ends
        mass, ones = np.zeros(ENDINGS), 0
        for e, c, _, o in by_ending:
            mass[e] = c - 0.5 * o
            ones += o
        self.top = {w: 1 + i for i, (w, _) in enumerate(top)}
        self.mass = np.zeros(CLASSES)
        self.mass[END_CLASS], self.mass[UNKNOWN] = ends, 0.5 * ones
        for w, c in top:
            own = c - 0.5 * (c == 1)
            self.mass[self.top[w]] = own
            mass[ending(w)] -= own
        self.of_ending = np.zeros(ENDINGS, np.uint8)
        free = np.arange(1 + TOP_WORDS, UNKNOWN)
        for e in np.lexsort((np.arange(ENDINGS), -mass)):      # heaviest first, to the lightest class
            k = free[np.argmin(self.mass[free])]
            self.of_ending[e] = k
            self.mass[k] += max(0.0, mass[e])

    def of(self, words: list[bytes], c: np.ndarray):
        """(class, log P(word | class), whether it stands in for unknown words) of each word."""
        k = np.fromiter((self.top.get(w) or self.of_ending[ending(w)] for w in words), np.int64, len(words))
        k[c == 0] = UNKNOWN
        own = np.where(c == 0, 1.0, c - 0.5 * (c == 1))
        share = own / np.where(c == 0, 1.0, np.maximum(self.mass[k], own))
        return k, np.log(share)


def prepare(classes: Classes, n: int):
    """Batch and answers -> the batch with, per word: hash, count, class, log share."""
    schema = pa.schema([("ids", pa.binary()), ("nulls", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary()), ("words", pa.binary())])

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        r = {x: left.column(x)[0].as_py() for x in ("ids", "nulls", "counts", "tokens", "words")}
        words = unpack_strings(r["words"])
        order, _ = by_bucket(words, n)
        c = np.zeros(len(words), np.int64)
        if len(words):
            parts = sorted(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()))
            c[order] = np.concatenate([unpack(d)[0] for _, d in parts])
        k, share = classes.of(words, c)
        h = np.fromiter((zlib.crc32(w) for w in words), np.uint32, len(words))
        r["words"] = pack(h, c.astype(np.uint64 if len(c) and c.max() >> 32 else np.uint32), k.astype(np.uint8), share)
        return pa.table([pa.array([r[f.name]], f.type) for f in schema], schema=schema)
    return run, "ids binary, nulls binary, counts binary, tokens binary, words binary"


# --- the model ----------------------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Tokens:
    """All tokens of some texts of a batch, ends included, with their classes and feature rows."""

    def __init__(self, row: dict, classes: Classes):
        h, c, k, share = unpack(row["words"])
        counts, tokens = unpack(row["counts"])[0].astype(np.int64), unpack(row["tokens"])[0]
        self.ids = unpack(row["ids"])[0]
        self.sizes = counts + 1
        self.starts = np.cumsum(self.sizes) - self.sizes
        end = self.starts + counts
        n = int(self.sizes.sum())
        is_end = np.zeros(n, bool)
        is_end[end] = True
        word = ~is_end

        def spread(values, at_end, kind):
            out = np.full(n, at_end, kind)
            out[word] = values[tokens]
            return out

        self.c = spread(c, classes.end_count, np.int64)
        self.k = spread(k, END_CLASS if classes.end_count else UNKNOWN, np.uint8)
        self.share = spread(share, 0.0, np.float32)
        stand = (c == 1) & (h & 1 == 0)                        # half of the words seen once
        self.target = spread(np.where(stand, np.uint8(UNKNOWN), k), END_CLASS, np.uint8)
        first = _mix(np.array([END_HASH]))
        before = np.r_[first, _mix(spread(h, END_HASH, np.uint64))[:-1]]
        second = np.r_[first, before[:-1]]
        second[self.starts] = first                            # a text's first word has no history
        self.features = np.empty((3, n), np.int32)
        for i, x in enumerate((before, second, None)):
            if x is None:
                before *= np.uint64(0x9E3779B97F4A7C15)
                before += second
                x = _mix(before)
            self.features[i] = (x % np.uint64(ROWS[i])).astype(np.int32) + sum(ROWS[:i])


def _row_max(z: np.ndarray) -> np.ndarray:
    while z.shape[1] % 2 == 0:
        half = z.shape[1] // 2
        z = np.maximum(z[:, :half], z[:, half:])
    out = z[:, :1]
    for j in range(1, z.shape[1]):
        out = np.maximum(out, z[:, j:j + 1])
    return out


def log_softmax(weights: np.ndarray, bias: np.ndarray, features: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Log probability of each class; a few rows at a time, in memory that stays: large arrays made anew cost more than the sums."""
    n = features.shape[1]
    out = np.empty((n, CLASSES), np.float32) if out is None else out[:n]
    spare = np.empty((min(n, BLOCK), CLASSES), np.float32)
    for a in range(0, n, BLOCK):
        z = out[a:a + BLOCK]
        t = spare[:len(z)]
        np.take(weights, features[0, a:a + BLOCK], axis=0, out=z, mode="clip")
        for f in features[1:]:
            z += np.take(weights, f[a:a + BLOCK], axis=0, out=t, mode="clip")
        z += bias
        z -= _row_max(z)
        z -= np.log(np.exp(z, out=t).sum(axis=1, keepdims=True))
    return out


def stretch_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``g[order]`` that begin at ``first``, as ``np.add.reduceat`` adds them up.

    Most stretches are short: those up to SHORT rows are added row by row for all of them at once, the others by reduceat."""
    sizes = np.diff(np.r_[first, len(order)])
    total = np.take(g, order[first], axis=0, mode="clip")
    for size in range(2, SHORT + 1):
        at = np.flatnonzero(sizes == size)
        if len(at):
            rest = np.take(g, order[first[at] + 1], axis=0)     # reduceat adds a stretch's first row to the sum of the others
            for j in range(2, size):
                rest += np.take(g, order[first[at] + j], axis=0)
            total[at] += rest
    long = sizes > SHORT
    if long.any():
        rows = order[np.repeat(long, sizes)]
        total[long] = np.add.reduceat(np.take(g, rows, axis=0, out=spare[:len(rows)], mode="clip"), np.cumsum(sizes[long]) - sizes[long], axis=0)
    return total


def start_bias(classes: Classes) -> np.ndarray:
    return np.log((classes.mass + 0.5) / (classes.mass.sum() + 0.5 * CLASSES)).astype(np.float32)


class Learner:
    """Adaptive gradient steps of one task."""

    def __init__(self, bias: np.ndarray):
        n = sum(ROWS)
        self.bias = bias
        self.w, self.sq = np.zeros((n, CLASSES), np.float32), np.full((n, CLASSES), 1e-2, np.float32)
        self.steps = np.zeros(n, np.float32)
        self.g, self.spare = np.empty((2, CHUNK, CLASSES), np.float32)

    def step(self, features: np.ndarray, target: np.ndarray):
        g = log_softmax(self.w, self.bias, features, self.g)
        np.exp(g, out=g)
        g[np.arange(len(target)), target] -= 1
        for f, base in zip(features, FIRST_ROWS):
            order = np.argsort((f - base).astype(np.uint16), kind="stable")      # a kind's rows fit 16 bits, which are sorted by radix
            first = np.flatnonzero(np.r_[True, np.diff(f[order]) != 0])
            row, total = f[order[first]], stretch_sums(g, order, first, self.spare)
            sq = total * total
            sq += np.take(self.sq, row, axis=0)
            self.sq[row] = sq
            total *= RATE
            total /= np.sqrt(sq, out=sq)
            self.w[row] = np.subtract(np.take(self.w, row, axis=0), total, out=total)
            self.steps[row] += np.diff(np.r_[first, len(f)])


def _train(classes: Classes):
    bias = start_bias(classes)

    def run(arrow):
        learner = Learner(bias)
        for b in arrow:
            for r in b.to_pylist():
                x = Tokens(r, classes)
                trains = np.repeat([not held_out(i) for i in x.ids.tolist()], x.sizes)
                features, target = x.features[:, trains], x.target[trains]
                for a in range(0, len(target), CHUNK):
                    learner.step(features[:, a:a + CHUNK], target[a:a + CHUNK])
        if learner.steps.any():
            for k, part in enumerate(np.array_split(np.arange(len(learner.w)), BLOCKS)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([learner.steps[part].tobytes()], pa.binary()),
                                                  pa.array([learner.w[part].astype(np.float16).tobytes()], pa.binary())], ["block", "steps", "w"])
    return run


def _average(key: tuple, parts):
    """Streams over one block's parts: the mean of each row over tasks, weighted by its updates."""
    total = weight = None
    for b in parts:
        for steps, w in zip(b.column("steps").to_pylist(), b.column("w").to_pylist()):
            s = np.frombuffer(steps, np.float32).astype(np.float64)
            v = np.frombuffer(w, np.float16).reshape(len(s), CLASSES).astype(np.float64) * s[:, None]
            total, weight = (v, s) if total is None else (total + v, weight + s)
    mean = (total / np.maximum(weight, 1)[:, None]).astype(np.float32)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["block", "w"])


def _average_rows(key: tuple, t: pa.Table) -> pa.Table:
    return pa.Table.from_batches(list(_average(key, t.to_batches())))


def _score(classes: Classes, weights):
    bias = start_bias(classes)
    scale = math.log10(classes.tokens + classes.types + 1)

    def run(arrow):
        spare = np.empty((CHUNK, CLASSES), np.float32)
        for b in arrow:
            for r in b.to_pylist():
                x = Tokens(r, classes)
                ln = np.empty(len(x.k))
                for a in range(0, len(ln), CHUNK):
                    s = slice(a, a + CHUNK)
                    if weights is None:
                        ln[s] = 0.0
                        continue
                    z = log_softmax(weights.value, bias, x.features[:, s], spare)
                    ln[s] = z[np.arange(len(z)), x.k[s]].astype(np.float64) + x.share[s]
                base = np.log10(x.c + 1.0) - scale
                nulls = np.frombuffer(r["nulls"], bool)
                total = lambda v: np.add.reduceat(v, x.starts)
                base_score = total(base)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.ids, pa.int64(), mask=nulls), pa.array([held_out(i) for i in x.ids.tolist()], pa.bool_()),
                     pa.array(x.sizes, pa.int64()), pa.array(total((x.c > 0).astype(np.int64)), pa.int64()),
                     pa.array(np.full(len(x.ids), classes.tokens), pa.int64()), pa.array(base_score),
                     pa.array(base_score if weights is None else total(ln) / math.log(10))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lm")
    n = max(1, -(-input_bytes(docs) // BUCKET))
    t = batches(docs, lambda text: text.lower().split(), f"{path}/texts", n)
    t.select("batch", "ids", "counts", "tokens", "words").mapInArrow(_ask(n), REQUEST_DDL).repartition(n, "bucket") \
        .groupBy("bucket").applyInArrow(_count, COUNT_DDL).write.parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    by_ending = counts.where("ending is not null").groupBy("ending").agg(F.sum("c"), F.sum("types"), F.sum("ones")).collect()
    top = counts.where("word is not null").orderBy(F.desc("c"), "word").limit(TOP_WORDS).select("word", "c").collect()
    not_held = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % HELD_MOD != HELD
    ends = docs.where(F.coalesce(not_held, F.lit(True))).count()
    classes = Classes(sorted(map(tuple, by_ending)), [(bytes(w), c) for w, c in top], ends)
    run, ddl = prepare(classes, n)
    t.groupBy("batch").cogroup(counts.where("data is not null").select("batch", "bucket", "data").groupBy("batch")) \
        .applyInArrow(run, ddl).write.parquet(f"{path}/ready")
    ready = spark.read.parquet(f"{path}/ready")
    weights = None
    if ends:
        mean = ready.select("ids", "counts", "tokens", "words").mapInArrow(_train(classes), "block int, steps binary, w binary") \
            .groupBy("block").applyInArrow(_average_rows, "block int, w binary")
        blocks = sorted((r["block"], bytes(r["w"])) for r in mean.collect())    # the weight table: fixed size
        weights = spark.sparkContext.broadcast(np.frombuffer(b"".join(w for _, w in blocks), np.float32).reshape(-1, CLASSES))
    return ready.mapInArrow(_score(classes, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                                      "base_score double, score double")


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
