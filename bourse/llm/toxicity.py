r"""Operator 6: toxicity by a subsequence string-kernel SVM with Nyström landmarks.

Words are compared by a gapped subsequence kernel of order 3: two words share a
feature for each ordered triple of characters that both contain, with at most
``GAP`` characters skipped between neighbours, each skipped character costing a
factor ``DECAY``.  An inserted character therefore lowers a similarity instead
of destroying it.  ``^`` and ``$`` mark a word's ends.

Landmarks are the word stems and words that best separate toxic from clean rows
of the training sample.  A text is described by its words' largest kernel values
against each landmark (as cosine, as share of the landmark found, and as share of
the landmark's ungapped triples that are found at any gap, which inserted
characters do not lower; no value is too small to count), projected by the
inverse square root of the landmarks' kernel matrix (Nyström) and judged by a
linear support vector machine; a logistic curve turns margins into scores.

The model is fitted on a documented, bounded sample (``TRAIN_ROWS`` rows a
class, lowest hashes first); scoring reads every whole text of the table, each
distinct word once a batch.

Defined cases: a NULL or empty text has no word, all its features are 0 and it
gets the score of the bias; rows whose label is NULL are not learnt from; with
no label, or one class only, every score is 0 (or 1 if all labels are 1);
repeated rows get equal scores; very long words are read in overlapping pieces;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import crc_mod_col, give_back, id_text, rows_of, small_arrow_batches, table

TRAIN_ROWS = 2_000   # labelled rows a class that the model is fitted on, at most
LANDMARKS = 64
GAP, DECAY = 2, 0.5
FLOOR = 0.0          # similarities below count as none; at 0 every one counts
POWER = 4            # of the share of ungapped triples: all of them stand out from the half that other words hold
VIEWS = 3            # values of a word against a landmark: cosine, share, ungapped triples found
PIECE = 32           # characters of a word read at once; longer words give pieces that overlap by half
STEMS = range(4, 9)  # stem lengths that may become landmarks
HELD_OUT_MOD = 5
WORD_CACHE = 300_000
GROUP = 1 << 20      # text bytes whose words are held at once, about
STEPS = 65535        # kernel values are remembered as multiples of 1 / STEPS, in two bytes
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_+=/\\~`"


def pieces(word: str) -> list[str]:
    """A word with its end marks, cut where it is very long."""
    w = "^" + word.strip(_EDGE) + "$"
    if len(w) <= PIECE:
        return [w]
    return [w[i:i + PIECE] for i in range(0, len(w) - PIECE // 2, PIECE // 2)]


def _triples(words: list[str]):
    """Yields (row, code, weight) arrays of all gapped character triples, one per gap combination."""
    m = np.zeros((len(words), PIECE), np.uint64)
    for i, w in enumerate(words):
        m[i, :len(w)] = np.frombuffer(w.encode("utf-32-le"), np.uint32)
    m &= np.uint64((1 << 21) - 1)
    for g in range(GAP + 1):
        for h in range(GAP + 1):
            last = m[:, 2 + g + h:]
            n = last.shape[1]
            code = m[:, :n] | (m[:, 1 + g:1 + g + n] << np.uint64(21)) | (last << np.uint64(42))
            yield code, last > 0, DECAY ** (g + h)


def self_weight(lengths: np.ndarray) -> np.ndarray:
    """Sum of squared weights of a word's triples, by its length."""
    out = np.zeros(lengths.shape, np.float64)
    for g in range(GAP + 1):
        for h in range(GAP + 1):
            out += np.maximum(0, lengths - 2 - g - h) * DECAY ** (2 * (g + h))
    return out


class Kernel:
    """Kernel values of words against fixed landmarks, through the landmarks' own features."""

    BITS = 16

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        found: dict[int, dict[int, float]] = {}
        for code, ok, weight in _triples(landmarks):
            for i, j in zip(*np.nonzero(ok)):
                row = found.setdefault(int(code[i, j]), {})
                row[int(i)] = row.get(int(i), 0.0) + weight
        self.codes = np.array(sorted(found), np.uint64)
        self.weights = np.zeros((len(found), len(landmarks)), np.float32)
        for k, c in enumerate(self.codes):
            for i, w in found[int(c)].items():
                self.weights[k, i] = w
        # by triple, the landmarks that hold it: which, its weight there, and its part of the landmark's triples without a gap
        at, self.mark = np.nonzero(self.weights)
        self.edge = np.searchsorted(at, np.arange(len(found) + 1))
        self.entry = self.weights[at, self.mark]
        plain = np.zeros_like(self.weights)
        code, ok, _ = next(_triples(landmarks))
        for i in range(len(landmarks)):
            own = np.searchsorted(self.codes, np.unique(code[i, ok[i]]))
            plain[own, i] = 1 / max(1, len(own))
        self.plain = plain[at, self.mark]
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[self._slot(self.codes)] = True
        self.own = np.maximum((self.weights.astype(np.float64) ** 2).sum(0), 1e-9)
        self.gram = (self.weights.T @ self.weights) / np.sqrt(np.outer(self.own, self.own))

    def _slot(self, code: np.ndarray) -> np.ndarray:
        return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def values(self, words: list[str]) -> np.ndarray:
        """(words, 3 * landmarks): cosine, share of the landmark, and share of its ungapped triples that are found at any gap."""
        n, size = len(self.landmarks), max(1, len(self.codes))
        keys, weights = [], []
        for code, ok, weight in _triples(words):
            row, col = np.nonzero(ok & self.maybe[self._slot(code)])
            c = code[row, col]
            at = np.minimum(np.searchsorted(self.codes, c), size - 1)
            real = self.codes[at] == c
            keys.append(row[real] * size + at[real])
            weights.append(np.full(len(keys[-1]), weight))
        # each triple that a word holds, once, then each landmark that holds it too
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        weight = np.bincount(inverse, np.concatenate(weights), len(key))
        at = key % size
        times = self.edge[at + 1] - self.edge[at] if len(key) else at
        entry = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times) + np.repeat(self.edge[at], times)
        cell = np.repeat(key // size, times) * n + self.mark[entry]
        k = np.bincount(cell, np.repeat(weight, times) * self.entry[entry], len(words) * n).reshape(-1, n)
        found = np.bincount(cell, self.plain[entry], len(words) * n).reshape(-1, n) ** POWER
        own = np.maximum(self_weight(np.array([len(w) for w in words])), 1e-9)
        v = np.concatenate([k / np.sqrt(own[:, None] * self.own[None, :]), k / self.own[None, :], found], axis=1)
        v = np.minimum(v, 1.0)
        if FLOOR > 0:
            v[v < FLOOR] = 0.0
        return v.astype(np.float32)


class Describer:
    """Texts to pooled kernel values; remembers distinct words, up to a bound.

    A word shares triples with few landmarks: only the values that are not 0 are kept, each with its place."""

    def __init__(self, landmarks: list[str]):
        self.kernel = Kernel(landmarks)
        self.width = VIEWS * len(landmarks)
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}          # word -> its number, 0 if nothing in it
        self.edge, self.used = np.zeros(1 << 12, np.int64), 1       # word k's values lie from edge[k] to edge[k + 1]
        kind = np.uint8 if self.width <= 256 else np.uint16
        self.place, self.value = np.zeros(1 << 14, kind), np.zeros(1 << 14, np.uint16)    # values in steps of 1 / STEPS

    def learn(self, words):
        new = [w for w in words if w not in self.known]
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            cut, first = [], []
            for w in part:
                first.append(len(cut))
                cut += pieces(w)
            v = self.kernel.values(cut)
            if len(cut) > len(part):
                v = np.maximum.reduceat(v, first, axis=0)
            v = np.rint(v * STEPS).astype(np.uint16)
            row, place = np.nonzero(v)
            count = np.bincount(row, minlength=len(part))
            some = count > 0
            number = np.where(some, self.used + np.cumsum(some) - 1, 0)
            begin, end = int(self.edge[self.used]), self.used + int(some.sum())
            self.edge = roomy(self.edge, end + 1)
            self.edge[self.used + 1:end + 1] = begin + np.cumsum(count[some])
            self.place, self.value = roomy(self.place, begin + len(row)), roomy(self.value, begin + len(row))
            self.place[begin:begin + len(row)], self.value[begin:begin + len(row)] = place, v[row, place]
            self.used = end
            self.known.update(zip(part, number.tolist()))

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        out, at, size = [np.zeros((0, self.width), np.float32)], 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= GROUP or i + 1 == len(texts):
                out.append(self.describe(texts[at:i + 1]))
                at, size = i + 1, 0
        return np.concatenate(out)

    def describe(self, texts: list[bytes]) -> np.ndarray:
        if len(self.known) > WORD_CACHE:
            self.forget()
        out = np.zeros((len(texts), self.width), np.uint16)
        sets = [set(t.decode().lower().split()) for t in texts]
        self.learn(set().union(*sets))
        for i, words in enumerate(sets):
            at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            at = at[at > 0]
            for k in range(0, len(at), 4096):
                begin = self.edge[at[k:k + 4096]]
                n = self.edge[at[k:k + 4096] + 1] - begin
                here = np.arange(int(n.sum())) + np.repeat(begin - (np.cumsum(n) - n), n)
                np.maximum.at(out[i], self.place[here], self.value[here])
        return out.astype(np.float32) / np.float32(STEPS)


def roomy(a: np.ndarray, n: int) -> np.ndarray:
    """a, with room for n entries."""
    if n <= len(a):
        return a
    out = np.zeros(n + n // 4, a.dtype)
    out[:len(a)] = a
    return out


def candidates(text: bytes) -> set[str]:
    """Marked words of a text and their stems."""
    out = set()
    for w in set(text.decode().lower().split()):
        w = w.strip(_EDGE)
        if 3 <= len(w) < PIECE - 2:
            out.add(f"^{w}$")
            out.update("^" + w[:n] for n in STEMS if n <= len(w))
    return out


def choose_landmarks(counts, n_toxic: int, n_clean: int, most: int = LANDMARKS) -> list[str]:
    """The candidates that best separate the classes, no two from one stem; counts: (candidate, toxic, clean)."""
    scored = []
    for c, toxic, clean in counts:
        odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if odds > 1:
            scored.append((-round(toxic * odds, 6), -len(c), c))
    chosen: list[str] = []
    for _, _, c in sorted(scored):
        stem = c.rstrip("$")
        if not any(stem.startswith(o.rstrip("$")) or o.startswith(stem) for o in chosen):
            chosen.append(c)
            if len(chosen) == most:
                break
    return chosen


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, passes: int = 60, seed: int = 3) -> np.ndarray:
    """Linear SVM (hinge loss, classes weighed alike) by dual coordinate descent; the last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    s = np.where(y > 0, 1.0, -1.0)
    limit = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y <= 0).sum())))
    q = (x * x).sum(1)
    alpha, w, rng = np.zeros(len(y)), np.zeros(x.shape[1]), np.random.default_rng(seed)
    for _ in range(passes):
        moved = 0.0
        for i in rng.permutation(len(y)):
            a = min(max(alpha[i] + (1 - s[i] * (x[i] @ w)) / q[i], 0.0), limit[i])
            if a != alpha[i]:
                w += (a - alpha[i]) * s[i] * x[i]
                moved = max(moved, abs(a - alpha[i]))
                alpha[i] = a
        if moved < 1e-3:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> dict:
    """Fits the model on at most ``train_rows`` labelled training rows of each class."""
    small_arrow_batches(docs.sparkSession)
    lab = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic")) \
        .where(crc_mod_col("doc_id", HELD_OUT_MOD) > 0)
    order = [F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id"]
    wanted = lab.where("toxic = 1").orderBy(*order).limit(train_rows) \
        .unionByName(lab.where("toxic = 0").orderBy(*order).limit(train_rows))
    # the sample's ids have a bound (2 * train_rows), so they can be broadcast and the texts stay where they are
    sample = id_text(docs).join(F.broadcast(wanted), "doc_id").dropDuplicates(["doc_id", "text"]).checkpoint()
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return {"constant": float(1 in n)}

    def count(batches):
        seen = Counter(), Counter()
        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[toxic].update(candidates(text))
        keys = list(seen[1].keys() | seen[0].keys())
        for i in range(0, len(keys), 50_000):
            part = keys[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array([seen[1][k] for k in part], pa.int64()),
                                              pa.array([seen[0][k] for k in part], pa.int64())], ["c", "toxic", "clean"])

    counts = sample.select("text", "toxic").mapInArrow(count, "c string, toxic long, clean long") \
        .groupBy("c").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .where("toxic >= 3 and toxic > 2 * clean").orderBy(F.desc(F.col("toxic") - F.col("clean")), "c").limit(20_000)
    chosen = choose_landmarks([tuple(r) for r in counts.collect()], n[1], n[0])
    if not chosen:
        return {"constant": 0.0}

    def describe(batches):
        d = Describer(chosen)
        for b in batches:
            v = d(b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(v), pa.list_(pa.float32())), b.column(1).cast(pa.int32())], ["v", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(describe, "v array<float>, toxic int").collect()
    rows.sort(key=lambda r: (r["toxic"], r["v"]))
    v, y = np.array([r["v"] for r in rows], np.float64), np.array([r["toxic"] for r in rows])
    gram = Kernel(chosen).gram.astype(np.float64)
    value, vector = np.linalg.eigh(gram + 1e-3 * np.eye(len(chosen)))
    root = vector @ np.diag(value ** -0.5) @ vector.T
    project = np.kron(np.eye(VIEWS), root)
    w = fit_svm(v @ project, y)
    margin = v @ project @ w[:-1] + w[-1]
    slope = 2.0 / max(1e-6, float(np.median(np.abs(margin))))
    return {"landmarks": chosen, "weights": project @ w[:-1], "bias": float(w[-1]), "slope": slope}


def scorer(model: dict):
    """Texts -> scores, for one task."""
    if "landmarks" not in model:
        return lambda texts: np.full(len(texts), model["constant"])
    d = Describer(model["landmarks"])

    def judge(texts: list[bytes]) -> np.ndarray:
        margin = d(texts).astype(np.float64) @ model["weights"] + model["bias"]
        return 1 / (1 + np.exp(-np.clip(model["slope"] * margin, -50, 50)))
    return judge


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    small_arrow_batches(docs.sparkSession)

    def run(batches):
        give_back()
        judge = scorer(model)
        for ids, texts in rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(judge(texts), pa.float64())], ["doc_id", "score"])

    out = id_text(docs).mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (crc_mod_col("doc_id", HELD_OUT_MOD) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of docs, all columns as they are, whose text the model does not call toxic; no shuffle."""
    small_arrow_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        give_back()
        judge = scorer(model)
        for b in batches:
            if b.num_rows:
                texts = [(t or "").encode() for t in b.column(at).to_pylist()]
                yield b.filter(pa.array(judge(texts) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
