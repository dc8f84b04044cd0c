r"""Operator 8: token-id files compressed by a Re-Pair grammar.

Documents are put in ascending order of id (then of a hash of the text), encoded
with a public tokenizer, an end id is added to each, and every part of the order
is written as shards of about a million ids.  A shard is a grammar: in rounds of
falling frequency, pairs of neighbouring symbols that occur often are replaced by
new symbols (non-overlapping, left to right), never across a document's end.
Stored are the rules, the expansion length of each symbol, and where each
document's symbols begin, so that one document decodes without the others.
Rounds go on until no pair is left that reaches the least frequency.

File format: Parquet, one file per part of the order, one row per shard:
``part, shard, n_ids, vocab, doc_ids, doc_symbols, doc_tokens, rules, symbols``.
``rules`` holds left symbols, right symbols, expansion lengths; rule i makes
symbol vocab + i; ``symbols`` is the start sequence.  All arrays are packed byte
plane by byte plane and compressed.

The tokenizer runs once per distinct word of a worker's memory: words here are
separated by ASCII white space, across which the tokenizer's pieces never reach.

Defined cases: NULL and empty texts hold the end id alone; NULL ids come first;
repeated rows are stored again, one after another; a very long text makes a
shard of its own; an empty table gives no shard and an empty result; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bourse.llm.blobs import gather, pack, unpack
from bourse.llm.common import NULL_ID, input_bytes, small_arrow_batches, table
from bourse.session import scratch_path

END = 2
SHARD_IDS = 1 << 20
PART_BYTES = 32 << 20      # text bytes per part of the order, about
WORD_CACHE = 700_000
MARKS = ".,;:!?"           # closing marks that a word is read without
JOINED = 2_000             # words that the tokenizer reads as one text
LEVELS = [1024, 256, 64, 16]   # least frequencies of a round's pairs, in a shard of SHARD_IDS; each is repeated while it finds pairs


#: The letter that stands for each byte in byte-level vocabularies: visible Latin-1 characters for themselves, the others from 256 on.
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_LETTERS = {b: chr(b) for b in _VISIBLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


# --- grammar ---------------------------------------------------------------

def repair(ids: np.ndarray, last: np.ndarray, vocab: int):
    """(symbols, last, left, right, lengths): the grammar of an id sequence; ``last`` marks the symbols that end a document."""
    s, last = ids.astype(np.int64), last.copy()
    left, right, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.ones(vocab, np.int64)
    for level in LEVELS:
        least, known = max(4, level * len(ids) // SHARD_IDS), 0
        # A round leaves none of its pairs in the sequence, and any other count only falls: after a level's first
        # round, only pairs that hold a symbol of the round before can reach the least frequency.
        while len(s) > 1:
            size = len(lengths)
            open_ = ~last[:-1]
            if known:
                fresh = s >= known
                open_ &= fresh[:-1] | fresh[1:]
            at = np.flatnonzero(open_)
            pair = s[at] * size + s[at + 1]
            code = np.sort(pair)
            first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
            count = np.diff(np.r_[first, len(code)])
            chosen = code[first[count >= least]]
            if not len(chosen):
                break
            # first by the two symbols alone, then exactly
            begins, follows = np.zeros(size, bool), np.zeros(size, bool)
            begins[chosen // size], follows[chosen % size] = True, True
            maybe = np.flatnonzero(begins[s[at]] & follows[s[at + 1]])
            found = np.minimum(np.searchsorted(chosen, pair[maybe]), len(chosen) - 1)
            exact = chosen[found] == pair[maybe]
            hit, found = at[maybe[exact]], found[exact]
            # of pairs that overlap in a row, every other one from the left
            place = np.arange(len(hit))
            run_start = np.maximum.accumulate(np.where(np.r_[True, np.diff(hit) != 1], place, 0))
            even = (place - run_start) % 2 == 0
            take = hit[even]
            used, rule = np.unique(found[even], return_inverse=True)
            s[take] = size + rule
            last[take] = last[take + 1]
            keep = np.ones(len(s), bool)
            keep[take + 1] = False
            s, last = s[keep], last[keep]
            a, b = chosen[used] // size, chosen[used] % size
            left.append(a)
            right.append(b)
            lengths = np.r_[lengths, lengths[a] + lengths[b]]
            known = size
    return s, last, np.concatenate(left), np.concatenate(right), lengths[vocab:]


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, vocab: int) -> np.ndarray:
    """The ids that a stretch of symbols stands for."""
    s = symbols.astype(np.int64)
    while len(s) and s.max() >= vocab:
        rule = s >= vocab
        out = np.repeat(s, 1 + rule)
        first = np.cumsum(1 + rule) - (1 + rule)
        out[first[rule]] = left[s[rule] - vocab]
        out[first[rule] + 1] = right[s[rule] - vocab]
        s = out
    return s.astype(np.uint32)


class Shard:
    """One row of the files; ``document(i)`` decodes that document alone."""

    def __init__(self, row: dict):
        self.vocab = row["vocab"]
        self.doc_ids, self.doc_symbols, self.doc_tokens = (unpack(row[c])[0] for c in ("doc_ids", "doc_symbols", "doc_tokens"))
        self.left, self.right, self.lengths = unpack(row["rules"])
        self.symbols = unpack(row["symbols"])[0]
        self.ends = np.cumsum(self.doc_symbols)

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.ends[i] - self.doc_symbols[i]:self.ends[i]], self.left, self.right, self.vocab)

    def all_ids(self) -> np.ndarray:
        return expand(self.symbols, self.left, self.right, self.vocab)


def small(a: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the smallest unsigned type that holds them."""
    top = int(a.max()) if len(a) else 0
    return a.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


# --- encoding --------------------------------------------------------------

def ends_in_letter(text: str) -> bool:
    """The tokenizer sees the text composed and in lower case: U+0130 then ends in a mark, not in a letter."""
    return text[-1].isalpha() and (text[-1].isascii() or unicodedata.normalize("NFC", text).lower()[-1].isalpha())


def words_apart(tokenizer) -> bool:
    """Whether the tokenizer lower-cases and reads words one by one, whatever white space is between them."""
    def ids(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids
    texts = ("Hello World", "a  b\n c", "x\ty.", " Lead", "trail ", "ONE-two 3,5")
    return all(ids(t) == [x for w in t.split() for x in ids(w.lower())] for t in texts)


class WordIds:
    """Numbers words and keeps each word's ids as a stretch of one flat array; word 0 is the end id.

    The tokenizer itself sees each distinct core once: the word without one
    closing mark after a letter (a piece never holds both), and in lower case
    where it is ASCII, as the tokenizer would make it.  A tokenizer that does not
    read words one by one in lower case gets whole texts instead.
    """

    def __init__(self, tokenizer, end: int):
        self.tokenizer, self.end = tokenizer, end
        self.apart = words_apart(tokenizer)        # else whole texts are encoded
        if self.apart:
            self.forget()

    def forget(self):
        self.number: dict[bytes, int] = {b"": 0}   # no word is empty
        self.flat, self.size = [np.array([self.end], np.uint32)], [np.ones(1, np.int64)]
        self.core: dict[str, int] = {}
        self.core_flat, self.core_size = [], []
        self.marks = {m: self.core.setdefault(m, len(self.core)) for m in MARKS}
        self.tokenize(list(MARKS))

    def tokenize(self, cores: list[str]):
        """Appends the ids of new cores.  One of letters alone is one piece and goes straight to the merges."""
        lists: list = [None] * len(cores)
        merges, rest = self.tokenizer.model.tokenize, []
        for i, t in enumerate(cores):
            if t.isalpha() and "\u03a3" not in t and "\u0130" not in t and (t.isascii() or unicodedata.is_normalized("NFC", t)):
                low = t.lower()
                if not low.isascii():
                    low = low.encode().decode("latin-1").translate(BYTE_LETTERS) if unicodedata.is_normalized("NFC", low) else None
                lists[i] = [x.id for x in merges(low)] if low is not None else None
            if not lists[i]:
                lists[i] = None
                rest.append(i)
        sizes = np.fromiter((0 if x is None else len(x) for x in lists), np.int64, len(lists))
        own = [x for x in lists if x]
        flat = np.fromiter(itertools.chain.from_iterable(own), np.uint32, int(sizes.sum()))
        if rest:
            more, more_sizes = self.tokenize_texts([cores[i] for i in rest])
            both = np.r_[flat, more]
            stretch = np.r_[sizes[sizes > 0], more_sizes]
            place = np.empty(len(cores), np.int64)
            place[np.flatnonzero(sizes > 0)] = np.arange(int((sizes > 0).sum()))
            place[rest] = int((sizes > 0).sum()) + np.arange(len(rest))
            flat, sizes = gather(both, stretch, place), stretch[place]
        self.core_flat.append(flat)
        self.core_size.append(sizes)

    def tokenize_texts(self, cores: list[str]):
        flats, counts = [], []
        for at in range(0, len(cores), JOINED):
            part = cores[at:at + JOINED]
            e = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            starts = np.cumsum([0] + [len(w) + 1 for w in part[:-1]])
            owner = np.searchsorted(starts, np.array([o[0] for o in e.offsets], np.int64), side="right") - 1
            flats.append(np.array(e.ids, np.uint32))
            counts.append(np.bincount(owner, minlength=len(part)))
        return np.concatenate(flats), np.concatenate(counts)

    def learn(self, words):
        new = [w for w in words if w not in self.number]
        if not new:
            return
        units, fresh, core = np.full((len(new), 2), -1, np.int64), [], self.core
        for i, w in enumerate(new):
            t = w.decode()
            if len(t) > 1 and t[-1] in self.marks and ends_in_letter(t[:-1]):
                units[i, 1] = self.marks[t[-1]]
                t = t[:-1]
            if t.isascii():
                t = t.lower()
            k = core.get(t)
            if k is None:
                k = core[t] = len(core)
                fresh.append(t)
            units[i, 0] = k
            self.number[w] = len(self.number)
        self.tokenize(fresh)
        self.core_flat, self.core_size = [np.concatenate(self.core_flat)], [np.concatenate(self.core_size)]
        size = self.core_size[0]
        self.flat.append(gather(self.core_flat[0], size, units[units >= 0]))
        self.size.append(size[units[:, 0]] + np.where(units[:, 1] >= 0, size[units[:, 1]], 0))

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each with its end id, and the number of ids per text."""
        if not self.apart:
            found = self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            rows = [np.array([*e.ids, self.end], np.uint32) for e in found]
            return np.concatenate(rows or [np.zeros(0, np.uint32)]), np.array([len(r) for r in rows], np.int64)
        if len(self.number) > WORD_CACHE:
            self.forget()
        words = [t.split() for t in texts]
        self.learn(dict.fromkeys(itertools.chain.from_iterable(words)))
        self.flat, self.size = [np.concatenate(self.flat)], [np.concatenate(self.size)]
        flat, size = self.flat[0], self.size[0]
        counts = np.array([len(x) + 1 for x in words], np.int64)
        seq = np.zeros(int(counts.sum()), np.int64)
        inner = np.ones(len(seq), bool)
        inner[np.cumsum(counts) - 1] = False       # the end id's places
        seq[inner] = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(words)), np.int64, int(inner.sum()))
        return gather(flat, size, seq), np.add.reduceat(size[seq], np.cumsum(counts) - counts) if len(counts) else counts


_WORDS: dict = {}    # of this Python process: tokenizer configuration -> its words, kept from task to task


def words_of(config: str, end: int) -> WordIds:
    key = hash((config, end))
    if key not in _WORDS:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_str(config)
        tokenizer.encode_special_tokens = True     # their strings in a text are ordinary text
        _WORDS.clear()
        _WORDS[key] = WordIds(tokenizer, end)
    return _WORDS[key]


def shard_row(part: int, shard: int, doc_ids: list, ids: np.ndarray, tokens: np.ndarray, vocab: int) -> dict:
    last = np.zeros(len(ids), bool)
    last[np.cumsum(tokens) - 1] = True
    symbols, last, left, right, lengths = repair(ids, last, vocab)
    doc_symbols = np.diff(np.flatnonzero(np.r_[True, last]))             # no rule reaches across a document's end
    return {"part": part, "shard": shard, "n_ids": len(ids), "vocab": vocab,
            "doc_ids": pack(np.array([NULL_ID if i is None else i for i in doc_ids], np.int64)),
            "doc_symbols": pack(small(doc_symbols)), "doc_tokens": pack(small(tokens)),
            "rules": pack(small(left), small(right), small(lengths)), "symbols": pack(small(symbols))}


FILE_SCHEMA = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_ids", pa.int64()), ("vocab", pa.int32()),
                         *((c, pa.binary()) for c in ("doc_ids", "doc_symbols", "doc_tokens", "rules", "symbols"))])
FILE_DDL = "part int, shard int, n_ids long, vocab int, doc_ids binary, doc_symbols binary, doc_tokens binary, rules binary, symbols binary"


def write(docs: DataFrame, path: str, tokenizer_file: str, end: int = END, shard_ids: int = SHARD_IDS) -> None:
    """Writes the documents' ids under ``path``."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        config = spark.sparkContext.broadcast(f.read())       # a vocabulary file: its size does not depend on the data
    parts = max(1, -(-input_bytes(docs) // PART_BYTES))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")) \
        .withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        from bourse.llm import token_files
        encode = token_files.words_of(config.value, end)
        vocab, part = encode.tokenizer.get_vocab_size(), TaskContext.get().partitionId()
        doc_ids, ids, tokens, held, shard = [], [], [], 0, 0

        def row():
            r = shard_row(part, shard, doc_ids, np.concatenate(ids), np.concatenate(tokens), vocab)
            return pa.RecordBatch.from_pylist([r], schema=FILE_SCHEMA)

        for b in batches:
            b_ids, b_texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            flat, n = encode(b_texts)
            edge = np.cumsum(n)
            at = 0
            while at < len(b_ids):
                # documents up to the shard's size, one at least
                base = edge[at] - n[at]
                take = max(1, int(np.searchsorted(edge, base + shard_ids - held, side="right")) - at) if not held or edge[at] - base + held <= shard_ids else 0
                if take:
                    doc_ids += b_ids[at:at + take]
                    ids.append(flat[base:edge[at + take - 1]])
                    tokens.append(n[at:at + take])
                    held += int(edge[at + take - 1] - base)
                    at += take
                if at < len(b_ids):
                    yield row()
                    doc_ids, ids, tokens, held, shard = [], [], [], 0, shard + 1
        if doc_ids:
            yield row()

    ordered.drop("tie").mapInArrow(run, FILE_DDL).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every stored document, decoded from the files."""
    files = spark.read.parquet(path)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                s = Shard(r)
                ids, end = s.all_ids(), np.cumsum(s.doc_tokens.astype(np.int64))
                begin = end - s.doc_tokens
                raw = ids.astype("<u4").tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * e]) for a, e in zip(begin.tolist(), end.tolist())]
                n = len(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["part"]] * n, pa.int32()), pa.array([r["shard"]] * n, pa.int32()),
                     pa.array(s.doc_ids, pa.int64(), mask=s.doc_ids == NULL_ID), pa.array(begin, pa.int64()),
                     pa.array(s.doc_tokens.astype(np.int64)), pa.array(crc, pa.int64())],
                    ["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = files.mapInArrow(run, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    # ids before a shard: those of earlier parts (one row per part) and of earlier shards of its part
    sizes = files.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = parts.select(F.col("part").alias("p"), F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("parts_before"))
    in_part = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("shards_before", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))) \
        .join(before_part, F.col("part") == F.col("p")) \
        .select(F.col("part").alias("p"), F.col("shard").alias("s"), (F.col("parts_before") + F.col("shards_before")).alias("base"))
    return docs.join(offsets, (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))) \
        .select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = scratch_path(spark, "token-files")
    write(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, path)
