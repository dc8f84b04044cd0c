r"""Operator 9: byte-level BPE encoding and decoding with Spark's higher-order functions.

Texts are cut by the public pattern into pieces; each distinct piece of the
corpus is encoded once, in SQL expressions: its bytes become an array of ids, and
``aggregate`` folds one merge a step over it, always the lowest-ranked neighbour
pair, leftmost first, until no pair has a rank.  Ranks come from a map,
from the one pair of ids that merges can make a rank of to that
rank: one flat array with a slot per pair and one of displacements that keep slots
apart, so a look-up reads one entry of each.  Decoding looks up each id's bytes in an
array and concatenates them.  These arrays stand in the rows, beside ``ROW_WORDS`` pieces
each, and not in the plan, of which the driver keeps and prints many copies.

Encodings reach the texts through ``dictionary``: a batch cuts its texts into pieces
once and asks once for each distinct one.  An answer is the piece's ids as decimal
text; decoded bytes are sent where they differ from the piece, else one flag.  Pieces over ``LONG`` bytes, for which a fold of array copies
would be quadratic, take the same merges from a heap in Python.

Defined cases: NULL and empty texts have no ids; repeated rows are encoded one by
one; an empty table gives an empty result; other columns are ignored or carried.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.blobs import from_ipc, gather, pack, unpack
from bourse.llm.common import give_back, input_bytes, table
from bourse.llm.dictionary import (ANSWER_DDL, ANSWER_SCHEMA, REQUEST_DDL, REQUEST_SCHEMA, Numbers, batches, by_bucket, cut,
                                   requests, rows)
from bourse.session import scratch_path

LONG = 256                # bytes of a piece beyond which Python's heap merges it
ID_BITS = 21              # ids are below 2**ID_BITS: two ids and a rank fit one long
BUCKET = 32 << 20         # text bytes per bucket of words, about
NO_ID = (1 << ID_BITS) - 1
NO_PAIR = NO_ID           # in an empty slot: no pair's, and short in printed plans
ROW_WORDS = 1 << 15       # pieces of a row, beside which the vocabulary's arrays stand once
#: The pattern's white space, spelled out: the same characters whichever library reads it.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def spelled_out(pattern: str) -> str:
    return pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class Splitter:
    """Pieces of a text by the pattern.  A run of white space and the word after it are split alike wherever they stand."""

    def __init__(self, pattern: str):
        import regex
        self.piece = regex.compile(spelled_out(pattern)).findall
        self.chunk = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+").findall
        self.space = re.compile(f"[{SPACE}]").match

    def chunks(self, text: bytes) -> list[str]:
        return self.chunk(text.decode())

    def pieces(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """(pieces of all chunks, their number by chunk), from one pass of the pattern over the chunks put together.

        White space ends a piece, so a chunk that begins with it can follow a chunk that does not end with it."""
        together, apart = [], []
        for i, c in enumerate(chunks):
            (together if self.space(c[0]) and not self.space(c[-1]) else apart).append(i)
        found = [self.piece(chunks[i]) for i in apart]
        whole = self.piece("".join([chunks[i] for i in together]))
        ends = np.cumsum(np.fromiter(map(len, whole), np.int64, len(whole)))
        edges = np.searchsorted(ends, np.cumsum(np.array([len(chunks[i]) for i in together], np.int64))) + 1
        counts = np.zeros(len(chunks), np.int64)
        counts[together], counts[apart] = np.diff(np.r_[0, edges]), [len(x) for x in found]
        out = np.empty(int(counts.sum()), object)
        first = np.cumsum(counts) - counts
        own = np.zeros(len(out), bool)
        for i, x in zip(apart, found):
            out[first[i]:first[i] + len(x)] = x
            own[first[i]:first[i] + len(x)] = True
        out[~own] = whole
        return out.tolist(), counts


# --- merges in SQL expressions ----------------------------------------------

def _json(value, ddl: str) -> Column:
    """A constant: folded once when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(value, separators=(",", ":"))), ddl)


def pair_key(a: int, b: int) -> int:
    return a << ID_BITS | b


def hash_key(key: int) -> int:
    """xxhash64 of a long as the SQL function computes it, as an unsigned number."""
    return xxhash.xxh64_intdigest(key.to_bytes(8, "little"), seed=42)


def slot_of(h: int, move: int, slots: int) -> int:
    return ((h >> 32) + move * ((h >> 16 & 0xFFFF) | 1)) & (slots - 1)


def pair_slots(pairs: dict[int, int]) -> tuple[list[int], list[int]]:
    """(slots, displacements): a pair with hash h stands in ``slot_of(h, displacements[h mod their number])``.

    A slot holds key and rank in one number, ``NO_PAIR`` where it is empty.  Groups of pairs with one displacement are
    placed from the largest on, each by the first displacement that finds all its slots free."""
    slots = 1 << max(4, (len(pairs) * 5 // 4).bit_length())
    out, moves = [NO_PAIR] * slots, [0] * (slots // 4)
    groups: dict[int, list] = {}
    for key, rank in pairs.items():
        h = hash_key(key)
        groups.setdefault(h & (len(moves) - 1), []).append((h, key << ID_BITS | rank))
    for g, members in sorted(groups.items(), key=lambda x: -len(x[1])):
        move = 0
        while True:
            at = [slot_of(h, move, slots) for h, _ in members]
            if len(set(at)) == len(at) and all(out[i] == NO_PAIR for i in at):
                break
            move += 1
        moves[g] = move
        for i, (_, entry) in zip(at, members):
            out[i] = entry
    return out, moves


def halves(piece: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the merges of a ranked piece come to before the last; None if they stop earlier.

    No other two parts of it ever stand side by side, in whatever text: until they are merged, the merges inside
    them are those of the piece alone, in the same order."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 2:
        known = [ranks.get(a + b, NO_ID) for a, b in zip(parts, parts[1:])]
        best = min(known)
        if best == NO_ID:
            return None
        i = known.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return (parts[0], parts[1]) if parts[0] in ranks and parts[1] in ranks else None


def tables(ranks: dict[bytes, int]) -> dict:
    """The rank map as arrays.

    slots, moves: ``pair_slots`` of the pairs of ids that merges can make a rank of (``halves``), one a rank.
    whole: pieces, in hexadecimal, that have a rank which merges do not reach.
    known: id of each byte, None where it has none; text: bytes of each id, empty where there is none.
    """
    top = max(ranks.values(), default=-1) + 1
    if top >= 1 << ID_BITS:
        raise ValueError(f"ids must be below {(1 << ID_BITS) - 1}")
    pairs, unreached = {}, {}
    for p, rank in ranks.items():
        last = halves(p, ranks) if len(p) > 1 else None
        if last:
            pairs[pair_key(ranks[last[0]], ranks[last[1]])] = rank
        elif len(p) > 1:
            unreached[p.hex()] = rank
    slots, moves = pair_slots(pairs)
    text = [b""] * top
    for piece, rank in ranks.items():
        text[rank] = piece
    return {"slots": np.array(slots, np.int64), "moves": np.array(moves, np.int32), "whole": unreached,
            "known": [ranks.get(bytes([i])) for i in range(256)], "text": text}


def expressions(t: dict, slots: Column, moves: Column, text: Column) -> dict:
    """What ``encode_word`` and ``decode_ids`` need of ``tables``: three large arrays as the columns given, the rest as constants."""
    return {"slots": slots, "moves": moves, "text": text, "n_slots": len(t["slots"]), "n_moves": len(t["moves"]),
            "whole": _json(t["whole"], "map<string,int>") if t["whole"] else None, "bytes": _json(t["known"], "array<int>"), "gaps": None in t["known"]}


def literals(ranks: dict[bytes, int]) -> dict:
    """The rank map as constants of the expression: megabytes of plan."""
    t = tables(ranks)
    return expressions(t, _json(t["slots"].tolist(), "array<bigint>"), _json(t["moves"].tolist(), "array<int>"),
                       _json([base64.b64encode(x).decode() for x in t["text"]], "array<binary>"))


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def encode_word(word: Column, lit: dict) -> Column:
    """array<int>: the ids of one piece (binary, not empty)."""
    folded = let(lit["slots"], lambda slots: let(lit["moves"], lambda moves: _fold(word, slots, moves, lit)))
    if lit["whole"] is None:
        return folded
    return let(F.try_element_at(lit["whole"], F.lower(F.hex(word))), lambda w: F.when(w.isNotNull(), F.array(w)).otherwise(folded))


def _fold(word: Column, slots: Column, moves: Column, lit: dict) -> Column:
    """State of the fold: one long for each neighbour pair of parts, its rank above the two ids, so that the least long is
    the pair to merge and parts need no array beside it; ``NO_ID`` stands beyond both ends, ``NO_ID`` as a rank for no rank.

    Pairs of one rank are equal (``halves``), so the first of them is the leftmost."""
    count, mask = F.length(word), F.lit(NO_ID)

    def pair_of(a: Column, b: Column) -> Column:
        return F.shiftleft(a, ID_BITS).bitwiseOR(b)

    def ranked(key: Column) -> Column:
        """The pair under its rank.  Its slot without its key is the rank, if the slot is the pair's own; else more than any."""
        def slot(h: Column) -> Column:
            move = F.get(moves, h.bitwiseAND(F.lit(lit["n_moves"] - 1)).cast("int"))
            place = F.shiftrightunsigned(h, 32) + move * F.shiftrightunsigned(h, 16).bitwiseAND(F.lit(0xFFFF)).bitwiseOR(F.lit(1))
            return F.get(slots, place.bitwiseAND(F.lit(lit["n_slots"] - 1)).cast("int"))
        rank = F.least(let(F.xxhash64(key), slot).bitwiseXOR(F.shiftleft(key, ID_BITS)), mask)
        return F.shiftleft(rank, 2 * ID_BITS).bitwiseOR(key)

    letters = let(F.decode(word, "ISO-8859-1"), lambda s: let(lit["bytes"], lambda known: F.transform(
        F.sequence(F.lit(1), count), lambda i: F.get(known, F.ascii(F.substring(s, i, 1))))))
    start = let(letters, lambda p: F.transform(F.transform(F.sequence(F.lit(0), count), lambda i: pair_of(
        F.coalesce(F.get(p, i - 1).cast("long"), mask), F.coalesce(F.get(p, i).cast("long"), mask))), ranked))

    def step(pairs, _):
        """One merge: the leftmost pair of the least rank becomes one part; the pairs beside it are looked up."""
        def merge(best, at):  # at: place of the pair, from 1
            one = F.shiftright(best, 2 * ID_BITS)
            before = F.shiftright(F.get(pairs, at - 2), ID_BITS).bitwiseAND(mask)
            beside = F.array(pair_of(before, one), pair_of(one, F.get(pairs, at).bitwiseAND(mask)))
            return F.concat(F.slice(pairs, F.lit(1), at - 2), F.transform(beside, ranked), F.slice(pairs, at + 2, count))

        return let(F.array_min(pairs), lambda best: F.when(best < F.lit(NO_ID << 2 * ID_BITS), let(
            F.array_position(pairs, best).cast("int"), lambda at: merge(best, at))).otherwise(pairs))

    def first_part(pair: Column) -> Column:
        part = F.shiftright(pair, ID_BITS).bitwiseAND(mask).cast("int")
        return F.when(part < mask, part).otherwise(F.lit(-1)) if lit["gaps"] else part

    steps = F.when(count > 1, F.sequence(F.lit(1), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, start, step, lambda pairs: F.transform(F.slice(pairs, F.lit(2), count), first_part))


def decode_ids(ids: Column, lit: dict) -> Column:
    """binary: the concatenated bytes of an array of ids."""
    return F.aggregate(ids, F.lit(b""), lambda acc, i: F.concat(acc, F.get(lit["text"], i)))


def heap_merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a very long piece, in n log n steps."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end, nxt, prev = [i + 1 for i in range(n)], [i + 1 for i in range(n)], [i - 1 for i in range(n)]
    alive = [True] * n
    heap = [(ranks[word[i:i + 2]], i, i + 2) for i in range(n - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or nxt[i] >= n or end[nxt[i]] != stop:
            continue    # one of its parts has been merged since
        j = nxt[i]
        alive[j], end[i], nxt[i] = False, end[j], nxt[j]
        if nxt[i] < n:
            prev[nxt[i]] = i
        for a, b in ((prev[i], i), (i, nxt[i])):
            if a >= 0 and b < n and word[a:end[b]] in ranks:
                heapq.heappush(heap, (ranks[word[a:end[b]]], a, end[b]))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i:end[i]]])
        i = nxt[i]
    return out


# --- the job ------------------------------------------------------------------

def cut_chunks(pattern: str) -> Callable[[list[str]], bytes]:
    """How a batch keeps its distinct chunks: distinct pieces, and the pieces of each chunk by number.

    Pieces over LONG bytes are numbered after all others; only the others are asked for."""
    def stored(chunks: list[str]) -> bytes:
        pieces, counts = splitter_of(pattern).pieces(chunks)
        every = Numbers()
        units = np.fromiter(map(every.__getitem__, pieces), np.int64, len(pieces))
        names = [p.encode() for p in every]
        sizes = np.fromiter(map(len, names), np.uint32, len(names))
        order = np.argsort(sizes > LONG, kind="stable")             # long ones last
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order))
        return pack(np.array([(sizes <= LONG).sum()], np.uint32), sizes[order], np.frombuffer(b"".join([names[i] for i in order.tolist()]), np.uint8),
                    counts.astype(np.uint32), place[units], dense=True)
    return stored


def stored_pieces(blob: bytes) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """(pieces that are asked for, very long ones, pieces a chunk, their numbers)."""
    n, sizes, data, counts, units = unpack(blob)
    names, n = cut(sizes, data), int(n[0])
    return names[:n], names[n:], counts.astype(np.int64), units.astype(np.int64)


def _ask(n: int):
    def run(arrow):
        for b in arrow:
            for batch, words in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                asked = [(k, batch, blob) for k, blob in requests(stored_pieces(words)[0], n, dense=True)]
                if asked:
                    yield from rows(REQUEST_SCHEMA, asked).to_batches()
    return run


def one_list(values: pa.Array, times: int) -> pa.Array:
    """The list of all values, the given times."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).take(pa.array([0] * times, pa.int32()))


def _distinct(vocabulary, row_words: int):
    """vocabulary: the broadcast (slots, moves, text) of ``tables``, which stand in each row."""
    def run(key: tuple, t: pa.Table) -> pa.Table:
        found = set()
        for blob in t.column("data").to_pylist():
            found.update(cut(*unpack(blob)))
        words = sorted(found)
        edges = [*range(0, len(words), row_words), len(words)]
        n = len(edges) - 1
        slots, moves, text = vocabulary.value
        return pa.table({"bucket": pa.array([key[0].as_py()] * n, pa.int32()),
                         "words": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words, pa.binary())),
                         "slots": one_list(pa.array(slots), n), "moves": one_list(pa.array(moves), n), "texts": one_list(pa.array(text, pa.binary()), n)})
    return run


def flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a binary column; NULL is empty."""
    values, sizes = [np.zeros(0, np.uint8)], [np.zeros(0, np.int64)]
    for c in column.chunks:
        ends = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
        values.append(np.frombuffer(c.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]])
        sizes.append(np.diff(ends).astype(np.int64))
    return np.concatenate(values), np.concatenate(sizes)


def _answer(key: tuple, coded: pa.Table, asked: pa.Table) -> pa.Table:
    """Per request: the ids as decimal text; which pieces decode to other bytes, and to which."""
    def all_of(name: str) -> pa.ChunkedArray:
        return pa.chunked_array([c.flatten() for c in coded.column(name).chunks], coded.schema.field(name).type.value_type)

    place = {w: i for i, w in enumerate(all_of("words").to_pylist())}
    text, others = all_of("coded").flatten()
    ids, id_sizes = flat(text)
    other, other_sizes = flat(others)
    differs = others.is_valid().to_numpy()
    out = []
    for batch, blob in zip(asked.column("batch").to_pylist(), asked.column("data").to_pylist()):
        words = cut(*unpack(blob))
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        odd = at[differs[at]]
        out.append((batch, key[0].as_py(), pack(id_sizes[at].astype(np.uint16), gather(ids, id_sizes, at), np.flatnonzero(differs[at]).astype(np.uint32),
                                                other_sizes[odd].astype(np.uint32), gather(other, other_sizes, odd), dense=True)))
    return rows(ANSWER_SCHEMA, out)


def encode(docs: DataFrame, ranks_file: str, pattern: str, carry: list[str] | None = None, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    With ``ids``, ``token_ids``; ``carry`` names columns of docs that come back in
    the struct ``carried``.
    """
    spark = docs.sparkSession
    carry = carry or []
    path = scratch_path(spark, "bpe")
    ranks = load_ranks(ranks_file)
    known = spark.sparkContext.broadcast(ranks)             # a vocabulary: its size does not depend on the data
    total = input_bytes(docs)
    n, files = max(1, -(-total // BUCKET)), max(1, -(-total // BUCKET))
    t = batches(docs, lambda text: splitter_of(pattern).chunks(text), f"{path}/texts", files, carry, stored=cut_chunks(pattern), dense=True)
    asked = t.select("batch", "words").mapInArrow(_ask(n), REQUEST_DDL).repartition(n, "bucket")
    t_ranks = tables(ranks)
    vocabulary = spark.sparkContext.broadcast((t_ranks["slots"], t_ranks["moves"], t_ranks["text"]))
    words = asked.groupBy("bucket").applyInArrow(_distinct(vocabulary, ROW_WORDS),
                                                 "bucket int, words array<binary>, slots array<bigint>, moves array<int>, texts array<binary>")
    lit = expressions(t_ranks, F.col("slots"), F.col("moves"), F.col("texts"))

    def answer(word: Column) -> Column:
        return let(encode_word(word, lit), lambda ids: let(decode_ids(ids, lit), lambda decoded: F.struct(
            F.array_join(ids.cast("array<string>"), ",").cast("binary").alias("text"), F.when(decoded != word, decoded).alias("other"))))

    coded = words.select("bucket", "words", F.transform("words", answer).alias("coded"))
    del ranks, t_ranks, lit
    give_back()
    answers = coded.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInArrow(_answer, ANSWER_DDL)
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, token_ids array<int>"
    if carry:
        ddl += f", carried {docs.select(*carry).schema.simpleString()}"

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = finished(left, right)
        give_back()
        return out

    def finished(left: pa.Table, right: pa.Table) -> pa.Table:
        r = {c: left.column(c)[0].as_py() for c in left.column_names}
        asked_for, long, counts, units = stored_pieces(r["words"])
        parts = [unpack(blob) for _, blob in sorted(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist()))]
        order, _ = by_bucket(asked_for, n)
        order = order.tolist()                                # the answers come in this order
        text: list = [b""] * len(order)
        decoded = list(asked_for)
        at = 0
        for sizes, data, odd, odd_sizes, odd_data in parts:
            for k, w in zip(order[at:at + len(sizes)], cut(sizes.astype(np.uint32), data)):
                text[k] = w
            for k, w in zip(odd.tolist(), cut(odd_sizes, odd_data)):
                decoded[order[at + k]] = w
            at += len(sizes)
        if long:
            by_id = {v: k for k, v in known.value.items()}
            for p in long:
                own = heap_merge(p, known.value)
                text.append(b",".join([b"%d" % x for x in own]))
                decoded.append(b"".join(map(by_id.__getitem__, own)))
        piece_n = np.fromiter((w.count(b",") + 1 for w in text), np.int64, len(text))
        first = np.cumsum(counts) - counts
        sizes = np.add.reduceat(piece_n[units], first) if len(first) else first
        listed_units, chunk_text, chunk_bytes = units.tolist(), [], []
        for a, k in zip(first.tolist(), counts.tolist()):
            if k == 1:
                chunk_text.append(text[listed_units[a]])
                chunk_bytes.append(decoded[listed_units[a]])
            else:
                own = listed_units[a:a + k]
                chunk_text.append(b",".join([text[x] for x in own]))
                chunk_bytes.append(b"".join([decoded[x] for x in own]))
        tokens = unpack(r["tokens"])[0]
        end = np.cumsum(unpack(r["counts"])[0].astype(np.int64))
        before = np.r_[0, np.cumsum(sizes[tokens])] if len(tokens) else np.zeros(1, np.int64)
        begin = np.r_[0, end[:-1]] if len(end) else end
        n_tokens, ids_sha, text_sha = before[end] - before[begin], [], []
        for a, e in zip(begin.tolist(), end.tolist()):
            own = tokens[a:e].tolist()
            ids_sha.append(hashlib.sha256(b",".join([chunk_text[x] for x in own])).hexdigest())
            text_sha.append(hashlib.sha256(b"".join([chunk_bytes[x] for x in own])).hexdigest())
        listed = pa.nulls(len(end), pa.list_(pa.int32()))
        if ids:
            numbers = np.array(b",".join(text).split(b","), dtype="S").astype(np.int64) if text else np.zeros(0, np.int64)
            all_units = gather(units, counts, tokens.astype(np.int64))
            listed = pa.ListArray.from_arrays(pa.array(np.r_[0, before[end]], pa.int32()), pa.array(gather(numbers, piece_n, all_units), pa.int32()))
        nulls = np.frombuffer(r["nulls"], bool)
        out = {"doc_id": pa.array(unpack(r["ids"])[0], pa.int64(), mask=nulls), "n_tokens": pa.array(n_tokens, pa.int64()),
               "ids_sha256": pa.array(ids_sha, pa.string()), "decoded_sha256": pa.array(text_sha, pa.string()),
               "token_ids": listed}
        if carry:
            out["carried"] = from_ipc(r["rest"]).to_struct_array()
        return pa.table(out)

    out = t.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, ddl)
    return out if ids else out.drop("token_ids")


_splitters: dict[str, Splitter] = {}


def splitter_of(pattern: str) -> Splitter:
    """The Python worker's one Splitter of a pattern."""
    if pattern not in _splitters:
        _splitters[pattern] = Splitter(pattern)
    return _splitters[pattern]


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
