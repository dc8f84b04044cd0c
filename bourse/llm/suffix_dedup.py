r"""Operator 3: repeated-substring removal by column-wise multi-string sorting.

A byte goes when a 50-byte string covering it also starts in a document with a
smaller id.  Sorting all suffixes of all texts would move every text many times,
so the collection is first cut, without loss, into short aligned strings:

* every 50-byte window chooses an anchor, the 24-byte string in it with the least
  hash (leftmost on ties); equal windows choose equal anchors at equal offsets;
* anchors whose hash occurs in one document only are dropped: none of their
  windows can repeat;
* what is left are strings of at most 76 bytes around an anchor, aligned at it,
  identical ones of a batch sent once with their least document id, dealt out by
  anchor hash into buckets of bounded size.

Each bucket is then built column by column from the right, one symbol per string
and round: the strings are stably re-ordered by the new symbol (the round's
column of the collection's Burrows-Wheeler transform) and the common prefixes of
neighbours are updated as one more than the least common prefix between them in
the round before.  Neighbours with a common prefix of 50 hold the same window;
windows whose least document id is smaller than a string's own are sent back as
a bit mask, and each batch unites them over its texts.

Aligned at equal anchors, equal windows always lie in the same column, so a round
sorts the strings of its own column only, in time linear in the bucket.  The
sequential external files are the compressed, bucketed tables between the steps.

Defined cases: NULL and empty texts have no bytes; texts under 50 bytes keep
everything; rows that repeat an id do not shadow one another; rows without an id
count as after all others; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.blobs import bucketed, from_ipc, numbered, pack, squeeze, to_ipc, unpack, unsqueeze
from bourse.llm.common import NULL_ID, input_bytes, small_arrow_batches, table
from bourse.session import scratch_path

LENGTH = 50                  # bytes of a string that counts as repeated
KMER = 24                    # bytes of an anchor
SPAN = LENGTH - KMER + 1     # anchors a window chooses from
WIDTH = SPAN - 1 + LENGTH    # bytes of an aligned string, at most
BATCH = 8 << 20              # text bytes of a batch, about
BUCKET = 16 << 20            # text bytes per bucket of anchors, about
STEP = 1 << 18               # windows hashed at once

_BYTE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype=np.uint64)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _windows(b: np.ndarray) -> np.ndarray:
    """For each 50-byte window of b: its least anchor hash, the anchor's offset in the low 5 bits."""
    x1 = _BYTE[b]
    x2 = x1[:-1] * _ODD[0] + x1[1:]
    x4 = x2[:-2] * _ODD[1] + x2[2:]
    x8 = x4[:-4] * _ODD[2] + x4[4:]
    x16 = x8[:-8] * _ODD[3] + x8[8:]
    v = _scramble(x16[:-8] * _ODD[4] + x8[16:]) & ~np.uint64(31)      # 24-byte strings
    done = 1
    while done < SPAN:                                               # least of 1, 2, 4, 8, 16, 27
        step = min(done, SPAN - done)
        v = np.minimum(v[:-step], v[step:] + np.uint64(step))
        done += step
    return v


def anchors(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """(hash, anchor position, first window, last window, document index) of each run of windows with one anchor."""
    found = []
    for at in range(0, max(0, len(buf) - LENGTH + 1), STEP):
        part = buf[at:at + STEP + LENGTH - 1]
        v = _windows(part)
        n = len(v)
        change = np.zeros(n + 1, np.int64)                           # windows that cross a document's end
        lo, hi = np.maximum(starts, ends - LENGTH + 1) - at, ends - at
        near = (hi > 0) & (lo < n) & (hi > lo)
        np.add.at(change, np.clip(lo[near], 0, n), 1)
        np.add.at(change, np.clip(hi[near], 0, n), -1)
        j = np.flatnonzero(np.cumsum(change[:n]) == 0)
        if not len(j):
            continue
        p = j + (v[j] & np.uint64(31)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (j[1:] != j[:-1] + 1)])
        last = np.r_[first[1:], len(j)] - 1
        # least hashes are small numbers: scrambled once more, ranges of them are even buckets
        found.append((_scramble(v[j[first]] & ~np.uint64(31)) >> np.uint64(16), p[first] + at, j[first] + at, j[last] + at))
    if not found:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, z, z
    h, p, lo, hi = (np.concatenate(x) for x in zip(*found))
    return h, p, lo, hi, np.searchsorted(starts, lo, side="right") - 1


class Batch:
    """A row of packed texts."""

    def __init__(self, blob: bytes, info: bytes):
        self.raw = unsqueeze(blob)
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.ids, sizes = unpack(info)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def anchors(self):
        return anchors(self.buf, self.starts, self.ends)


def _pack_texts(carry: list[str]):
    def run(batches):
        ids, texts, size, rest = [], [], 0, []

        def row():
            info = pack(np.array([NULL_ID if i is None else i for i in ids], np.int64), np.array([len(t) for t in texts], np.int64))
            nulls = np.array([i is None for i in ids], bool).tobytes()
            return [squeeze(b"".join(texts)), info, nulls, to_ipc(pa.Table.from_batches(rest)) if carry else None]

        for b in batches:
            b_ids, b_texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            others = b.select(list(range(2, b.num_columns))) if carry else None
            begin = 0
            for i, t in enumerate(b_texts):
                if ids and size + len(t) > BATCH:
                    if carry and i > begin:
                        rest.append(others.slice(begin, i - begin))
                    begin = i
                    yield row()
                    ids, texts, size, rest = [], [], 0, []
                ids.append(b_ids[i])
                texts.append(t)
                size += len(t)
            if carry and begin < len(b_ids):
                rest.append(others.slice(begin))
        if ids:
            yield row()
    return run


def _split(values: np.ndarray, bucket: np.ndarray, n: int):
    """Yields (bucket, slice of positions) of values sorted by bucket."""
    edges = np.searchsorted(bucket, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), slice(edges[k], edges[k + 1])


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Buckets are ranges of the 48-bit hash, so values sorted by hash are sorted by bucket."""
    return (h.astype(np.float64) * (n / float(1 << 48))).astype(np.int64).clip(0, n - 1)


def _anchor_hashes(n: int):
    """Per batch and bucket: its distinct anchor hashes, in order, and whether two documents of the batch have it."""
    def run(batches):
        for b in batches:
            for batch, blob, info in zip(*(b.column(i).to_pylist() for i in range(3))):
                x = Batch(blob, info)
                h, _, _, _, doc = x.anchors()
                if not len(h):
                    continue
                order = np.argsort(h)
                h, ids = h[order], x.ids[doc[order]]
                first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                several = np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)
                h = h[first]
                rows = [(k, batch, pack(np.diff(h[s], prepend=np.uint64(0)), several[s])) for k, s in _split(h, bucket_of(h, n), n)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary()))],
                                                 ["bucket", "batch", "hashes"])
    return run


def _repeated(key: tuple, t: pa.Table) -> pa.Table:
    """Of one bucket: each batch's hashes that occur in another batch or in several of its documents."""
    batch = t.column("batch").to_pylist()
    parts = [unpack(x) for x in t.column("hashes").to_pylist()]
    hashes = [np.cumsum(p[0]) for p in parts]
    every = np.concatenate(hashes)
    order = np.argsort(every, kind="stable")
    s = every[order]
    same = s[1:] == s[:-1]
    hit = np.zeros(len(every), bool)
    hit[order] = np.r_[same, False] | np.r_[False, same]
    hit |= np.concatenate([p[1] for p in parts]).astype(bool)
    out, at = [], 0
    for k, h in zip(batch, hashes):
        good = h[hit[at:at + len(h)]]
        at += len(h)
        if len(good):
            out.append((k, pack(np.diff(good, prepend=np.uint64(0)))))
    ks, blobs = zip(*out) if out else ((), ())
    return pa.table({"batch": pa.array(ks, pa.int64()), "hashes": pa.array(blobs, pa.binary())})


def _row_ids(rows: np.ndarray, head: np.ndarray) -> np.ndarray:
    """A 64-bit number of each byte row (WIDTH padded to words) and its head."""
    words = rows.view(np.uint64)
    h = _scramble(head.astype(np.uint64) + _ODD[0])
    for k in range(words.shape[1]):
        h = _scramble(h * _ODD[1] + words[:, k])
    return h


_PAD = -(-WIDTH // 8) * 8


def _strings(n: int):
    """Per batch: the distinct strings around repeated anchors by bucket, and (bucket -1) where they occur."""
    schema = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        x = Batch(left.column("texts")[0].as_py(), left.column("info")[0].as_py())
        wanted = np.sort(np.concatenate([np.cumsum(unpack(b)[0]) for b in right.column("hashes").to_pylist()]))
        h, p, lo, hi, doc = x.anchors()
        at = np.minimum(np.searchsorted(wanted, h), len(wanted) - 1)
        got = np.flatnonzero(wanted[at] == h)
        got = got[np.argsort(h[got], kind="stable")]
        h, p, lo, hi, ids = h[got], p[got], lo[got], hi[got], x.ids[doc[got]]
        size, before = hi - lo + LENGTH, p - lo
        raw = np.r_[x.buf, np.zeros(_PAD, np.uint8)]
        number = np.empty(len(h), np.uint64)
        span = np.arange(_PAD)
        for a in range(0, len(h), 1 << 13):
            s = slice(a, a + (1 << 13))
            rows = raw[lo[s, None] + span]
            rows[span >= size[s, None]] = 0
            number[s] = _row_ids(rows, before[s] * 128 + size[s])
        # equal strings are neighbours after sorting by (hash, number); h is sorted already
        order = np.lexsort((number, h))
        h, p, lo, size, before, ids, number = (a[order] for a in (h, p, lo, size, before, ids, number))
        new = np.r_[True, (h[1:] != h[:-1]) | (number[1:] != number[:-1])]
        # the 64-bit numbers only propose: a string that differs from its neighbour starts a group of its own
        for a in range(1, len(h), 1 << 13):
            s, t = slice(a, min(len(h), a + (1 << 13))), slice(a - 1, min(len(h), a + (1 << 13)) - 1)
            inside = span < size[s, None]
            differ = ((raw[lo[s, None] + span] != raw[lo[t, None] + span]) & inside).any(axis=1)
            new[s] |= differ | (size[s] != size[t]) | (before[s] != before[t])
        first = np.flatnonzero(new)
        string = np.cumsum(new) - 1
        least = np.minimum.reduceat(ids, first)
        later = ids > least[string]
        by_place = np.argsort(p, kind="stable")
        buckets = bucket_of(h[first], n)
        out = []
        for k, s in _split(first, buckets, n):
            f = first[s]
            inside = span < size[f, None]
            data = raw[lo[f, None] + span][inside]
            out.append((k, pack(before[f].astype(np.uint8), size[f].astype(np.uint8), least[s], data)))
        windows = ((np.uint64(1) << (size[first] - LENGTH + 1).astype(np.uint64)) - np.uint64(1)) << (SPAN - 1 - before[first]).astype(np.uint64)
        out.append((-1, pack(np.diff(p[by_place], prepend=0).astype(np.int64), string[by_place].astype(np.uint32), later[by_place],
                             windows.astype(np.uint32))))
        batch = left.column("batch")[0].as_py()
        return pa.table([pa.array([batch] * len(out), pa.int64()), pa.array([k for k, _ in out], pa.int32()),
                         pa.array([d for _, d in out], pa.binary())], schema=schema)
    return run


def column_wise(data: np.ndarray, offset: np.ndarray, before: np.ndarray, size: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Masks of the windows (bit: column) of each aligned string that occur in a string with a smaller id.

    One round per column from the right: ``order`` is the order of the strings'
    suffixes from that column on, ``common`` the capped common prefix of each
    with its predecessor.
    """
    m = len(offset)
    offset, size = offset.astype(np.int64), size.astype(np.int32)
    begin = (SPAN - 1 - before).astype(np.int32)    # column of a string's first byte
    order = np.arange(m, dtype=np.int32)
    common = np.zeros(m, np.uint8)
    masks = np.zeros(m, np.uint32)
    far = np.int64(NULL_ID)
    for column in range(WIDTH - 1, -1, -1):
        at = column - begin
        real = (at >= 0) & (at < size)
        symbol = np.zeros(m, np.uint8)
        symbol[real] = data[offset[real] + at[real]]
        symbol = symbol[order]
        move = np.argsort(symbol, kind="stable")
        symbol = symbol[move]
        fresh = np.zeros(m, np.uint8)
        edges = np.flatnonzero(np.r_[True, symbol[1:] != symbol[:-1], True])
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                old = move[a:b]
                fresh[a + 1:b] = np.minimum.reduceat(common[:old[-1] + 1], old[:-1] + 1) + 1
        common = np.minimum(fresh, LENGTH)
        order = order[move]
        if column < SPAN:
            own = (at[order] >= 0) & (at[order] + LENGTH <= size[order])
            doc = np.where(own, ids[order], far)
            group = np.flatnonzero(np.r_[True, common[1:] < LENGTH])
            least = np.repeat(np.minimum.reduceat(doc, group), np.diff(np.r_[group, m]))
            masks[order[own & (least < doc)]] |= np.uint32(1 << column)
    return masks


def _sorted_bucket(key: tuple, t: pa.Table) -> pa.Table:
    batch = t.column("batch").to_pylist()
    parts = [unpack(x) for x in t.column("data").to_pylist()]
    cut = np.cumsum([len(p[0]) for p in parts])[:-1]
    before, size, ids, data = (np.concatenate([p[i] for p in parts]) for i in range(4))
    del parts
    before, size = before.astype(np.int32), size.astype(np.int32)
    masks = column_wise(data, np.cumsum(size, dtype=np.int64) - size, before, size, ids)
    return pa.table({"batch": pa.array(batch, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(batch), pa.int32()),
                     "data": pa.array([pack(x) for x in np.split(masks, cut)], pa.binary())})


def _removed(x: Batch, rows: list[tuple[int, bytes]]) -> np.ndarray:
    """Which bytes of a batch go."""
    gone = np.zeros(len(x.buf) + 1, np.int32)
    rows = sorted(rows)
    if rows:
        place, string, later, windows = unpack(rows[0][1])   # bucket -1: the occurrences
        place = np.cumsum(place)
        found = np.concatenate([unpack(b)[0] for _, b in rows[1:]])
        # a document after the least one that has the string loses all its windows, that one what others have
        masks = np.where(later.astype(bool), windows[string], found[string])
        for column in range(SPAN):
            first = place[(masks >> np.uint32(column)) & np.uint32(1) == 1] - (SPAN - 1) + column
            np.add.at(gone, first, 1)
            np.add.at(gone, first + LENGTH, -1)
    return np.cumsum(gone)[:-1] > 0


def remove(docs: DataFrame, carry: list[str] | None = None, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row.

    With ``texts``, ``kept_text``: the remaining bytes as text, where a character
    that lost some of its bytes goes whole.  ``carry`` names columns of docs that
    come back in the struct ``carried``.
    """
    spark = docs.sparkSession
    small_arrow_batches(spark)
    carry = carry or []
    path = scratch_path(spark, "suffix")
    total = input_bytes(docs)
    n_buckets, n_files = max(1, -(-total // BUCKET)), max(1, -(-total // (4 * BATCH)))
    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text"),
                        *(F.col(c) for c in carry))
    schema = pa.schema([("batch", pa.int64()), ("texts", pa.binary()), ("info", pa.binary()), ("nulls", pa.binary()), ("rest", pa.binary())])
    t = bucketed(plain.mapInArrow(numbered(_pack_texts(carry), schema), "batch long, texts binary, info binary, nulls binary, rest binary"),
                 "batch", n_files, f"{path}/texts")
    hashes = t.select("batch", "texts", "info").mapInArrow(_anchor_hashes(n_buckets), "bucket int, batch long, hashes binary")
    repeated = hashes.groupBy("bucket").applyInArrow(_repeated, "batch long, hashes binary")
    strings = t.select("batch", "texts", "info").groupBy("batch").cogroup(repeated.groupBy("batch")) \
        .applyInArrow(_strings(n_buckets), "batch long, bucket int, data binary")
    strings.write.parquet(f"{path}/strings")
    strings = spark.read.parquet(f"{path}/strings")
    masks = strings.where("bucket >= 0").groupBy("bucket").applyInArrow(_sorted_bucket, "batch long, bucket int, data binary")
    answers = masks.unionByName(strings.where("bucket < 0"))
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    if carry:
        ddl += f", carried {docs.select(*carry).schema.simpleString()}"

    def finish(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        x = Batch(left.column("texts")[0].as_py(), left.column("info")[0].as_py())
        nulls = np.frombuffer(left.column("nulls")[0].as_py(), bool)
        gone = _removed(x, list(zip(right.column("bucket").to_pylist(), right.column("data").to_pylist())))
        removed, spans, digest, kept = [], [], [], []
        for s, e in zip(x.starts.tolist(), x.ends.tolist()):
            g = gone[s:e]
            k = int(np.count_nonzero(g))
            rest = x.raw[s:e] if not k else x.buf[s:e][~g].tobytes()
            removed.append(k)
            spans.append(int(g[:1].sum()) + int(np.count_nonzero(g[1:] & ~g[:-1])) if k else 0)
            digest.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest.decode(errors="ignore") if texts else None)
        out = {"doc_id": pa.array(x.ids, pa.int64(), mask=nulls), "n_bytes": pa.array(x.ends - x.starts, pa.int64()),
               "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(spans, pa.int64()),
               "kept_sha256": pa.array(digest, pa.string()), "kept_text": pa.array(kept, pa.string())}
        if carry:
            out["carried"] = from_ipc(left.column("rest")[0].as_py()).to_struct_array()
        return pa.table(out)

    out = t.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, ddl)
    return out if texts else out.drop("kept_text")


def query(spark, sf_dir: str) -> DataFrame:
    return remove(table(spark, sf_dir, "documents"))
