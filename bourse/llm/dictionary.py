"""Texts as numbers into a dictionary of their own batch, and an exchange of answers per distinct word.

A batch row holds its texts' words as indices into the batch's distinct words.
What must be known of a word over all texts (a count, an encoding) is asked once
per batch and word: requests go to buckets by a hash of the word, each bucket
answers every request in the order asked, and the answers come back to the batch.
A word in very many texts costs one request a batch, so no word makes a task hot.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.blobs import bucketed, numbered, pack, to_ipc, unpack
from bourse.llm.common import NULL_ID, small_arrow_batches

BATCH = 8 << 20      # text bytes of a batch, about

SCHEMA = pa.schema([("batch", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("counts", pa.binary()),
                    ("tokens", pa.binary()), ("words", pa.binary()), ("rest", pa.binary())])
DDL = "batch long, ids binary, nulls binary, counts binary, tokens binary, words binary, rest binary"


def pack_strings(words: list[bytes]) -> bytes:
    return pack(np.fromiter(map(len, words), np.uint32, len(words)), np.frombuffer(b"".join(words), np.uint8))


def cut(sizes: np.ndarray, data: np.ndarray) -> list[bytes]:
    raw, end = data.tobytes(), np.cumsum(sizes.astype(np.int64))
    return [raw[a:e] for a, e in zip((end - sizes).tolist(), end.tolist())]


def unpack_strings(blob: bytes) -> list[bytes]:
    return cut(*unpack(blob))


class Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def batches(docs: DataFrame, split: Callable[[bytes], list], path: str, files: int, carry: list[str] | None = None,
            batch_bytes: int = BATCH, stored: Callable[[list], bytes] = pack_strings,
            dense: bool = False) -> DataFrame:
    """One row per batch of texts (``SCHEMA``), written to ``path`` in buckets of the batch number.

    stored: how the batch's distinct words, as split gives them, are kept; dense: compress the texts' numbers harder."""
    small_arrow_batches(docs.sparkSession)
    carry = carry or []

    def run(arrow):
        ids, counts, tokens, rest, size, number = [], [], [], [], 0, Numbers()

        def row():
            return [pack(np.array([NULL_ID if i is None else i for i in ids], np.int64)), np.array([i is None for i in ids], bool).tobytes(),
                    pack(np.array(counts, np.uint32)), pack(np.concatenate(tokens), dense=dense), stored(list(number)),
                    to_ipc(pa.Table.from_batches(rest)) if carry else None]

        for b in arrow:
            others = b.select(list(range(2, b.num_columns))) if carry else None
            begin = 0
            for i, (doc_id, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                if ids and size + len(text) > batch_bytes:
                    if carry and i > begin:
                        rest.append(others.slice(begin, i - begin))
                    begin = i
                    yield row()
                    ids, counts, tokens, rest, size, number = [], [], [], [], 0, Numbers()
                words = split(text)
                ids.append(doc_id)
                counts.append(len(words))
                tokens.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                size += len(text)
            if carry and begin < b.num_rows:
                rest.append(others.slice(begin))
        if ids:
            yield row()

    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("_text"),
                        *(F.col(c) for c in carry))
    return bucketed(plain.mapInArrow(numbered(run, SCHEMA), DDL), "batch", files, path)


def by_bucket(words: list[bytes], n: int):
    """(order of the words by bucket, bucket of each): requests are made, and answers read, in this order."""
    bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % n
    order = np.argsort(bucket, kind="stable")
    return order, bucket[order]


def requests(words: list[bytes], n: int, extra: Callable[[np.ndarray], list[np.ndarray]] = lambda at: [], dense: bool = False):
    """Yields (bucket, blob of its words and extra arrays)."""
    order, bucket = by_bucket(words, n)
    edges = np.searchsorted(bucket, np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edges)):
        at = order[edges[k]:edges[k + 1]]
        own = [words[i] for i in at]
        yield int(k), pack(np.fromiter(map(len, own), np.uint32, len(own)), np.frombuffer(b"".join(own), np.uint8), *extra(at), dense=dense)


REQUEST_SCHEMA = pa.schema([("bucket", pa.int32()), ("batch", pa.int64()), ("data", pa.binary())])
REQUEST_DDL = "bucket int, batch long, data binary"
ANSWER_SCHEMA = pa.schema([("batch", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
ANSWER_DDL = "batch long, bucket int, data binary"


def rows(schema: pa.Schema, values: list[tuple]) -> pa.Table:
    return pa.table([pa.array([v[i] for v in values], t) for i, t in enumerate(schema.types)], schema=schema)
