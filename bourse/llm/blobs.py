"""Packed rows: many documents in one row, arrays as compressed binary columns.

``batches`` packs texts into rows of a bounded size, each with a batch number of
its own, and writes them bucketed by that number, so that later steps can bring
answers to the texts without shuffling the texts again.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_ZSTD = pa.Codec("zstd", compression_level=1)
_DENSE = pa.Codec("zstd", compression_level=3)


def squeeze(raw: bytes, dense: bool = False) -> bytes:
    return len(raw).to_bytes(8, "little") + (_DENSE if dense else _ZSTD).compress(raw, asbytes=True)


def unsqueeze(blob: bytes) -> bytes:
    return _ZSTD.decompress(blob[8:], decompressed_size=int.from_bytes(blob[:8], "little"), asbytes=True)


def pack(*arrays: np.ndarray, dense: bool = False) -> bytes:
    """Arrays as one compressed blob.  Each is stored byte plane by byte plane, which suits small numbers."""
    out = io.BytesIO()
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.write(len(a).to_bytes(8, "little") + a.dtype.str.encode().ljust(4))
        out.write(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes())
    return squeeze(out.getvalue(), dense)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = unsqueeze(blob), 0, []
    while at < len(raw):
        n, kind = int.from_bytes(raw[at:at + 8], "little"), np.dtype(raw[at + 8:at + 12].decode().strip())
        at += 12
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, n).T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += n * kind.itemsize
    return out


def gather(flat: np.ndarray, size: np.ndarray, seq: np.ndarray) -> np.ndarray:
    """The stretches of flat that seq names, one after another; size: length of each stretch."""
    begin, n = np.cumsum(size) - size, size[seq]
    return flat[np.repeat(begin[seq] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def to_ipc(table: pa.Table) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return squeeze(sink.getvalue())


def from_ipc(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(unsqueeze(blob)).read_all()


def numbered(run: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: pa.Schema):
    """For mapInArrow: gives the rows that ``run`` yields (lists of values) a batch number unique to the job."""
    def f(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId() << 32
        for i, values in enumerate(run(batches)):
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip([part + i, *values], schema.types)], schema.names)
    return f


def bucketed(df: DataFrame, key: str, n: int, path: str) -> DataFrame:
    """df written to ``path`` in ``n`` buckets of ``key`` and read back: grouping by ``key`` then needs no shuffle."""
    spark = df.sparkSession
    name = f"blobs_{uuid.uuid4().hex}"
    df.write.bucketBy(n, key).option("path", path).saveAsTable(name)
    back = spark.table(name)
    back.schema  # resolved; the files stay when the name goes
    out = back.select("*")
    spark.sql(f"DROP TABLE {name}")
    return out
