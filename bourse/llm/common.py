"""Small helpers shared by the operators of this package.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``.  All separators are ASCII, so
in UTF-8 they are exactly what ``bytes.split()`` splits on, and ``bytes.lower()``
changes A-Z and nothing else; the Python stages therefore work on bytes.
"""

from __future__ import annotations

import ctypes
import gc
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SQL = r"[^\x20\x09-\x0D]+"
NULL_ID = (1 << 63) - 1  # sorts after every document id; stands for a NULL doc_id inside Python stages

#: Bytes of one Arrow batch handed to Python, about (a batch holds one row at least): bounds a worker's memory.
ARROW_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_arrow_batches(spark: SparkSession, size: int = ARROW_BYTES) -> None:
    """Bound the bytes that one Arrow batch carries to Python in this session (lowers, never raises)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key, str(1 << 30)).rstrip("bB")) > size:
        spark.conf.set(key, str(size))


def give_back() -> None:
    """Returns memory that this Python worker no longer uses: the worker stays for later tasks, and would keep it beside theirs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # another C library
        pass


def id_text(docs: DataFrame) -> DataFrame:
    """doc_id and the whole text as UTF-8 bytes (NULL text: empty), nothing else."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """(doc ids, texts as bytes) per Arrow batch of ``id_text``."""
    for b in batches:
        if b.num_rows:
            yield b.column(0).to_pylist(), b.column(1).to_pylist()


def crc_mod(doc_id: int | None, m: int) -> int | None:
    """crc32 of the id as text, modulo m; None for a NULL id (it is then in no held-out part)."""
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % m


def crc_mod_col(col: str, m: int):
    """The same as a Column; -1 for a NULL id."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % m, F.lit(-1))


def input_bytes(docs: DataFrame, col: str = "text") -> int:
    """Bytes of a text column: one number, for sizing buckets and partitions."""
    return int(docs.agg(F.sum(F.octet_length(col)).alias("n")).first()["n"] or 0)
