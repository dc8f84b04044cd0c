r"""Operator 12: vector code compression with per-dimension value dictionaries.

Components become integers floor(1024 * x); a vector is cut into ``PARTS`` equal
consecutive parts, each coded by the nearest of ``ENTRIES`` codebook entries.
Vectors are packed once into blocks in vertical layout: per dimension the sorted
distinct integers of the block and, per vector, the place of its integer among
them.  To assign a block, the squared differences of every distinct integer to
the same component of all entries are tabulated, dimension by dimension; the
distances of all vectors are then gathers from that table, added up.  Each
tabulated difference serves all vectors that hold the integer.

A round sends per task one sum and one count per entry and component, added up by
Spark; the driver holds codebooks only, whose size is fixed by the parameters and
the vectors' length.  Blocks are files, so a lost executor repeats single blocks.

Defined cases: vectors that are NULL or hold NULL or non-finite components are
dropped; rows without an id are kept and come last among the seeds; rows that
repeat an id are separate vectors, ordered as seeds by their components; a vector
shorter than the longest, or a length that ``PARTS`` does not divide, is padded
with zeros; with fewer vectors than ``ENTRIES`` the codebooks have one entry each;
NULL labels count as one label; an empty table gives an empty result; other
columns are ignored.  Integers are held within the bound at which a vector's error
still fits a long (2**27 at 64 dimensions, components of 131,072); larger ones
count as the bound.  An error summed over a label stops at the largest long.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.blobs import pack, unpack
from bourse.llm.common import small_arrow_batches, table
from bourse.session import scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
ROWS = 512            # vectors whose distances are added up together: their table stays in the processor's cache
MAX_LONG = (1 << 63) - 1


def usable(vectors: DataFrame) -> DataFrame:
    good = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                          F.col("label")).where(F.coalesce(good, F.lit(False)))


def bound(dims: int) -> int:
    """Integers within it give errors that fit a long."""
    return math.isqrt((1 << 62) // max(dims, 1)) // 2


def integers(values: np.ndarray, sizes: np.ndarray, dims: int) -> np.ndarray:
    """(dims, vectors) integers of the vectors that ``values`` holds one after another."""
    limit = float(bound(dims))
    out = np.zeros((dims, len(sizes)), np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    with np.errstate(over="ignore"):
        out[place, owner] = np.clip(np.floor(SCALE * np.asarray(values, np.float64)), -limit, limit)
    return out


def blocks(rows: DataFrame, dims: int, path: str) -> DataFrame:
    """One row per block: its ids and labels, distinct integers and codes by dimension."""
    label = rows.schema["label"].dataType.simpleString()

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            column = b.column(1)
            m = integers(column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy()), dims)
            found = [np.unique(r, return_inverse=True) for r in m]
            sizes = np.array([len(u) for u, _ in found], np.int64)
            data = [sizes, *(u for u, _ in found), *(c.astype(np.uint16 if len(u) <= 1 << 16 else np.uint32) for u, c in found)]
            whole = pa.array([0, b.num_rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(whole, b.column(0)), pa.ListArray.from_arrays(whole, b.column(2)),
                 pa.array([pack(*data)], pa.binary())], ["ids", "labels", "data"])

    rows.mapInArrow(run, f"ids array<long>, labels array<{label}>, data binary").write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def nearest(dictionaries: list[np.ndarray], codes: list[np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance) of one part's vectors; ties go to the lower index.

    dictionaries, codes: by dimension of the part; book: (entries, dimensions)."""
    n = len(codes[0]) if codes else 0
    high = max([int(np.abs(u).max(initial=0)) for u in dictionaries] + [int(np.abs(book).max(initial=0))])
    kind = np.int32 if (2 * high) ** 2 * len(codes) < 1 << 31 else np.int64
    tables = [(u[:, None].astype(kind) - book[None, :, j].astype(kind)) ** 2 for j, u in enumerate(dictionaries)]
    index, least = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for a in range(0, n, ROWS):
        total = tables[0][codes[0][a:a + ROWS]]
        for t, c in zip(tables[1:], codes[1:]):
            total += t[c[a:a + ROWS]]
        index[a:a + ROWS] = i = total.argmin(axis=1)
        least[a:a + ROWS] = total[np.arange(len(i)), i]
    return index, least


def by_part(blob: bytes, dims: int):
    """(dictionaries, codes) of each part."""
    data, size = unpack(blob), dims // PARTS
    return [(data[1 + p * size:1 + (p + 1) * size], data[1 + dims + p * size:1 + dims + (p + 1) * size]) for p in range(PARTS)]


def improved(packed: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, entries to the floor of their parts' mean; unused entries stay."""
    spark = packed.sparkSession
    parts, entries, size = books.shape
    shared = spark.sparkContext.broadcast(books)

    def run(batches):
        sums, counts = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for b in batches:
            for blob in b.column(0).to_pylist():
                for p, (dictionaries, codes) in enumerate(by_part(blob, parts * size)):
                    index, _ = nearest(dictionaries, codes, shared.value[p])
                    counts[p] += np.bincount(index, minlength=entries)
                    for j, (u, c) in enumerate(zip(dictionaries, codes)):
                        np.add.at(sums[p, :, j], index, u[c])
        used = np.flatnonzero(counts.reshape(-1))
        cells = np.concatenate([used * (size + 1) + j for j in range(size + 1)]) if len(used) else used
        values = np.concatenate([counts.reshape(-1)[used], *(sums.reshape(-1, size)[used, j] for j in range(size))]) if len(used) else used
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int64()), pa.array(values, pa.int64())], ["cell", "value"])

    added = packed.select("data").mapInArrow(run, "cell long, value long") \
        .groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    cells = {r["cell"]: int(r["value"]) for r in added.collect()}   # parts x entries x (components + 1) numbers at most
    out = books.copy()
    for cell in range(parts * entries):
        n = cells.get(cell * (size + 1))
        if n:
            out[cell // entries, cell % entries] = [cells[cell * (size + 1) + 1 + j] // n for j in range(size)]
    return out


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every usable vector; the (parts, entries, components) codebooks)."""
    spark = vectors.sparkSession
    small_arrow_batches(spark)
    path = scratch_path(spark, "codes")
    rows = usable(vectors)
    longest = rows.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    dims = -(-longest // PARTS) * PARTS
    size = dims // PARTS
    packed = blocks(rows, dims, f"{path}/blocks")
    seeds = [r["embedding"] for r in rows.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()]
    first = integers(np.array([x for s in seeds for x in s], np.float64), np.array([len(s) for s in seeds], np.int64), dims)
    books = np.ascontiguousarray(first.reshape(PARTS, size, len(seeds)).transpose(0, 2, 1))
    if size and len(seeds):
        for _ in range(rounds):
            books = improved(packed, books)
    shared = spark.sparkContext.broadcast(books)
    label = packed.schema["labels"].dataType.elementType.simpleString()

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                ids, labels = b.column(0)[i].values, b.column(1)[i].values
                index, error = np.zeros((len(ids), PARTS), np.uint8), np.zeros(len(ids), np.int64)
                for p, (dictionaries, codes) in enumerate(by_part(b.column(2)[i].as_py(), dims)):
                    if size:
                        index[:, p], least = nearest(dictionaries, codes, shared.value[p])
                        error += least
                hexed = index.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([hexed[a:a + 2 * PARTS] for a in range(0, len(hexed), 2 * PARTS)], pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"])

    packed.mapInArrow(run, f"vec_id long, label {label}, code string, error long").write.parquet(f"{path}/codes")
    return spark.read.parquet(f"{path}/codes"), books


def query(spark, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    # one row a label; the join is left to the optimiser, which splits a hot label
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MAX_LONG).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("_label"))) \
        .select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _sql() -> str:
    """The same in SQL: brute-force distances of every part to every entry, round after round."""
    ctes = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rn, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor({SCALE}::DOUBLE * x::DOUBLE) AS BIGINT)) AS x
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
            f"""p AS (SELECT rn, part, list_slice(x, part * (len(x) // {PARTS}) + 1, (part + 1) * (len(x) // {PARTS})) AS x
        FROM v, range({PARTS}) r(part))""",
            f"b0 AS (SELECT part, rn - 1 AS entry, x FROM p WHERE rn <= {ENTRIES})"]
    for i in range(ROUNDS + 1):
        ctes.append(f"""a{i} AS MATERIALIZED (SELECT rn, part, min(d * {ENTRIES} + entry) AS best FROM (
            SELECT p.rn, p.part, b.entry, CAST(list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
            FROM p JOIN b{i} b ON p.part = b.part) GROUP BY rn, part)""")
        if i < ROUNDS:
            ctes.append(f"""m{i} AS (SELECT part, entry, list(m ORDER BY pos) AS x FROM (
                SELECT a.part, a.best % {ENTRIES} AS entry, pos, CAST((sum(p.x[pos]) - ((sum(p.x[pos]) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
                FROM a{i} a JOIN p ON a.rn = p.rn AND a.part = p.part, range(1, 65) q(pos) WHERE pos <= len(p.x)
                GROUP BY a.part, a.best % {ENTRIES}, pos) GROUP BY part, entry)""")
            ctes.append(f"b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN m{i} m ON b.part = m.part AND b.entry = m.entry)")
    ctes.append(f"""c AS (SELECT rn, string_agg(printf('%02x', CAST(best % {ENTRIES} AS INTEGER)), '' ORDER BY part) AS code,
        CAST(sum(best // {ENTRIES}) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY rn)""")
    ctes.append(f"s AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{ROUNDS})")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN c USING (rn), s"""


SQL = _sql()
