r"""Operator 5: exact top-k inner-product search by columnar branch and bound.

Components become integers floor(64 * x).  Candidates are packed into slices and
queries into blocks, both in vertical layout (one row of numbers per dimension).
Each (query block, candidate slice) pair is one unit of work: scores are summed
dimension block by dimension block, and after each block a pair can only stay
alive while its partial score plus the Cauchy-Schwarz product of both remaining
masses reaches the query's k-th best score so far; candidates alive for no query
are compacted away, and few survivors are finished pair by pair.  The k best of
each unit meet in one ranking per query.  No pair is dropped that could enter or
tie the result, so the answer is exact.

Defined cases: vectors that are NULL or hold NULL or non-finite components take
no part, nor do rows without an id; shorter vectors count as padded with zeros; a query's own row, and
any repetition of its id, is not its candidate; other ids that repeat are
separate candidates; ties go to the smaller id; an empty table, or one without
queries, gives an empty result.  Scores must fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import small_arrow_batches, table
from bourse.session import scratch_path

K = 20
QUERY_MOD = 20
SCALE = 64
SLICE_ROWS = 8192     # candidates of a slice, about
QUERY_ROWS = 512      # queries of a block, about
CHUNK = 1024          # candidates looked at together
DIM_BLOCK = 16
SPARSE = 0.1          # share of pairs alive below which pairs are finished one by one


def usable(vectors: DataFrame) -> DataFrame:
    good = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.coalesce(good, F.lit(False)))


def _pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """All rows of one block -> ids and a (dimensions, rows) matrix in the smallest integer type that holds it."""
    pdf = pdf.sort_values("vec_id")
    dims = max((len(e) for e in pdf["embedding"]), default=0)
    m = np.zeros((dims, len(pdf)), np.int64)
    for j, e in enumerate(pdf["embedding"]):
        m[:len(e), j] = np.floor(SCALE * np.asarray(e, np.float64))
    for kind in (np.int8, np.int16, np.int32, np.int64):
        if not m.size or (m.min() >= np.iinfo(kind).min and m.max() <= np.iinfo(kind).max):
            break
    return pd.DataFrame({"block": [key[0]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "kind": [np.dtype(kind).str], "dims": [dims], "data": [m.astype(kind).tobytes()]})


def blocks(rows: DataFrame, n: int, salt: str) -> DataFrame:
    """Rows packed into ``n`` blocks by a hash of the id."""
    key = F.pmod(F.xxhash64(F.lit(salt), "vec_id", "embedding"), F.lit(n)).cast("int")
    return rows.withColumn("block", key).groupBy("block").applyInPandas(
        _pack, "block int, ids binary, kind string, dims int, data binary")


def _matrix(kind, dims, ids, data) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(data, np.dtype(kind)).reshape(dims, len(ids))


def best_of(owner, score, ids, k: int):
    """The k best (score down, id up) of each owner."""
    order = np.lexsort((ids, -score, owner))
    owner, score, ids = owner[order], score[order], ids[order]
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else np.zeros(0, np.int64)
    rank = np.arange(len(owner)) - np.repeat(first, np.diff(np.r_[first, len(owner)]))
    keep = rank < k
    return owner[keep], score[keep], ids[keep]


def search(q_ids, q, c_ids, c, k: int = K, stats: dict | None = None):
    """(query index, score, candidate id) of the k best candidates of each query; q, c: (dimensions, rows) integers."""
    dims = max(len(q), len(c))
    pad = lambda m: np.concatenate([m, np.zeros((dims - len(m), m.shape[1]), m.dtype)])
    q, c = pad(q).astype(np.int64), pad(c).astype(np.int64)
    largest = lambda m: float(np.abs(m).max()) if m.size else 0.0
    kind = np.float64 if largest(q) * largest(c) * max(dims, 1) < 2 ** 52 else np.int64  # exact either way
    order = np.argsort(-(q.astype(np.float64) ** 2).sum(1), kind="stable")  # heavy dimensions first
    q, c = q[order], c[order]
    cuts = list(range(0, dims, DIM_BLOCK)) or [0]
    rest = lambda m: [np.sqrt((m[e:].astype(np.float64) ** 2).sum(0)) for e in [*cuts[1:], dims]]
    q_rest, c_rest = rest(q), rest(c)
    norm = np.argsort(-(c.astype(np.float64) ** 2).sum(0), kind="stable")   # heavy candidates first: thresholds rise early
    qk, ck = q.astype(kind), c.astype(kind)
    nq = q.shape[1]
    thr = np.full(nq, -np.inf)
    top = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, c.shape[1], CHUNK):
        cols = norm[at:at + CHUNK]
        partial = np.zeros((nq, len(cols)), kind)
        pairs = None
        for b, start in enumerate(cuts):
            end = min(start + DIM_BLOCK, dims)
            if stats is not None:
                stats["work"] = stats.get("work", 0) + (end - start) * (partial.size if pairs is None else len(pairs[0]))
            if pairs is None:
                partial += qk[start:end].T @ ck[start:end][:, cols]
                bound = partial + q_rest[b][:, None] * c_rest[b][cols][None, :]
                alive = bound + 1e-6 * (1 + np.abs(bound)) >= thr[:, None]
                some = alive.any(axis=0)
                if not some.all():
                    cols, partial, alive = cols[some], partial[:, some], alive[:, some]
                if alive.sum() < SPARSE * alive.size or end == dims:
                    qi, ci = np.nonzero(alive)
                    pairs = qi, cols[ci], partial[qi, ci]
            else:
                qi, ci, s = pairs
                s = s + (qk[start:end][:, qi] * ck[start:end][:, ci]).sum(0)
                bound = s + q_rest[b][qi] * c_rest[b][ci]
                live = bound + 1e-6 * (1 + np.abs(bound)) >= thr[qi]
                pairs = qi[live], ci[live], s[live]
        qi, ci, s = pairs
        other = q_ids[qi] != c_ids[ci]
        qi, ci, s = qi[other], ci[other], s[other].astype(np.int64)
        top = best_of(np.r_[top[0], qi], np.r_[top[1], s], np.r_[top[2], c_ids[ci]], k)
        last = np.flatnonzero(np.r_[top[0][1:] != top[0][:-1], True]) if len(top[0]) else np.zeros(0, np.int64)
        n = np.bincount(top[0], minlength=nq)
        full = n[top[0][last]] == k
        thr[top[0][last][full]] = top[1][last][full]
    return top


def _units(k: int):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                q_ids, q = _matrix(r.q_kind, r.q_dims, r.q_ids, r.q_data)
                c_ids, c = _matrix(r.c_kind, r.c_dims, r.c_ids, r.c_data)
                qi, s, ids = search(q_ids, q, c_ids, c, k)
                yield pd.DataFrame({"query_id": q_ids[qi], "vec_id": ids, "score": s})
    return run


def top_k(vectors: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    small_arrow_batches(spark)
    rows = usable(vectors)
    is_query = F.pmod("vec_id", F.lit(QUERY_MOD)) == 0
    n = rows.agg(F.count("*").alias("c"), F.count(F.when(is_query, 1)).alias("q")).first()
    slices, groups = max(1, -(-n["c"] // SLICE_ROWS)), max(1, -(-n["q"] // QUERY_ROWS))
    path = scratch_path(spark, "topk")
    blocks(rows, slices, "candidate").write.parquet(f"{path}/candidates")
    blocks(rows.where(is_query), groups, "query").write.parquet(f"{path}/queries")

    def side(name: str, p: str, other: str, count: int) -> DataFrame:
        b = spark.read.parquet(f"{path}/{name}")
        return b.select(F.col("block").alias(p), *(F.col(x).alias(f"{p}_{x}") for x in ("ids", "kind", "dims", "data")),
                        F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(other))

    # each block travels to every block of the other side: units of work, not pairs of rows
    units = side("candidates", "c", "q", groups).join(side("queries", "q", "c", slices), ["c", "q"])
    found = units.select("q_ids", "q_kind", "q_dims", "q_data", "c_ids", "c_kind", "c_dims", "c_data") \
        .mapInPandas(_units(k), "query_id long, vec_id long, score long")
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


SQL = """
with v as (select vec_id, [cast(floor(64 * x::double) as bigint) for x in embedding] as e from embeddings
           where embedding is not null and vec_id is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, cast(list_sum([q.e[i] * c.e[i] for i in range(1, least(len(q.e), len(c.e)) + 1)]) as bigint) as score
      from v q join v c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id)
select query_id, cast(r as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from p) where r <= 20"""
