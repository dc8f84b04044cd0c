"""Connected components of an edge list by alternating large-star and small-star steps.

Each step joins edges with the least neighbour of each node; no node's
neighbours are ever gathered, so a node with very many neighbours is only a
skewed join key.  Every iteration is written to the shared checkpoint folder.
Up to ``FEW`` edges are joined by broadcast, which spares an iteration most of
its shuffles; the number does not depend on the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.session import scratch_path

MAX_ITERATIONS = 100
FEW = 50_000          # rows of two numbers that are broadcast at most


def broadcast_few(df: DataFrame, rows: int) -> DataFrame:
    """df, to be joined by broadcast if it holds ``rows`` rows and they are few."""
    return F.broadcast(df) if rows <= FEW else df


def connected(edges: DataFrame) -> DataFrame:
    """edges (u, v) of longs -> (node, component): component is the least node reachable; only nodes with an edge."""
    spark = edges.sparkSession
    path = scratch_path(spark, "components")

    def kept(df: DataFrame, i: int) -> DataFrame:
        df.write.parquet(f"{path}/{i}")
        return spark.read.parquet(f"{path}/{i}")

    def unsettled(rows: int) -> int:
        """Nodes that have several edges upward, or one from a node that stands above others: none in a forest of stars."""
        up, tops = e.groupBy("u").agg(F.count("*").alias("n")), e.select(F.col("v").alias("top")).distinct()
        return up.join(broadcast_few(tops, rows), F.col("u") == F.col("top"), "left").where("n > 1 or top is not null").count()

    e = kept(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), 0)
    for i in range(1, MAX_ITERATIONS):
        rows = e.count()
        if not unsettled(rows):
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
        both = e.union(e.select("v", "u")).toDF("n", "m")
        least = both.groupBy("n").agg(F.min("m").alias("low")).select(F.col("n").alias("k"), F.least("n", "low").alias("low"))
        large = both.where("m > n").join(broadcast_few(least, 2 * rows), F.col("n") == F.col("k")).select(F.col("m").alias("u"), F.col("low").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        hung = large.join(broadcast_few(low.withColumnRenamed("u", "k"), 2 * rows), F.col("u") == F.col("k")).where("v <> low") \
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
        e = kept(hung.union(low.select("u", F.col("low").alias("v"))).distinct(), i)
    raise RuntimeError("components did not settle")
