"""A total order over a table, held in files, without a window over all rows.

Rows are dealt to partitions by ranges of the order and numbered inside each, so
later steps work inside partitions and carry one row a partition across their
edges.  Rows that are equal in the order may fall into neighbouring partitions,
so no value, however frequent, fills a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(df: DataFrame, order: list[Column], path: str) -> DataFrame:
    """df with ``part`` (number of the range) and ``nr`` (place in it), written to ``path`` and read back."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    df.withColumn("_salt", F.rand(11)).repartitionByRange(n, *order, F.col("_salt")).sortWithinPartitions(*order).drop("_salt") \
        .select("*", F.spark_partition_id().alias("part"), place.alias("nr")).write.parquet(path)
    return spark.read.parquet(path)
