r"""Operator 10: mixing sources to target weights by hash-threshold histograms.

Sources in code-point order (NULL last) weigh 5, 2, 1, 5, 2, 1, ...  Together
they get ``share`` of all words; no source gets more than ``cap`` times its own
size, and what a capped source cannot take is shared again by weight.

Which documents fill a target is decided by a hash of each document, without
sorting: words are summed by source and hash bucket (combined map-side), the
bucket where the running sum would cross the budget is found, and only that
bucket is split into finer buckets, level by level, until the hash bits are
used up.  A document is taken when its hash lies below its source's threshold;
budgets are nested, so a larger budget takes a superset.  A target above the
source's size first takes everything once and then fills the rest with a second
copy by the same thresholds.

Defined cases: NULL source is a source of its own; NULL or word-free text has
size 0 and is never taken; repeated rows with the same id and text share a hash
and are taken or left together; an empty table gives an empty result; other
columns of the input do not matter.  The hash depends on id and text alone, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import WORD_SQL, table
from bourse.session import scratch_path

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
CAP = 2
LEVEL_BITS = 10
LEVELS = 4


def doc_hash() -> Column:
    return F.xxhash64(F.lit("mix"), "doc_id", "text").bitwiseAND(F.lit((1 << LEVEL_BITS * LEVELS) - 1).cast("long"))


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and a 40-bit hash of each document."""
    return docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD_SQL)), F.lit(0)).cast("long").alias("size"),
        doc_hash().alias("h"))


def targets(sized: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP) -> DataFrame:
    """source, source_size, target: one row per source.

    The shared-out excess has a closed form: with sources ordered by
    size / weight, the capped ones are a prefix, and every other source gets
    weight * (budget - cap * sizes of the prefix) / (weights of the others).
    The comparison is in integers; the windows run over one row per source.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("k", (F.row_number().over(by_name) - 1) % len(weights))
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("k") + 1).cast("int")).cast("long"))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    d = F.lit(100).cast("decimal(38,0)")
    s = s.select("source", "source_size", "weight",
                 F.sum("source_size").over(whole).alias("total"),
                 F.sum("weight").over(whole).alias("weights"),
                 F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("size_before"),
                 F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"))
    budget = F.col("total") * share_percent          # in hundredths, so that it stays an integer
    # capped: even with all smaller ratios capped, the fair part is at least cap * size
    capped = ((F.col("weight") * (budget - 100 * cap * F.col("size_before"))).cast("decimal(38,0)")
              >= F.col("source_size").cast("decimal(38,0)") * (F.col("weights") - F.col("weight_before")) * cap * d)
    s = s.withColumn("capped", capped)
    free_size = F.sum(F.when(F.col("capped"), F.col("source_size")).otherwise(0)).over(whole)
    free_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(whole)
    fair = (F.col("weight") * (budget - 100 * cap * free_size)).cast("double") / (free_weight * 100).cast("double")
    return s.withColumn("target", F.when(F.col("capped"), (F.col("source_size") * cap).cast("double")).otherwise(fair)) \
            .select("source", "source_size", "target")


def thresholds(sized: DataFrame, target: DataFrame) -> DataFrame:
    """source_size, target, base copies and hash threshold ``cut`` per source.

    Each level sums sizes by bucket inside the boundary bucket of the level
    before, so a level reads one column pair and shuffles at most 2^LEVEL_BITS
    sums per source and task.  Documents with h < cut get one copy more.
    """
    t = target.withColumn("base", F.when(F.col("target") >= F.col("source_size"), 1).otherwise(0).cast("long"))
    side = _kept(t.select(
        F.col("source").alias("s"), "source_size", "target", "base",
        (F.col("target") - F.col("base") * F.col("source_size")).alias("room"), F.lit(0).cast("long").alias("cut")))
    for level in range(LEVELS):
        width = 1 << LEVEL_BITS * (LEVELS - 1 - level)
        end = F.col("cut") + width * (1 << LEVEL_BITS)
        sums = sized.where("size > 0").join(side, F.col("source").eqNullSafe(F.col("s"))) \
            .where((F.col("h") >= F.col("cut")) & (F.col("h") < end)) \
            .groupBy("s", F.floor(F.col("h") / width).alias("bucket")).agg(F.sum("size").alias("n"), F.first("room").alias("room"))
        run = Window.partitionBy("s").orderBy("bucket")
        sums = sums.withColumn("upto", F.sum("n").over(run))
        over = F.col("upto") > F.col("room")
        # buckets that fit whole, and the first that does not: the boundary
        fit = sums.groupBy(F.col("s").alias("s2")).agg(
            F.max(F.when(~over, F.col("upto"))).alias("used"),
            F.min(F.when(over, F.col("bucket"))).alias("boundary"),
            F.min(F.when(over, F.col("upto"))).alias("with_boundary"))
        room = F.col("room") - F.coalesce("used", F.lit(0))
        cut = F.coalesce(F.col("boundary") * width, end)  # no boundary: the whole range fits
        if level == LEVELS - 1:  # one hash value left: take it when that comes nearer to the target
            cut = cut + F.when(F.col("with_boundary") - F.col("room") < room, 1).otherwise(0)
        side = _kept(side.join(fit, F.col("s").eqNullSafe(F.col("s2")), "left").select(
            "s", "source_size", "target", "base", room.alias("room"), cut.alias("cut")))
    return side


def _kept(side: DataFrame) -> DataFrame:
    """One row per source as a written table: cuts the lineage, and its size on disk lets Spark choose the join."""
    path = scratch_path(side.sparkSession, "mix-side")
    side.coalesce(1).write.parquet(path)
    return side.sparkSession.read.parquet(path)


def cuts(docs: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """(sizes of all documents, thresholds of all sources), both as written tables."""
    spark = docs.sparkSession
    path = scratch_path(spark, "mix-sizes")
    sizes(docs).write.parquet(path)
    sized = spark.read.parquet(path)
    return sized, thresholds(sized, targets(sized, **kw))


def copies() -> Column:
    """How often the mix takes a document: of its hash h and its source's thresholds."""
    return F.col("base") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0)


def mix(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words the mix takes), copies."""
    sized, side = cuts(docs, **kw)
    return sized.join(side, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * copies()).alias("taken"), copies().alias("copies"))


def mixed(docs: DataFrame, **kw) -> DataFrame:
    """The rows of docs, all columns as they are, each as often as the mix takes it."""
    _, side = cuts(docs, **kw)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("of"), doc_hash().alias("h"))
    taken = rows.join(side, F.col("of").eqNullSafe(F.col("s"))).withColumn("n", copies()).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source", "copies")
