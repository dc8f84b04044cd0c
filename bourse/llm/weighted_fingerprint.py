r"""Operator 11: document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often each occurs.  Sample k of
a text draws, per term, r and c from Gamma(2, 1) and b uniformly, by hashes of term
and k alone: with t = floor(ln(weight) / r + b) it is the pair (term, t) of least
ln(c) - r * (t + 1 - b).  Two texts agree in a sample with the probability of their
generalised Jaccard similarity, sum of least over sum of greatest weights.  A
fingerprint holds 16 bits of each of ``SAMPLES`` pairs in hexadecimal; likeness is the
share of equal ones.

Everything is DataFrame expressions.  The numbers drawn of a term serve a document's
text and its edited text at once; each least value and the bits of its pair are one
long, so a sample is a plain minimum, combined in hash aggregates.  Texts are dealt
once, by document; a document's terms, its samples and its edited text then need no
other shuffle of texts.

Order of documents: doc_id descending, NULL ids last, then by hash of the text; the
document after the last is the first.  It is found by ranges of the order, with one
row a range carried over the edges.

Defined cases: NULL text counts as empty; texts without words have an empty
fingerprint, equal to another empty one and unlike all others; rows that repeat id
and text stand next to each other, so all but one of them have a copy of themselves as
next document; a single document is its own next one; an empty table gives an empty
result; very long texts are rows like others; other columns are ignored.  Texts under
one id count as equal if length and 64-bit hash agree; terms are 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import table
from bourse.llm.ordered import in_order
from bourse.session import scratch_path

SAMPLES = 48              # the 96 minima of two texts are what one generated stage holds (100 fields); a multiple of 4
SPLIT = r"[\x20\x09-\x0D]+"
PART_CHARS = 8 << 20      # characters of texts dealt to one task, about
FINE = 2.0 ** 36          # steps of a least value per unit; its range is below 2**7
MOVE = 40503              # odd: neighbouring t differ in their bits
KEY = ["id", "h"]
COPIES = 1 << 16


# --- samples ------------------------------------------------------------------

def sample(term: Column, k: int, logs: list[Column]) -> list[Column]:
    """For each logarithm of a weight the least value of sample k and the bits of its pair as one long; NULL for a NULL one."""
    first, second, third = (F.xxhash64(term, F.lit(3 * k + i)) for i in range(3))

    def high(x: Column) -> Column:
        return F.shiftrightunsigned(x, 32) + 0.5

    def low(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << 32) - 1)) + 0.5

    whole = 64 * math.log(2)
    r = F.lit(whole) - F.ln(high(first) * low(first))                    # Gamma(2, 1): minus the logarithm of two uniforms' product
    ln_c = F.ln(F.lit(whole) - F.ln(high(second) * low(second)))
    b = high(third) * (1 / float(1 << 32))
    rest = third.bitwiseAND(F.lit((1 << 32) - 1))
    out = []
    for log in logs:
        t = F.when(log == 0.0, F.lit(0).cast("long")).otherwise(F.floor(log / r + b))       # b is below 1; most terms occur once
        least = F.floor((ln_c - r * (t + F.lit(1.0) - b)) * FINE)
        out.append(F.shiftleft(least, 16).bitwiseOR((rest + t * MOVE).bitwiseAND(F.lit(65535))))
    return out


def packed(samples: list[Column]) -> Column:
    """array<long>: the bits of four samples each; NULL without terms."""
    bits = [x.bitwiseAND(F.lit(65535)) for x in samples]
    longs = [F.shiftleft(a, 48).bitwiseOR(F.shiftleft(b, 32)).bitwiseOR(F.shiftleft(c, 16)).bitwiseOR(d)
             for a, b, c, d in zip(*(bits[i::4] for i in range(4)))]
    return F.when(samples[0].isNotNull(), F.array(*longs))


def fingerprint(codes: Column) -> Column:
    """Text of an array of codes, empty without terms."""
    return F.coalesce(F.array_join(F.transform(codes, lambda c: F.lpad(F.lower(F.hex(c)), 16, "0")), ""), F.lit(""))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples of two arrays of codes; NULL stands for a text without words."""
    def equal(x: Column) -> Column:
        return sum(((F.shiftrightunsigned(x, 16 * i).bitwiseAND(F.lit(65535)) == 0).cast("int") for i in range(4)), F.lit(0))

    same = F.aggregate(F.zip_with(a, b, lambda x, y: x.bitwiseXOR(y)), F.lit(0), lambda n, x: n + equal(x))
    return F.when(a.isNull() | b.isNull(), (a.isNull() & b.isNull()).cast("double")).otherwise(same / F.greatest(F.size(a) * 4, F.lit(1)))


# --- documents and their next ones ----------------------------------------------

def texts(docs: DataFrame) -> DataFrame:
    """doc_id, id and hash that identify the row's content, text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(F.col("doc_id").isNull(), F.length(text), text).alias("h"), text.alias("text"))


def followed(rows: DataFrame, path: str) -> DataFrame:
    """Per id and hash its number of copies, its length, and the next content's id and hash."""
    counted = rows.groupBy("doc_id", "id", "h", F.length("text").alias("n")).agg(F.count("*").alias("copies"))
    placed = in_order(counted, [F.desc_nulls_last("doc_id"), F.asc("h"), F.asc("n")], path)
    here, parts = Window.partitionBy("part").orderBy("nr"), Window.orderBy("part")
    follower = F.struct(F.col("id").alias("next_id"), F.col("h").alias("next_h"))
    edges = placed.where("nr = 0").select("part", follower.alias("first"))       # one row a range
    edges = edges.select(F.col("part").alias("_part"), F.coalesce(
        F.lead("first").over(parts), F.first("first").over(parts.rowsBetween(Window.unboundedPreceding, 0))).alias("after"))
    return placed.select("*", F.lead(follower).over(here).alias("inside")).join(F.broadcast(edges), F.col("part") == F.col("_part")) \
        .select("doc_id", "id", "h", "n", "copies", F.coalesce("inside", "after").alias("next")).select("*", "next.*").drop("next")


def edited(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, id, h, own (whether followed by a copy of itself), times, n, next_id, next_h, text, edited text.

    The edited text has the last third of the text replaced by as many characters of the next one."""
    rows = texts(docs)
    followed(rows, f"{path}/order").write.parquet(f"{path}/followed")
    known = docs.sparkSession.read.parquet(f"{path}/followed")
    size = known.agg(F.sum(F.col("n") * F.col("copies")).alias("n"), F.max("copies").alias("copies")).first()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size["n"] or 0) // PART_CHARS))
    dealt = rows.select("id", "h", "text").repartition(parts, *KEY)
    if (size["copies"] or 1) > 1:
        dealt = dealt.dropDuplicates(KEY)
    # of a row and its copies, one is followed by the next content and the others by a copy
    need = F.floor(F.col("n") / 3).cast("int")
    asked = known.withColumn("e", F.explode(F.array(
        F.struct(F.lit(False).alias("own"), F.lit(1).cast("long").alias("times"), "next_id", "next_h"),
        F.struct(F.lit(True).alias("own"), (F.col("copies") - 1).alias("times"), F.col("id").alias("next_id"), F.col("h").alias("next_h"))))) \
        .select("doc_id", F.col("id").alias("for_id"), F.col("h").alias("for_h"), "n", need.alias("need"), "e.*").where("times > 0")
    found = dealt.join(asked, (F.col("id") == F.col("next_id")) & (F.col("h") == F.col("next_h"))) \
        .select("doc_id", "for_id", "for_h", "n", "need", "own", "times", "next_id", "next_h",
                F.substring("text", F.lit(1), F.col("need")).alias("taken")).repartition(parts, "for_id", "for_h")
    kept = F.substring("text", F.lit(1), F.col("n") - F.col("need"))
    return dealt.join(found, (F.col("id") == F.col("for_id")) & (F.col("h") == F.col("for_h"))) \
        .select("doc_id", "id", "h", "own", "times", "n", "next_id", "next_h", "text", F.concat(kept, F.col("taken")).alias("edited"))


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, codes, edited_codes, next_codes (packed, NULL without words)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "fingerprints")
    pairs = edited(docs, path)
    group = [*KEY, "own"]
    words = pairs.select(*group, F.explode(F.array(F.struct(F.lit(False).alias("new"), F.col("text").alias("t")),
                                                   F.struct(F.lit(True).alias("new"), F.col("edited").alias("t")))).alias("v")) \
        .select(*group, F.col("v.new").alias("new"), F.explode(F.split("v.t", SPLIT)).alias("word")).where("word != ''")
    weighted = words.groupBy(*group, F.xxhash64("word").alias("term")).agg(
        F.count_if(~F.col("new")).alias("w"), F.count_if(F.col("new")).alias("new_w"))
    logs = weighted.select(*group, "term", F.ln(F.col("w").cast("double")).alias("log"), F.ln(F.col("new_w").cast("double")).alias("new_log"))
    least = [sample(F.col("term"), k, [F.col("log"), F.col("new_log")]) for k in range(samples)]
    drawn = logs.groupBy(*group).agg(*(F.min(v).alias(f"{c}{k}") for k, pair in enumerate(least) for c, v in zip("ab", pair)))
    codes = [packed([F.col(f"{c}{k}") for k in range(samples)]).alias(n) for c, n in zip("ab", ("codes", "edited_codes"))]
    named = drawn.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("own").alias("_own"), *codes)
    plain = pairs.select("doc_id", *group, "times", "n", "next_id", "next_h", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    plain.join(named, (F.col("id") == F.col("_id")) & (F.col("h") == F.col("_h")) & (F.col("own") == F.col("_own")), "left") \
        .drop("_id", "_h", "_own").write.parquet(f"{path}/signed")
    signed = spark.read.parquet(f"{path}/signed")
    of_next = signed.where("not own").select(F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("codes").alias("next_codes"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / COPIES))
    one = signed.join(of_next, ["next_id", "next_h"]).withColumn("_b", F.explode(blocks)) \
        .withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("times") - F.col("_b") * COPIES))))
    return one.select("doc_id", F.col("n").cast("long").alias("n_chars"), "edited_sha256", "codes", "edited_codes", "next_codes")


def query(spark, sf_dir: str) -> DataFrame:
    f = fingerprints(table(spark, sf_dir, "documents"))
    return f.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("codes")).alias("fingerprint"),
                    fingerprint(F.col("edited_codes")).alias("edited_fingerprint"),
                    likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
                    likeness(F.col("codes"), F.col("next_codes")).alias("near_next"))
