r"""Operator 1: MinHash near-deduplication with fast similarity sketches.

Sketch: in round i every shingle of a document is thrown, by a hash of that
round, into one of ``t`` bins with value i + fraction; a bin keeps its least
value.  From round t on, round t + j throws every shingle into bin j, so each
bin is filled after at most 2t rounds, usually after two or three; documents
leave when all bins are full.  A coordinate of two sketches agrees with the
probability of their Jaccard similarity, with concentration as for independent
hash functions, in time n + t log t instead of n * t.

Steps: (1) one pass sketches every text; documents with equal shingle sets (by
a 128-bit digest) form a class, and only class representatives go on;
(2) bands of coordinates put representatives into buckets; (3) each
representative is verified on the full shingle sets against the hub among its
buckets' members, the one whose buckets are fullest (of a text and its edited
copies that is the text), and components are formed from confirmed links;
(4) buckets that still hold several components go on in rounds: members outside
the hub's component are verified against growing sets of pivots, until every
bucket holds one component or all its pairs across components were looked at.
So a group of thousands of near copies costs about one verification a member,
and no pair that could join two components is skipped.

In step 4 a test that never refuses a true link comes before the full sets: each
representative has a bitmap with the parity of its shingles by hash; two bitmaps
differ in no more bits than the sets in shingles, so a pair whose bitmaps differ
in more bits than the threshold leaves room for cannot link.

Bands are chosen so that a pair at the threshold misses every bucket with
probability below ``MISS``.  Shingles are compared as 64-bit hashes.

Defined cases: NULL, empty and word-free texts have no shingle, and are linked
with nothing; a text with fewer than k words has its whole word sequence as one
shingle; repeated rows are copies of one another; rows without doc_id get no
component and are kept; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import id_text, rows_of, small_arrow_batches, table
from bourse.llm.components import broadcast_few, connected
from bourse.session import scratch_path

K, PERCENT = 5, 80          # words a shingle, least similarity in percent: the defaults of near-duplicate work
MISS = 1e-8
BITS = 1024                 # of a representative's parity bitmap
WORD_CACHE = 300_000
PIVOTS, PIVOT_GROWTH = 8, 64  # pivots of a bucket in the first round, and the growth of their number
SALTS = 16


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): rows by threshold, bands until a pair at the threshold is missed with probability below MISS."""
    rows = 5 if percent >= 85 else 4 if percent >= 75 else 3
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** rows)), rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, k: int, known: WordHash) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, n)
    size = min(k, n)
    h = np.full(n - size + 1, size, np.uint64)
    for j in range(size):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:n - size + 1 + j])
    return np.unique(h)


def sketch(sets: list[np.ndarray], t: int) -> np.ndarray:
    """(sets, t) coordinates: the round in the upper bits, the fraction below; empty sets stay at the maximum."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(len(sets) * t, empty, np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    x = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    for i in range(2 * t):
        if not len(x):
            break
        h = mix(x ^ np.uint64((i + 1) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF))
        place = ((h >> np.uint64(40)) * np.uint64(t) >> np.uint64(24)).astype(np.int64) if i < t else i - t
        value = (h & np.uint64((1 << 40) - 1)) | np.uint64(i << 40)
        np.minimum.at(out, owner * t + place, value)
        full = (out.reshape(-1, t) != empty).all(axis=1)
        more = ~full[owner]
        if not more.all():
            x, owner = x[more], owner[more]
    return out.reshape(-1, t)


def band_keys(coordinates: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(sets, bands) signed keys; a key holds its band's number, so keys of different bands do not meet."""
    c = coordinates.reshape(len(coordinates), bands, rows)
    h = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), c.shape[:2])
    for j in range(rows):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + c[:, :, j])
    return h.view(np.int64)


def parity(sets: list[np.ndarray]) -> np.ndarray:
    """(sets, BITS / 64) words: bit h is set when an odd number of a set's shingles hash to h."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    place = owner * BITS + (mix(x ^ np.uint64(0xA5A5A5A5)) % np.uint64(BITS)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=len(sets) * BITS) & 1).astype(bool).reshape(-1, BITS), axis=1).view(np.int64)


def text_digest() -> Column:
    """MD5 of a row's text; NULL counts as empty, as in the sketches."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def sketches(docs: DataFrame, k: int, percent: int, digests: bool = False) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys, parity bitmap (and the text's digest); one pass over all texts."""
    bands, rows = bands_for(percent)

    def run(batches):
        known = WordHash()
        for ids, texts in rows_of(batches):
            sets = [shingles(t, k, known) for t in texts]
            digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            keys = band_keys(sketch(sets, bands * rows), bands, rows)
            bits = parity(sets)
            own = [pa.array([hashlib.md5(t).digest() for t in texts], pa.binary())] if digests else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([int.from_bytes(d[:8], "little", signed=True) for d in digest], pa.int64()),
                 pa.array([int.from_bytes(d[8:], "little", signed=True) for d in digest], pa.int64()),
                 pa.array([x if len(s) else [] for x, s in zip(keys, sets)], pa.list_(pa.int64())),
                 pa.array(list(bits), pa.list_(pa.int64())), *own],
                ["doc_id", "n_shingles", "d1", "d2", "keys", "bits", *["text_digest"] * digests])

    return id_text(docs).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, bits array<long>" + ", text_digest binary" * digests)


def _sets(k: int):
    def run(batches):
        known = WordHash()
        for ids, texts in rows_of(batches):
            sets = [shingles(t, k, known) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "n", "set"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= percent * union."""
    def side(x):
        return sets.select(F.col("id").alias(f"{x}_id"), F.col("n").alias(f"{x}_n"), F.col("set").alias(f"{x}_set"))

    def run(batches):
        for b in batches:
            u, v, a_sets, b_sets = (b.column(i).to_pylist() for i in range(4))
            good = []
            for x, y in zip(a_sets, b_sets):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    joined = pairs.join(side("a"), F.col("u") == F.col("a_id")).join(side("b"), F.col("v") == F.col("b_id")) \
        .where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
    return joined.select("u", "v", "a_set", "b_set").mapInArrow(run, "u long, v long")


def link(docs: DataFrame, k: int = K, percent: int = PERCENT, digests: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id (and text_digest) for every row of docs."""
    spark = docs.sparkSession
    small_arrow_batches(spark)
    path = scratch_path(spark, "near")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.parquet(f"{path}/{name}")

    sk = kept(sketches(docs, k, percent, digests), "sketches")
    classes = kept(sk.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = sk.where("n_shingles > 0").join(classes.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "rep"),
                                             (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("doc_id") == F.col("rep")))
    rows = firsts.select("rep", F.explode("keys").alias("key")).distinct()
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select(F.col("key").alias("k2"), "m")
    buckets = kept(rows.join(shared, F.col("key") == F.col("k2")).select("key", "rep", "m"), "buckets")
    crowd = buckets.groupBy("rep").agg(F.sum("m").alias("crowd")).withColumnRenamed("rep", "r")
    # an id that stands for several sets (a repeated doc_id with other texts) is only judged on full sets
    facts = firsts.groupBy("rep").agg(F.max("n_shingles").alias("n"), F.first("bits").alias("bits"),
                                      (F.min(F.struct("d1", "d2")) != F.max(F.struct("d1", "d2"))).alias("several"))
    reps = kept(crowd.join(facts, F.col("r") == F.col("rep")).drop("rep"), "reps")
    small = docs.join(reps.select(F.col("r").alias("_r")), F.col("doc_id") == F.col("_r"), "left_semi")
    sets = kept(id_text(small).mapInArrow(_sets(k), "id long, n long, set binary"), "sets")

    members = kept(buckets.join(reps.select("r", "crowd"), F.col("rep") == F.col("r")).select("key", "rep", "m", "crowd"), "members")
    hubs = members.groupBy(F.col("key").alias("k2")).agg(F.max(F.struct("crowd", -F.col("rep"))).alias("hub"))
    first = members.join(hubs, F.col("key") == F.col("k2")).groupBy("rep").agg(F.max("hub").alias("hub")) \
        .select(F.col("rep").alias("u"), (-F.col("hub.col2")).alias("v")).where("u <> v")
    links = kept(confirmed(first, sets, percent), "links-0")
    done, width = 0, PIVOTS
    tested = spark.createDataFrame([], "u long, v long")
    comp = kept(connected(links), "components")
    n_comp = comp.count()
    while True:
        now = members.where(F.col("m") > done) \
            .join(broadcast_few(comp, n_comp), F.col("rep") == F.col("node"), "left") \
            .select("key", "rep", "crowd", F.coalesce("component", "rep").alias("comp"))
        open_keys = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                           F.max(F.struct("crowd", -F.col("rep"), "comp")).alias("top")).where("lo < hi") \
            .select(F.col("key").alias("k2"), F.col("top.comp").alias("hub_comp"))
        now = kept(now.join(open_keys, F.col("key") == F.col("k2")).select("key", "rep", "crowd", "comp", "hub_comp"), f"open-{done}")
        if now.isEmpty():
            break
        # the pivots of this round: members number done .. done + width of each bucket, hubs first; ranked in salted parts first
        order = [F.desc("crowd"), F.asc("rep")]
        some = now.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS))) \
            .withColumn("i", F.row_number().over(Window.partitionBy("key", "salt").orderBy(*order))).where(F.col("i") <= done + width)
        pivots = some.withColumn("i", F.row_number().over(Window.partitionBy("key").orderBy(*order))) \
            .where((F.col("i") > done) & (F.col("i") <= done + width)).select(F.col("key").alias("k2"), F.col("rep").alias("pivot"), F.col("comp").alias("pivot_comp"))
        known = reps.select("r", "n", "several", "bits")
        pivots = pivots.join(known.toDF("p_r", "p_n", "p_several", "p_bits"), F.col("pivot") == F.col("p_r"))
        testers = now.where("comp <> hub_comp").select("key", "rep", "comp").join(known, F.col("rep") == F.col("r"))
        apart = sum((F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("p_bits", F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
        both = F.col("n") + F.col("p_n")
        common = F.ceil(percent * both / (100 + percent))       # shingles that a linked pair shares at least
        may = F.col("several") | F.col("p_several") | ((common <= F.least("n", "p_n")) & (apart <= both - 2 * common))
        pairs = testers.join(pivots, (F.col("key") == F.col("k2")) & (F.col("comp") != F.col("pivot_comp")) & may) \
            .select(F.greatest("rep", "pivot").alias("u"), F.least("rep", "pivot").alias("v")).distinct()
        pairs = kept(pairs.join(tested.toDF("tu", "tv"), (F.col("u") == F.col("tu")) & (F.col("v") == F.col("tv")), "left_anti"), f"pairs-{done}")
        tested = tested.union(pairs)
        done, width = done + width, width * PIVOT_GROWTH
        new = kept(confirmed(pairs, sets, percent), f"links-{done}")
        if not new.isEmpty():
            comp = kept(connected(new.union(comp.select("node", "component"))), f"components-{done}")
            n_comp = comp.count()
    out = sk.join(classes.select(F.col("d1").alias("c1"), F.col("d2").alias("c2"), "rep"),
                  (F.col("d1") == F.col("c1")) & (F.col("d2") == F.col("c2")) & (F.col("n_shingles") > 0), "left") \
        .join(broadcast_few(comp, n_comp), F.col("rep") == F.col("node"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"), F.col("rep").alias("class_id"),
                      *["text_digest"] * digests)


def query(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), k=3, percent=85)
