r"""Operator 13: prefix trie of rebuilt conversations by composable fingerprints.

A rebuilt conversation is the head of a base conversation followed by its own
turns; its texts are never put together.  A sequence of turns has the fingerprint
(length n, sums of x_i * B**i modulo a prime, in four lanes with their own B), x_i
from the SHA-256 of a turn's role and text.  Fingerprints form a monoid:
(n, s) + (m, t) = (n + m, s + B**n * t).  So the fingerprint of every rebuilt prefix
follows from prefix sums over the stored turns: the base's at the head's end, plus
the own ones from there on, moved by the difference in length.  The same law joins
the pieces of a conversation that is spread over many partitions.

Rows of equal depth and fingerprint form a node.  Each row refers to its stored last
turn and to its parent's fingerprint; a node is accepted when all its rows agree in
both, and turns of one digest when all their roles and texts agree, which by induction
proves the sequences equal.  Otherwise everything is repeated with other B.

No row is sent to all its ancestors: a node is owned by its smallest member, and a
member owns the nodes of its path from some depth on.  Children, leaves and words that
a member repeats are then sums over a node's own members, with that depth as the only
thing known of the path.  Conversations of any length cost one row a turn.

Defined cases: rows without conv_id take no part; NULL role or text counts as empty; a
NULL turn comes first; turns of the same number are ordered by the digest of role and
text, so repeated rows stand one after another; an absent base gives an empty head; an
empty table gives an empty result; other columns are ignored.  Ids of members that end
in a node are digested in order, in a stream of bounded memory.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import WORD_SQL, table
from bourse.llm.ordered import in_order
from bourse.session import scratch_path

P = (1 << 31) - 1
#: B of each lane by attempt.
BASES = ((1_103_515_245, 69_069_131, 1_664_525_021, 214_013_717), (1_566_083_941, 48_271_003, 630_360_017, 742_938_283),
         (950_706_377, 1_226_874_157, 62_089_909, 1_343_714_437))
LANES = range(4)
BLOCK, HEADS = 20, 4      # conversations of a block share its first one as base; heads have 0 to HEADS - 1 turns
SALTS = 16
RUN = 12                  # ids that agree in all but their lowest RUN bits are written as one string
KEY = ["d", "fa", "fb"]


def power(base: int, n: Column) -> Column:
    """base ** n modulo P for 0 <= n < 2**32."""
    out = F.lit(1).cast("long")
    for bit in range(32):
        out = (out * F.when(n.bitwiseAND(F.lit(1 << bit)) != 0, F.lit(pow(base, 1 << bit, P))).otherwise(F.lit(1)).cast("long")) % P
    return out


def stored_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest of role and text (hexadecimal)."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text)).cast("binary"), 256)
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), digest.alias("digest"))


def same_texts(turns: DataFrame) -> bool:
    """No digest stands for two different turns."""
    return turns.groupBy("digest", "role", "text").agg(F.lit(1).alias("one")).groupBy("digest").count().where("count > 1").isEmpty()


def own_prefixes(thin: DataFrame, bases: tuple, path: str) -> DataFrame:
    """Each stored turn with its place in its conversation, its lanes' terms t and prefix sums s, and the words up to it."""
    here = Window.partitionBy("part", "conv_id").orderBy("nr")
    local = thin.withColumn("at", F.row_number().over(here).cast("long"))
    local = local.withColumns({f"t{i}": F.col(f"g{i}") % P * power(bases[i], F.col("at")) % P for i in LANES})
    seg = local.groupBy("part", "conv_id").agg(F.count("*").alias("n"), F.sum("words").alias("sw"), *(F.sum(f"t{i}").alias(f"sum{i}") for i in LANES))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumns({"n0": F.coalesce(F.sum("n").over(before), F.lit(0)), "w0": F.coalesce(F.sum("sw").over(before), F.lit(0))})
    seg = seg.withColumns({f"move{i}": power(bases[i], F.col("n0")) for i in LANES})
    seg = seg.withColumns({f"o{i}": F.coalesce(F.sum(F.col(f"sum{i}") % P * F.col(f"move{i}") % P).over(before), F.lit(0)) % P for i in LANES})
    seg = seg.select(F.col("part").alias("_part"), F.col("conv_id").alias("_conv"), "n0", "w0", *(f"{c}{i}" for c in ("move", "o") for i in LANES))
    up_to = here.rowsBetween(Window.unboundedPreceding, 0)
    local = local.withColumns({"lw": F.sum("words").over(up_to), **{f"ls{i}": F.sum(f"t{i}").over(up_to) % P for i in LANES}})
    local.join(seg, (F.col("part") == F.col("_part")) & (F.col("conv_id") == F.col("_conv"))).select(
        "part", "conv_id", (F.col("at") + F.col("n0")).alias("pos"), "words", (F.col("lw") + F.col("w0")).alias("w"), *(f"g{i}" for i in LANES),
        *((F.col(f"move{i}") * F.col(f"t{i}") % P).alias(f"t{i}") for i in LANES),
        *(((F.col(f"o{i}") + F.col(f"move{i}") * F.col(f"ls{i}")) % P).alias(f"s{i}") for i in LANES)).write.parquet(path)
    return thin.sparkSession.read.parquet(path)


def records(own: DataFrame, bases: tuple, base: Column, head: Column, path: str) -> DataFrame:
    """One row per conversation: its head (turns of the base), and what stands before its own suffix."""
    early = F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS, F.struct(
        "pos", "words", "w", *(f"{c}{i}" for c in "gts" for i in LANES)))))       # HEADS - 1 turns at most
    convs = own.groupBy("conv_id").agg(F.max("pos").alias("len"), F.max("w").alias("own_words"), early.alias("early")) \
        .select("*", base.alias("base"), head.cast("int").alias("h"))
    bases_of = convs.select(F.col("conv_id").alias("base"), F.col("early").alias("base_early"))
    r = convs.join(bases_of, "base", "left").withColumn(
        "head", F.when(F.col("base_early").isNull(), F.slice("early", 1, 0)).otherwise(F.slice("base_early", F.lit(1), F.col("h"))))
    r = r.withColumn("k", F.size("head"))
    last, own_last = F.get("head", F.col("k") - 1), F.get("early", F.col("h") - 1)
    zero = F.lit(0).cast("long")
    inverse = {i: F.get(F.array(*(F.lit(pow(bases[i], -e, P)).cast("long") for e in range(HEADS))), F.col("h") - F.col("k")) for i in LANES}
    suffix = F.greatest(F.col("len") - F.col("h"), zero)
    skipped = F.when(F.col("h") > 0, own_last["w"]).otherwise(zero)
    head_words = F.coalesce(last["w"], zero)
    r.select("conv_id", "h", "k", "head", (F.col("k") + suffix).alias("m_len"), head_words.alias("hw"), skipped.alias("ow"),
             (head_words + F.when(suffix > 0, F.col("own_words") - skipped).otherwise(zero)).alias("all_words"),
             *(F.coalesce(last[f"s{i}"], zero).alias(f"hs{i}") for i in LANES),
             *(F.when(F.col("h") > 0, own_last[f"s{i}"]).otherwise(zero).alias(f"os{i}") for i in LANES),
             *(inverse[i].alias(f"inv{i}") for i in LANES)).write.parquet(path)
    return own.sparkSession.read.parquet(path)


def by_pieces(rows: DataFrame, record: DataFrame) -> DataFrame:
    """rows (part, conv_id, ..) with their conversation's record, joined by piece: a long conversation is many pieces."""
    pieces = rows.select(F.col("part").alias("_part"), F.col("conv_id").alias("_conv")).distinct() \
        .join(record.withColumnRenamed("conv_id", "_conv2"), F.col("_conv") == F.col("_conv2")).drop("_conv2")
    return rows.join(pieces, (F.col("part") == F.col("_part")) & (F.col("conv_id") == F.col("_conv"))).drop("_part", "_conv")


def members(own: DataFrame, record: DataFrame, path: str) -> DataFrame:
    """One row per conversation and prefix of it: depth, fingerprint, parent's fingerprint, words before the last turn."""
    def pair(lane, a: int) -> Column:
        return F.shiftleft(lane(a), 31).bitwiseOR(lane(a + 1))

    def row(lane, parent, *more) -> list[Column]:
        return [pair(lane, 0).alias("fa"), pair(lane, 2).alias("fb"), pair(parent, 0).alias("pa"), pair(parent, 2).alias("pb"), *more]

    zero = F.lit(0).cast("long")
    x = F.get("head", F.col("d") - 1)
    of_head = record.select("*", F.explode(F.sequence(F.lit(0), F.col("k"))).alias("d")).select(
        "conv_id", F.lit(-1).alias("part"), "m_len", F.col("d").cast("long").alias("d"),
        *row(lambda i: F.coalesce(x[f"s{i}"], zero), lambda i: F.coalesce((x[f"s{i}"] - x[f"t{i}"] + P) % P, zero),
             F.coalesce(x["w"] - x["words"], zero).alias("before"), *(F.coalesce(x[f"g{i}"], zero).alias(f"g{i}") for i in LANES)))

    def moved(c: Column, i: int) -> Column:
        return (F.col(f"hs{i}") + F.col(f"inv{i}") * ((c - F.col(f"os{i}") + 2 * P) % P)) % P

    of_suffix = by_pieces(own, record.drop("head")).where("pos > h").select(
        "conv_id", "part", "m_len", (F.col("k") + F.col("pos") - F.col("h")).alias("d"),
        *row(lambda i: moved(F.col(f"s{i}"), i), lambda i: moved(F.col(f"s{i}") - F.col(f"t{i}"), i),
             (F.col("hw") + F.col("w") - F.col("words") - F.col("ow")).alias("before"), *(F.col(f"g{i}") for i in LANES)))
    of_head.unionByName(of_suffix).write.parquet(path)
    return own.sparkSession.read.parquet(path)


def nodes(rows: DataFrame, path: str) -> tuple[DataFrame, bool]:
    """(one row per node; whether all rows of each node agree in parent and last turn)."""
    said = ["pa", "pb", *(f"g{i}" for i in LANES)]
    rows.groupBy(*KEY).agg(F.min("conv_id").alias("owner"), F.max("m_len").alias("deepest"), F.min("before").alias("before"),
                           *(f(c).alias(f"{n}_{c}") for c in said for n, f in (("min", F.min), ("max", F.max)))).write.parquet(path)
    out = rows.sparkSession.read.parquet(path)
    differ = F.lit(False)
    for c in said:
        differ = differ | (F.col(f"min_{c}") != F.col(f"max_{c}"))
    return out.select(*KEY, "owner", "deepest", "before", F.col("min_pa").alias("pa"), F.col("min_pb").alias("pb")), out.where(differ).isEmpty()


def owners(nodes: DataFrame) -> DataFrame:
    """Per conversation that owns a node: depth of the first one, words before it, its parent's owner, whether its end is a leaf."""
    own = nodes.groupBy("owner").agg(F.min("d").alias("o"), F.min("before").alias("wo"), F.min_by("pa", "d").alias("pa"), F.min_by("pb", "d").alias("pb"),
                                     F.max((F.col("deepest") == F.col("d")).cast("int")).alias("leaf"))
    # a node may have very many children: only nodes that are asked for go on, each copied to SALTS keys
    asked = own.where("o > 0").groupBy((F.col("o") - 1).alias("d"), F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.lit(1).alias("one"))
    parents = nodes.select(*KEY, F.col("owner").alias("parent")).join(asked, KEY, "left_semi") \
        .select((F.col("d") + 1).alias("o"), F.col("fa").alias("pa"), F.col("fb").alias("pb"), "parent",
                F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return own.withColumn("salt", F.pmod(F.xxhash64("owner"), F.lit(SALTS)).cast("int")).join(parents, ["o", "pa", "pb", "salt"], "left") \
        .select("owner", "o", "wo", "leaf", "parent")


def ends(rows: DataFrame) -> DataFrame:
    """Per node in which members end: the digest of their ids, in order, joined by commas."""
    runs = rows.where("d = m_len").groupBy(*KEY, F.shiftright("conv_id", RUN).alias("run")) \
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))   # 2**RUN ids at most
    schema = pa.schema([("d", pa.int64()), ("fa", pa.int64()), ("fb", pa.int64()), ("ends_sha256", pa.string())])

    def digest(batches):
        at, state = None, None
        for b in batches:
            done = []
            for d, fa, fb, ids in zip(*(b.column(c).to_pylist() for c in (0, 1, 2, 4))):
                if (d, fa, fb) == at:
                    state.update(b",")
                else:
                    if at:
                        done.append((*at, state.hexdigest()))
                    at, state = (d, fa, fb), hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)
        if at:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*at, state.hexdigest()), schema.types)], schema=schema)

    return runs.repartition(*KEY).sortWithinPartitions(*KEY, "run").mapInArrow(digest, "d long, fa long, fb long, ends_sha256 string")


def block_base(conv_id: Column) -> Column:
    return conv_id - conv_id % BLOCK


def head_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def trie(conversations: DataFrame, base=block_base, head=head_turns) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    base(conv_id): the conversation whose first turns head the rebuilt one; head(conv_id): how many of them, below
    ``HEADS``, in place of as many own ones."""
    spark = conversations.sparkSession
    path = scratch_path(spark, "trie")
    turns = stored_turns(conversations)
    if not same_texts(turns):
        raise ValueError("two different turns have one SHA-256")
    lanes = [F.conv(F.substring("digest", 15 * i + 1, 15), 16, 10).cast("long").alias(f"g{i}") for i in LANES]
    words = F.regexp_count("text", F.lit(WORD_SQL)).cast("long").alias("words")
    thin = in_order(turns.select("conv_id", "turn", "digest", words, *lanes),
                    [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")], f"{path}/turns").drop("turn", "digest")
    for attempt, bases in enumerate(BASES):
        at = f"{path}/{attempt}"
        own = own_prefixes(thin, bases, f"{at}/own")
        record = records(own, bases, base(F.col("conv_id")), head(F.col("conv_id")), f"{at}/records")
        rows = members(own, record, f"{at}/members")
        found, verified = nodes(rows, f"{at}/nodes")
        if verified:
            break
    else:
        raise RuntimeError("fingerprints collided in every attempt")
    owned = owners(found).withColumnRenamed("owner", "conv_id")
    # a conversation that owns nothing repeats all its words
    path_of = record.select("conv_id", "m_len", "all_words").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("o", F.col("m_len") + 1).alias("o"), F.coalesce("wo", "all_words").alias("wo"), F.coalesce("leaf", F.lit(0)).alias("leaf"), "parent")
    d, conv = F.col("d"), F.col("conv_id")
    out = by_pieces(rows, path_of).groupBy(*KEY).agg(
        F.min(conv).alias("conv_id"), F.min_by(F.when(d > F.col("o"), conv).otherwise(F.col("parent")), conv).alias("parent_conv_id"),
        F.count("*").alias("n_convs"), F.sum(F.col("o").between(F.lit(0), d + 1).__and__(d < F.col("m_len")).cast("long")).alias("n_children"),
        F.sum(F.col("leaf").cast("long")).alias("n_leaves"), F.sum(F.greatest(F.col("wo") - F.col("before"), F.lit(0))).alias("saved_tokens"))
    return out.join(ends(rows), KEY, "left").select(
        "conv_id", d.alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def query(spark, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


#: Rebuilds every conversation as a list of turns and groups its prefixes, by brute force.
SQL = r"""
WITH t AS (
  SELECT conv_id AS c, {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS m,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(m ORDER BY pos) AS ms,
    CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(c AS VARCHAR)[i]) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [CAST(y AS BIGINT) for y in range(8)]),
        lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) AS BIGINT) % 4 AS h
  FROM t GROUP BY c),
r AS (SELECT o.c, list_concat(CASE WHEN b.c IS NULL THEN [] ELSE b.ms[1:o.h] END, o.ms[o.h + 1:]) AS ms
  FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20),
p AS (SELECT c, d, ms[1:d] AS pre, ms[1:d - 1] AS par, len(ms) = d AS ending FROM r, unnest(range(0, len(ms) + 1)) u(d)),
n AS (SELECT d, pre, any_value(par) AS par, min(c) AS c, count(*) AS n,
    sha256(coalesce(string_agg(CASE WHEN ending THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '')) AS ends,
    CASE WHEN d = 0 THEN 0 ELSE len(list_filter(string_split_regex(pre[d].x, '[ \t-\r]+'), lambda s: s <> '')) END AS words
  FROM p GROUP BY d, pre),
k AS (SELECT a.d, a.pre, count(b.d) AS kids FROM n a LEFT JOIN n b ON b.d = a.d + 1 AND b.par = a.pre GROUP BY a.d, a.pre),
s AS (SELECT a.d, a.pre, sum((b.n - 1) * b.words) AS saved, sum(CASE WHEN k.kids = 0 THEN 1 ELSE 0 END) AS leaves
  FROM n a JOIN n b ON b.d >= a.d AND b.pre[1:a.d] = a.pre JOIN k ON k.d = b.d AND k.pre = b.pre GROUP BY a.d, a.pre)
SELECT n.c AS conv_id, CAST(n.d AS BIGINT) AS depth, q.c AS parent_conv_id, n.n AS n_convs, k.kids AS n_children,
       CAST(s.leaves AS BIGINT) AS n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN k ON k.d = n.d AND k.pre = n.pre JOIN s ON s.d = n.d AND s.pre = n.pre LEFT JOIN n q ON q.d = n.d - 1 AND q.pre = n.par
"""
