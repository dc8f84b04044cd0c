"""Operator 7: quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one failure bit per rule; a policy is a versioned bit mask over the rules,
so changing policy, or asking what one rule costs, never reads a text again:

* ``ledger``     documents -> measurements + ``fail_bits``
* ``store`` / ``open_ledger``  the ledger as a table, with a table of its rules beside it: bit,
  name, version, predicate.  A ledger stored under other rules is brought up to
  date from its measurements: only bits of new or changed rules are computed
* ``apply_policy`` ledger -> ``base_failed``, ``kept`` by a mask comparison
* ``ablations``  ledger -> per rule: documents failing it, failing it alone, and
  kept if it were dropped, all from one histogram of distinct bit patterns

A rule's bit is part of its definition and never given to another rule, so order
and additions do not touch what is stored; a changed predicate gets a new version.

Defined cases: a NULL text has no words and fails ``few_words``; repeated rows
are judged one by one; an empty table gives an empty ledger; a very long text is
measured whole, in memory of a few times its size; other columns of the input are
ignored, whatever their names; bits of rules that are no longer known are cleared.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import id_text, rows_of, small_arrow_batches, table
from bourse.session import scratch_path

class Rule(NamedTuple):
    bit: int
    version: int
    predicate: str      # SQL over the measurements that is TRUE when a document fails


RULES = {
    "few_words": Rule(0, 1, "n_words < 50"),
    "repeated_words": Rule(1, 1, "100 * n_repeat_words > 50 * n_words"),
    "symbols": Rule(2, 1, "10 * n_symbols > 3 * n_words"),
    "duplicate_lines": Rule(3, 1, "100 * n_dup_lines > 50 * n_lines"),
    "short_words": Rule(4, 1, "word_chars < 2 * n_words"),
    "long_words": Rule(5, 1, "word_chars > 15 * n_words"),
}
#: version -> rules whose failure rejects a document
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
}
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def measure(text: bytes) -> tuple[int, int, int, int, int, int]:
    """The measurements of one text."""
    words = text.split()
    n = len(words)
    # code points: bytes that do not continue a UTF-8 sequence, less the separators
    raw = np.frombuffer(text, np.uint8)
    chars = int(np.count_nonzero((raw & 0xC0) != 0x80)) - sum(text.count(s) for s in SPACES)
    symbols = sum(text.count(s) for s in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.split()]
    repeated = 0
    if n >= 3:
        number: dict[bytes, int] = {}
        w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, n)
        # windows as exact numbers: pair number, then (pair, third)
        _, pair = np.unique(w[:-1] * len(number) + w[1:], return_inverse=True)
        _, inv, count = np.unique(pair[:-1] * len(number) + w[2:], return_inverse=True, return_counts=True)
        hit = count[inv] > 1
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[k:n - 2 + k] |= hit
        repeated = int(mark.sum())
    return n, chars, symbols, len(lines), len(lines) - len(set(lines)), repeated


def _measure(batches):
    for ids, texts in rows_of(batches):
        cols = list(zip(*map(measure, texts)))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in cols)],
                                         ["doc_id", "n_words", "word_chars", "n_symbols", "n_lines",
                                          "n_dup_lines", "n_repeat_words"])


def mask_of(rules, known=RULES) -> int:
    return sum(1 << known[r].bit for r in rules)


def _bits(rules: dict[str, Rule]) -> Column:
    bits = F.lit(0).cast("long")
    for r in rules.values():
        bits = bits.bitwiseOR(F.when(F.expr(r.predicate), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, rules: dict[str, Rule] = RULES) -> DataFrame:
    """doc_id, measurements and ``fail_bits`` (a rule's bit is set: it failed)."""
    small_arrow_batches(docs.sparkSession)
    return id_text(docs).mapInArrow(_measure, f"doc_id long, {MEASURES}").withColumn("fail_bits", _bits(rules))


def store(led: DataFrame, path: str, rules: dict[str, Rule] = RULES) -> None:
    """Writes the ledger and, beside it, what its bits mean."""
    if len({r.bit for r in rules.values()}) < len(rules) or any(not 0 <= r.bit < 63 for r in rules.values()):
        raise ValueError("every rule needs a bit of its own, from 0 to 62")
    led.write.mode("overwrite").parquet(f"{path}/ledger")
    led.sparkSession.createDataFrame([(n, *r) for n, r in rules.items()], "rule string, bit int, version int, predicate string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/rules")


def open_ledger(spark, path: str, rules: dict[str, Rule] = RULES) -> DataFrame:
    """A stored ledger with the bits of ``rules``; those stored under the same name, version and bit are taken as they are."""
    led = spark.read.parquet(f"{path}/ledger")
    stored = {r["rule"]: Rule(r["bit"], r["version"], r["predicate"]) for r in spark.read.parquet(f"{path}/rules").collect()}
    same = [n for n, r in rules.items() if n in stored and stored[n][:2] == r[:2]]
    for n in same:
        if stored[n].predicate != rules[n].predicate:
            raise ValueError(f"rule {n} was stored as {stored[n].predicate!r} under the same version")
    new = {n: r for n, r in rules.items() if n not in same}
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask_of(same, rules)).cast("long"))
    return led.withColumn("fail_bits", bits.bitwiseOR(_bits(new)) if new else bits)


def apply_policy(led: DataFrame, version: str = "v1") -> DataFrame:
    """Adds ``base_failed`` and ``kept`` for a policy version."""
    def fails(v):
        return F.col("fail_bits").bitwiseAND(F.lit(mask_of(POLICIES[v])).cast("long")) != 0
    return led.withColumn("base_failed", fails("base")).withColumn("kept", ~fails("base") & ~fails(version))


def ablations(led: DataFrame, version: str = "v1") -> DataFrame:
    """rule, n_fail, n_fail_alone, kept_without: one row per rule of the policy.

    The ledger is reduced first to counts per bit pattern (at most 2^rules rows,
    combined map-side); every figure is a bitwise test on those patterns.
    """
    mask = mask_of(POLICIES[version])
    hist = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << RULES[r].bit).cast("long").alias("bit"))
                               for r in POLICIES[version])))
    x = hist.select("bits", "n", each.alias("r")).select("bits", "n", "r.*")
    rest = F.col("bits").bitwiseAND(F.bitwise_not("bit"))
    return x.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_fail"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_fail_alone"),
        F.sum(F.when(rest == 0, F.col("n")).otherwise(0)).alias("kept_without"))


def query(spark, sf_dir: str) -> DataFrame:
    """The ledger is stored once; the policy is applied to what is read back."""
    path = scratch_path(spark, "quality-ledger")
    store(ledger(table(spark, sf_dir, "documents")), path)
    return apply_policy(open_ledger(spark, path)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


_W = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_NO_WORD = r"[\x20\x09-\x0D]*"
SQL = rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text, {_W} as w from documents),
l as (select rid, doc_id, len(w) as n_words, len(array_to_string(w, '')) as word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
             list_filter(string_split(text, chr(10)), lambda x: not regexp_full_match(x, '{_NO_WORD}')) as ls
      from d),
g as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as t
      from (select rid, w, unnest(range(1, len(w) - 1)) as i from d where len(w) >= 3)),
h as (select rid, i from (select rid, i, count(*) over (partition by rid, t) as c from g) where c > 1),
r as (select rid, count(distinct p) as n from (select rid, unnest([i, i + 1, i + 2]) as p from h) group by rid),
m as (select l.*, len(ls) as n_lines, len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words
      from l left join r using (rid)),
j as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not (10 * n_symbols > 3 * n_words or 100 * n_dup_lines > 50 * n_lines
                                or word_chars < 2 * n_words or word_chars > 15 * n_words) as kept,
       cast(case when n_words < 50 then 1 else 0 end + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
            + case when 10 * n_symbols > 3 * n_words then 4 else 0 end + case when 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
            + case when word_chars < 2 * n_words then 16 else 0 end + case when word_chars > 15 * n_words then 32 else 0 end
            as bigint) as fail_bits
from j"""
