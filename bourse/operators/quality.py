"""Rule-driven data quality (flag, reason, three-way split, expectation metrics).

A rule is a named SQL boolean.  A ``RuleSet`` holds the critical rules (they
decide quarantine) and the warn rules (only counted).  Everything is one
``Project`` over the input: no extra scan, no shuffle, and Catalyst pushes a
``flag = false`` filter down into the scan as the conjunction of the rules.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.rules.catalog import CATALOG


@dataclass(frozen=True)
class RuleSet:
    dataset: str
    critical: tuple[tuple[str, str], ...]
    warn: tuple[tuple[str, str], ...] = ()

    @classmethod
    def from_dict(cls, dataset: str, d: dict) -> "RuleSet":
        return cls(dataset,
                   tuple((k, v) for k, v in (d.get("critical") or {}).items()),
                   tuple((k, v) for k, v in (d.get("warn") or {}).items()))

    def all_rules(self) -> list[tuple[str, str, str]]:
        return ([("critical", n, s) for n, s in self.critical]
                + [("warn", n, s) for n, s in self.warn])


def load_rules(dataset: str, path: str | None = None) -> RuleSet:
    """Rules of one dataset from a JSON catalog file, or from the built-in one.

    The catalog shape is ``{dataset: {"critical": {name: sql}, "warn": {...}}}``;
    catalog order is kept (it is the order of reasons).
    """
    if path is None:
        cat = CATALOG
    else:
        with open(path) as f:
            cat = json.load(f)
    if dataset not in cat:
        raise KeyError(f"no rules for dataset {dataset!r}")
    return RuleSet.from_dict(dataset, cat[dataset])


def _rule(sql: str) -> Column:
    # each rule is its own parenthesised expression, so a rule holding a
    # top-level OR cannot bind to its neighbours
    return F.expr(f"({sql})")


def flag_column(rules: RuleSet, null_policy: str = "sql") -> Column:
    """TRUE when a critical rule fails.

    null_policy="sql":  NOT(r1 AND r2 ...) with SQL three-valued logic; a row
                        whose rules are all true or unknown (none false) and
                        at least one unknown gets NULL.
    null_policy="fail": an unknown rule counts as failed (flag never NULL).
    """
    if not rules.critical:
        return F.lit(False)
    if null_policy == "sql":
        conj = None
        for _, s in rules.critical:
            conj = _rule(s) if conj is None else (conj & _rule(s))
        return ~conj
    if null_policy == "fail":
        conj = None
        for _, s in rules.critical:
            r = F.coalesce(_rule(s), F.lit(False))
            conj = r if conj is None else (conj & r)
        return ~conj
    raise ValueError(f"null_policy must be 'sql' or 'fail', not {null_policy!r}")


def reason_column(rules: RuleSet, null_policy: str = "sql") -> Column:
    """'<rule> has failed' for each failed critical rule, joined by ', ', in
    catalog order; '' (not NULL) when nothing failed."""
    parts = []
    for name, s in rules.critical:
        failed = ~_rule(s) if null_policy == "sql" else ~F.coalesce(_rule(s), F.lit(False))
        parts.append(F.when(failed, F.lit(f"{name} has failed")))
    if not parts:
        return F.lit("")
    return F.concat_ws(", ", *parts)


def apply_rules(df: DataFrame, rules: RuleSet, flag_col: str = "is_quarantined",
                reason_col: str = "quarantine_reason", null_policy: str = "sql") -> DataFrame:
    """Add the flag and reason columns (C1, C2; C7 with flag_col='is_critical')."""
    return df.withColumns({flag_col: flag_column(rules, null_policy),
                           reason_col: reason_column(rules, null_policy)})


class Split(NamedTuple):
    valid: DataFrame
    quarantine: DataFrame
    undecided: DataFrame


def split(flagged: DataFrame, flag_col: str = "is_quarantined",
          reason_col: str = "quarantine_reason") -> Split:
    """Three disjoint branches that together hold every input row.

    valid:      flag = false, flag and reason dropped (C3)
    quarantine: flag = true, flag and reason kept (C4)
    undecided:  flag NULL (C5) -- rows both filters above would lose
    """
    f = F.col(flag_col)
    return Split(flagged.filter(f == F.lit(False)).drop(flag_col, reason_col),
                 flagged.filter(f == F.lit(True)),
                 flagged.filter(f.isNull()))


def keep_passing(flagged: DataFrame, flag_col: str = "is_critical") -> DataFrame:
    """Rows of a flag-and-keep table whose flag is false (C7 consumers)."""
    return flagged.filter(F.col(flag_col) == F.lit(False))


def _count_aggs(rules: RuleSet) -> list[Column]:
    aggs = []
    for i, (sev, name, s) in enumerate(rules.all_rules()):
        r = _rule(s)
        aggs += [F.count_if(r).alias(f"p{i}"), F.count_if(~r).alias(f"f{i}"),
                 F.count_if(r.isNull()).alias(f"u{i}")]
    return aggs


def expectation_counts(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Pass / fail / unknown counts per rule, one row per rule.

    One global aggregate over the input: every task reduces its rows to one
    partial row, so the shuffle carries one row per task whatever the size.
    """
    wide = df.agg(*_count_aggs(rules))
    rows = rules.all_rules()
    stack = ", ".join(
        f"'{sev}', '{name}', p{i}, f{i}, u{i}" for i, (sev, name, _) in enumerate(rows))
    return wide.selectExpr(
        f"stack({len(rows)}, {stack}) as (severity, rule, passed, failed, unknown)")


def observe_rules(df: DataFrame, rules: RuleSet, name: str = "expectations") -> DataFrame:
    """Attach the same counters as ``expectation_counts`` as observed metrics.

    Works on batch and streaming DataFrames and never drops rows; a stream
    reports them in ``query.lastProgress['observedMetrics'][name]``.
    """
    return df.observe(name, *_count_aggs(rules))


def observed_to_rows(rules: RuleSet, metrics: dict) -> list[dict]:
    """Turn an observed-metrics row back into one dict per rule."""
    out = []
    for i, (sev, n, _) in enumerate(rules.all_rules()):
        out.append({"severity": sev, "rule": n, "passed": metrics.get(f"p{i}"),
                    "failed": metrics.get(f"f{i}"), "unknown": metrics.get(f"u{i}")})
    return out


# --- one evaluation per rule ---------------------------------------------------

VERDICT = "rule_verdicts"
PER_WORD = 31                   # rules in one long, two bits each
PASSED, FAILED, UNKNOWN = 0, 1, 2


def judge(df: DataFrame, rules: RuleSet, out: str = VERDICT) -> DataFrame:
    """Evaluates every rule, critical and warn, once; adds what came out as bits (C1, C2, C6 in one pass).

    ``out`` is an array of longs with two bits a rule, in the order of ``all_rules``:
    passed 0, failed 1, unknown 2, so a row that passes everything holds zeros.  Flag,
    reason, split and counts are read from the bits; a table that stores the column
    needs no rule again.  ``null`` never stands in it; without rules it is empty.
    """
    codes = [F.coalesce((~_rule(s)).cast("long"), F.lit(UNKNOWN).cast("long")) for _, _, s in rules.all_rules()]
    words = []
    for at in range(0, len(codes), PER_WORD):
        word = None
        for i, code in enumerate(codes[at:at + PER_WORD]):
            bits = F.shiftleft(code, 2 * i) if i else code
            word = bits if word is None else word.bitwiseOR(bits)
        words.append(word)
    return df.withColumn(out, F.array(*words) if words else F.array().cast("array<bigint>"))


def _code(i: int, verdict: str) -> Column:
    return F.shiftright(F.get(verdict, F.lit(i // PER_WORD)), 2 * (i % PER_WORD)).bitwiseAND(F.lit(3))


def _any_critical(rules: RuleSet, verdict: str, code: int) -> Column:
    """Whether a critical rule came out as ``code``: one mask and compare per word."""
    found = F.lit(False)
    n = len(rules.critical)
    for w in range(-(-n // PER_WORD)):
        mask = sum(code << 2 * i for i in range(min(PER_WORD, n - w * PER_WORD)))
        found = found | (F.get(verdict, F.lit(w)).bitwiseAND(F.lit(mask).cast("long")) != 0)
    return found


def judged_flag(rules: RuleSet, null_policy: str = "sql", verdict: str = VERDICT) -> Column:
    """``flag_column`` from the bits."""
    failed, unknown = _any_critical(rules, verdict, FAILED), _any_critical(rules, verdict, UNKNOWN)
    if null_policy == "fail":
        return failed | unknown
    if null_policy == "sql":
        return F.when(failed, F.lit(True)).when(unknown, F.lit(None).cast("boolean")).otherwise(F.lit(False))
    raise ValueError(f"null_policy must be 'sql' or 'fail', not {null_policy!r}")


def judged_reason(rules: RuleSet, null_policy: str = "sql", verdict: str = VERDICT) -> Column:
    """``reason_column`` from the bits."""
    parts = []
    for i, (name, _) in enumerate(rules.critical):
        failed = _code(i, verdict) == FAILED if null_policy == "sql" else _code(i, verdict) != PASSED
        parts.append(F.when(failed, F.lit(f"{name} has failed")))
    return F.concat_ws(", ", *parts) if parts else F.lit("")


def apply_verdicts(judged: DataFrame, rules: RuleSet, flag_col: str = "is_quarantined", reason_col: str = "quarantine_reason",
                   null_policy: str = "sql", verdict: str = VERDICT) -> DataFrame:
    """``apply_rules`` of a judged table; its bits are dropped."""
    return judged.withColumns({flag_col: judged_flag(rules, null_policy, verdict),
                               reason_col: judged_reason(rules, null_policy, verdict)}).drop(verdict)


def verdict_counts(judged: DataFrame, rules: RuleSet, verdict: str = VERDICT) -> DataFrame:
    """``expectation_counts`` of a judged table: the same rows, from the bits alone."""
    rows = rules.all_rules()
    aggs = [F.count_if(_code(i, verdict) == code).alias(f"{c}{i}")
            for i in range(len(rows)) for c, code in (("p", PASSED), ("f", FAILED), ("u", UNKNOWN))]
    stack = ", ".join(f"'{sev}', '{name}', p{i}, f{i}, u{i}" for i, (sev, name, _) in enumerate(rows))
    return judged.agg(*aggs).selectExpr(f"stack({len(rows)}, {stack}) as (severity, rule, passed, failed, unknown)")
