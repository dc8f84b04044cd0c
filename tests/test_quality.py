"""Rule flag / reason / split semantics (C0-C7) on hand-written quote rows."""

import json

from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from bourse.operators import quality

RULES = quality.RuleSet("t", (("a_pos", "a > 0"), ("b_set", "b IS NOT NULL")),
                        (("a_small", "a < 100 OR a IS NULL"),))
SCHEMA = "id int, a double, b string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_flag_three_valued(spark):
    df = _rows(spark, [(1, 5.0, "x"), (2, -1.0, "x"), (3, None, "x"), (4, None, None), (5, 5.0, None)])
    out = {r.id: (r.is_quarantined, r.quarantine_reason)
           for r in quality.apply_rules(df, RULES).collect()}
    assert out[1] == (False, "")
    assert out[2] == (True, "a_pos has failed")
    assert out[3] == (None, "")              # unknown, none false: NULL verdict, empty reason
    assert out[4] == (True, "b_set has failed")
    assert out[5] == (True, "b_set has failed")


def test_fail_policy_quarantines_unknown(spark):
    df = _rows(spark, [(3, None, "x"), (4, None, None)])
    out = {r.id: (r.is_quarantined, r.quarantine_reason)
           for r in quality.apply_rules(df, RULES, null_policy="fail").collect()}
    assert out[3] == (True, "a_pos has failed")
    assert out[4] == (True, "a_pos has failed, b_set has failed")


def test_rules_are_parenthesised(spark):
    r = quality.RuleSet("t", (("or_rule", "a > 0 OR a < -10"), ("b_set", "b IS NOT NULL")))
    df = _rows(spark, [(1, -20.0, None)])
    row = quality.apply_rules(df, r).collect()[0]
    # without parentheses "a > 0 OR a < -10 AND b IS NOT NULL" would pass
    assert row.is_quarantined is True


def test_split_is_a_partition(spark):
    df = _rows(spark, [(1, 5.0, "x"), (2, -1.0, "x"), (3, None, "x")])
    s = quality.split(quality.apply_rules(df, RULES))
    assert [r.id for r in s.valid.collect()] == [1]
    assert "is_quarantined" not in s.valid.columns
    assert [r.id for r in s.quarantine.collect()] == [2]
    assert [r.id for r in s.undecided.collect()] == [3]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-5, 5, allow_nan=False)),
                          st.one_of(st.none(), st.just("x"))), max_size=25))
def test_split_counts_add_up_property(spark, rows):
    df = _rows(spark, [(i, a, b) for i, (a, b) in enumerate(rows)])
    s = quality.split(quality.apply_rules(df, RULES))
    assert s.valid.count() + s.quarantine.count() + s.undecided.count() == len(rows)
    # reason empty <=> no rule false
    for r in quality.apply_rules(df, RULES).collect():
        assert (r.quarantine_reason == "") == (r.is_quarantined is not True)


def test_expectation_counts(spark):
    df = _rows(spark, [(1, 5.0, "x"), (2, -1.0, "x"), (3, None, None), (4, 500.0, "y")])
    got = {(r.severity, r.rule): (r.passed, r.failed, r.unknown)
           for r in quality.expectation_counts(df, RULES).collect()}
    assert got[("critical", "a_pos")] == (2, 1, 1)
    assert got[("critical", "b_set")] == (3, 1, 0)
    assert got[("warn", "a_small")] == (3, 1, 0)


def test_observe_rules_batch(spark):
    from pyspark.sql import Observation
    df = _rows(spark, [(1, 5.0, "x"), (2, -1.0, None)])
    obs = Observation("dq")
    df.observe(obs, *quality._count_aggs(RULES)).collect()
    rows = quality.observed_to_rows(RULES, obs.get)
    assert rows[0] == {"severity": "critical", "rule": "a_pos", "passed": 1, "failed": 1, "unknown": 0}


def test_load_rules_from_file_keeps_order(tmp):
    p = f"{tmp}/rules.json"
    with open(p, "w") as f:
        json.dump({"ds": {"critical": {"z": "a > 0", "a": "b > 0"}, "warn": {}}}, f)
    r = quality.load_rules("ds", p)
    assert [n for n, _ in r.critical] == ["z", "a"]


def test_builtin_catalog_has_nine_datasets():
    from bourse.rules.catalog import CATALOG
    assert len(CATALOG) == 9
    q = quality.load_rules("quote")
    assert [n for n, _ in q.critical] == ["symbol_not_null", "close_price_positive",
                                         "event_timestamp_not_null"]


def test_rule_with_digit_leading_column(spark):
    r = quality.load_rules("metric_snapshot")
    df = spark.createDataFrame([(10.0, 5.0)], "`52WeekHigh` double, `52WeekLow` double")
    got = df.select(F.expr("(52WeekHigh >= 52WeekLow)").alias("ok")).collect()[0].ok
    assert got is True
    assert any("52WeekHigh" in s for _, s in r.warn)


def test_scale_conf_bounds():
    from bourse.session import scale_conf
    big = scale_conf(100 * 10**12)
    assert int(big["spark.sql.shuffle.partitions"]) * int(big["spark.sql.files.maxPartitionBytes"]) >= 100 * 10**12
    assert scale_conf(10**9)["spark.sql.shuffle.partitions"] == "200"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats(-5, 200, allow_nan=False)),
                          st.one_of(st.none(), st.just("x"))), max_size=25))
def test_verdict_bits_give_flag_reason_and_counts(spark, rows):
    df = _rows(spark, [(i, a, b) for i, (a, b) in enumerate(rows)])
    judged = quality.judge(df, RULES)
    for policy in ("sql", "fail"):
        def key(t):
            return sorted(map(tuple, t.collect()))
        assert key(quality.apply_verdicts(judged, RULES, null_policy=policy)) == key(quality.apply_rules(df, RULES, null_policy=policy))
    assert quality.verdict_counts(judged, RULES).collect() == quality.expectation_counts(df, RULES).collect()


def test_verdict_bits_of_more_rules_than_one_word(spark):
    many = quality.RuleSet("t", tuple((f"r{i}", f"a > {i}") for i in range(70)), (("w", "b IS NOT NULL"),))
    df = _rows(spark, [(1, 100.0, "x"), (2, 64.5, None), (3, None, "x"), (4, 30.0, "x")])
    judged = quality.judge(df, many)
    for policy in ("sql", "fail"):
        assert quality.apply_verdicts(judged, many, null_policy=policy).collect() == quality.apply_rules(df, many, null_policy=policy).collect()
    assert quality.verdict_counts(judged, many).collect() == quality.expectation_counts(df, many).collect()
    none = quality.RuleSet("t", ())
    assert quality.apply_verdicts(quality.judge(df, none), none).collect() == quality.apply_rules(df, none).collect()


def test_each_rule_stands_once_in_the_plan(spark):
    rules = quality.RuleSet("t", (("even", "a % 4321 = 0"), ("b_set", "length(b) < 8765")), (("small", "a + 9876 < 1"),))
    df = spark.range(10).selectExpr("cast(id as double) a", "cast(id as string) b")
    out = quality.apply_verdicts(quality.judge(df, rules), rules)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert [plan.count(x) for x in ("4321", "8765")] == [1, 1]
