r"""Operator 2: URL filter, rules first and gradient-boosted trees for the rest.

Host and path are cut out of the url with one regular expression; rules fit a
host and its subdomains when the path starts with the rule's, longest rule
first.  Urls that a rule decides are labelled urls; the trees learn block / allow
from a bounded sample of them and judge the urls no rule fits, by lexical
features only: lengths, depth, digit ratio, character entropy of the host,
parameter counts, and how often labelled urls with the same host suffix, or the
same first path segment, were blocked.  Those counts are over all distinct
labelled urls, less the url itself; only the rows that the trees are fitted on are a sample.
Everything is DataFrame expressions and the DataFrame-based ML library; no
Python runs on executors.

Defined cases: a NULL url or one without ``://`` has empty host and path, no rule,
and is judged by the trees; when the labelled urls hold no or only one class,
the verdict is that class, or allow without any; repeated rows get the same
verdict; very long urls are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import table
from bourse.session import scratch_path

#: (host, path prefix, verdict), given
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
#: Labelled urls that the trees are fitted on, at most; the lowest hashes of the distinct urls are taken.
TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 10, 3, 7
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
FEATURES = ("url_len", "host_len", "path_len", "depth", "labels", "digit_ratio", "dashes", "entropy", "params",
            "suffix_rate_others", "suffix_n_others", "section_rate_others", "section_n_others")
#: Keys whose block rate among the labelled urls is a feature: last host label, first path segment.
RATED = ("suffix", "section")


def parts(pages: DataFrame) -> DataFrame:
    """page_id, url, host, path."""
    url = F.coalesce(F.col("url"), F.lit(""))
    return pages.select(
        "page_id", url.alias("url"),
        F.translate(F.regexp_extract(url, URL, 1), string.ascii_uppercase, string.ascii_lowercase).alias("host"),
        F.regexp_extract(url, URL, 2).alias("path"))


def fitting_rule(rules=RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, NULL without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest ends up outermost
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def entropy(c: Column) -> Column:
    """Shannon entropy of a string's characters, in bits."""
    chars = F.filter(F.split(c, ""), lambda x: x != "")
    n = F.greatest(F.size(chars), F.lit(1))
    return F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda acc, x: acc - (F.size(F.filter(chars, lambda y: y == x)) / n) * F.log2(F.size(F.filter(chars, lambda y: y == x)) / n))


def keys() -> list[Column]:
    """The columns RATED of a row with host and path."""
    return [F.regexp_extract("host", r"([^.]*)$", 1).alias("suffix"), F.regexp_extract("path", r"^/([^/]*)", 1).alias("section")]


def lexical(p: DataFrame) -> DataFrame:
    """Adds the features that need no labels, and the host's suffix."""
    count = lambda c, pattern: F.regexp_count(F.col(c), F.lit(pattern)).cast("double")
    length = F.length("url").cast("double")
    return p.select(
        "*", length.alias("url_len"), F.length("host").cast("double").alias("host_len"),
        F.length("path").cast("double").alias("path_len"), count("path", "/").alias("depth"),
        count("host", r"\.").alias("labels"), (count("url", "[0-9]") / F.greatest(length, F.lit(1.0))).alias("digit_ratio"),
        count("url", "[-_]").alias("dashes"), entropy(F.col("host")).alias("entropy"), count("url", r"[?&][^=&#]*=").alias("params"),
        *keys())


def _scored(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, held: Column | None = None) -> DataFrame:
    """Every page with rule, rule_verdict and tree_verdict; labelled urls for which ``held`` is true teach nothing."""
    rule, verdict = fitting_rule(rules)
    ruled = parts(pages).select("*", rule.alias("rule"), verdict.alias("rule_verdict"))
    teaches = F.col("rule").isNotNull() if held is None else F.col("rule").isNotNull() & ~held
    ruled = ruled.withColumn("teaches", teaches)
    labelled = ruled.where("teaches").select("url", "host", "path", "rule_verdict", "teaches").distinct()
    sample = labelled.orderBy(F.xxhash64("url"), "url").limit(train_rows)  # a top-k: bounded, the same on every run
    train = lexical(sample).withColumn("label", (F.col("rule_verdict") == "block").cast("double")).persist()
    try:
        seen = [r["label"] for r in train.select("label").distinct().collect()]
        if len(seen) < 2:
            return ruled.withColumn("tree_verdict", F.lit("block" if seen == [1.0] else "allow"))

        # counted over all labelled urls: one row a key, as many as the data has, so written out and never forced into a broadcast
        path = scratch_path(pages.sparkSession, "url-rates")
        counted = labelled.select("rule_verdict", *keys()).groupBy("suffix", "section") \
            .agg(F.sum((F.col("rule_verdict") == "block").cast("long")).alias("blocked"), F.count("*").alias("n"))
        counted.write.parquet(f"{path}/both")
        for key in RATED:
            pages.sparkSession.read.parquet(f"{path}/both").groupBy(key) \
                .agg(F.sum("blocked").alias(f"{key}_blocked"), F.sum("n").alias(f"{key}_all")).write.parquet(f"{path}/{key}")

        def featured(x: DataFrame) -> DataFrame:
            """Adds the keys' rates over all labelled urls, and over all others, which are the features: a url's own label is none."""
            own = F.col("teaches").cast("long")
            own_block = own * (F.coalesce("rule_verdict", F.lit("")) == "block").cast("long")
            for key in RATED:
                x = x.join(pages.sparkSession.read.parquet(f"{path}/{key}"), key, "left").fillna({f"{key}_blocked": 0, f"{key}_all": 0})
                blocked, n = F.col(f"{key}_blocked"), F.col(f"{key}_all")
                x = x.withColumns({f"{key}_rate": (blocked + 1) / (n + 2), f"{key}_n": F.log1p(n),
                                   f"{key}_rate_others": (blocked - own_block + 1) / (n - own + 2), f"{key}_n_others": F.log1p(n - own)}) \
                    .drop(f"{key}_blocked", f"{key}_all")
            return x

        to_vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", featuresCol="features",
                               predictionCol="tree_block").fit(to_vector.transform(featured(train).coalesce(1)))
    finally:
        train.unpersist()
    scored = fitted.transform(to_vector.transform(featured(lexical(ruled))))
    return scored.withColumn("tree_verdict", F.when(F.col("tree_block") > 0.5, "block").otherwise("allow"))


def judge(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict, by_rule."""
    return _scored(pages, rules, train_rows).select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", "tree_verdict").alias("verdict"), F.col("rule").isNotNull().alias("by_rule"))


def held_out(pages: DataFrame, rules=RULES, train_rows: int = TRAIN_ROWS, folds: int = 5) -> DataFrame:
    """rule_verdict, tree_verdict, n: what trees that saw none of a fifth of the labelled hosts say about those hosts' urls."""
    held = F.pmod(F.crc32(F.col("host").cast("binary")), F.lit(folds)) == 0
    return _scored(pages, rules, train_rows, held).where(F.col("rule").isNotNull() & ~F.col("teaches")) \
        .groupBy("rule_verdict", "tree_verdict").agg(F.count("*").alias("n"))


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("by_rule")
