"""Corpus pipeline: toxicity, near-dedup, repeated-substring removal, source mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet under the shared checkpoint folder and reads again as the next
stage's input: a lost executor repeats one stage's tasks, not the pipeline.  All
stages but the last return the columns of documents.

Defined cases, beyond those of the operators: an empty table passes through
every stage with its columns; columns that a table has besides doc_id, text,
lang, source and n_chars are kept; rows without an id are kept by the filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm import byte_bpe, mixing, near_dedup, suffix_dedup, toxicity
from bourse.llm.common import table
from bourse.session import scratch_path


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that the toxicity model calls toxic; the model learns from the documents that are labelled."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least id, of each group of near copies (five words, 0.8).

    A row goes if ``link`` rejects it: another text under the same id is judged by itself.
    Rows without an id all stay."""
    gone = near_dedup.link(docs, digests=True).where(~F.col("kept")) \
        .select(F.col("doc_id").alias("_gone"), F.col("text_digest").alias("_gone_text")).distinct()
    rest = docs.join(gone, (F.col("doc_id") == F.col("_gone")) & (near_dedup.text_digest() == F.col("_gone_text")), "left_anti")
    return rest.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(rest.where("doc_id is null")).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts bytes of 50-byte strings that a document with a smaller id holds; a character cut through goes whole."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = suffix_dedup.remove(docs, carry=others, texts=True)
    new = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*(new.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Brings sources to their target weights: a document appears as often as the mix takes it, twice at most."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and the digests of the ids and of the bytes they decode to."""
    import public_tokenizers
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, ids=True)


STAGES = [
    ("toxicity", toxic_filter),
    ("near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The toxicity model and the sketches are not SQL; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{i}-{name}")
        docs = spark.read.parquet(f"{path}/{i}-{name}")
    return docs
