"""The corpus pipeline: documents in, token ids out, in five stages.

Each stage is written as Parquet and read again as the next one's documents. All but the last return
the columns of ``documents``. Rows are told apart by doc_id and text, so a doc_id may stand on several texts, or be null.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, dart_minhash, line_dedup, mixing, quality
from tidemark.llm.queries import VOCABULARY, WEIGHTS, mixing_levels
from tidemark.llm.workers import importable
from tidemark.session import workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; cutoffs are set on the labelled ones among them."""
    importable(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = quality.quality_verdicts(docs, labels).filter("kept").select(
        F.col("doc_id").alias("_kept_id"), F.col("tie").alias("_kept_tie")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (F.xxhash64("text") == F.col("_kept_tie"))
    return docs.join(kept, same, "left_semi")


def drop_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated lines; what has no line left goes."""
    kept = line_dedup.drop_repeated_lines(docs)
    some = (F.col("n_removed") == 0) | (F.trim(F.translate("kept_text", "\t\n\r\x0b\x0c", "")) != "")
    return kept.filter(some).withColumns(
        {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    ).select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that of its chosen text. Repeated rows are copies."""
    importable(spark)
    chosen = dart_minhash.near_duplicates(docs).filter("chosen").select(
        F.col("doc_id").alias("_chosen_id"), F.col("tie").alias("_chosen_tie")
    ).distinct()
    told = docs.withColumn("_tie", F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_chosen_id")) & (F.col("_tie") == F.col("_chosen_tie"))
    return told.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "_tie"]).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of the mixing tree; a repeated epoch repeats its rows."""
    importable(spark)
    return mixing.mix(docs, mixing_levels(), WEIGHTS).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row."""
    importable(spark)
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("line_runs", drop_line_runs),
    ("near_duplicates", keep_one_of_each_class),
    ("mixing", mix_sources),
    ("bpe", to_tokens),
]
#: The binomial bounds, signatures, budgets and ids are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = workspace(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{root}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
