"""One query per operator, over its whole table, and SQL counterparts where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    bpe,
    bwt_dedup,
    conversation_repair,
    dart_minhash,
    line_dedup,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    topk,
    warc,
    word_windows,
)
from tidemark.llm.oracle import ORACLE
from tidemark.llm.workers import importable
from tidemark.session import workspace

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["kind"] != "novel")

    def shown(spans):
        one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(one, ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("found")).alias("spans"),
    )


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dart_minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return classes.select("doc_id", "class_id", "n_copies", "text_key")


def op3_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{workspace(spark, 'warc')}/archives"
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_archives(spark, path, payload=False))
    return captures.select(
        F.col("metadata.page_id").alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.type").alias("record_type"),
        F.col("metadata.refers_to_page").alias("refers_to"), F.col("request.record_id").isNotNull().alias("has_request"),
    )


def op4_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.remove_repeated_windows(_table(spark, sf_dir, "documents"), texts=False)


#: Names and weights of the mixing tree: a source's number tells its domain.
DOMAINS = {"web": range(0, 10), "books": range(10, 15), "code": range(15, 20)}
WEIGHTS = {
    ("web",): 0.5, ("books",): 0.3, ("code",): 0.2,
    **{(d, lang): w for d in DOMAINS for lang, w in (("en", 0.55), ("de", 0.15), ("fr", 0.15), ("es", 0.15))},
}


def mixing_levels() -> dict:
    number = F.expr("try_cast(regexp_extract(source, '[0-9]+$', 0) AS int)")
    domain = F.lit("other")
    for name, numbers in DOMAINS.items():
        domain = F.when(number.between(numbers.start, numbers.stop - 1), name).otherwise(domain)
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), mixing_levels(), WEIGHTS)
    path = F.col("mix_path")
    return mixed.select(
        "doc_id", path[0].alias("domain"), path[1].alias("lang"), path[2].alias("source"),
        F.col("mix_epoch").alias("epoch"),
    )


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_rules_failed",
    )


def op8_bwt_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_dedup.remove_repeated_bytes(_table(spark, sf_dir, "documents"), texts=False)


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(conversation_repair.damage(_table(spark, sf_dir, "conversations")))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = ngram_join.linked_groups(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "n_shingles", "component_id")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.path(PIECES))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_secret_scan, op2_dart_minhash, op3_warc_transactions, op4_word_windows, op5_mixing,
        op6_bpe_round_trip, op7_quality_rules, op8_bwt_byte_dedup, op9_top_k, op10_line_runs, op11_conversation_repair, op12_ngram_join, op13_token_alignment,
    )
}

__all__ = ["ORACLE", "QUERIES"]
