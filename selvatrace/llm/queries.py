"""The registered queries of the text operators: whole tables, production parameters, fixed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from selvatrace.llm import (
    conversations,
    decontaminate,
    divergence,
    html_text,
    language,
    mixing,
    packing,
    quality,
    quality_model,
    secret_scan,
    simhash,
    toxicity,
    urls,
)
from selvatrace.llm.common import bucket, pick

Query = Callable[[SparkSession, str], DataFrame]

#: Share of rows held out of training, and which.
FOLDS, LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 5, 4, 2
QUALITY_LIMIT, TOXICITY_LIMIT = 0.3, 0.5
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def vocabulary() -> str:
    """Ranks of the byte-level vocabulary, whose ids equal those of ``byte_bpe_50k.json``."""
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, d: str) -> DataFrame:
    out = html_text.extract(_table(spark, d, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op2_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    out = quality_model.classify(_table(spark, d, "documents"), _table(spark, d, "labels"))
    return out.select(
        "doc_id", (bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= QUALITY_LIMIT).cast("int").alias("predicted"),
    )


def op3_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    model = language.fit(docs, folds=LANGUAGE_FOLDS, held_out=LANGUAGE_HELD_OUT)
    held_out = (bucket(F.col("doc_id"), LANGUAGE_FOLDS) == LANGUAGE_HELD_OUT).alias("held_out")
    return language.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


def op4_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs = _table(spark, d, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, _table(spark, d, "labels"), folds=FOLDS))
    return out.select(
        "doc_id", (bucket(F.col("doc_id"), FOLDS) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= TOXICITY_LIMIT).cast("int").alias("predicted"),
    )


def op5_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, d, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secret_scan.BASE_KINDS))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k) for k in secret_scan.BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))


def op6_simhash(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, d, "documents"))


def op7_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    out = quality.cascade(_table(spark, d, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return out.select("doc_id", *quality.MEASURES, failed.alias("base_failed"), "kept")


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return urls.judge(_table(spark, d, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op9_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(_table(spark, d, "documents"), vocabulary())


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    out = decontaminate.contamination(_table(spark, d, "documents"), _table(spark, d, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_mixing(spark: SparkSession, d: str) -> DataFrame:
    out = mixing.mix(_table(spark, d, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "epochs")


def op12_divergence_audit(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(_table(spark, d, "documents"))


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` with faults that follow from a checksum of conversation and turn; ``n``: 0 for a row that is lost, 2 for
    one that is repeated, otherwise 1."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = F.crc32(name.cast("binary")) % 20
    return turns.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("n"),
    )


def op13_conversation_repair(spark: SparkSession, d: str) -> DataFrame:
    turns = damaged(pick(_table(spark, d, "conversations"), "conv_id", "turn", "role", "text"))
    return conversations.summary(turns, n="n")


def queries() -> dict[str, Query]:
    own = (
        op1_html_extraction, op2_quality_classifier, op3_language_id, op4_toxicity, op5_secret_scan, op6_simhash,
        op7_quality_rules, op8_url_filter, op9_packing, op10_decontamination,
        op11_mixing, op12_divergence_audit, op13_conversation_repair,
    )
    return {f.__name__: f for f in own}
