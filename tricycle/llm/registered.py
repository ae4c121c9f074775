"""Registered queries of the text operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tricycle.llm import lm
from tricycle.llm import quality as ranking
from tricycle.llm import sql
from tricycle.llm import toxicity as toxic
from tricycle.llm.ann import nearest_neighbours
from tricycle.llm.decontaminate import contamination
from tricycle.llm.filter_audit import audit
from tricycle.llm.minhash import near_duplicates
from tricycle.llm.mixing import sampled_mix
from tricycle.llm.resharding import resharded, text_size, with_slots
from tricycle.llm.secrets import secrets, span_text
from tricycle.llm.tokens import token_counts
from tricycle.llm.warc import captures, header_text, resolved_revisits
from tricycle.llm.whitening import whitened


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_scores(_table(spark, sf_dir, "documents"), lm.held_out())


def op2_adaptive_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ranking.fit(docs, _table(spark, sf_dir, "labels"))
    return ranking.quality(docs, model).select(
        "doc_id", ranking.held_out().alias("held_out"), "score", F.expr("int(score >= 0.3)").alias("predicted")
    )


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        *[
            F.expr(f"CAST(size(filter(spans, s -> s.kind = {k})) AS LONG)").alias(f"n_{name}")
            for k, name in enumerate(("assign", "access", "hex"))
        ],
        F.sha2(span_text("spans", 3), 256).alias("base_sha256"),
        span_text("spans").alias("spans"),
    )


def op7_revisit_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = resolved_revisits(captures(_table(spark, sf_dir, "pages")))
    return found.withColumn("headers", header_text("headers"))


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = toxic.fit(docs, _table(spark, sf_dir, "labels"))
    return toxic.toxicity(docs, model).select(
        "doc_id",
        toxic.held_out().alias("held_out"),
        "score",
        F.expr("int(score >= 0.3)").alias("predicted"),
        "threshold",
        "rejected",
    )


def op9_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_mix(_table(spark, sf_dir, "documents")).drop("copies")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op11_spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 32 old shards, in which each source has four, to 40 of equal bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    old = F.concat_ws(":", F.coalesce("source", F.lit("")), F.coalesce(F.col("doc_id") % 4, F.lit(0)).cast("string"))
    rows = _table(spark, sf_dir, "documents").select(
        "doc_id",
        text_size(text, 16).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.crc32(old.cast("binary")) % 32).cast("int").alias("old_shard"),
    )
    return with_slots(resharded(rows, 40)).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_backoff_automaton,
        op2_adaptive_ann,
        op3_quality_ranking,
        op4_minhash_near_dedup,
        op5_token_counts,
        op6_secret_scan,
        op7_revisit_resolution,
        op8_toxicity_cnn,
        op9_pareto_mix,
        op10_benchmark_decontamination,
        op11_spectral_whitening,
        op12_filter_audit,
        op13_flow_resharding,
    )
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        op6_secret_scan.__name__: sql.secret_scan(),
        op7_revisit_resolution.__name__: sql.revisits(),
        op9_pareto_mix.__name__: sql.mixing(),
        op10_benchmark_decontamination.__name__: sql.decontamination(),
        op12_filter_audit.__name__: sql.filter_audit(),
    }
