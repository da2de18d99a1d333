"""The subpackage's queries ``(spark, sf_dir) -> DataFrame`` by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.llm import (
    bytebpe,
    decontam,
    langid,
    merkle,
    ngramjoin,
    preference,
    quality,
    simhash,
    tokencount,
    tokenfile,
    topk,
    toxicity,
    vectorcodes,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_ids(_table(spark, sf_dir, "documents"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similar(_table(spark, sf_dir, "documents")).drop("key")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(_table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.byte_bpe_digest(_table(spark, sf_dir, "documents"))


def op9_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = preference.preferences(preference.swapped_replies(_table(spark, sf_dir, "conversations")))
    return found.withColumns({x: preference.spans_text(x) for x in ("chosen_spans", "rejected_spans")})


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.vector_codes(_table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(_table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_ids": op1_token_ids,
        "op2_top_k": op2_top_k,
        "op3_ngram_join": op3_ngram_join,
        "op4_token_counts": op4_token_counts,
        "op5_decontaminate": op5_decontaminate,
        "op6_quality": op6_quality,
        "op7_language": op7_language,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_preferences": op9_preferences,
        "op10_toxicity": op10_toxicity,
        "op11_vector_codes": op11_vector_codes,
        "op12_simhash": op12_simhash,
        "op13_merkle": op13_merkle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_top_k": topk.SQL,
        "op3_ngram_join": ngramjoin.SQL,
        "op5_decontaminate": decontam.SQL,
        "op9_preferences": preference.SQL,
        "op11_vector_codes": vectorcodes.SQL,
        "op13_merkle": merkle.SQL,
    }
