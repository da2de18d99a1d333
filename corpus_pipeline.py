"""A corpus from raw documents to token ids: each stage works on all that the one before it kept.

Every stage is ``(spark, docs, sf_dir) -> DataFrame``; its rows are written and read again as the next one's docs.
Classifiers learn from the labelled rows of the whole ``documents`` table, whatever earlier stages removed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from oreflow.llm import bytebpe, decontam, ngramjoin, quality, toxicity
from oreflow.sources.scratch import only_results, share_locally
from oreflow.sources.ship import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects."""
    ship_package(spark)
    return quality.without_poor(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the ordinal regression finds toxic."""
    ship_package(spark)
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"), _table(spark, sf_dir, "documents"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies."""
    ship_package(spark)
    return ngramjoin.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by benchmark items."""
    return decontam.without_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes what is left, and decodes it again."""
    ship_package(spark)
    return bytebpe.byte_bpe_digest(docs)


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_copies", no_near_copies),
    ("decontamination", no_benchmark),
    ("byte_bpe", encoded),
]

#: The classifiers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    share_locally(spark)
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with only_results(spark) as written:
            docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
