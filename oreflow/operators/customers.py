"""Queries over the customer tables: latest version per id, ordered extract, fingerprint lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.columns import guid_sort_key
from oreflow.model import CUSTOMERS


def latest_customers(bronze: DataFrame, guid_order: bool = False) -> DataFrame:
    return latest_versions(bronze, CUSTOMERS.key, guid_order)


def latest_versions(bronze: DataFrame, key: str, guid_order: bool = False) -> DataFrame:
    """Newest Bronze version per id; equal load times fall back to the batch id.

    Batch ids compare as text, or with ``guid_order`` the way SQL Server compares a uniqueidentifier.

    The rank limit of 1 is applied inside each input partition before the shuffle, so that an id with very
    many versions sends one row per task.
    """
    batch = F.expr(guid_sort_key("batch_id")) if guid_order else F.col("batch_id")
    newest = Window.partitionBy(key).orderBy(F.desc("ingested_at"), batch.desc())
    return bronze.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def ordered(df: DataFrame, key: str) -> DataFrame:
    """Key order.  The other columns and a salt break ties, so that the range partitioner can split a hot key

    even into equal rows.  The salt is seeded and drawn over the scan: a repeated task draws the same.
    """
    rest = [c for c in df.columns if c != key]
    return df.withColumn("_salt", F.rand(0)).orderBy(key, *rest, "_salt").drop("_salt")


def email_suffix(suffix: str) -> Column:
    return F.col("email").endswith(suffix) & F.col("record_hash").isNotNull()


def silver_hash_lookup(latest: DataFrame, silver: DataFrame, suffix: str) -> DataFrame:
    """How the latest Bronze versions compare with Silver: one join instead of one lookup per customer."""
    wanted = latest.filter(email_suffix(suffix)).select(CUSTOMERS.key, "record_hash")
    held = silver.select(F.col(CUSTOMERS.key).alias("_key"), F.col("record_hash").alias("_hash"))
    return wanted.join(held, F.col(CUSTOMERS.key) == F.col("_key"), "left").agg(
        F.count("*").alias("customers_checked"),
        F.count_if(F.col("record_hash") == F.col("_hash")).alias("matching"),
        F.count_if(F.col("record_hash") != F.col("_hash")).alias("differing"),
        F.count_if(F.col("_key").isNull()).alias("missing"),
    )
