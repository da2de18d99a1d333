"""Two batches over the mapped source tables: the inputs that the catalog's queries share.

Batch 1 is the earlier snapshot, batch 2 the current one.  A query evaluates only the parts and columns it selects.
The keys that a parent's Silver holds are written once per scenario: children read that narrow table, and no plan
holds the chain of its ancestors.
"""

from __future__ import annotations

from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.columns import hash_hex
from oreflow.model import ENTITIES, RunContext
from oreflow.operators.bronze import fingerprint, fingerprint_by_key, stamp_lineage
from oreflow.operators.quality import valid_customers
from oreflow.operators.silver import missing_keys, promotable, rejected_rows, silver_merge
from oreflow.sources import testdata
from oreflow.sources.scratch import written

FIRST = RunContext("00000000-0000-4000-8000-0000000000a1", "00000000-0000-4000-8000-0000000000b1", datetime(2024, 2, 1))
SECOND = RunContext("00000000-0000-4000-8000-0000000000a2", "00000000-0000-4000-8000-0000000000b2", datetime(2024, 2, 2))
# An attempt at batch 2 that got only part of the way, before SECOND finished it.
INTERRUPTED = RunContext(
    "00000000-0000-4000-8000-0000000000a3", "00000000-0000-4000-8000-0000000000b2", datetime(2024, 2, 1, 12)
)
CONTEXTS = {1: FIRST, 2: SECOND}

# The rows the interrupted attempt had already handled.
HANDLED = {
    "customers": "phone < '555-2'",
    "products": "product_name < 'm'",
    "orders": "order_date < TIMESTAMP_NTZ '1996-01-01 00:00:00'",
    "order_items": "quantity < 25",
    "payments": "payment_date < TIMESTAMP_NTZ '1996-01-01 00:00:00'",
}

EMAIL_SUFFIX = "@example.test"


def shown(df: DataFrame) -> DataFrame:
    """Query output form: the binary fingerprint as lower-case hex."""
    return df.withColumn("record_hash", F.expr(hash_hex()))


def once(method):
    """Keep a method's result on its scenario, so that shared parts are one DataFrame."""

    @wraps(method)
    def kept(self, *args):
        memo, key = self.__dict__.setdefault("_memo", {}), (method.__name__, *args)
        if key not in memo:
            memo[key] = method(self, *args)
        return memo[key]

    return kept


class Scenario:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @once
    def source(self, entity: str, batch: int = 2) -> DataFrame:
        read = testdata.snapshot if batch == 2 else testdata.earlier_snapshot
        return read(self.spark, self.sf_dir, entity)

    @once
    def rows(self, entity: str, batch: int = 2) -> DataFrame:
        """Rows to land for a batch, customers validated, as the source has them."""
        rows = self.source(entity, batch)
        return valid_customers(rows) if entity == "customers" else rows

    @once
    def landed(self, entity: str, batch: int = 2) -> DataFrame:
        """Rows to land for a batch: fingerprinted, customers validated."""
        return fingerprint(self.rows(entity, batch), ENTITIES[entity])

    @once
    def batch(self, entity: str, batch: int = 2) -> DataFrame:
        return stamp_lineage(self.landed(entity, batch), CONTEXTS[batch])

    def bronze(self, entity: str) -> DataFrame:
        return self.batch(entity, 1).unionByName(self.batch(entity, 2))

    def interrupted_bronze(self, entity: str) -> DataFrame:
        """Bronze when batch 2 had been loaded only in part."""
        part = stamp_lineage(self.landed(entity).filter(HANDLED[entity]), INTERRUPTED)
        return self.batch(entity, 1).unionByName(part)

    def parents(self, entity: str, batch: int = 2) -> dict[str, DataFrame]:
        return {p.entity: self.silver_keys(p.entity, batch) for p in ENTITIES[entity].parents}

    @once
    def missing(self, entity: str, batch: int = 2) -> dict[str, DataFrame]:
        """For each parent the keys that a batch refers to and Silver does not hold, written once."""
        rows, parents = self.rows(entity, batch), self.parents(entity, batch)
        return {p.entity: written(missing_keys(rows, parents, p), f"missing-{entity}-{p.entity}-{batch}") for p in ENTITIES[entity].parents}

    @once
    def promotable(self, entity: str, batch: int = 2) -> DataFrame:
        return promotable(self.rows(entity, batch), self.parents(entity, batch), ENTITIES[entity], self.missing(entity, batch))

    @once
    def trusted(self, entity: str, batch: int = 2) -> DataFrame:
        return stamp_lineage(fingerprint(self.promotable(entity, batch), ENTITIES[entity]), CONTEXTS[batch])

    @once
    def keyed(self, entity: str, batch: int = 2) -> DataFrame:
        """``trusted`` for joins on the key; valid customers are dealt out by it already."""
        if entity == "customers":
            return self.trusted(entity, batch)
        return stamp_lineage(fingerprint_by_key(self.promotable(entity, batch), ENTITIES[entity]), CONTEXTS[batch])

    @once
    def merged(self, entity: str, batch: int = 2) -> DataFrame:
        before = self.silver(entity, 1) if batch == 2 else None
        return silver_merge(self.keyed(entity, batch), before, ENTITIES[entity], CONTEXTS[batch])

    @once
    def silver(self, entity: str, batch: int = 2) -> DataFrame:
        return self.merged(entity, batch).drop("merge_action")

    @once
    def silver_keys(self, entity: str, batch: int = 2) -> DataFrame:
        """What a child needs of its parent: the keys in Silver after a batch.  Nothing ever leaves Silver."""
        keys = self.promotable(entity, batch).select(ENTITIES[entity].key)
        if batch == 2:
            keys = keys.unionByName(self.silver_keys(entity, 1)).distinct()
        return written(keys, f"silver-keys-{entity}-{batch}")

    @once
    def rejected(self, entity: str) -> DataFrame:
        return rejected_rows(self.batch(entity), self.parents(entity), ENTITIES[entity], self.missing(entity))

    def held_quarantine(self, entity: str) -> DataFrame:
        """Evidence the interrupted attempt left behind."""
        return self.rejected(entity).filter(HANDLED[entity]).withColumn("batch_id", F.lit(INTERRUPTED.batch_id))

    # --- logs ---

    def runs(self) -> DataFrame:
        return testdata.pipeline_runs(self.spark, self.sf_dir)

    def stages(self) -> DataFrame:
        return testdata.stage_runs(self.spark, self.sf_dir)

    def events(self) -> DataFrame:
        return testdata.pipeline_events(self.spark, self.sf_dir)

    def quarantined_customers(self) -> DataFrame:
        return testdata.customer_quarantine(self.spark, self.sf_dir)
