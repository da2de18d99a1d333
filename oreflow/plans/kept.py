"""Latest versions kept up to date: the newest Bronze version per key as a table that takes in what was landed since.

The newest version is a maximum, so state and new rows merge in any order, and a batch that comes late finds its place.
A refresh asks the ledger of Bronze for the writes that the state does not hold yet, reads these alone, and of the state
only the buckets with one of their keys; the paths of older writes stay where they are.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.model import CUSTOMERS, EntitySpec, RunContext
from oreflow.operators.customers import latest_versions
from oreflow.sources.warehouse import Warehouse


def latest_spec(spec: EntitySpec) -> EntitySpec:
    """The kept table: a Bronze row for each key, in buckets like Silver's."""
    lineage = {"pipeline_run_id": "STRING", "batch_id": "STRING"}
    return replace(
        spec, name=f"{spec.name}_latest", columns={**spec.columns, **lineage}, rules=(), list_rules=(), parents=(),
        required_in_silver=(), unset_in_silver=(), checked_before_bronze=False, processor=None,
    )


def refresh_latest(warehouse: Warehouse, ctx: RunContext, spec: EntitySpec = CUSTOMERS, guid_order: bool = False) -> int:
    """Bring the kept versions up to what Bronze has published; returns the number of writes taken in.

    The state becomes current before its writes are marked as taken in.  Dying in between, the next refresh takes
    them in again, which changes nothing.
    """
    kept = latest_spec(spec)
    done = warehouse.log("kept_ledger", kept.name).select("path")
    landed = warehouse.log("bronze_ledger").filter(F.col("entity") == spec.name).select("path")
    paths = [row.path for row in landed.join(done, "path", "left_anti").distinct().collect()]
    if not paths:
        return 0
    arrived = latest_versions(warehouse.bronze_writes(spec, paths), spec.key, guid_order)
    arrived = warehouse.stage(kept.name, ctx, arrived)
    buckets = warehouse.touched_buckets(kept, arrived)
    held = latest_bronze(warehouse, spec, buckets)
    newest = arrived if held is None else latest_versions(held.unionByName(arrived), spec.key, guid_order)
    rows = newest.select(
        *kept.columns, "record_hash", F.col("ingested_at").alias("source_ingested_at"), F.lit(ctx.at).cast("timestamp_ntz").alias("processed_at")
    )
    warehouse.publish_silver(kept, ctx, rows, {"rows_inserted": arrived.count(), "rows_updated": 0}, buckets)
    warehouse.append_log("kept_ledger", [(kept.name, path) for path in paths])
    warehouse.clear_stage(kept.name, ctx)
    return len(paths)


def latest_bronze(warehouse: Warehouse, spec: EntitySpec = CUSTOMERS, buckets: set[int] | None = None) -> DataFrame | None:
    """The kept versions in Bronze form, or some buckets of them."""
    held = warehouse.silver(latest_spec(spec), buckets)
    if held is None:
        return None
    return held.select(
        *spec.columns, F.col("source_ingested_at").alias("ingested_at"), "pipeline_run_id", "record_hash", "batch_id"
    )
