"""Health and daily metrics over a warehouse's own logs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from oreflow.model import CUSTOMER_PIPELINE, CUSTOMERS
from oreflow.operators import monitoring
from oreflow.operators.lifecycle import latest_state
from oreflow.sources.warehouse import Warehouse


def warehouse_health(
    warehouse: Warehouse,
    name: str = CUSTOMER_PIPELINE,
    bronze_stage: str = "customer_bronze",
    silver_stage: str = "customer_silver",
) -> DataFrame:
    """One row for each run of a pipeline.

    Logs are append-only: runs and stages are reduced to their current rows first, and stages are counted under the
    names that the loads give them.
    """
    return monitoring.pipeline_health(
        latest_state(warehouse.log("pipeline_runs"), "pipeline_run_id"),
        latest_state(warehouse.log("stage_runs"), "stage_run_id"),
        warehouse.log("events"),
        warehouse.quarantine(CUSTOMERS),
        name,
        bronze_stage,
        silver_stage,
    )


def warehouse_daily_metrics(warehouse: Warehouse, name: str = CUSTOMER_PIPELINE, **stages: str) -> DataFrame:
    return monitoring.pipeline_daily_metrics(warehouse_health(warehouse, name, **stages))
