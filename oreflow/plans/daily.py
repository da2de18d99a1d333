"""Daily metrics kept up to date from mergeable parts.

A day's part is one row of sums, counts and a maximum, beside the folder of the rows of its runs.  A refresh reads what was
appended to the logs since the last one, and finds the runs concerned.  The rows of these alone are made anew, from the
days of the log that can hold them; only days that such a run belongs or belonged to get a new part.  So appends may
come in any order, and a run that is completed late reopens its day.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import metric_date
from oreflow.model import CUSTOMER_PIPELINE, CUSTOMERS, RunContext
from oreflow.operators import monitoring
from oreflow.operators.lifecycle import latest_state
from oreflow.sources.warehouse import Warehouse

RUN = monitoring.RUN


def _parts(warehouse: Warehouse, name: str) -> DataFrame:
    """Current part of every day: one row each."""
    rows = warehouse.log("daily_parts", name)
    rest = [c for c in rows.columns if c != "metric_date"]
    return rows.groupBy("metric_date").agg(F.max_by(F.struct(*rest), "seq").alias("_row")).select("metric_date", "_row.*")


def _rows_of_days(warehouse: Warehouse, ddl: str, paths: list[str]) -> DataFrame:
    if not paths:
        return warehouse.empty(ddl)
    return warehouse.spark.read.schema(ddl).parquet(*[f"{warehouse.root}/{x}" for x in paths])


HEALTH_DDL = (
    "pipeline_run_id STRING, pipeline_name STRING, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, status STRING, "
    "duration_ms BIGINT, bronze_rows_processed BIGINT, silver_rows_processed BIGINT, bronze_duration_ms BIGINT, "
    "silver_duration_ms BIGINT, invalid_customers BIGINT, validation_errors BIGINT, retry_count BIGINT, recovery_count BIGINT, "
    "error_message STRING"
)


def refresh_daily(
    warehouse: Warehouse,
    ctx: RunContext,
    name: str = CUSTOMER_PIPELINE,
    bronze_stage: str = "customer_bronze",
    silver_stage: str = "customer_silver",
    quarantine: DataFrame | None = None,
    today: date | None = None,
) -> int:
    """Bring a pipeline's daily parts up to what its logs hold; returns the number of days that got a new part."""
    today = today or datetime.now(timezone.utc).date()
    since, last = warehouse.log("daily_parts", name).agg(F.max("refreshed_on"), F.coalesce(F.max("seq"), F.lit(0))).first()
    fresh = {x: warehouse.log_since(x, since) for x in ("pipeline_runs", "stage_runs", "events")}
    ids = fresh["pipeline_runs"].select(RUN).unionByName(fresh["stage_runs"].select(RUN)).unionByName(fresh["events"].select(RUN))
    touched = warehouse.stage("daily_touched", ctx, ids.distinct())
    try:
        return _refreshed(warehouse, ctx, name, bronze_stage, silver_stage, quarantine, today, since, last, fresh["pipeline_runs"], touched)
    finally:
        for x in ("daily_touched", "daily_spans", "daily_health"):
            warehouse.clear_stage(x, ctx)


def _refreshed(
    warehouse: Warehouse, ctx: RunContext, name: str, bronze_stage: str, silver_stage: str, quarantine: DataFrame | None,
    today: date, since: date | None, last: int, fresh_runs: DataFrame, touched: DataFrame,
) -> int:
    # A run whose first row is among the new ones has all its rows there.  Of the others the run log tells when they began.
    rows = fresh_runs
    if since is not None:
        begun = fresh_runs.groupBy(RUN).agg(F.min("seq").alias("first")).filter("first = 1").select(RUN)
        rows = rows.unionByName(warehouse.log("pipeline_runs").join(touched.join(begun, RUN, "left_anti"), RUN, "left_semi"))
    spans = warehouse.stage("daily_spans", ctx, rows.filter(F.col("pipeline_name") == name).select(
        RUN, F.expr(metric_date("started_at")).alias("metric_date")).distinct())
    lowest = spans.agg(F.min("metric_date")).first()[0]
    if lowest is None:
        return 0
    # Nothing of a run is logged before the day it began; a day is allowed for clocks that differ.
    low = None if since is None else min(since, lowest - timedelta(days=1))
    runs = spans.select(RUN).distinct()
    own = lambda log: warehouse.log_since(log, low).join(runs, RUN, "left_semi")
    evidence = warehouse.quarantine(CUSTOMERS) if quarantine is None else quarantine
    health = monitoring.pipeline_health(
        latest_state(own("pipeline_runs"), RUN), latest_state(own("stage_runs"), "stage_run_id"), own("events"),
        evidence.join(runs, RUN, "left_semi"), name, bronze_stage, silver_stage,
    )
    made = warehouse.stage("daily_health", ctx, monitoring.completed_only(health))
    days = spans.select("metric_date").distinct()
    paths = [r.path for r in _parts(warehouse, name).join(days, "metric_date", "left_semi").select("path").collect() if r.path]
    held = _rows_of_days(warehouse, HEALTH_DDL, paths).join(runs, RUN, "left_anti")
    folder = f"daily/{name}/{warehouse.write_name(ctx)}"
    day = F.expr(metric_date("started_at"))
    held.unionByName(made).withColumn("metric_date", day).hint("rebalance", "metric_date").write.partitionBy("metric_date").parquet(f"{warehouse.root}/{folder}")
    written = warehouse.spark.read.schema(HEALTH_DDL).parquet(f"{warehouse.root}/{folder}")
    parts = days.join(monitoring.daily_parts(written), "metric_date", "left")
    path = F.when(F.col("total_runs").isNotNull(), F.concat(F.lit(f"{folder}/metric_date="), F.col("metric_date").cast("string")))
    columns = {"pipeline_name": F.lit(name), "path": path, "refreshed_on": F.lit(today), "seq": F.lit(last + 1).cast("bigint")}
    order = warehouse.empty_log("daily_parts").columns
    warehouse.append_log("daily_parts", parts.withColumns(columns).select(*order).coalesce(1), today)
    return days.count()


def kept_daily_metrics(warehouse: Warehouse, name: str = CUSTOMER_PIPELINE) -> DataFrame:
    """The daily metrics as of the last refresh: one part per day, no run is read."""
    return monitoring.daily_metrics_of_parts(monitoring.merged_daily_parts(_parts(warehouse, name).filter("total_runs > 0")))
