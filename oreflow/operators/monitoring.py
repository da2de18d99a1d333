"""Run, stage, event and quarantine logs turned into per-run health and daily metrics.

Each log is reduced to one row per run before it is joined, so joins never multiply rows and a run that
owns a large share of a log is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import average_decimal, duration_ms, metric_date, or_zero, success_rate_pct
from oreflow.model import CUSTOMER_PIPELINE

RUN = "pipeline_run_id"


def run_metrics(runs: DataFrame) -> DataFrame:
    return runs.select(
        RUN,
        "pipeline_name",
        "started_at",
        "completed_at",
        "status",
        F.expr(duration_ms("started_at", "completed_at")).alias("duration_ms"),
        "error_message",
    )


def stage_run_metrics(stages: DataFrame) -> DataFrame:
    return stages.select(
        "stage_run_id",
        RUN,
        "stage_name",
        "started_at",
        "completed_at",
        "status",
        "rows_processed",
        F.expr(duration_ms("started_at", "completed_at")).alias("duration_ms"),
        "error_message",
    )


def completed_only(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("completed_at").isNotNull())


def of_pipeline(runs: DataFrame, name: str) -> DataFrame:
    return runs.filter(F.col("pipeline_name") == name)


def quarantine_metrics(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy(RUN).agg(
        F.count_distinct("customer_id").alias("invalid_customers"), F.count("*").alias("validation_errors")
    )


def quarantine_parts(quarantine: DataFrame) -> DataFrame:
    """``pipeline_run_id, bucket, ids, errors``: evidence as bitmaps of 32,768 ids, exact for ids of 64 bits.

    Parts of several appends are merged by ``merged_quarantine_parts``: bitmaps are joined, and no id is shuffled again.
    A bitmap takes 4 KB before compression, so this pays where ids lie close together.  Evidence without an id only counts.
    """
    return quarantine.groupBy(RUN, F.expr("bitmap_bucket_number(customer_id)").alias("bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(customer_id))").alias("ids"), F.count("*").alias("errors")
    )


def merged_quarantine_parts(parts: DataFrame) -> DataFrame:
    return parts.groupBy(RUN, "bucket").agg(F.expr("bitmap_or_agg(ids)").alias("ids"), F.sum("errors").alias("errors"))


def quarantine_metrics_of_parts(parts: DataFrame) -> DataFrame:
    """``quarantine_metrics`` from merged parts."""
    known = F.when(F.col("bucket").isNotNull(), F.expr("bitmap_count(ids)")).otherwise(0)
    return parts.groupBy(RUN).agg(F.sum(known).alias("invalid_customers"), F.sum("errors").alias("validation_errors"))


def event_metrics(events: DataFrame) -> DataFrame:
    return events.groupBy(RUN).agg(
        F.count_if(F.col("event_type") == "RETRY").alias("retry_count"),
        F.count_if(F.col("event_type") == "RECOVERED").alias("recovery_count"),
    )


def stage_metrics(stages: DataFrame, bronze_stage: str = "bronze", silver_stage: str = "silver") -> DataFrame:
    def total(stage: str, value: str) -> Column:
        return F.sum(F.when(F.col("stage_name") == stage, F.col(value)).otherwise(0))

    return (
        stage_run_metrics(stages)
        .groupBy(RUN)
        .agg(
            total(bronze_stage, "rows_processed").alias("bronze_rows_processed"),
            total(silver_stage, "rows_processed").alias("silver_rows_processed"),
            total(bronze_stage, "duration_ms").alias("bronze_duration_ms"),
            total(silver_stage, "duration_ms").alias("silver_duration_ms"),
        )
    )


def health_join(runs: DataFrame, stages: DataFrame, quarantine: DataFrame, events: DataFrame) -> DataFrame:
    """Per-run metrics with their three pre-aggregated companions, nulls as they come."""
    return runs.join(stages, RUN, "left").join(quarantine, RUN, "left").join(events, RUN, "left")


def pipeline_health(
    runs: DataFrame,
    stages: DataFrame,
    events: DataFrame,
    quarantine: DataFrame,
    name: str = CUSTOMER_PIPELINE,
    bronze_stage: str = "bronze",
    silver_stage: str = "silver",
) -> DataFrame:
    joined = health_join(
        of_pipeline(run_metrics(runs), name),
        stage_metrics(stages, bronze_stage, silver_stage),
        quarantine_metrics(quarantine),
        event_metrics(events),
    )
    zeroed = "invalid_customers", "validation_errors", "retry_count", "recovery_count"
    return joined.selectExpr(
        RUN,
        "pipeline_name",
        "started_at",
        "completed_at",
        "status",
        "duration_ms",
        *[f"{or_zero(c)} AS {c}" for c in ("bronze_rows_processed", "silver_rows_processed")],
        # Stage durations stay null for a run without stage rows, so that averages leave it out.
        "bronze_duration_ms",
        "silver_duration_ms",
        *[f"{or_zero(c)} AS {c}" for c in zeroed],
        "error_message",
    )


def pipeline_daily_metrics(health: DataFrame) -> DataFrame:
    succeeded = "count_if(status = 'SUCCESS')"
    measures = {
        "total_runs": "count(*)",
        "successful_runs": succeeded,
        "failed_runs": "count_if(status = 'FAILED')",
        "success_rate_pct": success_rate_pct(succeeded, "count(*)"),
        "retry_count": "sum(retry_count)",
        "recovery_count": "sum(recovery_count)",
        "invalid_customers": "sum(invalid_customers)",
        "validation_errors": "sum(validation_errors)",
        "average_duration_ms": average_decimal("duration_ms"),
        "max_duration_ms": "max(duration_ms)",
        "average_bronze_duration_ms": average_decimal("bronze_duration_ms"),
        "average_silver_duration_ms": average_decimal("silver_duration_ms"),
    }
    return (
        completed_only(health)
        .groupBy(F.expr(metric_date("started_at")).alias("metric_date"))
        .agg(*[F.expr(sql).alias(name) for name, sql in measures.items()])
    )


#: Sums, counts and a maximum: what daily metrics follow from, and what parts of a day are merged by.
DAILY_SUMS = (
    "total_runs", "successful_runs", "failed_runs", "retry_count", "recovery_count", "invalid_customers", "validation_errors",
    "duration_sum", "duration_n", "bronze_sum", "bronze_n", "silver_sum", "silver_n",
)


def daily_parts(health: DataFrame) -> DataFrame:
    """One row per day of completed runs, to be merged with other parts of the same day that hold other runs."""
    measures = {
        "total_runs": "count(*)", "successful_runs": "count_if(status = 'SUCCESS')", "failed_runs": "count_if(status = 'FAILED')",
        **{x: f"sum({x})" for x in ("retry_count", "recovery_count", "invalid_customers", "validation_errors")},
        "max_duration_ms": "max(duration_ms)",
    }
    for name, column in (("duration", "duration_ms"), ("bronze", "bronze_duration_ms"), ("silver", "silver_duration_ms")):
        measures |= {f"{name}_sum": f"sum({column})", f"{name}_n": f"count({column})"}
    return (
        completed_only(health)
        .groupBy(F.expr(metric_date("started_at")).alias("metric_date"))
        .agg(*[F.expr(sql).alias(name) for name, sql in measures.items()])
    )


def merged_daily_parts(parts: DataFrame) -> DataFrame:
    sums = [F.sum(x).alias(x) for x in DAILY_SUMS]
    return parts.groupBy("metric_date").agg(*sums, F.max("max_duration_ms").alias("max_duration_ms"))


def daily_metrics_of_parts(parts: DataFrame) -> DataFrame:
    """``pipeline_daily_metrics`` from merged parts: the same numbers, rounded the same way."""

    def mean(name: str) -> str:
        # As avg() of a DECIMAL(18,2) has it: six places first, then two.
        exact = f"CAST({name}_sum AS DECIMAL(28,2)) / nullif(CAST({name}_n AS DECIMAL(20,0)), 0)"
        return f"CAST(CAST({exact} AS DECIMAL(22,6)) AS DECIMAL(18,2))"

    return parts.selectExpr(
        "metric_date", "total_runs", "successful_runs", "failed_runs",
        f"{success_rate_pct('successful_runs', 'total_runs')} AS success_rate_pct",
        "retry_count", "recovery_count", "invalid_customers", "validation_errors",
        f"{mean('duration')} AS average_duration_ms", "max_duration_ms", f"{mean('bronze')} AS average_bronze_duration_ms",
        f"{mean('silver')} AS average_silver_duration_ms",
    )
