"""Lifecycle and monitoring queries on small logs."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from oreflow.model import BATCH_LOG_DDL, EVENT_LOG_DDL, RUN_LOG_DDL, STAGE_LOG_DDL
from oreflow.operators import contracts, lifecycle, monitoring
from oreflow.sources.local import local_rows

T = datetime(2026, 5, 1, 8)


def at(seconds: float) -> datetime:
    return T + timedelta(seconds=seconds)


def batches(spark, *entries):
    given = [(b, p, T, None, status, None, None, seq) for seq, (b, p, status) in enumerate(entries)]
    return local_rows(spark, given, BATCH_LOG_DDL)


def claims(spark, log, *requests):
    asked = local_rows(spark, list(requests), "batch_id STRING, pipeline_name STRING")
    return {r.batch_id: r for r in lifecycle.batch_transition(asked, log).collect()}


def test_batch_transitions(spark):
    log = batches(
        spark, ("run", "p", "RUNNING"), ("ok", "p", "RUNNING"), ("ok", "p", "SUCCESS"), ("bad", "p", "RUNNING"),
        ("bad", "p", "FAILED"), ("theirs", "other", "FAILED"),
    )
    got = claims(spark, log, *[(b, "p") for b in ("new", "run", "ok", "bad", "theirs")])
    assert {b: r.outcome for b, r in got.items()} == {
        "new": "CLAIM_NEW", "run": "REJECT_RUNNING", "ok": "REJECT_SUCCESS", "bad": "CLAIM_RETRY",
        "theirs": "REJECT_OTHER_PIPELINE",
    }
    assert got["theirs"].message == "Batch theirs belongs to pipeline 'other', not 'p'."
    assert {b: r.new_status for b, r in got.items() if r.message is None} == {"new": "RUNNING", "bad": "RUNNING"}


def test_completion_closes_the_latest_start(spark):
    log = batches(spark, ("b", "p", "RUNNING"), ("b", "p", "FAILED"), ("b", "p", "RUNNING"))
    results = local_rows(
        spark, [("b", at(5), "SUCCESS", 12, None)],
        "batch_id STRING, completed_at TIMESTAMP_NTZ, status STRING, rows_processed BIGINT, error_message STRING",
    )
    both = log.unionByName(lifecycle.completion_rows(log, results))
    (now,) = lifecycle.successful_batches(both).collect()
    assert (now.batch_id, now.rows_processed, now.completed_at) == ("b", 12, at(5))


ATTEMPT = (
    "pipeline_run_id STRING, batch_id STRING, pipeline_name STRING, stage_name STRING, dag_run_id STRING, "
    "try_number INT, state STRING, error_type STRING, error_message STRING, ended_at TIMESTAMP_NTZ"
)


def attempt(run, stage, number, state, kind=None, text=None, seconds=0):
    return (run, "b", "customer_pipeline", stage, "dag", number, state, kind, text, at(seconds))


def test_retry_and_recovery_events(spark):
    given = local_rows(
        spark,
        [
            attempt("r", "bronze", 1, "up_for_retry", "Transient", "no route"),
            attempt("r", "bronze", 2, "up_for_retry"),
            attempt("r", "bronze", 3, "success"),
            attempt("r", "silver", 1, "success"),
            attempt("r", "silver", 2, "failed", "X", "y"),
            attempt(None, "bronze", 1, "up_for_retry", "X", "y"),
        ],
        ATTEMPT,
    )
    got = [(r.event_type, r.try_number, r.error_type, r.event_message) for r in lifecycle.retry_events(given).collect()]
    assert sorted(got, key=lambda r: r[1]) == [
        ("RETRY", 1, "Transient", "no route"),
        ("RETRY", 2, "UnknownError", "Task retry requested without an exception."),
        ("RECOVERED", 3, None, "Task succeeded after one or more retries."),
    ]


def test_failure_summary_prefers_the_earliest_stage_and_its_last_failure(spark):
    runs = local_rows(spark, [("a",), ("b",), ("c",)], "pipeline_run_id STRING")
    given = local_rows(
        spark,
        [
            attempt("a", "silver", 1, "failed", "S", "late", 9),
            attempt("a", "bronze", 1, "failed", "B", "first", 1),
            attempt("a", "bronze", 2, "failed", "B", "second", 2),
            attempt("b", "prepare_run", 1, "failed"),
            attempt("c", "bronze", 1, "success"),
        ],
        ATTEMPT,
    )
    got = {r.pipeline_run_id: tuple(r)[1:] for r in lifecycle.failure_summary(runs, given).collect()}
    assert got["a"] == ("bronze", "B", "second", 2)
    assert got["b"] == ("prepare_run", "UnknownError", "Task failed without an exception.", 1)
    assert got["c"] == (
        "unknown", "PipelineFailure", "Airflow customer pipeline failed. See task logs for details.", None
    )


def logs(spark):
    def run(run_id, status, start, end, name="customer_pipeline"):
        return (run_id, name, None, at(start), None if end is None else at(end), status, None, 1)

    runs = local_rows(
        spark,
        [run("a", "SUCCESS", 0, 10), run("b", "FAILED", 100, 100.5), run("c", "RUNNING", 200, None), run("d", "SUCCESS", 300, 301, "commerce")],
        RUN_LOG_DDL,
    )

    def stage(run_id, name, n, start, end):
        return (f"{run_id}-{name}", run_id, name, at(start), at(end), "SUCCESS", n, None, 1)

    stages = local_rows(
        spark,
        [stage("a", "bronze", 5, 0, 2), stage("a", "bronze", None, 2, 3), stage("a", "silver", 4, 3, 7), stage("a", "extract", 9, 0, 1)],
        STAGE_LOG_DDL,
    )
    events = local_rows(
        spark,
        [("a", None, "p", "bronze", kind, T, None, 1, None, None) for kind in ("RETRY", "RETRY", "RECOVERED")],
        EVENT_LOG_DDL,
    )
    quarantine = local_rows(spark, [("b", 1), ("b", 1), ("b", 2)], "pipeline_run_id STRING, customer_id BIGINT")
    return runs, stages, events, quarantine


def test_health(spark):
    got = {r.pipeline_run_id: r for r in monitoring.pipeline_health(*logs(spark)).collect()}
    assert sorted(got) == ["a", "b", "c"]
    a, b, c = got["a"], got["b"], got["c"]
    assert (a.duration_ms, a.bronze_rows_processed, a.silver_rows_processed) == (10_000, 5, 4)
    assert (a.bronze_duration_ms, a.silver_duration_ms, a.retry_count, a.recovery_count) == (3000, 4000, 2, 1)
    assert (b.bronze_rows_processed, b.bronze_duration_ms, b.invalid_customers, b.validation_errors) == (0, None, 2, 3)
    assert (c.duration_ms, c.retry_count) == (None, 0)


def test_stage_names_are_parameters(spark):
    runs, stages, events, quarantine = logs(spark)
    got = monitoring.pipeline_health(runs, stages, events, quarantine, bronze_stage="extract", silver_stage="none")
    row = got.filter("pipeline_run_id = 'a'").first()
    assert (row.bronze_rows_processed, row.silver_rows_processed) == (9, 0)


def test_daily_metrics(spark):
    (day,) = monitoring.pipeline_daily_metrics(monitoring.pipeline_health(*logs(spark))).collect()
    assert (day.total_runs, day.successful_runs, day.failed_runs, day.success_rate_pct) == (2, 1, 1, Decimal("50.00"))
    assert (day.average_duration_ms, day.max_duration_ms) == (Decimal("5250.00"), 10_000)
    assert day.average_bronze_duration_ms == Decimal("3000.00")


def test_contract_counts_and_enforcement(spark):
    log = batches(spark, ("a", "p", "RUNNING"), ("b", "p", "DONE"), ("c", "p", "DONE"))
    counts = contracts.count_violations(log, "batches", contracts.BATCH_CHECKS)
    assert [tuple(r) for r in counts.collect()] == [("batches", "status is not allowed", 2)]
    with pytest.raises(contracts.ContractError, match=r"batches: status is not allowed \(2 rows\)"):
        contracts.enforce(counts)


def test_newest_runs(spark):
    runs = logs(spark)[0]
    assert [r.pipeline_run_id for r in lifecycle.newest_runs(runs, 2).collect()] == ["d", "c"]


def test_rows_processed_sums_bronze_stages(spark):
    given = local_rows(
        spark, [("r", "orders_bronze", 3), ("r", "customers_bronze", 4), ("r", "orders_silver", 9)],
        "pipeline_run_id STRING, stage_name STRING, rows_processed BIGINT",
    )
    assert [tuple(r) for r in lifecycle.batch_rows_processed(given).collect()] == [("r", 7)]
