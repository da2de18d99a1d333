"""An attempt in separate steps, each of which may run in a process of its own and be repeated.

``prepare`` gives the ids; the other steps take the run's id only and find the rest in the warehouse's logs.  A step
that raises leaves the attempt running: repeat it, or ``fail`` the attempt.  Repeating a step that has done its work adds
nothing, and repeating ``prepare``, ``complete`` or ``fail`` leaves the one current row that the first call wrote.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from oreflow.model import CUSTOMER_PIPELINE, DEFAULT_INVALID_RATE_THRESHOLD, EntitySpec, RunContext
from oreflow.operators.lifecycle import DEFAULT_FAILURE_MESSAGE
from oreflow.plans.loads import (
    AttemptClosedError,
    Extractor,
    Journal,
    StageResult,
    attempt_state,
    customer_bronze,
    customer_silver,
    load_bronze,
    load_silver,
    new_context,
)
from oreflow.sources.warehouse import Warehouse


def prepare(
    warehouse: Warehouse,
    batch_id: str | None = None,
    pipeline_run_id: str | None = None,
    pipeline_name: str = CUSTOMER_PIPELINE,
) -> RunContext:
    """Put the run on record and claim the batch for it.  A refused attempt is closed as failed, and raises."""
    state = attempt_state(warehouse, pipeline_run_id) if pipeline_run_id else None
    if state is not None and state.holds_batch and batch_id in (None, state.ctx.batch_id):
        return state.ctx
    journal = Journal(warehouse, new_context(batch_id or (state and state.ctx.batch_id), pipeline_run_id), pipeline_name)
    journal.start_run()
    try:
        journal.claim_batch()
    except BaseException as exc:
        journal.close("FAILED", error=str(exc) or type(exc).__name__)
        raise
    return RunContext(journal.ctx.pipeline_run_id, journal.ctx.batch_id, journal.run_started)


def bronze_step(
    warehouse: Warehouse,
    spec: EntitySpec,
    extract: Extractor,
    pipeline_run_id: str,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
) -> StageResult:
    """One entity of the five-entity run up to Bronze."""
    journal, name = Journal.resumed(warehouse, pipeline_run_id), f"{spec.name}_bronze"
    with journal.step(name), journal.stage(name):
        return StageResult(name, load_bronze(warehouse, spec, extract(), journal.ctx, journal, threshold))


def silver_step(warehouse: Warehouse, spec: EntitySpec, pipeline_run_id: str) -> StageResult:
    """One entity of the five-entity run from Bronze to Silver."""
    journal, name = Journal.resumed(warehouse, pipeline_run_id), f"{spec.name}_silver"
    with journal.step(name), journal.stage(name):
        return StageResult(name, **load_silver(warehouse, spec, journal.ctx))


def customer_bronze_step(
    warehouse: Warehouse, extract: Extractor, pipeline_run_id: str, threshold: float = DEFAULT_INVALID_RATE_THRESHOLD
) -> StageResult:
    journal = Journal.resumed(warehouse, pipeline_run_id)
    with journal.step("customer_bronze"):
        return customer_bronze(warehouse, extract, journal.ctx, journal, threshold)


def customer_silver_step(warehouse: Warehouse, pipeline_run_id: str) -> StageResult:
    journal = Journal.resumed(warehouse, pipeline_run_id)
    with journal.step("customer_silver"):
        return customer_silver(warehouse, journal.ctx, journal)


def _ended(warehouse: Warehouse, pipeline_run_id: str, status: str) -> bool:
    """Whether the attempt has ended with this status; one that ended with another cannot be closed again."""
    state = attempt_state(warehouse, pipeline_run_id)
    if state is None:
        raise AttemptClosedError(f"Run {pipeline_run_id} has not been prepared.")
    if state.status not in ("RUNNING", status):
        raise AttemptClosedError(f"Run {pipeline_run_id} has already ended as {state.status}.")
    return state.status == status


def complete(warehouse: Warehouse, pipeline_run_id: str) -> int:
    """Close batch and run as successful; returns the rows that the attempt landed, summed from the Bronze ledger."""
    batch_id = None if (state := attempt_state(warehouse, pipeline_run_id)) is None else state.ctx.batch_id
    rows = 0
    if batch_id is not None:
        landed = warehouse.log("bronze_ledger", batch_id).filter(F.col("pipeline_run_id") == pipeline_run_id)
        rows = landed.agg(F.coalesce(F.sum("rows_inserted"), F.lit(0))).first()[0]
    if not _ended(warehouse, pipeline_run_id, "SUCCESS"):
        Journal.resumed(warehouse, pipeline_run_id).close("SUCCESS", rows=rows)
    return rows


def fail(warehouse: Warehouse, pipeline_run_id: str, error: str | None = None) -> str:
    """Close batch and run as failed, with the error of the first stage that failed unless one is given."""
    if not _ended(warehouse, pipeline_run_id, "FAILED"):
        state = attempt_state(warehouse, pipeline_run_id)
        if not state.holds_batch:
            # Prepared no further than the run row: there is no batch to close.
            journal = Journal(warehouse, state.ctx, state.pipeline_name)
            journal.run_started, journal._run_seq = state.ctx.at, state.run_seq
        else:
            journal = Journal.resumed(warehouse, pipeline_run_id)
        failed = journal._first_failure(pipeline_run_id)
        journal.close("FAILED", error=error or (failed.error_message if failed else None) or DEFAULT_FAILURE_MESSAGE)
    return warehouse.log("pipeline_runs", pipeline_run_id).orderBy(F.desc("seq")).first().error_message
