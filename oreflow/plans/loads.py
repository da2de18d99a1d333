"""The loads: one entity's Bronze and Silver steps, the customer run and the five-entity run.

An attempt's log is all that its steps share: ``attempt_state`` folds its ids, start times and sequence numbers from
the log rows, so any process can carry it on (see ``steps``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from oreflow.functions.columns import same_key
from oreflow.functions.rules import fields_valid
from oreflow.model import (
    COMMERCE_PIPELINE,
    CUSTOMER_PIPELINE,
    CUSTOMERS,
    DEFAULT_INVALID_RATE_THRESHOLD,
    ENTITIES,
    EntitySpec,
    RunContext,
)
from oreflow.operators.bronze import bronze_new_rows, enforce_contract, fingerprint, landing_rows, silver_violations, violations
from oreflow.operators.lifecycle import (
    CLAIM_RETRY,
    RECOVERED_MESSAGE,
    RETRY_WITHOUT_ERROR,
    UNKNOWN_ERROR,
    BatchRejectedError,
    batch_transition,
    latest_state,
    successful_batches,
)
from oreflow.operators.quality import ProcessResult, customer_quality_gate, processor_of
from oreflow.operators.silver import (
    apply_changes,
    as_inserted,
    merge_counts,
    missing_keys,
    packed,
    quarantine_rows,
    rejected_rows,
    silver_changes,
    without_keys,
)
from oreflow.sources.local import local_rows
from oreflow.sources.warehouse import Warehouse

Extractor = Callable[[], DataFrame]


@dataclass(frozen=True)
class StageResult:
    stage_name: str
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_quarantined: int = 0


@dataclass(frozen=True)
class RunResult:
    pipeline_run_id: str
    batch_id: str
    status: str
    stages: list[StageResult]


class AttemptClosedError(ValueError):
    """The attempt is not running, so no step can be added to it."""


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_context(batch_id: str | None = None, pipeline_run_id: str | None = None) -> RunContext:
    return RunContext(pipeline_run_id or str(uuid.uuid4()), batch_id or str(uuid.uuid4()), _now())


def _last_seq(log: DataFrame) -> int:
    return log.agg(F.coalesce(F.max("seq"), F.lit(0))).first()[0]


def _error(exc: BaseException) -> str:
    return str(exc) or type(exc).__name__


@dataclass(frozen=True)
class AttemptState:
    """An attempt as its log rows tell it; ``ctx.at`` is the time its run began."""

    ctx: RunContext
    pipeline_name: str
    status: str
    holds_batch: bool
    run_seq: int
    batch_started: datetime | None
    batch_seq: int


def attempt_state(warehouse: Warehouse, pipeline_run_id: str) -> AttemptState | None:
    """The attempt's current state, or None if no run row names it.  Reads the folders of its run and batch only."""
    runs = warehouse.log("pipeline_runs", pipeline_run_id)
    run = runs.orderBy(F.desc("seq")).first()
    if run is None:
        return None
    batch = warehouse.log("batches", run.batch_id).orderBy(F.desc("seq")).first()
    holds = batch is not None and batch.status == "RUNNING" and batch.pipeline_run_id == pipeline_run_id
    return AttemptState(
        RunContext(pipeline_run_id, run.batch_id, run.started_at), run.pipeline_name, run.status, holds, run.seq,
        batch.started_at if holds else None, batch.seq if batch else 0,
    )


class Journal:
    """Writes the run, stage, batch and event logs of one attempt.

    Log rows of an id are numbered on from the last one in the log, so no clock decides which is current.
    """

    def __init__(self, warehouse: Warehouse, ctx: RunContext, pipeline_name: str):
        self.warehouse, self.ctx, self.pipeline_name = warehouse, ctx, pipeline_name
        self.run_started = self.batch_started = None
        self._run_seq = self._batch_seq = 0
        self._ended_stages: list[tuple] = []

    @classmethod
    def resumed(cls, warehouse: Warehouse, pipeline_run_id: str) -> Journal:
        """The journal of an attempt that another process began.  It has to be running and to hold its batch."""
        state = attempt_state(warehouse, pipeline_run_id)
        if state is None:
            raise AttemptClosedError(f"Run {pipeline_run_id} has not been prepared.")
        if state.status != "RUNNING" or not state.holds_batch:
            raise AttemptClosedError(f"Run {pipeline_run_id} is not running batch {state.ctx.batch_id}: it is {state.status}.")
        journal = cls(warehouse, state.ctx, state.pipeline_name)
        journal.run_started, journal._run_seq = state.ctx.at, state.run_seq
        journal.batch_started, journal._batch_seq = state.batch_started, state.batch_seq
        return journal

    # --- rows ----------------------------------------------------------------------------------------

    def _run_row(self, completed: datetime | None, status: str, error: str | None) -> None:
        self._run_seq += 1
        row = (
            self.ctx.pipeline_run_id, self.pipeline_name, self.ctx.batch_id, self.run_started, completed, status,
            error, self._run_seq,
        )
        self.warehouse.append_log("pipeline_runs", [row])

    def _batch_row(self, completed: datetime | None, status: str, rows: int | None, error: str | None) -> None:
        self._batch_seq += 1
        row = (
            self.ctx.batch_id, self.pipeline_name, self.batch_started, completed, status, rows, error, self._batch_seq,
            self.ctx.pipeline_run_id,
        )
        self.warehouse.append_log("batches", [row])

    def _event(self, kind: str, stage: str, tries: int, error: str | None, message: str) -> None:
        row = (
            self.ctx.pipeline_run_id, self.ctx.batch_id, self.pipeline_name, stage, kind, _now(), None, tries, error, message,
        )
        self.warehouse.append_log("events", [row])

    def _retry(self, failed: Row | None, tries: int, message: str | None = None) -> None:
        """RETRY of what failed: the stage, its error's type and message, and the number of the try that begins."""
        if failed is None:
            self._event("RETRY", "prepare_run", tries, UNKNOWN_ERROR, message or RETRY_WITHOUT_ERROR)
        else:
            kind, text = failed.error_type or UNKNOWN_ERROR, failed.error_message or RETRY_WITHOUT_ERROR
            self._event("RETRY", failed.stage_name, tries, kind, text)

    def _stages_of(self, pipeline_run_id: str) -> DataFrame:
        return latest_state(self.warehouse.log("stage_runs", pipeline_run_id), "stage_run_id")

    def _first_failure(self, pipeline_run_id: str | None) -> Row | None:
        """The first stage of a run that failed: the outermost, for it begins before those inside it."""
        if pipeline_run_id is None:
            return None
        return self._stages_of(pipeline_run_id).filter("status = 'FAILED'").orderBy("started_at", F.desc("completed_at")).first()

    # --- run and batch -------------------------------------------------------------------------------

    def start_run(self) -> None:
        self._run_seq = _last_seq(self.warehouse.log("pipeline_runs", self.ctx.pipeline_run_id))
        self.run_started = _now()
        self._run_row(None, "RUNNING", None)

    def claim_batch(self) -> None:
        """Take the batch for this attempt, or raise when it is running, done or another pipeline's.

        Taking a failed batch again is a retry, and goes into the event log with the stage that had failed.
        """
        log = self.warehouse.log("batches", self.ctx.batch_id)
        request = local_rows(
            self.warehouse.spark, [(self.ctx.batch_id, self.pipeline_name)], "batch_id STRING, pipeline_name STRING"
        )
        claim = batch_transition(request, log).first()
        if claim.message is not None:
            raise BatchRejectedError(claim.message)
        self._batch_seq = _last_seq(log)
        if claim.outcome == CLAIM_RETRY:
            last = latest_state(log, "batch_id").first()
            tries = log.filter("status = 'RUNNING'").count() + 1
            self._retry(self._first_failure(last.pipeline_run_id), tries, last.error_message)
        self.batch_started = _now()
        self._batch_row(None, "RUNNING", None, None)

    def _recovered(self) -> None:
        """RECOVERED for the failure that made this attempt a retry, if it is one."""
        log = self.warehouse.log("batches", self.ctx.batch_id)
        claims = log.filter(F.col("status") == "RUNNING").count()
        failed = log.filter("status = 'FAILED'").orderBy(F.desc("seq")).first()
        if failed is not None:
            stage = self._first_failure(failed.pipeline_run_id)
            self._event("RECOVERED", stage.stage_name if stage else "prepare_run", claims, None, RECOVERED_MESSAGE)

    def close(self, status: str, rows: int | None = None, error: str | None = None) -> None:
        """Close the batch, if this attempt holds it, and the run."""
        self._write_stages()
        if self.batch_started is not None:
            if status == "SUCCESS":
                self._recovered()
            self._batch_row(_now(), status, rows, error)
        self._run_row(_now(), status, error)

    @contextmanager
    def run(self) -> Iterator[dict]:
        """One attempt from its run row to its end: closed as failed by any exception, an interrupt included.

        The run is on record before the batch is claimed, so a refused attempt leaves a FAILED run behind.  Success is
        recorded inside the guard: when even that fails, the batch is closed as failed and can be taken again.  The
        block puts the rows it landed into ``rows`` of what this yields.
        """
        info: dict = {"rows": None}
        self.start_run()
        try:
            self.claim_batch()
            yield info
            self.close("SUCCESS", rows=info["rows"])
        except BaseException as exc:
            self.close("FAILED", error=_error(exc))
            raise

    # --- stages --------------------------------------------------------------------------------------

    def _write_stages(self, *started: tuple) -> None:
        rows, self._ended_stages = [*self._ended_stages, *started], []
        if rows:
            self.warehouse.append_log("stage_runs", rows)

    @contextmanager
    def stage(self, name: str) -> Iterator[dict]:
        """Logs a stage's start at once, and its end together with the next start or the end of the run."""
        stage_id, started, info = str(uuid.uuid4()), _now(), {"rows_processed": None}

        def row(completed: datetime | None, status: str, error: BaseException | None = None) -> tuple:
            rows, run_id = info["rows_processed"], self.ctx.pipeline_run_id
            text, kind = (None, None) if error is None else (_error(error), type(error).__name__)
            return (stage_id, run_id, name, started, completed, status, rows, text, 1 if status == "RUNNING" else 2, kind)

        self._write_stages(row(None, "RUNNING"))
        try:
            yield info
        except BaseException as exc:
            self._ended_stages.append(row(_now(), "FAILED", exc))
            raise
        self._ended_stages.append(row(_now(), "SUCCESS"))

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        """A part of the attempt that a process of its own carries out and may repeat; its stage rows are written when it ends.

        Repeating a step of which the last try in this run failed is a RETRY, its success then RECOVERED.
        """
        tries = self._stages_of(self.ctx.pipeline_run_id).filter(F.col("stage_name") == name).orderBy(F.desc("started_at")).collect()
        failures = 0
        while failures < len(tries) and tries[failures].status == "FAILED":
            failures += 1
        if failures:
            self._retry(tries[0], failures + 1)
        try:
            yield
            if failures:
                self._event("RECOVERED", name, failures + 1, None, RECOVERED_MESSAGE)
        finally:
            self._write_stages()


def batch_is_successful(warehouse: Warehouse, batch_id: str) -> bool:
    log = warehouse.log("batches", batch_id)
    return not successful_batches(log).isEmpty()


@dataclass(frozen=True)
class CheckStages:
    """Stage names of the checks before Bronze; the two flows have their own."""

    validate: str
    quarantine: str


def _accept(
    warehouse: Warehouse,
    spec: EntitySpec,
    stage: Callable[[str, DataFrame], DataFrame],
    staged: DataFrame,
    ctx: RunContext,
    journal: Journal | None,
    threshold: float,
    names: CheckStages,
) -> ProcessResult:
    """Have the processor take the rows apart, keep the evidence, then apply the gate: evidence stays even if it fails."""
    with _stage(journal, names.validate) as info:
        result = processor_of(spec)(staged, ctx, spec, stage)
        info["rows_processed"] = staged.count()
    if not (result.quarantine if result.suspects is None else result.suspects).isEmpty():
        with _stage(journal, names.quarantine) as info:
            info["rows_processed"] = warehouse.append_quarantine(spec, ctx, result.quarantine)
    (result.gate or customer_quality_gate)(result.metrics, threshold)
    return result


@contextmanager
def _stage(journal: Journal | None, name: str) -> Iterator[dict]:
    if journal is None:
        yield {}
    else:
        with journal.stage(name) as info:
            yield info


def load_bronze(
    warehouse: Warehouse,
    spec: EntitySpec,
    snapshot: DataFrame,
    ctx: RunContext,
    journal: Journal | None = None,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
    validate: bool = True,
) -> int:
    """Land a snapshot once per (batch, key); returns the rows this attempt added."""
    if not (spec.processed and validate):
        # Read from the source once and written once: the key check runs on what was written.
        return _append(warehouse, spec, snapshot, ctx, land=landing_rows)
    with _staging(warehouse, ctx) as stage:
        staged = stage(spec.name, fingerprint(snapshot, spec))
        names = CheckStages(f"{spec.name}_validate", f"{spec.name}_quarantine")
        accepted = _accept(warehouse, spec, stage, staged, ctx, journal, threshold, names)
        return _append(warehouse, spec, accepted.valid, ctx, accepted.unique)


@contextmanager
def _staging(warehouse: Warehouse, ctx: RunContext) -> Iterator[Callable[[str, DataFrame], DataFrame]]:
    """Yields ``stage(name, rows)``; what was staged is removed when the block ends, however it ends."""
    names = []

    def stage(name: str, rows: DataFrame) -> DataFrame:
        names.append(name)
        return warehouse.stage(name, ctx, rows)

    try:
        yield stage
    finally:
        for name in names:
            warehouse.clear_stage(name, ctx)


def _append(
    warehouse: Warehouse, spec: EntitySpec, rows: DataFrame, ctx: RunContext, unique: bool = False, land: Callable = bronze_new_rows
) -> int:
    # Validated customers are unique already: every repeated id was taken out.
    held = warehouse.bronze_batch(spec, ctx.batch_id)
    new = enforce_contract(land(rows, held, spec, ctx), spec, violations(spec))
    return warehouse.append_bronze(spec, ctx, new, unique)


def load_silver(warehouse: Warehouse, spec: EntitySpec, ctx: RunContext, keys: DataFrame | None = None) -> dict[str, int]:
    """Bring one batch, or the rows of it that ``keys`` name, into the entity's current state; callable on its own.

    Missing parents, rejected rows and then changed rows are written to the stage.  So the parent joins run once, whole rows
    are shuffled once to find the changes and once for the next state, and a batch that changes nothing leaves the
    published state alone.
    """
    batch, rejected, quarantined = warehouse.bronze_batch(spec, ctx.batch_id), None, 0
    if batch is None:
        return {"rows_inserted": 0, "rows_updated": 0, "rows_quarantined": 0}
    with _staging(warehouse, ctx) as stage:
        if keys is not None:  # a few rows of many, which every step below reads
            batch = stage(f"{spec.name}_named", batch.join(keys, spec.key, "left_semi"))
        if spec.has_quarantine:
            parents = {p.entity: warehouse.silver_or_empty(ENTITIES[p.entity]) for p in spec.parents}
            missing = {p.entity: stage(f"{spec.name}_no_{p.entity}", missing_keys(batch, parents, p)) for p in spec.parents}
            rejected = stage(f"{spec.name}_rejected", rejected_rows(batch, parents, spec, missing))
            held = warehouse.quarantine_part(spec, ctx)
            quarantined = warehouse.append_quarantine(spec, ctx, quarantine_rows(rejected, held, spec, ctx))
            batch = batch.filter(fields_valid(spec))
        # A contract is held against all rows of the batch, so changes do not carry them.
        checks = silver_violations(spec)
        carried = () if checks else (*spec.columns, "_print", "ingested_at")
        trusted = packed(batch, spec) if carried else batch
        if rejected is not None:
            # Dealt out as the join with Silver wants it.
            bad = rejected.selectExpr(f"{spec.key} AS _bad")
            trusted = trusted.join(bad, F.expr(same_key(spec.key, "_bad", spec)), "left_anti")
        silver = warehouse.silver_for(spec, trusted, ctx.batch_id)
        if silver is None and rejected is not None:
            state = without_keys(as_inserted(batch, spec, ctx), rejected, spec, warehouse.place(spec, ctx.batch_id))
            counts = warehouse.publish_silver(spec, ctx, enforce_contract(state, spec, checks), dealt=True)
        elif silver is None:
            counts = warehouse.publish_silver(spec, ctx, as_inserted(enforce_contract(batch, spec, checks), spec, ctx))
        else:
            changes = stage(f"{spec.name}_changes", silver_changes(trusted, silver, spec, *carried))
            counts = merge_counts(changes).first().asDict()
            if any(counts.values()):
                # Only buckets with a changed key are read wide and written again.
                buckets, updates = warehouse.touched_buckets(spec, changes), counts["rows_updated"] > 0
                checked, place = enforce_contract(trusted, spec, checks), warehouse.place(spec, ctx.batch_id)
                state = apply_changes(checked, warehouse.silver(spec, buckets), changes, spec, ctx, updates, place)
                warehouse.publish_silver(spec, ctx, state, counts, buckets, dealt=updates)
    return {**counts, "rows_quarantined": quarantined}


def run_entity(
    warehouse: Warehouse,
    spec: EntitySpec,
    extract: Extractor,
    ctx: RunContext,
    journal: Journal | None = None,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
) -> list[StageResult]:
    """Bronze then Silver of one entity."""
    with _stage(journal, f"{spec.name}_bronze"):
        inserted = load_bronze(warehouse, spec, extract(), ctx, journal, threshold)
    with _stage(journal, f"{spec.name}_silver"):
        counts = load_silver(warehouse, spec, ctx)
    return [StageResult(f"{spec.name}_bronze", inserted), StageResult(f"{spec.name}_silver", **counts)]


def run_commerce(
    warehouse: Warehouse,
    extractors: dict[str, Extractor],
    ctx: RunContext | None = None,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
) -> RunResult:
    """All five entities, parents first; the first failure stops the run and marks batch and run FAILED."""
    ctx = ctx or new_context()
    journal = Journal(warehouse, ctx, COMMERCE_PIPELINE)
    stages: list[StageResult] = []
    with journal.run() as info:
        for spec in ENTITIES.values():
            stages += run_entity(warehouse, spec, extractors[spec.name], ctx, journal, threshold)
        info["rows"] = sum(s.rows_inserted for s in stages if s.stage_name.endswith("_bronze"))
    return RunResult(ctx.pipeline_run_id, ctx.batch_id, "SUCCESS", stages)


def customer_bronze(
    warehouse: Warehouse,
    extract: Extractor,
    ctx: RunContext,
    journal: Journal | None = None,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
) -> StageResult:
    """The customer flow up to Bronze, as a step of its own that may be repeated under the same ids.

    A batch that has been loaded successfully is left alone: nothing is extracted.
    """
    spec = CUSTOMERS
    if batch_is_successful(warehouse, ctx.batch_id):
        return StageResult("customer_bronze")
    with _stage(journal, "customer_bronze") as whole, _staging(warehouse, ctx) as stage:
        with _stage(journal, "extract") as info:
            staged = stage(spec.name, fingerprint(extract(), spec))
            info["rows_processed"] = staged.count()
        names = CheckStages(validate="validate", quarantine="quarantine_invalid_customers")
        accepted = _accept(warehouse, spec, stage, staged, ctx, journal, threshold, names)
        with _stage(journal, "load_bronze_customers") as info:
            info["rows_processed"] = inserted = _append(warehouse, spec, accepted.valid, ctx, accepted.unique)
        whole["rows_processed"] = inserted
    return StageResult("customer_bronze", inserted)


def customer_silver(warehouse: Warehouse, ctx: RunContext, journal: Journal | None = None) -> StageResult:
    """The customer flow from Bronze to Silver, as a step of its own."""
    with _stage(journal, "customer_silver") as info:
        counts = load_silver(warehouse, CUSTOMERS, ctx)
        info["rows_processed"] = counts["rows_inserted"] + counts["rows_updated"]
    return StageResult("customer_silver", **counts)


def run_customer(
    warehouse: Warehouse,
    extract: Extractor,
    ctx: RunContext | None = None,
    threshold: float = DEFAULT_INVALID_RATE_THRESHOLD,
    pipeline_name: str = CUSTOMER_PIPELINE,
) -> RunResult:
    """The customer-only flow with its finer stages, both steps under one run."""
    ctx = ctx or new_context()
    journal = Journal(warehouse, ctx, pipeline_name)
    with journal.run() as info:
        stages = [
            customer_bronze(warehouse, extract, ctx, journal, threshold),
            customer_silver(warehouse, ctx, journal),
        ]
        info["rows"] = stages[0].rows_inserted
    return RunResult(ctx.pipeline_run_id, ctx.batch_id, "SUCCESS", stages)
