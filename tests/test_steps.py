"""Attempts in separate steps: every call gets a warehouse object of its own, as a process would."""

import random

import pytest

from oreflow.model import CUSTOMERS, ORDERS
from oreflow.operators import lifecycle
from oreflow.operators.lifecycle import BatchRejectedError, latest_state
from oreflow.plans import loads, steps
from oreflow.sources.local import local_rows
from oreflow.sources.warehouse import Warehouse
from tests import rows


@pytest.fixture
def fresh(spark, tmp_path):
    return lambda: Warehouse(spark, str(tmp_path / "warehouse"))


def people(spark, *more):
    return lambda: rows.frame(spark, CUSTOMERS, rows.customer(1), rows.customer(2), *more)


def lost():
    raise ConnectionError("source went away")


def current(warehouse, log, key):
    return {getattr(r, key): r for r in latest_state(warehouse.log(log), key).collect()}


def test_each_step_in_a_process_of_its_own_and_repeated(spark, fresh):
    ids = [steps.prepare(fresh(), "b1", "r1") for _ in range(2)]
    assert ids[0] == ids[1] and (ids[0].batch_id, ids[0].pipeline_run_id) == ("b1", "r1")
    assert [steps.customer_bronze_step(fresh(), people(spark), "r1").rows_inserted for _ in range(2)] == [2, 0]
    assert [steps.customer_silver_step(fresh(), "r1").rows_inserted for _ in range(2)] == [2, 0]
    assert [steps.complete(fresh(), "r1") for _ in range(2)] == [2, 2]
    warehouse = fresh()
    assert warehouse.silver(CUSTOMERS).count() == 2
    run, batch = current(warehouse, "pipeline_runs", "pipeline_run_id")["r1"], current(warehouse, "batches", "batch_id")["b1"]
    assert (run.status, batch.status, batch.rows_processed, batch.pipeline_run_id) == ("SUCCESS", "SUCCESS", 2, "r1")
    assert warehouse.log("pipeline_runs").count() == warehouse.log("batches").count() == 2
    assert warehouse.log("events").count() == 0
    with pytest.raises(loads.AttemptClosedError, match="already ended as SUCCESS"):
        steps.fail(fresh(), "r1")
    with pytest.raises(loads.AttemptClosedError, match="it is SUCCESS"):
        steps.customer_silver_step(fresh(), "r1")
    with pytest.raises(BatchRejectedError, match="already completed"):
        steps.prepare(fresh(), "b1", "r2")
    assert current(fresh(), "pipeline_runs", "pipeline_run_id")["r2"].status == "FAILED"


def test_failing_and_taking_a_batch_again(spark, fresh, monkeypatch):
    steps.prepare(fresh(), "b1", "r1")
    with pytest.raises(ConnectionError):
        steps.customer_bronze_step(fresh(), lost, "r1")
    steps.customer_bronze_step(fresh(), people(spark), "r1")
    with monkeypatch.context() as broken:
        broken.setattr(loads, "load_silver", lambda *_: (_ for _ in ()).throw(TimeoutError("no answer")))
        with pytest.raises(TimeoutError):
            steps.customer_silver_step(fresh(), "r1")
    with pytest.raises(BatchRejectedError, match="already running"):
        steps.prepare(fresh(), "b1", "other")
    # The first stage that failed explains the run, and whoever asks gets the same answer.
    assert [steps.fail(fresh(), "r1") for _ in range(2)] == ["source went away"] * 2
    with pytest.raises(loads.AttemptClosedError, match="already ended as FAILED"):
        steps.complete(fresh(), "r1")

    steps.prepare(fresh(), "b1", "r2")
    assert steps.customer_bronze_step(fresh(), people(spark), "r2").rows_inserted == 0
    assert steps.customer_silver_step(fresh(), "r2").rows_inserted == 2
    assert steps.complete(fresh(), "r2") == 0
    events = fresh().log("events").orderBy("event_time", "event_type").collect()
    assert [(e.pipeline_run_id, e.event_type, e.stage_name, e.try_number, e.error_type) for e in events] == [
        ("r1", "RETRY", "customer_bronze", 2, "ConnectionError"), ("r1", "RECOVERED", "customer_bronze", 2, None),
        ("r2", "RETRY", "customer_bronze", 2, "ConnectionError"), ("r2", "RECOVERED", "customer_bronze", 2, None)]

    warehouse = fresh()
    runs = latest_state(warehouse.log("pipeline_runs"), "pipeline_run_id")
    tried = lifecycle.stage_attempts(runs, latest_state(warehouse.log("stage_runs"), "stage_run_id"))
    told = sorted((e.stage_name, e.event_type, e.try_number, e.error_type) for e in
                  lifecycle.retry_events(tried).filter("stage_name like 'customer%'").collect())
    assert told == [("customer_bronze", "RECOVERED", 2, None), ("customer_bronze", "RETRY", 1, "ConnectionError"),
                    ("customer_silver", "RECOVERED", 2, None), ("customer_silver", "RETRY", 1, "TimeoutError")]
    summary = lifecycle.failure_summary(
        runs.filter("pipeline_run_id = 'r1'"), tried, ("customer_bronze", "customer_silver"), ("failed", "up_for_retry")
    )
    failed = {r.pipeline_run_id: (r.error_type, r.error_message) for r in summary.collect()}
    assert failed == {"r1": ("ConnectionError", "source went away")}


def test_a_run_that_fails_in_silver_tells_its_stage_when_repeated(spark, warehouse, monkeypatch):
    with monkeypatch.context() as broken:
        broken.setattr(loads, "load_silver", lambda *_: (_ for _ in ()).throw(TimeoutError("no answer")))
        with pytest.raises(TimeoutError):
            loads.run_customer(warehouse, people(spark), rows.context("r1"))
    loads.run_customer(warehouse, people(spark), rows.context("r2"))
    events = {e.event_type: e for e in warehouse.log("events").collect()}
    assert (events["RETRY"].stage_name, events["RETRY"].error_type, events["RETRY"].event_message) == ("customer_silver", "TimeoutError", "no answer")
    assert (events["RECOVERED"].stage_name, events["RECOVERED"].try_number) == ("customer_silver", 2)


def test_a_batch_whose_success_could_not_be_recorded_can_be_taken_again(spark, warehouse, monkeypatch):
    row = loads.Journal._run_row

    def refuse(self, completed, status, error):
        if status == "SUCCESS":
            raise OSError("disk full")
        row(self, completed, status, error)

    with monkeypatch.context() as broken:
        broken.setattr(loads.Journal, "_run_row", refuse)
        with pytest.raises(OSError, match="disk full"):
            loads.run_customer(warehouse, people(spark), rows.context("r1"))
    assert current(warehouse, "batches", "batch_id")["batch-1"].status == "FAILED"
    assert loads.run_customer(warehouse, people(spark), rows.context("r2")).status == "SUCCESS"


def test_entities_of_the_five_entity_run_step_by_step(spark, fresh):
    steps.prepare(fresh(), "b1", "r1", "commerce")
    for spec, given in ((CUSTOMERS, people(spark)), (ORDERS, lambda: rows.frame(spark, ORDERS, rows.order(7, 1), rows.order(8, 99)))):
        for _ in range(2):
            steps.bronze_step(fresh(), spec, given, "r1")
            steps.silver_step(fresh(), spec, "r1")
    assert steps.complete(fresh(), "r1") == 4
    warehouse = fresh()
    assert (warehouse.silver(ORDERS).count(), warehouse.quarantine(ORDERS).count()) == (1, 1)


# --- requests one after another ---------------------------------------------------------------------------

REQUEST = "batch_id STRING, seq BIGINT, kind STRING, pipeline_name STRING, status STRING"
LOG = "batch_id STRING, pipeline_name STRING, status STRING, seq BIGINT"


def judged(requests, known):
    state, out = {b: (p, s) for b, p, s, _ in known}, []
    for batch, seq, kind, name, status in sorted(requests, key=lambda r: (r[1], r[2] == "CLAIM", r[3] or "")):
        owner, now = state.get(batch, (None, None))
        if kind == "COMPLETE":
            if now:
                state[batch] = (owner, status)
            continue
        outcome = ("CLAIM_NEW" if now is None else "REJECT_OTHER_PIPELINE" if owner != name else
                   {"FAILED": "CLAIM_RETRY", "SUCCESS": "REJECT_SUCCESS", "RUNNING": "REJECT_RUNNING"}[now])
        if outcome.startswith("CLAIM"):
            state[batch] = (name, "RUNNING")
        out.append((batch, name, seq, now, outcome, state[batch][1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("stride", [100_000, 7])
def test_requests_are_folded_in_order(spark, stride):
    rng = random.Random(stride)
    given = []
    for seq in range(600):
        batch = rng.choice(["hot", "hot", "b", "c", "known", "done"])
        if rng.random() < 0.6:
            given.append((batch, seq, "CLAIM", rng.choice(["p", "p", "p", "q"]), None))
        else:
            given.append((batch, seq, "COMPLETE", None, rng.choice(["FAILED", "FAILED", "SUCCESS"])))
    given += [("twice", 5, "CLAIM", "p", None), ("twice", 6, "CLAIM", "p", None), ("twice", 9, "COMPLETE", None, "FAILED"), ("twice", 11, "CLAIM", "p", None)]
    known = [("known", "p", "FAILED", 1), ("done", "q", "SUCCESS", 1)]
    found = lifecycle.batch_transition(local_rows(spark, given, REQUEST).repartition(4), local_rows(spark, known, LOG), stride)
    got = sorted(((r.batch_id, r.pipeline_name, r.seq, r.current_status, r.outcome, r.new_status) for r in found.collect()), key=str)
    assert got == judged(given, known)
    assert [x[4] for x in got if x[0] == "twice"] == ["CLAIM_RETRY", "CLAIM_NEW", "REJECT_RUNNING"]


def test_two_claims_at_once(spark):
    asked = local_rows(spark, [("new", "b"), ("new", "a"), ("new", "a")], "batch_id STRING, pipeline_name STRING")
    got = lifecycle.batch_transition(asked, local_rows(spark, [], LOG)).collect()
    assert sorted((r.pipeline_name, r.outcome) for r in got) == [("a", "CLAIM_NEW"), ("a", "REJECT_RUNNING"), ("b", "REJECT_OTHER_PIPELINE")]


# --- logs by part and day ------------------------------------------------------------------------------------


def test_a_claim_reads_few_of_many_files(spark, warehouse):
    from datetime import date

    from oreflow.model import BATCH_LOG_DDL

    many = [(f"b{i}", "p", rows.DAY, None, status, None, None, seq) for i in range(1000) for seq, status in ((1, "RUNNING"), (2, "FAILED"))]
    for day in (1, 2):
        warehouse.append_log("batches", local_rows(spark, many[day - 1 :: 2], BATCH_LOG_DDL), date(2026, 1, day))
    own = warehouse.log("batches", "b7")
    assert [(r.seq, r.status) for r in own.orderBy("seq").collect()] == [(1, "RUNNING"), (2, "FAILED")]
    assert len(own.inputFiles()) <= 4 and len(warehouse.log("batches").inputFiles()) >= 32
    assert warehouse.log("batches").count() == 2000
    late = warehouse.log_since("batches", date(2026, 1, 2))
    assert late.count() == 1000 and all("day=2026-01-02" in x for x in late.inputFiles())
    assert warehouse.log_since("batches", date(2026, 1, 3)).count() == 0
    assert warehouse.log_since("batches", None).count() == 2000
