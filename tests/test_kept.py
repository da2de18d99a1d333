"""Results kept up to date: latest versions, daily parts, distinct counts; rows that are due again."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oreflow.model import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS, RUN_LOG_DDL, RunContext
from oreflow.operators import monitoring
from oreflow.operators.customers import latest_customers
from oreflow.plans import daily, due, kept, loads
from oreflow.plans.health import warehouse_health
from oreflow.sources.local import local_rows
from oreflow.sources.warehouse import Warehouse
from tests import rows


def people(spark, *given):
    return rows.frame(spark, CUSTOMERS, *given)


def test_latest_versions_after_late_and_repeated_batches(spark, tmp_path, monkeypatch):
    fresh = lambda: Warehouse(spark, str(tmp_path / "w"))
    read = []
    original = Warehouse._read_bronze
    monkeypatch.setattr(Warehouse, "_read_bronze", lambda self, spec, paths: read.append(paths) or original(self, spec, paths))
    batches = [
        (rows.context("r1", "b1", 5), [rows.customer(i, first="one") for i in range(1, 200)]),
        (rows.context("r2", "b2", 9), [rows.customer(7, first="two"), rows.customer(900, first="two")]),
        (rows.context("r3", "b3", 7), [rows.customer(7, first="late"), rows.customer(8, first="late")]),  # older than b2
    ]
    for ctx, given in batches:
        rows.land(fresh(), "customers", people(spark, *given), ctx)
        read.clear()
        assert kept.refresh_latest(fresh(), ctx) == 1
        assert [len(x) for x in read] == [1] and f"batch_id={ctx.batch_id}" in read[0][0]  # nothing but the new write
        whole = latest_customers(fresh().bronze(CUSTOMERS))
        assert sorted(map(tuple, kept.latest_bronze(fresh()).select(whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    names = {r.customer_id: r.first_name for r in kept.latest_bronze(fresh()).filter("customer_id in (7, 8, 9, 900)").collect()}
    assert names == {7: "two", 8: "late", 9: "one", 900: "two"}
    assert kept.refresh_latest(fresh(), batches[0][0]) == 0
    # Only buckets with one of the batch's keys were written again.
    versions = fresh().log("silver_ledger", "customers_latest").orderBy("version").collect()
    assert [sum(a != b for a, b in zip(x.paths, y.paths, strict=True)) for x, y in zip(versions, versions[1:], strict=False)] == [2, 2]


def run(run_id, status, seq, started, ended=None, name="customer_pipeline"):
    return (run_id, name, "b", started, ended, status, None, seq)


def test_daily_parts_after_appends_in_any_order(spark, tmp_path):
    fresh = lambda: Warehouse(spark, str(tmp_path / "w"))
    at = lambda day, hour: datetime(2026, 3, day, hour)
    stage = lambda run_id, name, n, start: (f"{run_id}-{name}", run_id, name, start, start + timedelta(seconds=n), "SUCCESS", n, None, 1)
    event = lambda run_id, kind: (run_id, "b", "customer_pipeline", "customer_bronze", kind, at(9, 9), None, 1, None, None)
    appends = [
        (4, [("pipeline_runs", [run("a", "RUNNING", 1, at(1, 8)), run("a", "SUCCESS", 2, at(1, 8), at(1, 9)), run("late", "RUNNING", 1, at(1, 23)),
                                run("c", "RUNNING", 1, at(4, 1)), run("c", "FAILED", 2, at(4, 1), at(4, 2)), run("x", "RUNNING", 1, at(1, 1), None, "commerce")]),
             ("stage_runs", [stage("a", "customer_bronze", 5, at(1, 8)), stage("late", "customer_bronze", 7, at(1, 23))]), ("events", [event("a", "RETRY")])]),
        (6, [("pipeline_runs", [run("d", "RUNNING", 1, at(6, 1)), run("d", "SUCCESS", 2, at(6, 1), at(6, 3))])]),
        (8, [("pipeline_runs", [run("late", "SUCCESS", 2, at(1, 23), at(8, 1))]), ("events", [event("c", "RETRY"), event("late", "RECOVERED")]),
             ("stage_runs", [stage("c", "customer_silver", 9, at(4, 1))])]),
        (9, [("pipeline_runs", [run("d", "RUNNING", 3, at(9, 1))])]),  # repeated under its id: it leaves its day
        (10, [("pipeline_runs", [run("d", "SUCCESS", 4, at(9, 1), at(9, 2))])]),
    ]
    reopened = []
    for number, (day, logs) in enumerate(appends):
        for name, given in logs:
            fresh().append_log(name, given, date(2026, 3, day))
        reopened.append(daily.refresh_daily(fresh(), rows.context(f"r{number}", "daily"), today=date(2026, 3, day)))
        want = monitoring.pipeline_daily_metrics(warehouse_health(fresh()))
        assert sorted(map(tuple, daily.kept_daily_metrics(fresh()).select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert reopened == [2, 3, 3, 4, 2]  # rows of the last refresh's own day are read again
    assert daily.refresh_daily(fresh(), rows.context("r9", "daily"), "commerce", today=date(2026, 3, 10)) == 1
    assert daily.kept_daily_metrics(fresh(), "commerce").count() == 0


def test_a_refresh_reads_new_rows_and_touched_days_only(spark, warehouse, monkeypatch):
    for day in range(1, 6):
        start = datetime(2026, 3, day)
        warehouse.append_log("pipeline_runs", [run(f"r{day}", "RUNNING", 1, start), run(f"r{day}", "SUCCESS", 2, start, start)], date(2026, 3, day))
        if day == 4:
            daily.refresh_daily(warehouse, rows.context("x", "daily"), today=date(2026, 3, 4))
    read = []
    original = Warehouse.log_since
    monkeypatch.setattr(Warehouse, "log_since", lambda self, name, day: read.append((name, day)) or original(self, name, day))
    monkeypatch.setattr(daily, "_rows_of_days", lambda w, ddl, paths: read.append(paths) or w.empty(ddl))
    assert daily.refresh_daily(warehouse, rows.context("y", "daily"), today=date(2026, 3, 5)) == 2  # of the day of the last refresh too
    assert {x[1] for x in read if isinstance(x, tuple)} == {date(2026, 3, 4), date(2026, 3, 3)}
    assert [len(x) for x in read if isinstance(x, list)] == [1]


def test_distinct_counts_by_bitmaps(spark):
    ids = [1, 1, 0, -5, -5, 32768, 32769, 1 << 40, (1 << 40) + 1, 1 << 62, -(1 << 62), None, None, 7]
    given = local_rows(spark, [("r1", x) for x in ids] + [("r2", None), ("r3", 5), ("r3", 5)], "pipeline_run_id STRING, customer_id BIGINT")
    parts = [monitoring.quarantine_parts(given.filter(F.pmod(F.xxhash64("customer_id"), F.lit(3)) == n)) for n in range(3)] + [monitoring.quarantine_parts(given)]
    merged = monitoring.merged_quarantine_parts(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    for found in (monitoring.quarantine_metrics_of_parts(merged), monitoring.quarantine_metrics_of_parts(parts[3])):
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, monitoring.quarantine_metrics(given).collect()))
    twice = monitoring.quarantine_metrics_of_parts(monitoring.merged_quarantine_parts(parts[3].unionByName(parts[3])))
    assert {r.pipeline_run_id: r.invalid_customers for r in twice.collect()} == {"r1": 10, "r2": 0, "r3": 1}


def test_daily_parts_merge(spark):
    given = [run(f"r{i}", ("SUCCESS", "FAILED")[i % 2], 1, datetime(2026, 1, 1 + i % 3), datetime(2026, 1, 1 + i % 3, 1, i)) for i in range(30)]
    health = monitoring.pipeline_health(
        local_rows(spark, given, RUN_LOG_DDL), *(local_rows(spark, [], ddl) for ddl in (
            "stage_run_id STRING, pipeline_run_id STRING, stage_name STRING, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, status STRING, rows_processed BIGINT, error_message STRING",
            "pipeline_run_id STRING, event_type STRING", "pipeline_run_id STRING, customer_id BIGINT")))
    halves = [monitoring.daily_parts(health.filter(f"pmod(hash(pipeline_run_id), 2) = {n}")) for n in (0, 1)]
    found = monitoring.daily_metrics_of_parts(monitoring.merged_daily_parts(halves[0].unionByName(halves[1])))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, monitoring.pipeline_daily_metrics(health).collect()))


# --- rows that are due ---------------------------------------------------------------------------------------


def test_due_rows_are_promoted_as_a_full_reload_would(spark, tmp_path):
    def loaded(name, last):
        w = Warehouse(spark, str(tmp_path / name))
        load = lambda e, ctx, *given: loads.run_entity(w, ENTITIES[e], lambda: rows.frame(spark, ENTITIES[e], *given), ctx, threshold=1.0)
        load("products", rows.context("r1", "b1", 1), rows.product(1))
        load("orders", rows.context("r1", "b1", 1), rows.order(10, 1), rows.order(11, 2), rows.order(12, 3, total="-1.00"))
        load("order_items", rows.context("r1", "b1", 1), rows.item(100, 10, 1), rows.item(101, 11, 1), rows.item(102, 10, 9), rows.item(103, 99, 1))
        load("payments", rows.context("r1", "b1", 1), rows.payment(500, 10), rows.payment(501, 11))
        assert due.batches_due(w).count() == 0
        load("customers", rows.context("r2", "b2", 2), rows.customer(1))
        load("orders", rows.context("r3", "b3", 3), rows.order(11, 1, total="7.00"))  # a newer state of a row that waits
        last(w)
        return {spec.name: sorted(map(tuple, w.silver_or_empty(spec).drop("processed_at").collect()), key=str) for spec in (ORDERS, ORDER_ITEMS, PAYMENTS)}, w

    def promote(w):
        assert [tuple(r) for r in due.batches_due(w).orderBy("entity").collect()] == [("order_items", "b1", 1), ("orders", "b1", 1), ("payments", "b1", 1)]
        later = rows.context("r4", "unused", 4)
        found = [(b, s.stage_name, s.rows_inserted) for b, s in due.promote_due(w, later)]
        assert found == [("b1", "orders_silver", 1), ("b1", "order_items_silver", 2), ("b1", "payments_silver", 2)]
        assert due.batches_due(w).count() == 0 and due.promote_due(w, rows.context("r5", "unused", 5)) == []

    def reload(w):
        for spec in (ORDERS, ORDER_ITEMS, PAYMENTS):
            if spec is ORDERS:  # the row that a newer batch made is not to be turned back
                loads.load_silver(w, spec, RunContext("r4", "b1", datetime(2026, 11, 4)), local_rows(spark, [(10,), (12,)], "order_id BIGINT"))
            else:
                loads.load_silver(w, spec, RunContext("r4", "b1", datetime(2026, 11, 4)))

    assert loaded("a", promote)[0] == loaded("b", reload)[0]


@pytest.mark.parametrize("reason, waits", [
    ("OrderID does not exist in silver.Orders; ", True), ("ProductID does not exist in silver.Products; ", True),
    ("OrderID does not exist in silver.Orders; ProductID does not exist in silver.Products; ", True),
    ("Quantity must be greater than zero; OrderID does not exist in silver.Orders; ", False), ("", False),
])
def test_only_missing_parents_make_a_row_wait(spark, reason, waits):
    evidence = local_rows(spark, [(1, 2, 3, "b", reason, rows.DAY)], "order_item_id BIGINT, order_id BIGINT, product_id BIGINT, batch_id STRING, failure_reason STRING, quarantined_at TIMESTAMP_NTZ")
    assert due.waiting_rows(evidence, ORDER_ITEMS).count() == waits


def test_products_have_nothing_to_wait_for(warehouse):
    assert due.due_of(warehouse, ORDERS) is None and not PRODUCTS.parents
