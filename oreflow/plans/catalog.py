"""Every operator as a named query ``(spark, sf_dir) -> DataFrame`` over the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions import columns as fc
from oreflow.functions.rules import field_messages, fields_valid
from oreflow.model import COMMERCE_PIPELINE, CUSTOMER_PIPELINE, CUSTOMERS, ENTITIES, ORDERS, PRODUCTS, RunContext
from oreflow.operators import bronze as b
from oreflow.operators import contracts, lifecycle, monitoring, quality, silver
from oreflow.operators import customers as c
from oreflow.plans import daily, due, kept, loads, steps
from oreflow.plans.health import warehouse_health
from oreflow.plans.scenario import CONTEXTS, EMAIL_SUFFIX, FIRST, HANDLED, INTERRUPTED, SECOND, Scenario, shown
from oreflow.sources import testdata
from oreflow.sources.local import local_rows
from oreflow.sources.scratch import scratch_path, written
from oreflow.sources.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
CHECKED = [name for name, spec in ENTITIES.items() if spec.has_quarantine]


def _flag(condition: Column, name: str) -> Column:
    return condition.cast("int").alias(name)


def _warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, label))


@contextmanager
def _throwaway(spark: SparkSession, label: str) -> Iterator[Warehouse]:
    """A warehouse for a query whose result does not read from it."""
    warehouse = _warehouse(spark, label)
    try:
        yield warehouse
    finally:
        warehouse.remove()


def _key_and_hash(df: DataFrame, entity: str) -> DataFrame:
    return shown(df.select(ENTITIES[entity].key, "record_hash"))


# --- scans and sinks -----------------------------------------------------------------------------------


def src(entity: str, s: Scenario) -> DataFrame:
    return s.source(entity)


def stage_replace_run(s: Scenario) -> DataFrame:
    """Two runs stage their orders; one of them stages again and replaces only its own rows."""
    warehouse = _warehouse(s.spark, "stage")
    first = warehouse.stage("orders", FIRST, s.landed("orders", 1))
    warehouse.stage("orders", SECOND, s.landed("orders", 1))
    second = warehouse.stage("orders", SECOND, s.landed("orders", 2))
    rows = [df.withColumn("pipeline_run_id", F.lit(x.pipeline_run_id)) for df, x in ((first, FIRST), (second, SECOND))]
    return shown(rows[0].unionByName(rows[1]).select("pipeline_run_id", "order_id", "record_hash"))


def bronze_append(entity: str, s: Scenario) -> DataFrame:
    """Batch 1, an interrupted attempt at batch 2, the attempt that adds what was missing, and the same once more."""
    spec, warehouse = ENTITIES[entity], _warehouse(s.spark, f"bronze-{entity}")
    steps = ((FIRST, s.rows(entity, 1)), (INTERRUPTED, s.rows(entity).filter(HANDLED[entity])), (SECOND, s.rows(entity)), (SECOND, s.rows(entity)))
    for ctx, rows in steps:
        held = warehouse.bronze_batch(spec, ctx.batch_id)
        new = b.enforce_contract(b.landing_rows(rows, held, spec, ctx), spec, b.violations(spec))
        warehouse.append_bronze(spec, ctx, new, unique=entity == "customers")
    written = warehouse.bronze(spec)
    return shown(written.select(spec.key, "batch_id", "pipeline_run_id", "ingested_at", "record_hash"))


def quarantine_append(s: Scenario) -> DataFrame:
    """All four quarantine tables written and read back; two attempts at batch 2 for the keyed three."""
    warehouse = _warehouse(s.spark, "quarantine")
    errors = quality.quarantine_customers(quality.customer_errors(s.source("customers")), SECOND)
    warehouse.append_quarantine(CUSTOMERS, SECOND, errors)
    parts = [
        warehouse.quarantine(CUSTOMERS).select(
            F.lit("customers").alias("entity"), F.col("customer_id").cast("string").alias("record_key"), "pipeline_run_id",
            F.col("validation_message").alias("reason"),
        )
    ]
    for entity in CHECKED:
        spec = ENTITIES[entity]
        rejected = warehouse.stage(f"{entity}_rejected", SECOND, s.rejected(entity))
        for ctx, rows in ((INTERRUPTED, rejected.filter(HANDLED[entity])), (SECOND, rejected)):
            held = warehouse.quarantine_part(spec, ctx)
            warehouse.append_quarantine(spec, ctx, silver.quarantine_rows(rows, held, spec, ctx))
        parts.append(
            warehouse.quarantine(spec).select(
                F.lit(entity).alias("entity"), F.col(spec.key).cast("string").alias("record_key"), "pipeline_run_id",
                F.col("failure_reason").alias("reason"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def silver_publish(s: Scenario) -> DataFrame:
    """Two versions published, the current one read through the ledger."""
    warehouse = _warehouse(s.spark, "silver")
    warehouse.publish_silver(PRODUCTS, FIRST, silver.as_inserted(s.batch("products", 1), PRODUCTS, FIRST))
    batch, held = s.batch("products"), warehouse.silver(PRODUCTS)
    changes = warehouse.stage("products_changes", SECOND, silver.silver_changes(batch, held, PRODUCTS))
    buckets = warehouse.touched_buckets(PRODUCTS, changes)
    state = silver.apply_changes(batch, warehouse.silver(PRODUCTS, buckets), changes, PRODUCTS, SECOND)
    warehouse.publish_silver(PRODUCTS, SECOND, state, silver.merge_counts(changes).first().asDict(), buckets)
    return shown(warehouse.silver(PRODUCTS))


def ops_log_append(s: Scenario) -> DataFrame:
    """All four logs, start rows and completion rows appended separately, then reduced to the current state."""
    warehouse = _warehouse(s.spark, "ops")
    runs, batches = testdata.run_log(s.spark, s.sf_dir), testdata.batch_log(s.spark, s.sf_dir)
    for seq in (1, 2):
        warehouse.append_log("pipeline_runs", runs.filter(F.col("seq") == seq))
        warehouse.append_log("batches", batches.filter(F.col("seq") == seq))
    warehouse.append_log("stage_runs", s.stages().withColumn("seq", F.lit(1).cast("bigint")))
    warehouse.append_log("events", testdata.event_log(s.spark, s.sf_dir))
    def shared(rows: DataFrame, log: str, key: str, status: str = "status") -> DataFrame:
        columns = {"log": F.lit(log), "id": F.col(key), "status": F.col(status)}
        for name, kind in LOG_COLUMNS.items():
            columns[name] = (F.col(name) if name in rows.columns else F.lit(None)).cast(kind)
        return rows.select(*[value.alias(name) for name, value in columns.items()])

    parts = [
        shared(lifecycle.latest_state(warehouse.log(name), key), name, key)
        for name, key in (("pipeline_runs", "pipeline_run_id"), ("batches", "batch_id"), ("stage_runs", "stage_run_id"))
    ]
    parts.append(shared(warehouse.log("events"), "events", "pipeline_run_id", "event_type"))
    result = parts[0]
    for more in parts[1:]:
        result = result.unionByName(more)
    return result


#: What the logs have in common or one of them has alone, compared where a log has it.
LOG_COLUMNS = {
    "pipeline_name": "string", "batch_id": "string", "stage_name": "string", "started_at": "timestamp_ntz", "completed_at": "timestamp_ntz",
    "event_time": "timestamp_ntz", "rows_processed": "bigint", "error_message": "string",
}


# --- projections ---------------------------------------------------------------------------------------


def hashes(entity: str, s: Scenario) -> DataFrame:
    return _key_and_hash(b.fingerprint(s.source(entity), ENTITIES[entity]), entity)


def iso_timestamp(s: Scenario) -> DataFrame:
    midnight = "CAST(to_date(ts) AS TIMESTAMP_NTZ)"
    return testdata.table(s.spark, s.sf_dir, "events").selectExpr(
        "event_id", f"{fc.iso_timestamp('ts')} AS iso_text", f"{fc.iso_timestamp(midnight)} AS iso_midnight"
    )


def decimal_text(s: Scenario) -> DataFrame:
    return s.source("products").selectExpr(
        "product_id", *[f"{fc.decimal_text(x)} AS {x}_text" for x in ("unit_cost", "unit_price")]
    )


def stamp_lineage(s: Scenario) -> DataFrame:
    return s.batch("orders").select("order_id", "ingested_at", "pipeline_run_id", "batch_id")


def failure_reasons(entity: str, s: Scenario) -> DataFrame:
    return s.rejected(entity).select(ENTITIES[entity].key, "failure_reason")


def duration_ms(s: Scenario) -> DataFrame:
    return s.runs().selectExpr("pipeline_run_id", f"{fc.duration_ms('started_at', 'completed_at')} AS duration_ms")


def metric_date(s: Scenario) -> DataFrame:
    return s.runs().selectExpr("pipeline_run_id", f"{fc.metric_date('started_at')} AS metric_date")


def null_defaults(s: Scenario) -> DataFrame:
    stages = monitoring.stage_metrics(s.stages())
    rows = fc.or_zero("bronze_rows_processed")
    return s.runs().join(stages, "pipeline_run_id", "left").selectExpr(
        "pipeline_run_id", f"{rows} AS rows_or_zero", f"nullif({rows}, 0L) AS rows_or_null"
    )


def success_rate_pct(s: Scenario) -> DataFrame:
    rate = F.expr(fc.success_rate_pct("count_if(status = 'SUCCESS')", "count(*)"))
    day = F.expr(fc.metric_date("started_at"))
    return s.runs().groupBy(day.alias("metric_date")).agg(rate.alias("success_rate_pct"))


def stable_batch_id(s: Scenario) -> DataFrame:
    name = "concat('load:', pipeline_run_id)"
    return s.runs().selectExpr("pipeline_run_id", f"{fc.stable_id(name)} AS batch_id")


# --- predicates ----------------------------------------------------------------------------------------


def validate_customers(s: Scenario) -> DataFrame:
    return quality.customer_errors(s.source("customers")).select(
        "customer_id", "email", "validation_rule", "validation_message"
    )


def valid_customers(s: Scenario) -> DataFrame:
    return quality.valid_customers(s.source("customers"))


def validate_list(entity: str, s: Scenario) -> DataFrame:
    spec = ENTITIES[entity]
    return s.source(entity).selectExpr(spec.key, f"posexplode({field_messages(spec)}) AS (position, message)")


def field_valid(entity: str, s: Scenario) -> DataFrame:
    return s.source(entity).filter(fields_valid(ENTITIES[entity]))


def batch_scope(s: Scenario) -> DataFrame:
    return b.batch_scope(s.bronze("orders"), SECOND.batch_id).select("order_id", "batch_id", "status", "total_amount")


def hash_changed(s: Scenario) -> DataFrame:
    held = s.silver("products", 1).selectExpr("product_id", "record_hash AS held")
    changed = silver.hash_changed("record_hash", "held")
    return s.batch("products").join(held, "product_id").selectExpr("product_id", f"CAST({changed} AS INT) AS changed")


def email_suffix_like(s: Scenario) -> DataFrame:
    return s.batch("customers").filter(c.email_suffix(EMAIL_SUFFIX)).select("customer_id", "email")


def completed_runs_only(s: Scenario) -> DataFrame:
    return monitoring.completed_only(s.runs()).select("pipeline_run_id", "completed_at", "status")


def pipeline_name_filter(s: Scenario) -> DataFrame:
    return monitoring.of_pipeline(s.runs(), COMMERCE_PIPELINE).select("pipeline_run_id", "pipeline_name", "status")


def schema_contract(s: Scenario) -> DataFrame:
    counts = contracts.count_violations(
        testdata.batch_log(s.spark, s.sf_dir), "batches", contracts.BATCH_CHECKS
    ).unionByName(contracts.count_violations(s.events(), "events", contracts.EVENT_CHECKS))
    # Source customers are checked against the Silver contract: their null names are what it must find.
    for entity in ENTITIES:
        rows = b.fingerprint(s.source(entity), ENTITIES[entity])
        checks = contracts.silver_checks(ENTITIES[entity])
        counts = counts.unionByName(contracts.count_violations(rows, entity, checks))
    return counts


# --- joins ---------------------------------------------------------------------------------------------


def bronze_new_rows(entity: str, s: Scenario) -> DataFrame:
    rows = b.landing_rows(s.rows(entity), s.interrupted_bronze(entity), ENTITIES[entity], SECOND)
    return shown(rows.select(ENTITIES[entity].key, "pipeline_run_id", "batch_id", "record_hash"))


def orders_orphans(s: Scenario) -> DataFrame:
    return silver.orphans(s.batch("orders"), s.parents("orders"), ORDERS, s.missing("orders")).select("order_id", "customer_id")


def with_parents(entity: str, s: Scenario) -> DataFrame:
    spec = ENTITIES[entity]
    joined = silver.with_parents(s.batch(entity), s.parents(entity), spec, s.missing(entity))
    flags = [_flag(F.col(f"_{p.entity}_key").isNull(), f"{p.entity}_missing") for p in spec.parents]
    return joined.select(spec.key, *flags)


def promotable(entity: str, s: Scenario) -> DataFrame:
    return s.trusted(entity).select(*ENTITIES[entity].columns)


def silver_changed(entity: str, s: Scenario) -> DataFrame:
    return _key_and_hash(silver.silver_changed(s.keyed(entity), s.silver(entity, 1), ENTITIES[entity]), entity)


def silver_new(entity: str, s: Scenario) -> DataFrame:
    return _key_and_hash(silver.silver_new(s.keyed(entity), s.silver(entity, 1), ENTITIES[entity]), entity)


def quarantine_new(entity: str, s: Scenario) -> DataFrame:
    spec = ENTITIES[entity]
    rows = silver.quarantine_new(s.rejected(entity), s.held_quarantine(entity), spec, SECOND)
    return rows.select(spec.key, "failure_reason")


def health_join(s: Scenario) -> DataFrame:
    return monitoring.health_join(
        monitoring.run_metrics(s.runs()).select("pipeline_run_id", "status", "duration_ms"),
        monitoring.stage_metrics(s.stages()),
        monitoring.quarantine_metrics(s.quarantined_customers()),
        monitoring.event_metrics(s.events()),
    )


def silver_hash_lookup(s: Scenario) -> DataFrame:
    """Latest Bronze versions against the Silver of the batch before: some match, differ or are missing."""
    return c.silver_hash_lookup(c.latest_customers(s.bronze("customers")), s.silver("customers", 1), EMAIL_SUFFIX)


# --- aggregates, windows, top-n ------------------------------------------------------------------------


def avg_duration(s: Scenario) -> DataFrame:
    return (
        monitoring.run_metrics(s.runs())
        .groupBy("pipeline_name", "status")
        .agg(F.expr(fc.average_decimal("duration_ms")).alias("average_duration_ms"))
    )


def customer_invalid_rate(s: Scenario) -> DataFrame:
    return quality.customer_invalid_rate(s.source("customers"))


def batch_rows_processed(s: Scenario) -> DataFrame:
    return lifecycle.batch_rows_processed(testdata.stage_results(s.spark, s.sf_dir))


def _silver_facts(merged: DataFrame, rejected: DataFrame | None, label: Column) -> DataFrame:
    """Rows to be summed into inserted / updated / quarantined counts."""
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    is_new, is_changed = (F.col("merge_action") == x for x in (silver.INSERT, silver.UPDATE))
    facts = merged.select(
        label, _flag(is_new, "rows_inserted"), _flag(is_changed, "rows_updated"), zero.alias("rows_quarantined")
    )
    if rejected is None:
        return facts
    return facts.unionByName(
        rejected.select(label, *[zero.alias(x) for x in ("rows_inserted", "rows_updated")], one.alias("rows_quarantined"))
    )


def _sum_facts(facts: list[DataFrame], *keys: str) -> DataFrame:
    union = facts[0]
    for more in facts[1:]:
        union = union.unionByName(more)
    return union.groupBy(*keys).agg(*[F.sum(x).alias(x) for x in ("rows_inserted", "rows_updated", "rows_quarantined")])


def stage_result_counts(s: Scenario) -> DataFrame:
    counts = [
        silver.batch_counts(s.rows(entity), s.parents(entity), s.silver(entity, 1), spec, s.missing(entity)).withColumn("stage_name", F.lit(f"{entity}_silver"))
        for entity, spec in ENTITIES.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def latest_customers(s: Scenario) -> DataFrame:
    return shown(c.latest_customers(s.bronze("customers")))


def latest_customers_kept(s: Scenario) -> DataFrame:
    """Three batches taken in one after another; the last to come is older than the second."""
    warehouse = _warehouse(s.spark, "kept")
    late = RunContext("00000000-0000-4000-8000-0000000000a5", "00000000-0000-4000-8000-0000000000b3", datetime(2024, 2, 1, 18))
    for ctx, rows in ((FIRST, s.batch("customers", 1)), (SECOND, s.batch("customers")), (late, None)):
        if rows is None:
            rows = b.stamp_lineage(s.landed("customers", 1).filter("customer_id % 3 = 0"), late)
        warehouse.append_bronze(CUSTOMERS, ctx, rows, unique=True)
        kept.refresh_latest(warehouse, ctx)
    return shown(kept.latest_bronze(warehouse))


def quarantine_metrics_merged(s: Scenario) -> DataFrame:
    """Each append reduced to bitmaps on its own; then only bitmaps are merged."""
    evidence = testdata.wide_quarantine(s.spark, s.sf_dir)
    appends = [monitoring.quarantine_parts(evidence.filter(F.col("append") == n)) for n in range(3)]
    parts = written(appends[0].unionByName(appends[1]).unionByName(appends[2]), "quarantine-parts")
    return monitoring.quarantine_metrics_of_parts(monitoring.merged_quarantine_parts(parts))


def duplicate_customers(s: Scenario) -> DataFrame:
    return quality.duplicate_customers(s.source("customers"))


def latest_state(s: Scenario) -> DataFrame:
    return lifecycle.latest_state(testdata.run_log(s.spark, s.sf_dir), "pipeline_run_id")


def customers_ordered(s: Scenario) -> DataFrame:
    return c.ordered(s.source("customers"), "customer_id")


def newest_runs(n: int, s: Scenario) -> DataFrame:
    return lifecycle.newest_runs(s.runs(), n).select("pipeline_run_id", "pipeline_name", "status", "started_at")


def batch_exists(s: Scenario) -> DataFrame:
    """Asked of the ledger, once the batch has landed."""
    with _throwaway(s.spark, "exists") as warehouse:
        warehouse.append_bronze(CUSTOMERS, SECOND, s.batch("customers"), unique=True)
        found = [(x,) for x in (SECOND.batch_id, "never-loaded") if warehouse.batch_exists(CUSTOMERS, x)]
    return local_rows(s.spark, found, "batch_id STRING")


# --- merges, gate, lifecycle ---------------------------------------------------------------------------


def silver_state(entity: str, s: Scenario) -> DataFrame:
    return shown(s.silver(entity))


def quarantine_customers(s: Scenario) -> DataFrame:
    return quality.process_customers(s.source("customers"), SECOND).quarantine


def quarantine(entity: str, s: Scenario) -> DataFrame:
    return silver.quarantine_rows(s.rejected(entity), None, ENTITIES[entity], SECOND)


def promote_after_recovery(s: Scenario) -> DataFrame:
    """Batch 2 of orders loaded before and after its customers arrived."""
    batch, before = s.batch("orders"), s.silver("orders", 1)
    early, late = s.parents("orders", 1), s.parents("orders", 2)
    first = silver.silver_merge(silver.promotable(batch, early, ORDERS), before, ORDERS, INTERRUPTED)
    evidence = silver.quarantine_rows(silver.rejected_rows(batch, early, ORDERS), None, ORDERS, INTERRUPTED)
    first, evidence = written(first, "recovery-first"), written(evidence, "recovery-evidence")
    second = silver.silver_merge(silver.promotable(batch, late, ORDERS), first.drop("merge_action"), ORDERS, SECOND)
    again = silver.quarantine_rows(silver.rejected_rows(batch, late, ORDERS), evidence, ORDERS, SECOND)
    attempt = [F.lit(n).alias("attempt") for n in (1, 2)]
    return _sum_facts([_silver_facts(first, evidence, attempt[0]), _silver_facts(second, again, attempt[1])], "attempt")


def _late_customers(s: Scenario, label: str) -> Warehouse:
    """Batch 2 of orders and payments loaded while Silver had the customers of batch 1 only; then these of batch 2."""
    warehouse = _warehouse(s.spark, label)
    for entity, number, ctx in (("customers", 1, FIRST), ("orders", 1, FIRST), ("orders", 2, INTERRUPTED), ("payments", 2, INTERRUPTED), ("customers", 2, SECOND)):
        loads.run_entity(warehouse, ENTITIES[entity], partial(s.source, entity, number), ctx, threshold=1.0)
    return warehouse


def batches_due(s: Scenario) -> DataFrame:
    return due.batches_due(_late_customers(s, "due"))


def due_promotions(s: Scenario) -> DataFrame:
    """The due rows brought into Silver, orders and then the payments that waited for them; nothing is due after that."""
    warehouse = _late_customers(s, "promotions")
    later = RunContext("00000000-0000-4000-8000-0000000000a4", SECOND.batch_id, datetime(2024, 2, 3))
    results = due.promote_due(warehouse, later) + due.promote_due(warehouse, later)
    return _stage_rows(s.spark, {batch_id: [x for b_id, x in results if b_id == batch_id] for batch_id, _ in results})


def customer_quality_gate(s: Scenario) -> DataFrame:
    result = quality.gate_result(quality.customer_invalid_rate(s.source("customers")))
    return result.withColumn("passed", F.col("passed").cast("int"))


def process_customers(s: Scenario) -> DataFrame:
    valid = quality.process_customers(s.source("customers"), SECOND).valid
    return shown(b.fingerprint(valid, CUSTOMERS))


def batch_transition(s: Scenario) -> DataFrame:
    return lifecycle.batch_transition(
        testdata.batch_requests(s.spark, s.sf_dir), testdata.batch_log(s.spark, s.sf_dir)
    )


def batch_complete(s: Scenario) -> DataFrame:
    log = testdata.batch_log(s.spark, s.sf_dir)
    results = log.filter("seq = 2").select("batch_id", "completed_at", "status", "rows_processed", "error_message")
    started = log.filter("seq = 1")
    return lifecycle.latest_state(started.unionByName(lifecycle.completion_rows(started, results)), "batch_id")


def batch_is_successful(s: Scenario) -> DataFrame:
    return lifecycle.successful_batches(testdata.batch_log(s.spark, s.sf_dir)).select("batch_id", "rows_processed")


def _stage_rows(spark: SparkSession, results: dict[str, list[loads.StageResult]]) -> DataFrame:
    rows = [
        (batch_id, x.stage_name, x.rows_inserted, x.rows_updated, x.rows_quarantined)
        for batch_id, stages in results.items()
        for x in stages
    ]
    ddl = "batch_id STRING, stage_name STRING, rows_inserted BIGINT, rows_updated BIGINT, rows_quarantined BIGINT"
    return local_rows(spark, rows, ddl)


def run_entity(s: Scenario) -> DataFrame:
    """Customers, then the orders that need them, each through Bronze and Silver."""
    stages = []
    with _throwaway(s.spark, "entity") as warehouse:
        for spec in (CUSTOMERS, ORDERS):
            stages += loads.run_entity(warehouse, spec, partial(s.source, spec.name), SECOND)
    return _stage_rows(s.spark, {SECOND.batch_id: stages})


def run_commerce(s: Scenario) -> DataFrame:
    """Both batches through all five entities; stage results per batch."""
    results = {}
    with _throwaway(s.spark, "commerce") as warehouse:
        for number, ctx in CONTEXTS.items():
            extractors = {entity: partial(s.source, entity, number) for entity in ENTITIES}
            results[ctx.batch_id] = loads.run_commerce(warehouse, extractors, ctx).stages
    return _stage_rows(s.spark, results)


def run_customer(s: Scenario) -> DataFrame:
    results = {}
    with _throwaway(s.spark, "customer") as warehouse:
        for number, ctx in CONTEXTS.items():
            results[ctx.batch_id] = loads.run_customer(warehouse, partial(s.source, "customers", number), ctx).stages
    return _stage_rows(s.spark, results)


def customer_run_health(s: Scenario) -> DataFrame:
    """Health over the logs that runs leave: batch 1, an attempt at batch 2 that the gate stops, and its retry."""
    warehouse = _warehouse(s.spark, "health")
    for number, ctx, threshold in ((1, FIRST, 1.0), (2, INTERRUPTED, 0.0), (2, SECOND, 1.0)):
        with suppress(quality.DataQualityError):
            loads.run_customer(warehouse, partial(s.source, "customers", number), ctx, threshold)
    return warehouse_health(warehouse).select(
        "pipeline_run_id", "status", "bronze_rows_processed", "silver_rows_processed", "invalid_customers",
        "validation_errors", "retry_count", "recovery_count",
    )


# --- monitoring ----------------------------------------------------------------------------------------


def _health(s: Scenario, name: str = CUSTOMER_PIPELINE) -> DataFrame:
    return monitoring.pipeline_health(s.runs(), s.stages(), s.events(), s.quarantined_customers(), name)


def failure_summary(s: Scenario) -> DataFrame:
    return lifecycle.failure_summary(s.runs().filter("status = 'FAILED'"), testdata.task_attempts(s.spark, s.sf_dir))


def batch_request_stream(s: Scenario) -> DataFrame:
    """Claims and completions of every batch, judged one after another."""
    return lifecycle.batch_transition(testdata.request_stream(s.spark, s.sf_dir), testdata.known_batches(s.spark, s.sf_dir))


def _month_attempts(s: Scenario) -> DataFrame:
    return lifecycle.stage_attempts(testdata.month_runs(s.spark, s.sf_dir), testdata.stage_executions(s.spark, s.sf_dir))


def stage_attempts(s: Scenario) -> DataFrame:
    """Every execution of a stage as one of the tries of its batch."""
    return _month_attempts(s).drop("dag_run_id")


def logged_retry_events(s: Scenario) -> DataFrame:
    """Retries and recoveries that follow from the stage log alone."""
    return lifecycle.retry_events(_month_attempts(s)).drop("dag_run_id")


def logged_failure_summary(s: Scenario) -> DataFrame:
    """First failed stage of each failed run, from the stage log."""
    failed = testdata.month_runs(s.spark, s.sf_dir).filter("status = 'FAILED'")
    return lifecycle.failure_summary(failed, _month_attempts(s), states=("failed", "up_for_retry"))


def _lost() -> DataFrame:
    raise ConnectionError("source went away")


def customer_steps(s: Scenario) -> DataFrame:
    """Batch 2 in separate steps, each by a warehouse object that knows nothing of the others; the source is lost once.

    Every step is called twice.  What the logs hold in the end: one current row of run and batch, the stages, the events.
    """
    root = scratch_path(s.spark, "steps")
    extract = partial(s.source, "customers", 2)
    fresh = lambda: Warehouse(s.spark, root)
    loads.run_customer(fresh(), partial(s.source, "customers", 1), FIRST, 1.0)
    run_id = SECOND.pipeline_run_id
    for _ in range(2):
        steps.prepare(fresh(), SECOND.batch_id, run_id)
    with suppress(ConnectionError):
        steps.customer_bronze_step(fresh(), _lost, run_id, 1.0)
    for _ in range(2):
        steps.customer_bronze_step(fresh(), extract, run_id, 1.0)
    for _ in range(2):
        steps.customer_silver_step(fresh(), run_id)
    for _ in range(2):
        steps.complete(fresh(), run_id)
    warehouse = fresh()
    of_run = F.col("pipeline_run_id") == run_id
    runs = lifecycle.latest_state(warehouse.log("pipeline_runs"), "pipeline_run_id").filter(of_run)
    batches = lifecycle.latest_state(warehouse.log("batches"), "batch_id").filter(of_run)
    stages = lifecycle.latest_state(warehouse.log("stage_runs"), "stage_run_id").filter(of_run)
    stages = stages.groupBy("stage_name", "status", "error_type").agg(F.sum("rows_processed").alias("n"))
    none = F.lit(None).cast("bigint")
    result = runs.select(
        F.lit("run").alias("log"), F.lit("").alias("name"), "status", none.alias("n"), F.col("error_message").alias("error")
    )
    for more in (
        batches.select(F.lit("batch"), F.lit(""), "status", "rows_processed", "error_message"),
        stages.select(F.lit("stage"), "stage_name", "status", "n", "error_type"),
        warehouse.log("events").filter(of_run).select(
            F.lit("event"), "stage_name", "event_type", F.col("try_number").cast("bigint"), "error_type"
        ),
    ):
        result = result.union(more)
    return result


def daily_metrics_kept(s: Scenario) -> DataFrame:
    """Logs appended on three days out of order, with a refresh after each: runs that end late, stages that come after
    the end.  What is returned was put together from the days' parts alone."""
    warehouse = _warehouse(s.spark, "daily")
    group = F.pmod(F.xxhash64("pipeline_run_id"), F.lit(3))
    runs, stages, events = testdata.run_log(s.spark, s.sf_dir), s.stages().withColumn("seq", F.lit(1).cast("bigint")), testdata.event_log(s.spark, s.sf_dir)
    appends = [
        (runs.filter((group == 0) | ((group == 1) & (F.col("seq") == 1))), stages.filter((group == 0) & (F.col("stage_name") == "bronze")), events.filter(group == 3)),
        (runs.filter(group == 2), stages.filter((group == 2) | ((group == 0) & (F.col("stage_name") == "silver"))), events.filter(group == 0)),
        (runs.filter((group == 1) & (F.col("seq") == 2)), stages.filter(group == 1), events.filter(group != 0)),
    ]
    for number, (some_runs, some_stages, some_events) in enumerate(appends, 1):
        day = date(2035, 1, number)
        for log, rows in (("pipeline_runs", some_runs), ("stage_runs", some_stages), ("events", some_events)):
            warehouse.append_log(log, rows, day)
        ctx = RunContext(f"refresh-{number}", "daily", datetime(2035, 1, number))
        daily.refresh_daily(warehouse, ctx, CUSTOMER_PIPELINE, "bronze", "silver", s.quarantined_customers(), day)
    return daily.kept_daily_metrics(warehouse)


def catalog() -> dict[str, Query]:
    entries: dict[str, Callable[[Scenario], DataFrame]] = {}
    for entity in ENTITIES:
        entries[f"src_{entity}"] = partial(src, entity)
        entries[f"hash_{entity}"] = partial(hashes, entity)
        entries[f"bronze_append_{entity}"] = partial(bronze_append, entity)
        entries[f"bronze_new_rows_{entity}"] = partial(bronze_new_rows, entity)
        entries[f"silver_changed_{entity}"] = partial(silver_changed, entity)
        entries[f"silver_new_{entity}"] = partial(silver_new, entity)
        entries[f"silver_{entity}"] = partial(silver_state, entity)
    for entity in CHECKED:
        entries[f"failure_reason_{entity}"] = partial(failure_reasons, entity)
        entries[f"validate_{entity}"] = partial(validate_list, entity)
        entries[f"{entity}_field_valid"] = partial(field_valid, entity)
        entries[f"{entity}_promotable"] = partial(promotable, entity)
        entries[f"quarantine_{entity}"] = partial(quarantine, entity)
        entries[f"quarantine_new_{entity}"] = partial(quarantine_new, entity)
    for entity in ("order_items", "payments"):
        entries[f"{entity}_parents"] = partial(with_parents, entity)
    for query in (
        stage_replace_run, quarantine_append, silver_publish, ops_log_append,
        iso_timestamp, decimal_text, stamp_lineage, duration_ms, metric_date, null_defaults, success_rate_pct,
        stable_batch_id,
        validate_customers, valid_customers, batch_scope, hash_changed, email_suffix_like, completed_runs_only,
        pipeline_name_filter, schema_contract,
        orders_orphans, health_join, silver_hash_lookup,
        avg_duration, customer_invalid_rate, batch_rows_processed, stage_result_counts,
        latest_customers, duplicate_customers, latest_state, customers_ordered, batch_exists,
        quarantine_customers, promote_after_recovery, customer_quality_gate, process_customers,
        batch_transition, batch_complete, batch_is_successful, run_entity, run_commerce, run_customer, customer_run_health,
        failure_summary, batch_request_stream, stage_attempts, logged_retry_events, logged_failure_summary, customer_steps,
        batches_due, due_promotions, latest_customers_kept, quarantine_metrics_merged,
        daily_metrics_kept,
    ):
        entries[query.__name__] = query
    entries |= {
        "last_run": partial(newest_runs, 1),
        "recent_runs": partial(newest_runs, 5),
        "run_metrics": lambda s: monitoring.run_metrics(s.runs()),
        "stage_run_metrics": lambda s: monitoring.stage_run_metrics(s.stages()),
        "quarantine_metrics": lambda s: monitoring.quarantine_metrics(s.quarantined_customers()),
        "event_metrics": lambda s: monitoring.event_metrics(s.events()),
        "stage_metrics": lambda s: monitoring.stage_metrics(s.stages()),
        "pipeline_health": _health,
        "daily_metrics": lambda s: monitoring.pipeline_daily_metrics(_health(s, COMMERCE_PIPELINE)),
        "pipeline_daily_metrics": lambda s: monitoring.pipeline_daily_metrics(_health(s)),
        "retry_events": lambda s: lifecycle.retry_events(testdata.task_attempts(s.spark, s.sf_dir)),
    }
    return {name: _bind(run) for name, run in entries.items()}


def _bind(run: Callable[[Scenario], DataFrame]) -> Query:
    return lambda spark, sf_dir: _line_keys_as_text(run(Scenario(spark, sf_dir)))


def _line_keys_as_text(df: DataFrame) -> DataFrame:
    """Query output form: keys beyond 64 bits as text."""
    wide = [name for name, kind in df.dtypes if kind == "decimal(38,0)"]
    return df.withColumns({name: F.col(name).cast("string") for name in wide}) if wide else df
