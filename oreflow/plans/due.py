"""Rows that waited in quarantine for their parents and could be promoted now, and their promotion.

A row waits when missing parents are all that its evidence names.  Only evidence that a parent's newer state can have
answered is looked at: without a version of a parent published since the evidence there is nothing to join, and of a
parent's Silver only rows written since the oldest waiting evidence are read to find what came in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.model import ENTITIES, EntitySpec, RunContext
from oreflow.plans.loads import StageResult, load_silver
from oreflow.sources.warehouse import Warehouse


def waiting_rows(evidence: DataFrame, spec: EntitySpec) -> DataFrame:
    """``batch_id``, key and parent columns of rows whose every reason is a missing parent, with ``waits_since``."""
    rest: Column = F.col("failure_reason")
    for parent in spec.parents:
        rest = F.replace(rest, F.lit(parent.message + spec.parent_suffix), F.lit(""))
    columns = dict.fromkeys(("batch_id", spec.key, *(p.column for p in spec.parents)))
    return evidence.filter((rest == "") & (F.col("failure_reason") != "")).groupBy(*columns).agg(
        F.max("quarantined_at").alias("waits_since")
    )


def due_rows(waiting: DataFrame, parents: dict[str, DataFrame], silver: DataFrame | None, spec: EntitySpec) -> DataFrame:
    """``batch_id``, key and ``waits_since`` of waiting rows that may enter Silver now: a parent came in since, and none is missing.

    Left out are rows whose key Silver holds in a state written since: they were promoted, or a newer batch was.
    """
    oldest = waiting.agg(F.min("waits_since")).first()[0]
    if oldest is None:
        return waiting.select("batch_id", spec.key, "waits_since")
    came = []
    for parent in spec.parents:
        recent = parents[parent.entity].filter(F.col("processed_at") >= F.lit(oldest)).select(
            F.col(ENTITIES[parent.entity].key).alias("_parent"), F.col("processed_at").alias("_came")
        )
        came.append(waiting.join(recent, (F.col(parent.column) == F.col("_parent")) & (F.col("_came") >= F.col("waits_since")), "left_semi"))
    due = reduce(DataFrame.unionByName, came).distinct() if len(came) > 1 else came[0]
    if len(came) > 1:  # the one that came in may not be the only one that was missing
        for parent in spec.parents:
            held = parents[parent.entity].select(F.col(ENTITIES[parent.entity].key).alias("_parent"))
            due = due.join(held, F.col(parent.column) == F.col("_parent"), "left_semi")
    if silver is not None:
        newer = silver.filter(F.col("processed_at") >= F.lit(oldest)).select(F.col(spec.key).alias("_key"), F.col("processed_at").alias("_at"))
        due = due.join(newer, (F.col(spec.key) == F.col("_key")) & (F.col("_at") >= F.col("waits_since")), "left_anti")
    return due.select("batch_id", spec.key, "waits_since")


def due_of(warehouse: Warehouse, spec: EntitySpec) -> DataFrame | None:
    """The due rows of one entity of a warehouse, or None when no parent was published since its evidence."""
    waiting = waiting_rows(warehouse.quarantine(spec), spec)
    oldest = waiting.agg(F.min("waits_since")).first()[0]
    published = {p.entity: warehouse.last_published(ENTITIES[p.entity]) for p in spec.parents}
    if oldest is None or not any(at is not None and at >= oldest for at in published.values()):
        return None
    parents = {p.entity: warehouse.silver_or_empty(ENTITIES[p.entity]) for p in spec.parents}
    return due_rows(waiting, parents, warehouse.silver(spec), spec)


DUE_DDL = "entity STRING, batch_id STRING, rows_due BIGINT"


def batches_due(warehouse: Warehouse) -> DataFrame:
    """``entity, batch_id, rows_due``: batches that would gain rows if they were brought into Silver again now."""
    found = [warehouse.empty(DUE_DDL)]
    for spec in ENTITIES.values():
        due = due_of(warehouse, spec) if spec.parents else None
        if due is not None:
            found.append(due.groupBy("batch_id").agg(F.count("*").alias("rows_due")).select(F.lit(spec.name).alias("entity"), "batch_id", "rows_due"))
    return reduce(DataFrame.unionByName, found)


def promote_due(warehouse: Warehouse, ctx: RunContext) -> list[tuple[str, StageResult]]:
    """Bring all due rows into Silver, parents first, so that rows that waited for promoted rows follow at once, and of
    each entity the batch that has waited longest first.

    Only the due rows of a batch are taken, from its Bronze; whatever newer batches made of its other rows stays.
    Evidence is kept.  Returns each batch's id with its result.
    """
    results = []
    for spec in ENTITIES.values():
        due = due_of(warehouse, spec) if spec.parents else None
        if due is None:
            continue
        rows = warehouse.stage(f"{spec.name}_due", ctx, due)
        oldest_first = rows.groupBy("batch_id").agg(F.min("waits_since").alias("since")).orderBy("since", "batch_id")
        for batch_id, _ in oldest_first.collect():
            own = RunContext(ctx.pipeline_run_id, batch_id, ctx.at)
            keys = rows.filter(F.col("batch_id") == batch_id).select(spec.key)
            results.append((batch_id, StageResult(f"{spec.name}_silver", **load_silver(warehouse, spec, own, keys))))
        warehouse.clear_stage(f"{spec.name}_due", ctx)
    return results
