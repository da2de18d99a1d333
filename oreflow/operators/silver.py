"""Parent checks, quarantine and the current-state merge, driven by an EntitySpec."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.columns import packed_hash, same_key, shorter_than_hash, timestamp_literal, unpacked_hash
from oreflow.functions.rules import failure_reason, fields_valid
from oreflow.model import EntitySpec, Parent, RunContext
from oreflow.operators.bronze import fingerprint_by_key
from oreflow.sources.scratch import written

INSERT, UPDATE, KEEP = "insert", "update", "keep"
# What ``settled`` is told of a row: it is there, it comes in, or its key goes.
HELD, COMING, GOING = 0, 1, 2


def missing_keys(batch: DataFrame, parents: dict[str, DataFrame], parent: Parent) -> DataFrame:
    """The keys that a batch refers to and the parent's Silver does not hold, each once.

    Only keys are shuffled, those of the batch after each task has left out its repeats.
    """
    referred = batch.select(parent.column).filter(f"{parent.column} IS NOT NULL").distinct()
    return referred.join(parents[parent.entity].select(parent.column), parent.column, "left_anti")


def _missing(
    batch: DataFrame, parents: dict[str, DataFrame], parent: Parent, missing: dict[str, DataFrame] | None
) -> DataFrame:
    """The missing keys as a written table, unless they were handed over: the planner then knows how few they are.

    The functions below take them as ``missing``, so that a load can write them once and reuse them.
    """
    found = written(missing_keys(batch, parents, parent), f"missing-{parent.entity}") if missing is None else missing[parent.entity]
    return found.selectExpr(f"{parent.column} AS _no_{parent.entity}")


def _refers(parent: Parent) -> Column:
    return F.expr(f"{parent.column} = _no_{parent.entity}")


def with_parents(
    batch: DataFrame, parents: dict[str, DataFrame], spec: EntitySpec, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Adds a ``_<parent>_key`` per parent: the referenced key, null when Silver does not hold it.

    Rows meet the missing keys, each of which is there once, and not all of a parent's.  There is no hint: the planner
    broadcasts sets below its size threshold, so that wide rows stay where they are, and otherwise splits hot
    referencing keys at run time (adaptive skew join splits the left side).
    """
    joined = batch
    for parent in spec.parents:
        joined = joined.join(_missing(batch, parents, parent, missing), _refers(parent), "left")
    held = [f"CASE WHEN _no_{p.entity} IS NULL THEN {p.column} END AS _{p.entity}_key" for p in spec.parents]
    return joined.selectExpr(*batch.columns, *held)


def check_batch(
    batch: DataFrame, parents: dict[str, DataFrame], spec: EntitySpec, *more: str, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """The batch's records with ``failure_reason``: '' for a row that may enter Silver; and with ``more`` columns."""
    absent = {p.entity: f"_{p.entity}_key IS NULL" for p in spec.parents}
    return with_parents(batch, parents, spec, missing).selectExpr(
        *spec.columns, f"{failure_reason(spec, absent)} AS failure_reason", *more
    )


def batch_counts(
    rows: DataFrame, parents: dict[str, DataFrame], silver: DataFrame, spec: EntitySpec, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row: what bringing rows into Silver would insert, update and quarantine, each row being checked once.

    Rows come without fingerprints.
    """
    checked = check_batch(rows, parents, spec, missing=missing) if spec.has_quarantine else rows.selectExpr("*", "'' AS failure_reason")
    checked = fingerprint_by_key(checked.withColumn("_good", F.col("failure_reason") == ""), spec, "_good")
    held = silver.selectExpr(f"{spec.key} AS _key", "record_hash AS _hash")
    good, new = F.col("_good"), F.col("_key").isNull()
    return checked.join(held, F.expr(same_key(spec.key, "_key", spec)), "left").agg(
        F.count_if(good & new).alias("rows_inserted"),
        F.count_if(good & ~new & F.expr(hash_changed("record_hash", "_hash"))).alias("rows_updated"),
        F.count_if(~good).alias("rows_quarantined"),
    )


def rejected_rows(
    batch: DataFrame, parents: dict[str, DataFrame], spec: EntitySpec, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    return check_batch(batch, parents, spec, missing=missing).filter("failure_reason <> ''")


def orphans(
    batch: DataFrame, parents: dict[str, DataFrame], spec: EntitySpec, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows whose own fields pass but whose parent is missing (single-parent entities)."""
    (parent,) = spec.parents
    valid = batch.filter(fields_valid(spec))
    joined = valid.join(_missing(valid, parents, parent, missing), _refers(parent), "left")
    return joined.filter(f"{parent.column} IS NULL OR _no_{parent.entity} IS NOT NULL").select(*batch.columns)


def promotable(
    batch: DataFrame, parents: dict[str, DataFrame], spec: EntitySpec, missing: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows that may enter Silver: fields pass and every parent is there."""
    valid = trusted = batch.filter(fields_valid(spec)) if spec.rules else batch
    for parent in spec.parents:
        refers = trusted.filter(f"{parent.column} IS NOT NULL")
        trusted = refers.join(_missing(valid, parents, parent, missing), _refers(parent), "left_anti")
    return trusted


def quarantine_new(
    rejected: DataFrame, quarantine: DataFrame | None, spec: EntitySpec, ctx: RunContext
) -> DataFrame:
    """Rejected rows that the batch's quarantine does not hold yet.

    One entry per (batch, key) is enough, except where a missing parent's reason stands apart: such a row is only
    held back by an entry with that very reason.
    """
    if quarantine is None:
        return rejected
    held = quarantine.filter(F.col("batch_id") == ctx.batch_id).selectExpr(
        f"{spec.key} AS _held_key", "failure_reason AS _held_reason"
    )
    same = same_key(spec.key, "_held_key", spec)
    if spec.parent_reason_apart:
        orphan = spec.parents[0].message + spec.parent_suffix
        same += f" AND (failure_reason <> '{orphan}' OR _held_reason = '{orphan}')"
    return rejected.join(held, F.expr(same), "left_anti")


def quarantine_rows(
    rejected: DataFrame, quarantine: DataFrame | None, spec: EntitySpec, ctx: RunContext
) -> DataFrame:
    """Rejected rows as new quarantine rows, one per bad record with all its reasons."""
    return quarantine_new(rejected, quarantine, spec, ctx).selectExpr(
        *spec.columns,
        "failure_reason",
        f"'{ctx.pipeline_run_id}' AS pipeline_run_id",
        f"{timestamp_literal(ctx.at)} AS quarantined_at",
        f"'{ctx.batch_id}' AS batch_id",
    )


# A null fingerprint on either side means 'not changed', as with SQL's <>.
def hash_changed(batch_hash: str, silver_hash: str) -> str:
    return f"{batch_hash} <> {silver_hash}"


def silver_new(batch: DataFrame, silver: DataFrame, spec: EntitySpec) -> DataFrame:
    held = silver.selectExpr(f"{spec.key} AS _key")
    return batch.join(held, F.expr(same_key(spec.key, "_key", spec)), "left_anti")


def silver_changed(batch: DataFrame, silver: DataFrame, spec: EntitySpec) -> DataFrame:
    """Batch rows whose key is in Silver with another fingerprint."""
    current = silver.selectExpr(f"{spec.key} AS _key", "record_hash AS _hash")
    # Coalesced, or the planner would look for null fingerprints, and make them, before the rows are dealt out.
    changed = f"coalesce({hash_changed('record_hash', '_hash')}, false)"
    return batch.join(current, F.expr(f"{same_key(spec.key, '_key', spec)} AND {changed}")).drop("_key", "_hash")


def as_inserted(trusted: DataFrame, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    """Batch rows in Silver form, as they are when their key is new."""
    unset = {c: f"CAST(NULL AS {spec.columns[c]}) AS {c}" for c in spec.unset_in_silver}
    return trusted.selectExpr(
        *[unset.get(c, c) for c in spec.columns],
        "record_hash",
        "ingested_at AS source_ingested_at",
        f"{timestamp_literal(ctx.at)} AS processed_at",
    )


def silver_merge(trusted: DataFrame, silver: DataFrame | None, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    """The next Silver state with a ``merge_action`` per row (insert, update or keep), in one pass.

    One full outer join on the key, unique on both sides: each side is shuffled once, every row is
    classified once, and counts are a group over ``merge_action``.  Keys missing from the batch are kept.
    """
    key = spec.key
    if silver is None:
        return as_inserted(trusted, spec, ctx).selectExpr("*", f"'{INSERT}' AS merge_action")

    incoming = trusted.selectExpr(
        *[f"{c} AS _b_{c}" for c in spec.columns if c not in spec.unset_in_silver],
        "record_hash AS _b_record_hash",
        "ingested_at AS _b_source_ingested_at",
    )
    action = (
        f"CASE WHEN {key} IS NULL THEN '{INSERT}' WHEN _b_{key} IS NOT NULL "
        f"AND {hash_changed('_b_record_hash', 'record_hash')} THEN '{UPDATE}' ELSE '{KEEP}' END AS merge_action"
    )
    taken = f"merge_action <> '{KEEP}'"

    def pick(name: str) -> str:
        return f"CASE WHEN {taken} THEN _b_{name} ELSE {name} END AS {name}"

    joined = incoming.join(silver, F.expr(same_key(f"_b_{key}", key, spec)), "full_outer")
    return joined.selectExpr("*", action).selectExpr(
        f"coalesce({key}, _b_{key}) AS {key}",
        *[c if c in spec.unset_in_silver else pick(c) for c in spec.attributes],
        pick("record_hash"),
        pick("source_ingested_at"),
        f"CASE WHEN {taken} THEN {timestamp_literal(ctx.at)} ELSE processed_at END AS processed_at",
        "merge_action",
    )


def packed(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows for a shuffle: with ``_print``, which is empty where their columns give their fingerprint, in its place."""
    return rows.withColumn("_print", F.expr(packed_hash(spec))).drop("record_hash")


def unpacked(rows: DataFrame, spec: EntitySpec) -> DataFrame:
    return rows.withColumn("_print", F.expr(unpacked_hash(spec, "_print"))).withColumnRenamed("_print", "record_hash")


def silver_changes(trusted: DataFrame, silver: DataFrame, spec: EntitySpec, *more: str) -> DataFrame:
    """Key and ``merge_action`` of the batch rows that change Silver, and ``more`` of their columns.

    Of Silver only keys and fingerprints are shuffled, or what these are made of where that is shorter; of the batch no more
    than is asked for.  ``trusted`` may come ``packed``.
    """
    key, sent = spec.key, "_print" if "_print" in trusted.columns else "record_hash"
    mine = unpacked_hash(spec, sent) if sent == "_print" else sent
    if sent == "_print" and shorter_than_hash(spec):
        behind = packed(silver.select(key, *spec.hash_columns, "record_hash"), spec)
        held, theirs = behind.selectExpr(*[f"{c} AS _held_{c}" for c in behind.columns]), unpacked_hash(spec, "_held__print", "_held_")
    else:
        held, theirs = silver.selectExpr(f"{key} AS _held_{key}", "record_hash AS _held_hash"), "_held_hash"
    action = f"CASE WHEN _held_{key} IS NULL THEN '{INSERT}' WHEN {hash_changed(mine, theirs)} THEN '{UPDATE}' END"
    columns = list(dict.fromkeys((key, *more)))
    return (
        trusted.select(*dict.fromkeys((*columns, *(spec.hash_columns if sent == "_print" else ()), sent)))
        .join(held, F.expr(same_key(key, f"_held_{key}", spec)), "left")
        .selectExpr(*columns, f"{action} AS merge_action")
        .filter("merge_action IS NOT NULL")
    )


def ranked(rows: DataFrame, rank: int) -> DataFrame:
    return rows.withColumn("_rank", F.lit(rank).cast("tinyint"))


def settled(rows: DataFrame, spec: EntitySpec, place: Column) -> DataFrame:
    """Of ranked rows those that come in, and those held whose key neither comes in nor goes; dealt out by ``place``.

    The key decides the place, so one shuffle does for an anti-join on the key and for a layout by something else.
    It moves the rows packed.
    """
    same = Window.partitionBy("_place", spec.key)
    stays = (F.col("_rank") == COMING) | ((F.col("_rank") == HELD) & (F.col(spec.key).isNull() | (F.col("_last") == HELD)))
    dealt = packed(rows, spec).withColumn("_place", place).repartition("_place")
    left = dealt.withColumn("_last", F.max("_rank").over(same)).filter(stays).drop("_place", "_rank", "_last")
    return unpacked(left, spec).select(*[c for c in rows.columns if c != "_rank"])


def without_keys(rows: DataFrame, keys: DataFrame, spec: EntitySpec, place: Column) -> DataFrame:
    """The rows whose key is not among ``keys``, dealt out by ``place``."""
    going = ranked(keys.select(spec.key), GOING)
    return settled(ranked(rows, HELD).unionByName(going, allowMissingColumns=True), spec, place)


def apply_changes(
    batch: DataFrame | None,
    silver: DataFrame,
    changes: DataFrame,
    spec: EntitySpec,
    ctx: RunContext,
    updates: bool = True,
    place: Column | None = None,
) -> DataFrame:
    """The next Silver state, given the changes as a written table; without ``updates`` all of them are new keys.

    Changes that carry the batch's columns, packed, need no batch.  With a ``place`` that the key decides, a state with updates is
    dealt out by it, in the one shuffle that also takes the old rows out.  Otherwise the planner knows the written table's
    size: when it is small its keys are broadcast, and neither Silver nor the batch is shuffled; when it is large both
    are, once.
    """
    key = spec.key
    same = F.expr(same_key(key, "_changed", spec))
    if "_print" in changes.columns:
        taken = unpacked(changes, spec)
    else:
        taken = batch.join(changes.selectExpr(f"{key} AS _changed"), same, "left_semi")
    incoming = as_inserted(taken, spec, ctx)
    if spec.unset_in_silver:
        # An update leaves these columns as they are.
        kept_values = silver.select(key, *spec.unset_in_silver)
        incoming = incoming.drop(*spec.unset_in_silver).join(kept_values, key, "left")
    if not updates:
        return silver.unionByName(incoming)
    if place is not None:
        return settled(ranked(silver, HELD).unionByName(ranked(incoming, COMING)), spec, place)
    updated = changes.filter(F.col("merge_action") == UPDATE).selectExpr(f"{key} AS _changed")
    return silver.join(updated, same, "left_anti").unionByName(incoming)


def merge_counts(actions: DataFrame) -> DataFrame:
    """One row: ``rows_inserted`` and ``rows_updated`` of a merge or of its changes."""
    return actions.agg(
        F.count_if(F.col("merge_action") == INSERT).alias("rows_inserted"),
        F.count_if(F.col("merge_action") == UPDATE).alias("rows_updated"),
    )
