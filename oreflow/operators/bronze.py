"""Landing a snapshot: contract, fingerprint, lineage and once-per-batch loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import join_key, record_hash, round_to_millis, same_key, timestamp_literal, wide_key
from oreflow.model import EntitySpec, RunContext


class DuplicateKeyError(ValueError):
    """A key occurs more than once among the rows one batch would add."""


def violations(spec: EntitySpec) -> dict[str, str]:
    """Contract checks as ``{name: SQL predicate that is true for a bad row}``."""
    checks = {f"{c} must not be null": f"{c} IS NULL" for c in spec.required}
    checks |= {f"{c} is longer than {n}": f"char_length({c}) > {n}" for c, n in spec.widths.items()}
    return checks


def silver_violations(spec: EntitySpec) -> dict[str, str]:
    return {f"{c} must not be null": f"{c} IS NULL" for c in spec.required_in_silver}


def enforce_contract(df: DataFrame, spec: EntitySpec, checks: dict[str, str]) -> DataFrame:
    """Fail the job that evaluates ``df`` on the first row for which a check's predicate is true.

    The checks ride along with the write, so they cost no scan of their own.
    """
    if not checks:
        return df
    return guarded(df, spec.name, spec.key, checks)


def guarded(df: DataFrame, table: str, column: str, checks: dict[str, str]) -> DataFrame:
    """``column`` fails to evaluate in a row for which a check's predicate is true; a good row builds no text."""
    broken = " OR ".join(f"({p})" for p in checks.values())
    arms = ", ".join(f"CASE WHEN {p} THEN '{table}: {n}; ' END" for n, p in checks.items())
    return df.withColumn(column, F.expr(f"CASE WHEN {broken} THEN raise_error(concat_ws('', {arms})) ELSE {column} END"))


def fingerprint(snapshot: DataFrame, spec: EntitySpec, *more: str) -> DataFrame:
    """A source snapshot as landing rows: contract columns, source rounding and ``record_hash``; and ``more`` columns."""
    columns = [f"{round_to_millis(c)} AS {c}" if c in spec.millis_columns else c for c in spec.columns]
    return snapshot.selectExpr(*columns, f"{record_hash(spec)} AS record_hash", *more)


def fingerprint_by_key(snapshot: DataFrame, spec: EntitySpec, *more: str) -> DataFrame:
    """``fingerprint``, made after the rows are dealt out as a join on the key wants them, which then needs no shuffle.

    A fingerprint is 32 bytes that no codec shortens, half of what a shuffle of an order item would move.
    """
    return fingerprint(snapshot.repartition(F.expr(join_key(spec.key, spec))), spec, *more)


def stamp_lineage(df: DataFrame, ctx: RunContext) -> DataFrame:
    return df.selectExpr(
        "*",
        f"{timestamp_literal(ctx.at)} AS ingested_at",
        f"'{ctx.pipeline_run_id}' AS pipeline_run_id",
        f"'{ctx.batch_id}' AS batch_id",
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row: counts are combined before the shuffle, which moves keys only."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key)


def batch_scope(bronze: DataFrame, batch_id: str) -> DataFrame:
    """One batch's slice; ``batch_id`` is the partition column, so other batches are not listed or read."""
    return bronze.filter(F.col("batch_id") == batch_id)


def bronze_new_rows(rows: DataFrame, bronze: DataFrame | None, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    """The rows whose key the batch does not hold yet, stamped with the attempt's lineage.

    All of them for a batch's first attempt, which therefore needs no shuffle.
    """
    return stamp_lineage(_not_held(rows, bronze, spec, ctx), ctx)


def landing_rows(snapshot: DataFrame, bronze: DataFrame | None, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    """``bronze_new_rows`` of a snapshot without fingerprints: only new rows get one, after the shuffle."""
    return stamp_lineage(fingerprint(_not_held(snapshot, bronze, spec, ctx), spec), ctx)


def _not_held(rows: DataFrame, bronze: DataFrame | None, spec: EntitySpec, ctx: RunContext) -> DataFrame:
    if bronze is None:
        return rows
    held = batch_scope(bronze, ctx.batch_id).selectExpr(f"{spec.key} AS _held_key")
    return rows.join(held, F.expr(same_key(spec.key, "_held_key", spec)), "left_anti")


def count_unique(rows: DataFrame, spec: EntitySpec, ctx: RunContext, bits: int = 64) -> int:
    """The number of rows, in the same aggregate that stops the load when a key would enter the batch twice.

    Of a wide key so many ``bits`` of a hash are shuffled; only where rows share them are the keys themselves counted.
    """
    if wide_key(spec):
        short = F.shiftrightunsigned(F.xxhash64(spec.key), 64 - bits).alias("_short")
        per_hash = rows.groupBy(short).agg(F.count("*").alias("_n"))
        total, shared = per_hash.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(F.col("_n") > 1)).first()
        if not shared:
            return total
        _count_by_key(rows.join(per_hash.filter("_n > 1").select("_short"), short == F.col("_short"), "left_semi"), spec, ctx)
        return total
    return _count_by_key(rows, spec, ctx)


def _count_by_key(rows: DataFrame, spec: EntitySpec, ctx: RunContext) -> int:
    per_key = rows.groupBy(spec.key).agg(F.count("*").alias("_n"))
    total, repeated = per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)), F.min(F.when(F.col("_n") > 1, F.col(spec.key)))
    ).first()
    if repeated is not None:
        raise DuplicateKeyError(f"{spec.name}: {spec.key}={repeated} occurs twice in batch {ctx.batch_id}")
    return total
