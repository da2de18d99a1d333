"""Customer validation: errors, the ids they taint, the valid rest and the quality gate."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import timestamp_literal
from oreflow.functions.rules import any_field_error, field_errors
from oreflow.model import CUSTOMERS, DEFAULT_INVALID_RATE_THRESHOLD, DUPLICATE_RULE, EntitySpec, RunContext
from oreflow.sources.scratch import written

# Copies are written out in chunks of this many rows, so that one heavily repeated row is spread over tasks.
COPY_CHUNK = 10_000
# Parts into which equal rows are dealt before they are counted.
SALTS = 64


class DataQualityError(RuntimeError):
    """The share of invalid customers is above the threshold."""


@dataclass(frozen=True)
class ProcessResult:
    """What a processor makes of an extract.

    ``valid`` rows land in Bronze.  ``quarantine`` is evidence in the entity's quarantine columns and is kept whatever
    the gate says.  ``metrics`` is what the gate decides on: it raises to stop the load, and is by default
    ``customer_quality_gate``.  ``suspects``, a narrow written table, tells whether there is evidence at all; ``unique``
    that no key occurs twice among the valid rows.
    """

    valid: DataFrame
    quarantine: DataFrame
    metrics: DataFrame
    gate: Callable[[DataFrame, float], None] | None = None
    suspects: DataFrame | None = None
    unique: bool = False


#: ``(rows, context, spec, stage) -> ProcessResult``: rows are staged and fingerprinted, and ``stage(name, rows)`` writes
#: a table that lasts as long as the load.
Processor = Callable[[DataFrame, RunContext, EntitySpec, Callable[[str, DataFrame], DataFrame]], ProcessResult]


def _replicate(df: DataFrame, copies: str) -> DataFrame:
    """Each row ``copies`` times, without building a long array or leaving the work to one task."""
    chunked = df.withColumn("_chunk", F.explode(F.expr(f"sequence(0L, ({copies} - 1) div {COPY_CHUNK}L)")))
    spread = chunked.repartition(F.xxhash64(*df.columns, "_chunk"))
    in_chunk = f"least({COPY_CHUNK}L, {copies} - _chunk * {COPY_CHUNK}L)"
    return spread.withColumn("_copy", F.explode(F.expr(f"sequence(1L, {in_chunk})"))).drop("_chunk", "_copy", copies)


def _per_id(snapshot: DataFrame, spec: EntitySpec) -> DataFrame:
    """Row and error facts per id in one combinable aggregate over narrow columns."""
    return (
        snapshot.selectExpr(spec.key, f"{any_field_error(spec)} AS _bad")
        .groupBy(spec.key)
        .agg(F.count("*").alias("_rows"), F.max("_bad").alias("_bad"))
        .select(spec.key, "_rows", ((F.col("_rows") > 1) | F.col("_bad")).alias("_invalid"))
    )


def invalid_ids(snapshot: DataFrame, spec: EntitySpec = CUSTOMERS) -> DataFrame:
    """Ids with any error, and how many rows each has (``_rows``).

    The functions below take this set as ``invalid``, so that a load can write it once and reuse it.
    """
    return _per_id(snapshot, spec).filter("_invalid").select(spec.key, "_rows")


def _staged_invalid(snapshot: DataFrame, spec: EntitySpec, invalid: DataFrame | None) -> DataFrame:
    """The invalid ids as a written table, unless they were handed over: its size is then known, and a join with it
    is not tied to an aggregate."""
    return written(invalid_ids(snapshot, spec), "customer-invalid") if invalid is None else invalid


def dealt_rows(snapshot: DataFrame, repeated: DataFrame, spec: EntitySpec) -> DataFrame:
    """Rows of repeated ids, dealt out by all columns and a ``_salt``.

    The salt is written with the rows before it becomes a shuffle key: after a shuffled join rows come in any order,
    and a task that runs again would give equal rows other salts than those already counted.
    """
    rows = snapshot.select(*spec.columns).join(repeated, spec.key, "left_semi")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))
    return written(rows.withColumn("_salt", salt), "customer-salted").repartition(*spec.columns, "_salt")


def duplicate_customers(
    snapshot: DataFrame, spec: EntitySpec = CUSTOMERS, invalid: DataFrame | None = None
) -> DataFrame:
    """Second and later rows of every repeated id; the first is the smallest over all columns.

    A window would sort all rows of one id in one task, and so would any step that keeps rows dealt out by id.
    Instead rows of repeated ids are dealt out by all their columns and a salt, equal ones are counted in two steps,
    the first row per id is a minimum that each task takes before the shuffle, and each distinct row is then
    repeated as often as it exceeds that first one.  The repeated ids, the salted rows, the counts and the first rows
    are written tables, so that both joins on the id are of bare shuffles, which adaptive skew join can split.
    """
    rest = spec.attributes
    repeated = _staged_invalid(snapshot, spec, invalid).filter("_rows > 1").select(spec.key)
    salted = dealt_rows(snapshot, repeated, spec).groupBy(*spec.columns, "_salt").agg(F.count("*").alias("_n"))
    copies = written(salted.groupBy(*spec.columns).agg(F.sum("_n").alias("_n")), "customer-copies")
    first = written(copies.groupBy(spec.key).agg(F.min(F.struct(*rest)).alias("_first")), "customer-first")
    extra = (
        copies.join(first, spec.key)
        .withColumn("_n", F.col("_n") - F.when(F.struct(*rest).eqNullSafe(F.col("_first")), 1).otherwise(0))
        .filter("_n > 0")
        .drop("_first")
    )
    return _replicate(extra, "_n")


def customer_errors(
    snapshot: DataFrame, spec: EntitySpec = CUSTOMERS, invalid: DataFrame | None = None
) -> DataFrame:
    """One row per (row, failed rule)."""
    columns = list(spec.columns)
    invalid = _staged_invalid(snapshot, spec, invalid)
    field = (
        snapshot.filter(any_field_error(spec))
        .selectExpr(*columns, f"explode({field_errors(spec)}) AS _e")
        .selectExpr(*columns, "_e.rule AS validation_rule", "_e.message AS validation_message")
    )
    repeated = duplicate_customers(snapshot, spec, invalid).selectExpr(
        *columns,
        f"'{DUPLICATE_RULE}' AS validation_rule",
        f"concat('Duplicate CustomerID=', {spec.key}) AS validation_message",
    )
    return field.unionByName(repeated)


def valid_customers(
    snapshot: DataFrame, spec: EntitySpec = CUSTOMERS, invalid: DataFrame | None = None
) -> DataFrame:
    """Rows whose id has no error at all; every row of a repeated id goes."""
    tainted = _staged_invalid(snapshot, spec, invalid)
    return snapshot.join(tainted.select(spec.key), spec.key, "left_anti")


def customer_invalid_rate(
    snapshot: DataFrame, spec: EntitySpec = CUSTOMERS, invalid: DataFrame | None = None
) -> DataFrame:
    """One row: ``total_rows``, ``invalid_ids`` and ``invalid_rate`` (distinct invalid ids over rows, 0 if empty)."""
    if invalid is None:
        facts = _per_id(snapshot, spec).select("_rows", F.col("_invalid").cast("bigint").alias("_ids"))
    else:
        zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
        facts = snapshot.select(one.alias("_rows"), zero.alias("_ids")).unionByName(
            invalid.select(zero.alias("_rows"), one.alias("_ids"))
        )
    rate = F.col("invalid_ids").cast("double") / F.col("total_rows").cast("double")
    return facts.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("_ids"), F.lit(0)).alias("invalid_ids"),
    ).withColumn("invalid_rate", F.when(F.col("total_rows") == 0, F.lit(0.0)).otherwise(rate))


def gate_result(metrics: DataFrame, threshold: float = DEFAULT_INVALID_RATE_THRESHOLD) -> DataFrame:
    return metrics.withColumns(
        {"threshold": F.lit(float(threshold)), "passed": F.col("invalid_rate") <= F.lit(float(threshold))}
    )


def check_threshold(threshold: float | str) -> float:
    try:
        value = float(threshold)
    except ValueError as exc:
        raise ValueError(f"invalid-rate threshold must be numeric, received {threshold!r}") from exc
    if not 0 <= value <= 1:
        raise ValueError("invalid-rate threshold must be between 0 and 1")
    return value


def customer_quality_gate(metrics: DataFrame, threshold: float | str = DEFAULT_INVALID_RATE_THRESHOLD) -> None:
    """Raise when the invalid rate is above the threshold.  Collects the one metrics row."""
    limit = check_threshold(threshold)
    rate = metrics.first()["invalid_rate"]
    if rate > limit:
        raise DataQualityError(f"Customer invalid rate {rate:.2%} exceeds threshold {limit:.2%}")


def quarantine_customers(errors: DataFrame, ctx: RunContext) -> DataFrame:
    """Error rows as customer quarantine rows.  There is no check for earlier ones: each attempt leaves its own."""
    return errors.selectExpr(
        "*",
        f"{timestamp_literal(ctx.at)} AS quarantined_at",
        "CAST(NULL AS TIMESTAMP_NTZ) AS resolved_at",
        f"'{ctx.pipeline_run_id}' AS pipeline_run_id",
    )


def process_customers(
    snapshot: DataFrame, ctx: RunContext, spec: EntitySpec = CUSTOMERS, invalid: DataFrame | None = None
) -> ProcessResult:
    """Validate, quarantine and filter a customer snapshot; the caller decides when to apply the gate."""
    invalid = _staged_invalid(snapshot, spec, invalid)
    return ProcessResult(
        valid=valid_customers(snapshot, spec, invalid),
        quarantine=quarantine_customers(customer_errors(snapshot, spec, invalid), ctx),
        metrics=customer_invalid_rate(snapshot, spec, invalid),
    )


def list_rule_processor(
    rows: DataFrame, ctx: RunContext, spec: EntitySpec, stage: Callable[[str, DataFrame], DataFrame]
) -> ProcessResult:
    """The processor of customers and of every entity that is checked by its list rules."""
    invalid = stage(f"{spec.name}_invalid", invalid_ids(rows, spec))
    return replace(process_customers(rows, ctx, spec, invalid), suspects=invalid, unique=True)


def processor_of(spec: EntitySpec) -> Processor | None:
    return spec.processor or (list_rule_processor if spec.checked_before_bronze else None)
