"""What the warehouse's declared constraints demand, counted as violations per rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.model import EVENT_TYPES, RUN_STATUSES, EntitySpec
from oreflow.operators.bronze import silver_violations, violations


class ContractError(ValueError):
    """A table breaks one of its declared constraints."""


def _one_of(column: str, values: tuple[str, ...]) -> str:
    return f"{column} NOT IN ({', '.join(repr(v) for v in values)})"


def silver_checks(spec: EntitySpec) -> dict[str, str]:
    return violations(spec) | silver_violations(spec) | {"record_hash must not be null": "record_hash IS NULL"}


BATCH_CHECKS = {"status is not allowed": _one_of("status", RUN_STATUSES)}
EVENT_CHECKS = {"event_type is not allowed": _one_of("event_type", EVENT_TYPES)}


def count_violations(df: DataFrame, table: str, checks: dict[str, str]) -> DataFrame:
    """One row per check: ``table_name``, ``check_name``, ``violations``; one narrow aggregate for all."""
    counts = df.agg(*[F.count_if(F.expr(p)).alias(f"c{i}") for i, p in enumerate(checks.values())])
    rows = [F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("violations")) for i, n in enumerate(checks)]
    return counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def enforce(counts: DataFrame) -> None:
    broken = counts.filter("violations > 0").collect()
    if broken:
        raise ContractError("; ".join(f"{r.table_name}: {r.check_name} ({r.violations} rows)" for r in broken))
