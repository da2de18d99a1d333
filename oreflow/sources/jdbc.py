"""Snapshot extraction from a relational source with Spark's partitioned JDBC reader."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from oreflow.model import EntitySpec

ROWS_PER_PARTITION = 1_000_000


def source_name(column: str) -> str:
    """Source spelling of a column: order_item_id -> OrderItemID."""
    return "".join("ID" if part == "id" else part.capitalize() for part in column.split("_"))


def snapshot_query(spec: EntitySpec, table: str) -> str:
    columns = ", ".join(f"{source_name(c)} AS {c}" for c in spec.columns)
    return f"(SELECT {columns} FROM {table}) snapshot"


def depth_query(table: str, key: str, parts: int) -> str:
    """The greatest key of each of ``parts`` sets of equally many rows, in key order: one query, answered by the source."""
    tiles = f"SELECT {key} AS k, NTILE({parts}) OVER (ORDER BY {key}) AS tile FROM {table} WHERE {key} IS NOT NULL"
    return f"SELECT max(k) AS k FROM ({tiles}) tiles GROUP BY tile"


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"'{value}'" if isinstance(value, (date, datetime)) else str(value)


def depth_predicates(column: str, greatest: list) -> list[str]:
    """Conditions that part a table at the greatest keys of its parts: every row, also one without a key or one that came
    in since, meets exactly one."""
    cuts = [_literal(x) for x in sorted({x for x in greatest if x is not None})[:-1]]
    if not cuts:
        return ["1 = 1"]
    first = f"({column} <= {cuts[0]} OR {column} IS NULL)"
    between = [f"({column} > {a} AND {column} <= {b})" for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return [first, *between, f"{column} > {cuts[-1]}"]


def read_snapshot(
    spark: SparkSession,
    spec: EntitySpec,
    table: str,
    options: dict[str, str],
    key_range: tuple[int, int] | None = None,
    partitions: int | None = None,
    rows_per_partition: int = ROWS_PER_PARTITION,
    predicates: list[str] | None = None,
    equal_rows: bool = False,
) -> DataFrame:
    """The full source table, read by key ranges in parallel.

    ``options`` are the usual JDBC ones (url, driver, user, fetchsize, ...).  Without ``key_range`` or ``partitions``
    the bounds and the number of rows come from one query that the source answers from its key index; the number of
    ranges follows the rows.  Ranges are even in the key: where keys lie in clusters, ``equal_rows`` asks the source for
    boundaries between parts of equally many rows, or pass ``predicates``, SQL conditions on the source's columns that
    part the table, one for each task.
    """
    ask = lambda query: spark.read.format("jdbc").options(**options).option("query", query).load()
    if equal_rows and predicates is None:
        key = source_name(spec.key)
        n = ask(f"SELECT count(*) AS n FROM {table}").first()[0] if partitions is None else 0
        found = ask(depth_query(table, key, partitions or max(1, -(-n // rows_per_partition)))).collect()
        # Conditions are on the columns that the snapshot's query gives out.
        predicates = depth_predicates(spec.key, [row[0] for row in found])
    if predicates is not None:
        rest = {k: v for k, v in options.items() if k != "url"}
        return spark.read.jdbc(options["url"], snapshot_query(spec, table), predicates=predicates, properties=rest)
    if key_range is None or partitions is None:
        key = source_name(spec.key)
        facts = f"SELECT min({key}) AS lo, max({key}) AS hi, count(*) AS n FROM {table}"
        low, high, n = ask(facts).first()
        key_range = key_range or (low or 0, high or 0)
        partitions = partitions or max(1, -(-n // rows_per_partition))
    return (
        spark.read.format("jdbc")
        .options(**options)
        .option("dbtable", snapshot_query(spec, table))
        .option("partitionColumn", spec.key)
        .option("lowerBound", key_range[0])
        .option("upperBound", key_range[1] + 1)
        .option("numPartitions", partitions)
        .load()
    )
