"""The five entities and the operational logs, mapped from the TPC-H-like parquet tables.

Every mapping is a projection (customers also an explode) over the whole source table.  Defects are put
in by key, so that each rule fires at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.functions.columns import stable_id
from oreflow.model import COMMERCE_PIPELINE, CUSTOMER_PIPELINE, ENTITIES, EntitySpec

# Declared, so that planning a scan opens no file.
SOURCE_DDL = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}

# Added to a key to make it point nowhere, or to give a row the older key it had in an earlier snapshot.
NOWHERE = 1_000_000_000_000_000
OLDER_KEY = 2_000_000_000_000_000
# The line key has 38 digits: 14 of the order key and room above it, 2 of the line number, 2 of the quantity, 10 of
# the part and 9 of the supplier.  Its older-key mark lies above all packed keys.
OLDER_LINE_KEY = 5 * 10**37
LINE_UNIT = 10**19  # of the high half
LINE_SIGN = "CASE WHEN l_orderkey % 487 = 3 THEN -1L ELSE 1L END"

# The halves of a line key.  A part with more digits than it has room for would run into the next one.
LINE_HIGH = f"{LINE_SIGN} * (l_orderkey * 10000 + l_linenumber * 100 + CAST(l_quantity AS BIGINT))"
LINE_FITS = "l_linenumber BETWEEN 0 AND 99 AND l_quantity >= 0 AND l_quantity < 100 AND l_suppkey BETWEEN 0 AND 999999999"
LINE_LOW = (
    f"CASE WHEN {LINE_FITS} THEN {LINE_SIGN} * (l_partkey * 1000000000 + l_suppkey) "
    "ELSE raise_error(concat('line of order ', l_orderkey, ': a part of its key has too many digits')) END"
)


def line_key(high: str, low: str) -> str:
    """The exact decimal of both halves."""
    return f"CAST(CAST({high} AS DECIMAL(19,0)) * CAST('{LINE_UNIT}' AS DECIMAL(20,0)) + CAST({low} AS DECIMAL(19,0)) AS DECIMAL(38,0))"


MAPPINGS = {
    "customers": (
        "customer",
        (
            "c_custkey AS customer_id",
            "CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE substr(c_name, 1, 8) END AS first_name",
            "CASE WHEN c_custkey % 127 = 0 THEN '' ELSE substr(c_name, 10, 9) END AS last_name",
            "CASE WHEN copy = 1 THEN concat('dup-', c_custkey, '@example.test') "
            "WHEN c_custkey % 7 = 3 THEN NULL "
            "WHEN c_custkey % 53 = 0 THEN concat('customer', c_custkey) "
            "ELSE concat('customer', c_custkey, '@example.test') END AS email",
            "concat('555-', c_nationkey) AS phone",
            "TIMESTAMP_NTZ '2024-01-01 09:30:00.123556' AS created_at",
        ),
    ),
    "products": (
        "part",
        (
            "p_partkey AS product_id",
            "p_name AS product_name",
            "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS category",
            "CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.80 AS DECIMAL(18,2)) AS unit_cost",
            "CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price",
        ),
    ),
    "orders": (
        "orders",
        (
            "o_orderkey AS order_id",
            f"CASE WHEN o_orderkey % 401 = 0 THEN o_custkey + {NOWHERE} ELSE o_custkey END AS customer_id",
            "o_orderdate AS order_date",
            "CASE WHEN o_orderkey % 211 = 0 THEN 'Unknown' WHEN o_orderkey % 17 = 0 THEN 'Cancelled' "
            "WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Processing' "
            "ELSE 'Pending' END AS status",
            "CAST(CASE WHEN o_orderkey % 307 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) "
            "AS total_amount",
        ),
    ),
    "order_items": (
        "lineitem",
        (
            # The source has no unique key: the columns that tell lines apart, side by side in decimal digits.
            # Two 64-bit halves, checked for overflow and for parts beyond their digits, and one exact decimal of both.
            f"{line_key(LINE_HIGH, LINE_LOW)} AS order_item_id",
            "l_orderkey AS order_id",
            f"CASE WHEN l_partkey % 503 = 7 THEN l_partkey + {NOWHERE} ELSE l_partkey END AS product_id",
            "CASE WHEN l_orderkey % 499 = 1 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity",
            "CAST(CASE WHEN l_orderkey % 491 = 2 THEN 0 ELSE l_extendedprice END AS DECIMAL(18,2)) AS unit_price",
        ),
    ),
    "payments": (
        "orders",
        (
            "o_orderkey AS payment_id",
            f"CASE WHEN o_orderkey % 409 = 5 THEN o_orderkey + {NOWHERE} ELSE o_orderkey END AS order_id",
            "o_orderdate AS payment_date",
            "CASE WHEN o_orderkey % 223 = 0 THEN 'GoldBars' WHEN o_orderkey % 4 = 0 THEN 'CreditCard' "
            "WHEN o_orderkey % 4 = 1 THEN 'DebitCard' WHEN o_orderkey % 4 = 2 THEN 'PayPal' "
            "ELSE 'BankTransfer' END AS payment_method",
            "CAST(CASE WHEN o_orderkey % 227 = 0 THEN -o_totalprice ELSE o_totalprice END AS DECIMAL(18,2)) AS amount",
            "CASE WHEN o_orderkey % 229 = 0 THEN 'Exploded' WHEN o_orderkey % 31 = 0 THEN 'Refunded' "
            "WHEN o_orderkey % 29 = 0 THEN 'Failed' WHEN o_orderstatus = 'F' THEN 'Completed' "
            "ELSE 'Pending' END AS status",
        ),
    ),
}

# How a row looked one snapshot earlier: one changed attribute where the key ends in 1.
EARLIER_VALUES = {
    "customers": ("phone", "concat('old-', phone)"),
    "products": ("unit_price", "CAST(unit_price - 1.00 AS DECIMAL(18,2))"),
    "orders": ("total_amount", "CAST(total_amount + 1.00 AS DECIMAL(18,2))"),
    "order_items": ("quantity", "quantity + 1"),
    "payments": ("amount", "CAST(amount + 1.00 AS DECIMAL(18,2))"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_DDL[name]).parquet(f"{sf_dir}/{name}.parquet")


def snapshot(spark: SparkSession, sf_dir: str, entity: str, *more: str) -> DataFrame:
    """The entity's current source snapshot, with ``more`` expressions over the source's columns."""
    name, columns = MAPPINGS[entity]
    source = table(spark, sf_dir, name)
    if entity == "customers":
        copies = F.when(F.col("c_custkey") % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        source = source.withColumn("copy", F.explode(copies))
    return source.selectExpr(*columns, *more)


def earlier_snapshot(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The whole table one snapshot earlier: other values for some rows, an older key for others.

    Against it the current snapshot holds new, changed and unchanged rows, and misses some that were there.
    """
    spec: EntitySpec = ENTITIES[entity]
    changed, value = EARLIER_VALUES[entity]
    key, kind, more, digits = spec.key, spec.columns[spec.key], (), spec.key
    older = f"CASE WHEN {key} % 25 = 24 THEN CAST({key} + CAST('{OLDER_KEY}' AS {kind}) AS {kind}) ELSE {key} END"
    if entity == "order_items":
        # On the halves, without arithmetic on wide decimals: the low one has the remainders of the whole key.
        more, digits = (f"{LINE_HIGH} AS high", f"{LINE_LOW} AS low"), "low"
        older = line_key(f"(high + CASE WHEN low % 25 = 24 THEN {OLDER_LINE_KEY // LINE_UNIT}L ELSE 0L END)", "low")
    values = {key: older, changed: f"CASE WHEN {digits} % 10 = 1 THEN {value} ELSE {changed} END"}
    return snapshot(spark, sf_dir, entity, *more).selectExpr(*[f"{values.get(c, c)} AS {c}" for c in spec.columns])


# --- operational logs, one run per user and day -----------------------------------------------------


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))


def _run_id() -> Column:
    return F.concat_ws("-", F.col("user_id").cast("string"), F.col("day").cast("string"))


def _pipeline_name() -> Column:
    return F.when(F.col("user_id") % 5 == 0, COMMERCE_PIPELINE).otherwise(CUSTOMER_PIPELINE)


def _batch_id(prefix: str = "load:") -> Column:
    return F.expr(stable_id(f"concat('{prefix}', pipeline_run_id)"))


def pipeline_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.bool_or((F.col("event_type") == "error") & (F.col("value") > 50))
    running = F.col("user_id") % 13 == 0
    status = F.when(running, "RUNNING").when(F.col("failed"), "FAILED").otherwise("SUCCESS")
    return (
        _events(spark, sf_dir)
        .groupBy("user_id", "day")
        .agg(F.min("ts").alias("started_at"), F.max("ts").alias("last_at"), failed.alias("failed"))
        .select(
            _run_id().alias("pipeline_run_id"),
            _pipeline_name().alias("pipeline_name"),
            "started_at",
            F.when(~running, F.col("last_at")).alias("completed_at"),
            status.alias("status"),
            F.when(status == "FAILED", "load failed").alias("error_message"),
        )
        .withColumn("batch_id", _batch_id())
    )


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = F.when(F.col("event_type") == "view", "bronze").otherwise("silver")
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type").isin("view", "click"))
        .groupBy("user_id", "day", stage.alias("stage_name"))
        .agg(
            F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"), F.count("*").alias("rows_processed")
        )
        .select(
            F.concat_ws("-", _run_id(), "stage_name").alias("stage_run_id"),
            _run_id().alias("pipeline_run_id"),
            "stage_name",
            "started_at",
            "completed_at",
            F.lit("SUCCESS").alias("status"),
            "rows_processed",
            F.lit(None).cast("string").alias("error_message"),
        )
    )


def stage_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per run and entity stage, named the way the five-entity run names its stages."""
    stage = (
        F.when(F.col("event_type") == "view", "customers_bronze")
        .when(F.col("event_type") == "click", "customers_silver")
        .when(F.col("event_type") == "purchase", "orders_bronze")
        .when(F.col("event_type") == "signup", "orders_silver")
        .otherwise("payments_bronze")
    )
    return (
        _events(spark, sf_dir)
        .groupBy("user_id", "day", stage.alias("stage_name"))
        .agg(F.count("*").alias("rows_processed"))
        .select(_run_id().alias("pipeline_run_id"), "stage_name", "rows_processed")
    )


def pipeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "RETRY").otherwise("RECOVERED")
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type").isin("error", "signup"))
        .select(_run_id().alias("pipeline_run_id"), kind.alias("event_type"), F.col("ts").alias("event_time"))
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as rows of the event log, without the details that the source does not have."""
    none = F.lit(None)
    return pipeline_events(spark, sf_dir).select(
        "pipeline_run_id", _batch_id().alias("batch_id"), none.cast("string").alias("pipeline_name"),
        F.lit("bronze").alias("stage_name"), "event_type", "event_time", none.cast("string").alias("dag_run_id"),
        none.cast("int").alias("try_number"), none.cast("string").alias("error_type"), none.cast("string").alias("event_message"),
    )


def customer_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _events(spark, sf_dir)
        .filter(F.col("event_type") == "purchase")
        .select(_run_id().alias("pipeline_run_id"), (F.col("event_id") % 7).alias("customer_id"))
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only form of the runs: a RUNNING row each, then the final one for those that ended."""
    runs = pipeline_runs(spark, sf_dir)
    last = F.struct("completed_at", "status", "error_message", F.lit(2).cast("bigint").alias("seq"))
    first = F.struct(
        F.lit(None).cast("timestamp_ntz").alias("completed_at"),
        F.lit("RUNNING").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(1).cast("bigint").alias("seq"),
    )
    rows = F.when(F.col("status") == "RUNNING", F.array(first)).otherwise(F.array(first, last))
    return runs.select("pipeline_run_id", "pipeline_name", "batch_id", "started_at", F.inline(rows))


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_log(spark, sf_dir).select(
        "batch_id",
        "pipeline_name",
        "started_at",
        "completed_at",
        "status",
        F.when(F.col("status") == "SUCCESS", F.length("pipeline_run_id").cast("bigint")).alias("rows_processed"),
        "error_message",
        "seq",
    )


def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per run: mostly its own batch, some by another pipeline, some for a batch never seen."""
    days = _events(spark, sf_dir).select("user_id", "day").distinct()
    run = days.withColumn("pipeline_run_id", _run_id())
    return run.select(
        F.when(F.col("user_id") % 11 == 0, _batch_id("new:")).otherwise(_batch_id()).alias("batch_id"),
        F.when(F.col("user_id") % 7 == 0, "nightly").otherwise(_pipeline_name()).alias("pipeline_name"),
    )


def task_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One task attempt per event; a lost one left no failure detail."""
    number = F.col("event_id")
    state = (
        F.when((F.col("event_type") == "error") & (F.col("value") > 60), "lost")
        .when(F.col("event_type") == "error", "failed")
        .when(F.col("event_type") == "purchase", "up_for_retry")
        .otherwise("success")
    )
    stage = F.when(number % 3 == 0, "prepare_run").when(number % 3 == 1, "bronze").otherwise("silver")
    explained = (F.col("state") != "success") & (number % 5 != 0)
    return (
        _events(spark, sf_dir)
        .withColumns({"pipeline_run_id": _run_id(), "state": state})
        .select(
            "pipeline_run_id",
            _batch_id().alias("batch_id"),
            _pipeline_name().alias("pipeline_name"),
            stage.alias("stage_name"),
            F.concat(F.lit("scheduled__"), F.col("day").cast("string")).alias("dag_run_id"),
            (number % 4 + 1).cast("int").alias("try_number"),
            "state",
            F.when(explained, "TransientError").alias("error_type"),
            F.when(explained, F.concat(F.lit("event "), number.cast("string"))).alias("error_message"),
            F.col("ts").alias("ended_at"),
        )
    )


def _month_batch() -> Column:
    """Batches that many runs share: one for each user and month."""
    return F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM"))


def request_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims and completions of batches in the order of the events: views and clicks claim, the rest completes."""
    claims = F.col("event_type").isin("view", "click")
    rival = F.when(F.col("event_id") % 6 == 0, "nightly").otherwise(_pipeline_name())
    status = F.when((F.col("event_type") != "error") & (F.col("event_id") % 9 == 0), "SUCCESS").otherwise("FAILED")
    return _events(spark, sf_dir).select(
        _month_batch().alias("batch_id"), F.col("event_id").cast("bigint").alias("seq"),
        F.when(claims, "CLAIM").otherwise("COMPLETE").alias("kind"), F.when(claims, rival).alias("pipeline_name"),
        F.when(~claims, status).alias("status"),
    )


def known_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch log that knows every third user's batches before the stream begins."""
    batches = _events(spark, sf_dir).filter("user_id % 3 = 0").select(
        "user_id", _month_batch().alias("batch_id"), _pipeline_name().alias("pipeline_name")
    )
    status = F.when(F.col("user_id") % 2 == 0, "FAILED").otherwise("RUNNING")
    return batches.distinct().select("batch_id", "pipeline_name", status.alias("status"), F.lit(1).cast("bigint").alias("seq"))


def month_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a user's day, each an attempt at the batch of its month."""
    runs = _events(spark, sf_dir).groupBy("user_id", "day").agg(
        F.min("ts").alias("ts"), F.bool_or(F.col("event_type") == "error").alias("failed")
    )
    return runs.select(
        _run_id().alias("pipeline_run_id"), _month_batch().alias("batch_id"), _pipeline_name().alias("pipeline_name"),
        F.when(F.col("failed"), "FAILED").otherwise("SUCCESS").alias("status"),
    )


def stage_executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One execution of a stage per event; errors failed, and some are without a type."""
    number, failed = F.col("event_id"), F.col("event_type") == "error"
    stage = F.when(number % 3 == 0, "prepare_run").when(number % 3 == 1, "bronze").otherwise("silver")
    told = failed & (number % 5 != 0)
    return _events(spark, sf_dir).select(
        F.lpad(number.cast("string"), 12, "0").alias("stage_run_id"), _run_id().alias("pipeline_run_id"), stage.alias("stage_name"),
        F.col("ts").alias("started_at"), F.col("ts").alias("completed_at"),
        F.when(failed, "FAILED").when(F.col("event_type") == "signup", "RUNNING").otherwise("SUCCESS").alias("status"),
        F.when(told, "TransientError").alias("error_type"),
        F.when(told, F.concat(F.lit("event "), number.cast("string"))).alias("error_message"),
    )


def wide_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence in three appends, of customers whose ids are far beyond 32 bits, some of them repeated or missing."""
    number = F.col("event_id")
    wide = (number % 7 - 2) * 10_000_000_000 + number % 3
    return _events(spark, sf_dir).filter("event_type IN ('purchase', 'click')").select(
        _run_id().alias("pipeline_run_id"), F.when(number % 10 != 9, wide).alias("customer_id"), (number % 3).alias("append")
    )
