"""DuckDB SQL for every query of the catalog, written from the rules and not from the Spark plans.

Shared steps are named CTEs; a query lists only its last step and gets the CTEs it refers to.  Traps that
shape the text: DuckDB divides decimals as doubles (so rates and averages use integers), its concat skips
nulls, and durations are counted in millisecond boundaries.
"""

from __future__ import annotations

import re

RUN = {1: "00000000-0000-4000-8000-0000000000a1", 2: "00000000-0000-4000-8000-0000000000a2"}
BATCH = {1: "00000000-0000-4000-8000-0000000000b1", 2: "00000000-0000-4000-8000-0000000000b2"}
LOADED = {1: "TIMESTAMP '2024-02-01 00:00:00'", 2: "TIMESTAMP '2024-02-02 00:00:00'"}
INTERRUPTED_RUN = "00000000-0000-4000-8000-0000000000a3"
NOWHERE, OLDER_KEY, OLDER_LINE_KEY = 10**15, 2 * 10**15, 5 * 10**37

KEY = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
}
ATTRIBUTES = {
    "customers": ["first_name", "last_name", "email", "phone", "created_at"],
    "products": ["product_name", "category", "unit_cost", "unit_price"],
    "orders": ["customer_id", "order_date", "status", "total_amount"],
    "order_items": ["order_id", "product_id", "quantity", "unit_price"],
    "payments": ["order_id", "payment_date", "payment_method", "amount", "status"],
}
CHECKED = ["orders", "order_items", "payments"]
SINGLE_PARENT = {"orders": "customers", "payments": "orders"}

HANDLED = {
    "customers": "phone < '555-2'",
    "products": "product_name < 'm'",
    "orders": "order_date < TIMESTAMP '1996-01-01 00:00:00'",
    "order_items": "quantity < 25",
    "payments": "payment_date < TIMESTAMP '1996-01-01 00:00:00'",
}


def columns(entity: str, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in [KEY[entity], *ATTRIBUTES[entity]])


def iso(column: str) -> str:
    return (
        f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN date_part('microsecond', {column}) % 1000000 <> 0 "
        f"THEN strftime({column}, '.%f') ELSE '' END"
    )


HASH = {
    "customers": "sha256(coalesce(first_name, '') || '|' || coalesce(last_name, '') || '|' || coalesce(email, '') "
    "|| '|' || coalesce(phone, ''))",
    "products": "sha256(product_name || '|' || coalesce(category, '') || '|' || unit_cost::VARCHAR || '|' "
    "|| unit_price::VARCHAR)",
    "orders": f"sha256(customer_id::VARCHAR || '|' || {iso('order_date')} || '|' || status || '|' "
    "|| total_amount::VARCHAR)",
    "order_items": "sha256(order_id::VARCHAR || '|' || product_id::VARCHAR || '|' || quantity::VARCHAR || '|' "
    "|| unit_price::VARCHAR)",
    "payments": f"sha256(order_id::VARCHAR || '|' || {iso('payment_date')} || '|' || payment_method || '|' "
    "|| amount::VARCHAR || '|' || status)",
}

# --- source snapshots ------------------------------------------------------------------------------------

CTES: dict[str, str] = {}

CTES["customers_2"] = """
    WITH base AS (
        SELECT c_custkey AS customer_id,
            CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE substr(c_name, 1, 8) END AS first_name,
            CASE WHEN c_custkey % 127 = 0 THEN '' ELSE substr(c_name, 10, 9) END AS last_name,
            CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 53 = 0 THEN 'customer' || c_custkey
                ELSE 'customer' || c_custkey || '@example.test' END AS email,
            '555-' || c_nationkey AS phone,
            TIMESTAMP '2024-01-01 09:30:00.123556' AS created_at
        FROM customer)
    SELECT * FROM base
    UNION ALL
    SELECT customer_id, first_name, last_name, 'dup-' || customer_id || '@example.test', phone, created_at
    FROM base WHERE customer_id % 101 = 0"""
CTES["products_2"] = """
    SELECT p_partkey AS product_id, p_name AS product_name,
        CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_type END AS category,
        CAST(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(0.80 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS unit_cost,
        CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price
    FROM part"""
CTES["orders_2"] = f"""
    SELECT o_orderkey AS order_id,
        CASE WHEN o_orderkey % 401 = 0 THEN o_custkey + {NOWHERE} ELSE o_custkey END AS customer_id,
        o_orderdate AS order_date,
        CASE WHEN o_orderkey % 211 = 0 THEN 'Unknown' WHEN o_orderkey % 17 = 0 THEN 'Cancelled'
            WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Processing'
            ELSE 'Pending' END AS status,
        CASE WHEN o_orderkey % 307 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS total_amount
    FROM orders"""
CTES["order_items_2"] = f"""
    SELECT CASE WHEN l_orderkey % 487 = 3 THEN -1 ELSE 1 END * (l_orderkey::HUGEINT * 100000000000000000000000::HUGEINT +
            l_linenumber::HUGEINT * 1000000000000000000000::HUGEINT + l_quantity::HUGEINT * 10000000000000000000::HUGEINT +
            l_partkey::HUGEINT * 1000000000::HUGEINT + l_suppkey::HUGEINT) AS order_item_id,
        l_orderkey AS order_id,
        CASE WHEN l_partkey % 503 = 7 THEN l_partkey + {NOWHERE} ELSE l_partkey END AS product_id,
        CASE WHEN l_orderkey % 499 = 1 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
        CASE WHEN l_orderkey % 491 = 2 THEN CAST(0 AS DECIMAL(18,2))
            ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS unit_price
    FROM lineitem"""
CTES["payments_2"] = f"""
    SELECT o_orderkey AS payment_id,
        CASE WHEN o_orderkey % 409 = 5 THEN o_orderkey + {NOWHERE} ELSE o_orderkey END AS order_id,
        o_orderdate AS payment_date,
        CASE WHEN o_orderkey % 223 = 0 THEN 'GoldBars' WHEN o_orderkey % 4 = 0 THEN 'CreditCard'
            WHEN o_orderkey % 4 = 1 THEN 'DebitCard' WHEN o_orderkey % 4 = 2 THEN 'PayPal'
            ELSE 'BankTransfer' END AS payment_method,
        CASE WHEN o_orderkey % 227 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2))
            ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
        CASE WHEN o_orderkey % 229 = 0 THEN 'Exploded' WHEN o_orderkey % 31 = 0 THEN 'Refunded'
            WHEN o_orderkey % 29 = 0 THEN 'Failed' WHEN o_orderstatus = 'F' THEN 'Completed'
            ELSE 'Pending' END AS status
    FROM orders"""

EARLIER = {
    "customers": ("phone", "'old-' || phone"),
    "products": ("unit_price", "CAST(unit_price - CAST(1.00 AS DECIMAL(3,2)) AS DECIMAL(18,2))"),
    "orders": ("total_amount", "CAST(total_amount + CAST(1.00 AS DECIMAL(3,2)) AS DECIMAL(18,2))"),
    "order_items": ("quantity", "quantity + 1"),
    "payments": ("amount", "CAST(amount + CAST(1.00 AS DECIMAL(3,2)) AS DECIMAL(18,2))"),
}
for entity, key in KEY.items():
    changed, value = EARLIER[entity]
    CTES[f"{entity}_1"] = f"""
    SELECT * REPLACE (CASE WHEN {key} % 25 = 24 THEN {key} + {OLDER_LINE_KEY if entity == 'order_items' else OLDER_KEY} ELSE {key} END AS {key},
        CASE WHEN {key} % 10 = 1 THEN {value} ELSE {changed} END AS {changed})
    FROM {entity}_2"""

# --- customers ---------------------------------------------------------------------------------------------

for n in (1, 2):
    CTES[f"customer_errors_{n}"] = f"""
    WITH ranked AS (
        SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY first_name NULLS FIRST, last_name NULLS FIRST,
            email NULLS FIRST, phone NULLS FIRST, created_at NULLS FIRST) AS occurrence
        FROM customers_{n})
    SELECT * EXCLUDE (occurrence), 'DUPLICATE_CUSTOMER_ID' AS validation_rule,
        'Duplicate CustomerID=' || customer_id AS validation_message FROM ranked WHERE occurrence > 1
    UNION ALL
    SELECT * EXCLUDE (occurrence), 'FIRST_NAME_REQUIRED', 'FirstName is required'
    FROM ranked WHERE coalesce(first_name, '') = ''
    UNION ALL
    SELECT * EXCLUDE (occurrence), 'LAST_NAME_REQUIRED', 'LastName is required'
    FROM ranked WHERE coalesce(last_name, '') = ''
    UNION ALL
    SELECT * EXCLUDE (occurrence), 'EMAIL_FORMAT', 'Invalid email ''' || email || ''''
    FROM ranked WHERE email <> '' AND position('@' IN email) = 0"""
    CTES[f"valid_customers_{n}"] = f"""
    SELECT * FROM customers_{n} WHERE customer_id NOT IN (SELECT customer_id FROM customer_errors_{n})"""

# --- bronze --------------------------------------------------------------------------------------------------

for entity in KEY:
    for n in (1, 2):
        source = f"valid_customers_{n}" if entity == "customers" else f"{entity}_{n}"
        rounded = "* REPLACE (TIMESTAMP '2024-01-01 09:30:00.124' AS created_at)" if entity == "customers" else "*"
        CTES[f"batch_{entity}_{n}"] = f"""
    SELECT {rounded}, {HASH[entity]} AS record_hash, {LOADED[n]} AS ingested_at, '{RUN[n]}' AS pipeline_run_id,
        '{BATCH[n]}' AS batch_id
    FROM {source}"""
    CTES[f"bronze_{entity}"] = f"SELECT * FROM batch_{entity}_1 UNION ALL SELECT * FROM batch_{entity}_2"

# --- rules ---------------------------------------------------------------------------------------------------

STATUSES = "('Pending', 'Processing', 'Completed', 'Cancelled')"
METHODS = "('CreditCard', 'DebitCard', 'PayPal', 'BankTransfer')"
PAID = "('Pending', 'Completed', 'Failed', 'Refunded')"
VALID = {
    "orders": f"order_id > 0 AND customer_id > 0 AND status IN {STATUSES} AND total_amount >= 0",
    "order_items": "order_item_id > 0 AND order_id > 0 AND product_id > 0 AND quantity > 0 AND unit_price > 0",
    "payments": f"payment_id > 0 AND order_id > 0 AND payment_method IN {METHODS} AND amount > 0 AND status IN {PAID}",
}
# (failed, text) in rule order
FIELD_RULES = {
    "orders": [
        ("order_id <= 0", "OrderID must be greater than zero"),
        ("customer_id <= 0", "CustomerID must be greater than zero"),
        (f"status NOT IN {STATUSES}", "Invalid order status"),
        ("total_amount < 0", "TotalAmount must be greater than or equal to zero"),
    ],
    "order_items": [
        ("order_item_id <= 0", "OrderItemID must be greater than zero"),
        ("order_id <= 0", "OrderID must be greater than zero"),
        ("product_id <= 0", "ProductID must be greater than zero"),
        ("quantity <= 0", "Quantity must be greater than zero"),
        ("unit_price <= 0", "UnitPrice must be greater than zero"),
    ],
    "payments": [
        ("payment_id <= 0", "PaymentID must be greater than zero"),
        ("order_id <= 0", "OrderID must be greater than zero"),
        (f"payment_method NOT IN {METHODS}", "Invalid payment method"),
        ("amount <= 0", "Amount must be greater than zero"),
        (f"status NOT IN {PAID}", "Invalid payment status"),
    ],
}
NO_CUSTOMER = "CustomerID does not exist in silver.Customers"
NO_ORDER = "OrderID does not exist in silver.Orders"
NO_PRODUCT = "ProductID does not exist in silver.Products"


def arm(failed: str, text: str) -> str:
    return f"CASE WHEN {failed} THEN '{text}' ELSE '' END"


def exists(parent: str, column: str, n: int) -> str:
    return f"{column} IN (SELECT {KEY[parent]} FROM silver_{parent}_{n})"


def trusted(entity: str, n: int) -> str:
    tests = [VALID.get(entity, "true")]
    if entity in SINGLE_PARENT:
        parent = SINGLE_PARENT[entity]
        tests.append(exists(parent, KEY[parent], n))
    elif entity == "order_items":
        tests += [exists("orders", "order_id", n), exists("products", "product_id", n)]
    return " AND ".join(tests)


def reason(entity: str, n: int = 2) -> str:
    arms = [arm(failed, text + "; ") for failed, text in FIELD_RULES[entity]]
    if entity == "orders":
        arms.append(arm(f"{VALID['orders']} AND NOT {exists('customers', 'customer_id', n)}", NO_CUSTOMER))
    elif entity == "payments":
        arms.append(arm(f"{VALID['payments']} AND NOT {exists('orders', 'order_id', n)}", NO_ORDER + "; "))
    else:
        arms.append(arm(f"order_id > 0 AND NOT {exists('orders', 'order_id', n)}", NO_ORDER + "; "))
        arms.append(arm(f"product_id > 0 AND NOT {exists('products', 'product_id', n)}", NO_PRODUCT + "; "))
    return " || ".join(arms)


# --- silver --------------------------------------------------------------------------------------------------


def silver_columns(entity: str, prefix: str = "") -> str:
    names = [("NULL::TIMESTAMP AS created_at" if c == "created_at" else prefix + c) for c in ATTRIBUTES[entity]]
    return ", ".join([prefix + KEY[entity], *names, prefix + "record_hash"])


for entity, key in KEY.items():
    for n in (1, 2):
        CTES[f"trusted_{entity}_{n}"] = f"SELECT * FROM batch_{entity}_{n} WHERE {trusted(entity, n)}"
    loaded = "{columns}, {p}ingested_at AS source_ingested_at, {at} AS processed_at"
    CTES[f"silver_{entity}_1"] = f"""
    SELECT {loaded.format(columns=silver_columns(entity), p='', at=LOADED[1])} FROM trusted_{entity}_1"""
    CTES[f"changed_{entity}"] = f"""
    SELECT b.* FROM trusted_{entity}_2 b JOIN silver_{entity}_1 s USING ({key}) WHERE b.record_hash <> s.record_hash"""
    CTES[f"new_{entity}"] = f"""
    SELECT * FROM trusted_{entity}_2 WHERE {key} NOT IN (SELECT {key} FROM silver_{entity}_1)"""
    CTES[f"silver_{entity}_2"] = f"""
    SELECT * FROM silver_{entity}_1 WHERE {key} NOT IN (SELECT {key} FROM changed_{entity})
    UNION ALL
    SELECT {loaded.format(columns=silver_columns(entity), p='', at=LOADED[2])}
    FROM (SELECT * FROM changed_{entity} UNION ALL SELECT * FROM new_{entity})"""
for entity in CHECKED:
    for n in (1, 2):
        CTES[f"rejected_{entity}_{n}"] = f"""
    SELECT * FROM (SELECT {columns(entity)}, {reason(entity, n)} AS failure_reason FROM batch_{entity}_{n})
    WHERE failure_reason <> ''"""
CTES["rejected_early"] = f"""
    SELECT * FROM (SELECT order_id, {reason('orders', 1)} AS failure_reason FROM batch_orders_2)
    WHERE failure_reason <> ''"""


def stage_counts(entity: str, n: int, prefix: str = "") -> str:
    quarantined = f"(SELECT count(*) FROM rejected_{entity}_{n})" if entity in CHECKED else "CAST(0 AS BIGINT)"
    if n == 1:
        counts = f"(SELECT count(*) FROM trusted_{entity}_1) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated"
    else:
        counts = (
            f"(SELECT count(*) FROM new_{entity}) AS rows_inserted, "
            f"(SELECT count(*) FROM changed_{entity}) AS rows_updated"
        )
    return f"SELECT {prefix}'{entity}_silver' AS stage_name, {counts}, {quarantined} AS rows_quarantined"


def bronze_counts(entity: str, n: int, prefix: str = "") -> str:
    return (
        f"SELECT {prefix}'{entity}_bronze' AS stage_name, (SELECT count(*) FROM batch_{entity}_{n}) AS rows_inserted, "
        "CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_quarantined"
    )


# --- logs ------------------------------------------------------------------------------------------------------

CTES["marked"] = """
    SELECT *, CAST(ts AS DATE) AS day, user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS pipeline_run_id,
        CASE WHEN user_id % 5 = 0 THEN 'commerce' ELSE 'customer_pipeline' END AS pipeline_name
    FROM events"""


def stable_id(name: str) -> str:
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))"
    variant = f"substr('89ab', CAST('0x' || substr({digest}, 17, 1) AS INTEGER) % 4 + 1, 1)"
    return (
        f"substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || "
        f"{variant} || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12)"
    )


CTES["runs"] = f"""
    SELECT pipeline_run_id, pipeline_name, started_at,
        CASE WHEN user_id % 13 <> 0 THEN last_at END AS completed_at,
        CASE WHEN user_id % 13 = 0 THEN 'RUNNING' WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status,
        CASE WHEN user_id % 13 <> 0 AND failed THEN 'load failed' END AS error_message,
        {stable_id("'load:' || pipeline_run_id")} AS batch_id, user_id, day
    FROM (
        SELECT user_id, day, pipeline_run_id, pipeline_name, min(ts) AS started_at, max(ts) AS last_at,
            count(*) FILTER (event_type = 'error' AND value > 50) > 0 AS failed
        FROM marked GROUP BY ALL)"""
CTES["run_facts"] = """
    SELECT *, date_diff('millisecond', started_at, completed_at) AS duration_ms FROM runs"""
CTES["stages"] = """
    SELECT pipeline_run_id || '-' || stage_name AS stage_run_id, pipeline_run_id, stage_name, started_at,
        completed_at, 'SUCCESS' AS status, rows_processed,
        date_diff('millisecond', started_at, completed_at) AS duration_ms, NULL::VARCHAR AS error_message
    FROM (
        SELECT pipeline_run_id, CASE event_type WHEN 'view' THEN 'bronze' ELSE 'silver' END AS stage_name,
            min(ts) AS started_at, max(ts) AS completed_at, count(*) AS rows_processed
        FROM marked WHERE event_type IN ('view', 'click') GROUP BY 1, 2)"""
CTES["stage_sums"] = """
    SELECT pipeline_run_id,
        CAST(sum(CASE WHEN stage_name = 'bronze' THEN rows_processed ELSE 0 END) AS BIGINT) AS bronze_rows_processed,
        CAST(sum(CASE WHEN stage_name = 'silver' THEN rows_processed ELSE 0 END) AS BIGINT) AS silver_rows_processed,
        CAST(sum(CASE WHEN stage_name = 'bronze' THEN duration_ms ELSE 0 END) AS BIGINT) AS bronze_duration_ms,
        CAST(sum(CASE WHEN stage_name = 'silver' THEN duration_ms ELSE 0 END) AS BIGINT) AS silver_duration_ms
    FROM stages GROUP BY 1"""
CTES["quarantine_sums"] = """
    SELECT pipeline_run_id, count(DISTINCT event_id % 7) AS invalid_customers, count(*) AS validation_errors
    FROM marked WHERE event_type = 'purchase' GROUP BY 1"""
CTES["event_sums"] = """
    SELECT pipeline_run_id, count(*) FILTER (event_type = 'error') AS retry_count,
        count(*) FILTER (event_type = 'signup') AS recovery_count
    FROM marked WHERE event_type IN ('error', 'signup') GROUP BY 1"""
CTES["health"] = """
    SELECT r.pipeline_run_id, pipeline_name, started_at, completed_at, status, duration_ms,
        coalesce(bronze_rows_processed, 0) AS bronze_rows_processed,
        coalesce(silver_rows_processed, 0) AS silver_rows_processed, bronze_duration_ms, silver_duration_ms,
        coalesce(invalid_customers, 0) AS invalid_customers, coalesce(validation_errors, 0) AS validation_errors,
        coalesce(retry_count, 0) AS retry_count, coalesce(recovery_count, 0) AS recovery_count, error_message
    FROM run_facts r LEFT JOIN stage_sums USING (pipeline_run_id) LEFT JOIN quarantine_sums USING (pipeline_run_id)
        LEFT JOIN event_sums USING (pipeline_run_id)"""
CTES["attempts"] = f"""
    SELECT pipeline_run_id, {stable_id("'load:' || pipeline_run_id")} AS batch_id, pipeline_name,
        CASE event_id % 3 WHEN 0 THEN 'prepare_run' WHEN 1 THEN 'bronze' ELSE 'silver' END AS stage_name,
        'scheduled__' || CAST(day AS VARCHAR) AS dag_run_id, CAST(event_id % 4 + 1 AS INTEGER) AS try_number,
        CASE WHEN event_type = 'error' AND value > 60 THEN 'lost' WHEN event_type = 'error' THEN 'failed'
            WHEN event_type = 'purchase' THEN 'up_for_retry' ELSE 'success' END AS state,
        CASE WHEN event_type IN ('error', 'purchase') AND event_id % 5 <> 0 THEN 'TransientError' END AS error_type,
        CASE WHEN event_type IN ('error', 'purchase') AND event_id % 5 <> 0 THEN 'event ' || event_id END
            AS error_message, ts AS ended_at
    FROM marked"""


# Batches of a user's month: their requests in order, and the executions of their stages.
CTES["requests"] = """
    SELECT user_id || '-' || strftime(ts, '%Y-%m') AS batch_id, event_id AS seq, event_type IN ('view', 'click') AS is_claim,
        CASE WHEN event_type NOT IN ('view', 'click') THEN NULL WHEN event_id % 6 = 0 THEN 'nightly' ELSE pipeline_name END AS pipeline_name,
        CASE WHEN event_type IN ('view', 'click') THEN NULL WHEN event_type <> 'error' AND event_id % 9 = 0 THEN 'SUCCESS'
            ELSE 'FAILED' END AS status,
        row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m') ORDER BY event_id) AS n
    FROM marked"""
CTES["request_fold"] = """
    WITH RECURSIVE fold AS (
        SELECT batch_id, 0::BIGINT AS n, max(CASE WHEN user_id % 3 = 0 THEN pipeline_name END) AS owner,
            max(CASE WHEN user_id % 3 <> 0 THEN NULL WHEN user_id % 2 = 0 THEN 'FAILED' ELSE 'RUNNING' END) AS now_is,
            NULL::VARCHAR AS pipeline_name, NULL::BIGINT AS seq, false AS is_claim, NULL::VARCHAR AS owner_before, NULL::VARCHAR AS was
        FROM (SELECT *, user_id || '-' || strftime(ts, '%Y-%m') AS batch_id FROM marked) GROUP BY batch_id
        UNION ALL
        SELECT f.batch_id, r.n, CASE WHEN r.is_claim THEN coalesce(f.owner, r.pipeline_name) ELSE f.owner END,
            CASE WHEN NOT r.is_claim THEN CASE WHEN f.now_is IS NOT NULL THEN r.status END
                WHEN f.now_is IS NULL OR (f.now_is = 'FAILED' AND f.owner = r.pipeline_name) THEN 'RUNNING' ELSE f.now_is END,
            r.pipeline_name, r.seq, r.is_claim, f.owner, f.now_is
        FROM fold f JOIN requests r ON r.batch_id = f.batch_id AND r.n = f.n + 1)
    SELECT * FROM fold"""
CTES["lined"] = """
    SELECT *, user_id || '-' || strftime(ts, '%Y-%m') AS batch_id,
        CASE event_id % 3 WHEN 0 THEN 'prepare_run' WHEN 1 THEN 'bronze' ELSE 'silver' END AS stage_name,
        CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
        CASE WHEN event_type = 'error' AND event_id % 5 <> 0 THEN 'TransientError' END AS error_type,
        CASE WHEN event_type = 'error' AND event_id % 5 <> 0 THEN 'event ' || event_id END AS error_message
    FROM marked"""
CTES["tries"] = """
    SELECT pipeline_run_id, batch_id, pipeline_name, stage_name,
        CAST(row_number() OVER (PARTITION BY batch_id, stage_name, streak ORDER BY ts, event_id) AS INTEGER) AS try_number,
        CASE WHEN status = 'SUCCESS' THEN 'success' WHEN status = 'RUNNING' THEN 'running' WHEN again THEN 'up_for_retry'
            ELSE 'failed' END AS state, error_type, error_message, ts AS ended_at
    FROM (
        SELECT *, lead(event_id) OVER w IS NOT NULL AS again,
            coalesce(sum(CAST(status = 'SUCCESS' AS INTEGER)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS streak
        FROM lined WINDOW w AS (PARTITION BY batch_id, stage_name ORDER BY ts, event_id))"""


def average(value: str) -> str:
    """Mean rounded half up to two decimals, in integer hundredths."""
    total, n = f"CAST(sum({value}) AS HUGEINT)", f"count({value})"
    return (
        f"CAST(CAST((2 * 100 * {total} + {n}) // (2 * nullif({n}, 0)) AS DECIMAL(20,0)) / 100 AS DECIMAL(18,2))"
    )


def rate(ok: str, total: str) -> str:
    return f"CAST(CAST((2 * 10000 * {ok} + {total}) // (2 * {total}) AS DECIMAL(20,0)) / 100 AS DECIMAL(5,2))"


def daily(name: str) -> str:
    ok = "count(*) FILTER (status = 'SUCCESS')"
    return f"""
    SELECT CAST(started_at AS DATE) AS metric_date, count(*) AS total_runs, {ok} AS successful_runs,
        count(*) FILTER (status = 'FAILED') AS failed_runs, {rate(ok, 'count(*)')} AS success_rate_pct,
        CAST(sum(retry_count) AS BIGINT) AS retry_count, CAST(sum(recovery_count) AS BIGINT) AS recovery_count,
        CAST(sum(invalid_customers) AS BIGINT) AS invalid_customers,
        CAST(sum(validation_errors) AS BIGINT) AS validation_errors,
        {average('duration_ms')} AS average_duration_ms, max(duration_ms) AS max_duration_ms,
        {average('bronze_duration_ms')} AS average_bronze_duration_ms,
        {average('silver_duration_ms')} AS average_silver_duration_ms
    FROM health WHERE completed_at IS NOT NULL AND pipeline_name = '{name}' GROUP BY 1"""


RUN_STATE = "SELECT pipeline_run_id, pipeline_name, batch_id, started_at, completed_at, status, error_message FROM runs"
BATCH_STATE = """
    SELECT batch_id, pipeline_name, started_at, completed_at, status,
        CASE WHEN status = 'SUCCESS' THEN length(pipeline_run_id) END AS rows_processed, error_message FROM runs"""

# --- queries -----------------------------------------------------------------------------------------------------


def _queries() -> dict[str, str]:
    q: dict[str, str] = {}
    for entity, key in KEY.items():
        q[f"src_{entity}"] = f"SELECT * FROM {entity}_2"
        q[f"hash_{entity}"] = f"SELECT {key}, {HASH[entity]} AS record_hash FROM {entity}_2"
        handled = HANDLED[entity]
        q[f"bronze_append_{entity}"] = f"""
    SELECT {key}, batch_id, pipeline_run_id, ingested_at, record_hash FROM batch_{entity}_1
    UNION ALL
    SELECT {key}, batch_id, CASE WHEN {handled} THEN '{INTERRUPTED_RUN}' ELSE pipeline_run_id END,
        CASE WHEN {handled} THEN TIMESTAMP '2024-02-01 12:00:00' ELSE ingested_at END, record_hash
    FROM batch_{entity}_2"""
        q[f"bronze_new_rows_{entity}"] = f"""
    SELECT {key}, pipeline_run_id, batch_id, record_hash FROM batch_{entity}_2 WHERE NOT ({handled})"""
        q[f"silver_changed_{entity}"] = f"SELECT {key}, record_hash FROM changed_{entity}"
        q[f"silver_new_{entity}"] = f"SELECT {key}, record_hash FROM new_{entity}"
        q[f"silver_{entity}"] = f"SELECT * FROM silver_{entity}_2"
    for entity in CHECKED:
        key = KEY[entity]
        q[f"failure_reason_{entity}"] = f"SELECT {key}, failure_reason FROM rejected_{entity}_2"
        q[f"{entity}_field_valid"] = f"SELECT * FROM {entity}_2 WHERE {VALID[entity]}"
        q[f"{entity}_promotable"] = f"SELECT {columns(entity)} FROM trusted_{entity}_2"
        q[f"quarantine_{entity}"] = f"""
    SELECT *, '{RUN[2]}' AS pipeline_run_id, {LOADED[2]} AS quarantined_at, '{BATCH[2]}' AS batch_id
    FROM rejected_{entity}_2"""
        q[f"quarantine_new_{entity}"] = f"""
    SELECT {key}, failure_reason FROM rejected_{entity}_2 WHERE NOT ({HANDLED[entity]})"""
    lists = {
        "orders": [
            *FIELD_RULES["orders"][:2],
            ("order_date IS NULL", "OrderDate is required"),
            (f"status NOT IN {STATUSES}", "Invalid order status: ' || status || '"),
            FIELD_RULES["orders"][3],
        ],
        "order_items": FIELD_RULES["order_items"],
        "payments": [
            *FIELD_RULES["payments"][:2],
            ("payment_date IS NULL", "PaymentDate is required"),
            *FIELD_RULES["payments"][2:],
        ],
    }
    for entity, rules in lists.items():
        # A message's position counts the failed rules before it.
        parts = []
        for i, (failed, text) in enumerate(rules):
            before = " + ".join([f"CAST(({f}) AS INTEGER)" for f, _ in rules[:i]]) or "0"
            parts.append(f"SELECT {KEY[entity]}, {before} AS position, '{text}' AS message FROM {entity}_2 WHERE {failed}")
        q[f"validate_{entity}"] = " UNION ALL ".join(parts)
    q["order_items_parents"] = f"""
    SELECT order_item_id, CAST(NOT {exists('orders', 'order_id', 2)} AS INTEGER) AS orders_missing,
        CAST(NOT {exists('products', 'product_id', 2)} AS INTEGER) AS products_missing FROM batch_order_items_2"""
    q["payments_parents"] = f"""
    SELECT payment_id, CAST(NOT {exists('orders', 'order_id', 2)} AS INTEGER) AS orders_missing FROM batch_payments_2"""
    q["orders_orphans"] = f"""
    SELECT order_id, customer_id FROM batch_orders_2
    WHERE {VALID['orders']} AND NOT {exists('customers', 'customer_id', 2)}"""

    q["stage_replace_run"] = f"""
    SELECT pipeline_run_id, order_id, record_hash FROM bronze_orders"""
    q["quarantine_append"] = f"""
    SELECT 'customers' AS entity, customer_id::VARCHAR AS record_key, '{RUN[2]}' AS pipeline_run_id,
        validation_message AS reason FROM customer_errors_2""" + "".join(
        f"""
    UNION ALL
    SELECT '{entity}', {KEY[entity]}::VARCHAR, CASE WHEN {HANDLED[entity]} THEN '{INTERRUPTED_RUN}' ELSE '{RUN[2]}' END,
        failure_reason FROM rejected_{entity}_2"""
        for entity in CHECKED
    )
    q["silver_publish"] = "SELECT * FROM silver_products_2"
    q["ops_log_append"] = f"""
    SELECT 'pipeline_runs' AS log, pipeline_run_id AS id, status, pipeline_name, batch_id, NULL::VARCHAR AS stage_name, started_at,
        completed_at, NULL::TIMESTAMP AS event_time, NULL::BIGINT AS rows_processed, error_message FROM runs
    UNION ALL SELECT 'batches', batch_id, status, pipeline_name, batch_id, NULL, started_at, completed_at, NULL, rows_processed,
        error_message FROM ({BATCH_STATE})
    UNION ALL SELECT 'stage_runs', stage_run_id, status, NULL, NULL, stage_name, started_at, completed_at, NULL, rows_processed,
        error_message FROM stages
    UNION ALL SELECT 'events', pipeline_run_id, CASE event_type WHEN 'error' THEN 'RETRY' ELSE 'RECOVERED' END, NULL,
        {stable_id("'load:' || pipeline_run_id")}, 'bronze', NULL, NULL, ts, NULL, NULL
    FROM marked WHERE event_type IN ('error', 'signup')"""
    q["iso_timestamp"] = f"""
    SELECT event_id, {iso('ts')} AS iso_text, strftime(ts, '%Y-%m-%dT00:00:00') AS iso_midnight FROM events"""
    q["decimal_text"] = """
    SELECT product_id, unit_cost::VARCHAR AS unit_cost_text, unit_price::VARCHAR AS unit_price_text FROM products_2"""
    q["stamp_lineage"] = "SELECT order_id, ingested_at, pipeline_run_id, batch_id FROM batch_orders_2"
    q["duration_ms"] = "SELECT pipeline_run_id, duration_ms FROM run_facts"
    q["metric_date"] = "SELECT pipeline_run_id, CAST(started_at AS DATE) AS metric_date FROM runs"
    q["null_defaults"] = """
    SELECT pipeline_run_id, coalesce(bronze_rows_processed, 0) AS rows_or_zero,
        nullif(coalesce(bronze_rows_processed, 0), 0) AS rows_or_null
    FROM runs LEFT JOIN stage_sums USING (pipeline_run_id)"""
    ok = "count(*) FILTER (status = 'SUCCESS')"
    q["success_rate_pct"] = f"""
    SELECT CAST(started_at AS DATE) AS metric_date, {rate(ok, 'count(*)')} AS success_rate_pct FROM runs GROUP BY 1"""
    q["stable_batch_id"] = "SELECT pipeline_run_id, batch_id FROM runs"
    q["validate_customers"] = "SELECT customer_id, email, validation_rule, validation_message FROM customer_errors_2"
    q["valid_customers"] = "SELECT * FROM valid_customers_2"
    q["batch_scope"] = f"""
    SELECT order_id, batch_id, status, total_amount FROM bronze_orders WHERE batch_id = '{BATCH[2]}'"""
    q["hash_changed"] = """
    SELECT product_id, CAST(b.record_hash <> s.record_hash AS INTEGER) AS changed
    FROM batch_products_2 b JOIN silver_products_1 s USING (product_id)"""
    q["email_suffix_like"] = """
    SELECT customer_id, email FROM batch_customers_2 WHERE email LIKE '%@example.test' AND record_hash IS NOT NULL"""
    q["completed_runs_only"] = "SELECT pipeline_run_id, completed_at, status FROM runs WHERE completed_at IS NOT NULL"
    q["pipeline_name_filter"] = """
    SELECT pipeline_run_id, pipeline_name, status FROM runs WHERE pipeline_name = 'commerce'"""
    q["schema_contract"] = _contract()
    q["health_join"] = """
    SELECT pipeline_run_id, status, duration_ms, bronze_rows_processed, silver_rows_processed, bronze_duration_ms,
        silver_duration_ms, invalid_customers, validation_errors, retry_count, recovery_count
    FROM run_facts LEFT JOIN stage_sums USING (pipeline_run_id) LEFT JOIN quarantine_sums USING (pipeline_run_id)
        LEFT JOIN event_sums USING (pipeline_run_id)"""
    latest = """
    SELECT * FROM bronze_customers
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingested_at DESC, batch_id DESC) = 1"""
    q["silver_hash_lookup"] = f"""
    SELECT count(*) AS customers_checked, count(*) FILTER (l.record_hash = s.record_hash) AS matching,
        count(*) FILTER (l.record_hash <> s.record_hash) AS differing,
        count(*) FILTER (s.customer_id IS NULL) AS missing
    FROM ({latest}) l LEFT JOIN silver_customers_1 s ON s.customer_id = l.customer_id
    WHERE l.email LIKE '%@example.test'"""
    q["quarantine_metrics"] = "SELECT * FROM quarantine_sums"
    q["event_metrics"] = "SELECT * FROM event_sums"
    q["stage_metrics"] = "SELECT * FROM stage_sums"
    q["daily_metrics"] = daily("commerce")
    q["pipeline_daily_metrics"] = daily("customer_pipeline")
    q["daily_metrics_kept"] = daily("customer_pipeline")
    q["pipeline_health"] = "SELECT * FROM health WHERE pipeline_name = 'customer_pipeline'"
    q["run_metrics"] = """
    SELECT pipeline_run_id, pipeline_name, started_at, completed_at, status, duration_ms, error_message FROM run_facts"""
    q["stage_run_metrics"] = "SELECT * FROM stages"
    q["avg_duration"] = f"""
    SELECT pipeline_name, status, {average('duration_ms')} AS average_duration_ms FROM run_facts GROUP BY 1, 2"""
    gate = """
    SELECT (SELECT count(*) FROM customers_2) AS total_rows,
        (SELECT count(DISTINCT customer_id) FROM customer_errors_2) AS invalid_ids"""
    q["customer_invalid_rate"] = f"""
    SELECT *, CAST(invalid_ids AS DOUBLE) / CAST(total_rows AS DOUBLE) AS invalid_rate FROM ({gate})"""
    q["customer_quality_gate"] = f"""
    SELECT *, CAST(0.05 AS DOUBLE) AS threshold, CAST(NOT invalid_rate > 0.05 AS INTEGER) AS passed
    FROM ({q['customer_invalid_rate']})"""
    q["batch_rows_processed"] = """
    SELECT pipeline_run_id, count(*) AS rows_processed FROM marked
    WHERE event_type NOT IN ('click', 'signup') GROUP BY 1"""
    q["stage_result_counts"] = " UNION ALL ".join(stage_counts(entity, 2) for entity in KEY)
    q["latest_customers"] = latest
    q["latest_customers_kept"] = """
    SELECT * FROM (
        SELECT * FROM bronze_customers
        UNION ALL
        SELECT * REPLACE (TIMESTAMP '2024-02-01 18:00:00' AS ingested_at, '00000000-0000-4000-8000-0000000000a5' AS pipeline_run_id,
            '00000000-0000-4000-8000-0000000000b3' AS batch_id) FROM batch_customers_1 WHERE customer_id % 3 = 0)
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY ingested_at DESC, batch_id DESC) = 1"""
    q["quarantine_metrics_merged"] = """
    SELECT pipeline_run_id, count(DISTINCT CASE WHEN event_id % 10 <> 9 THEN event_id % 7 * 10 + event_id % 3 END) AS invalid_customers,
        count(*) AS validation_errors
    FROM marked WHERE event_type IN ('purchase', 'click') GROUP BY 1"""
    q["duplicate_customers"] = """
    SELECT * EXCLUDE (validation_rule, validation_message) FROM customer_errors_2
    WHERE validation_rule = 'DUPLICATE_CUSTOMER_ID'"""
    q["latest_state"] = RUN_STATE
    q["customers_ordered"] = "SELECT * FROM customers_2 ORDER BY customer_id"
    for name, n in (("last_run", 1), ("recent_runs", 5)):
        q[name] = f"""
    SELECT pipeline_run_id, pipeline_name, status, started_at FROM runs
    ORDER BY started_at DESC, pipeline_run_id DESC LIMIT {n}"""
    q["batch_exists"] = f"SELECT batch_id FROM bronze_customers WHERE batch_id = '{BATCH[2]}' LIMIT 1"
    q["quarantine_customers"] = f"""
    SELECT *, {LOADED[2]} AS quarantined_at, NULL::TIMESTAMP AS resolved_at, '{RUN[2]}' AS pipeline_run_id
    FROM customer_errors_2"""
    early = f"batch_orders_2 WHERE {trusted('orders', 1)}"
    late_new = """trusted_orders_2 WHERE order_id NOT IN (SELECT order_id FROM silver_orders_1)
        AND order_id NOT IN (SELECT order_id FROM early)"""
    q["promote_after_recovery"] = f"""
    SELECT 1 AS attempt,
        (SELECT count(*) FROM {early} AND order_id NOT IN (SELECT order_id FROM silver_orders_1)) AS rows_inserted,
        (SELECT count(*) FROM (SELECT * FROM {early}) b JOIN silver_orders_1 s USING (order_id)
            WHERE b.record_hash <> s.record_hash) AS rows_updated,
        (SELECT count(*) FROM rejected_early) AS rows_quarantined
    UNION ALL
    SELECT 2, (SELECT count(*) FROM {late_new}),
        (SELECT count(*) FROM changed_orders WHERE order_id NOT IN (SELECT order_id FROM early)),
        (SELECT count(*) FROM rejected_orders_2 WHERE order_id NOT IN (SELECT order_id FROM rejected_early))"""
    CTES["early"] = f"SELECT * FROM {early}"
    CTES["due_orders_1"] = f"""
    SELECT * FROM batch_orders_1 WHERE {VALID['orders']} AND customer_id NOT IN (SELECT customer_id FROM silver_customers_1)
        AND customer_id IN (SELECT customer_id FROM silver_customers_2)"""
    CTES["due_orders_2"] = "SELECT * FROM trusted_orders_2 WHERE order_id IN (SELECT order_id FROM rejected_early)"
    CTES["held_orders"] = "SELECT order_id, record_hash FROM silver_orders_1 UNION ALL SELECT order_id, record_hash FROM due_orders_1"
    q["batches_due"] = " UNION ALL ".join(
        f"SELECT 'orders' AS entity, '{BATCH[n]}' AS batch_id, count(*) AS rows_due FROM due_orders_{n} HAVING count(*) > 0" for n in (1, 2)
    )
    q["due_promotions"] = f"""
    SELECT '{BATCH[1]}' AS batch_id, 'orders_silver' AS stage_name, (SELECT count(*) FROM due_orders_1) AS rows_inserted,
        CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_quarantined
    UNION ALL
    SELECT '{BATCH[2]}', 'orders_silver', (SELECT count(*) FROM due_orders_2 WHERE order_id NOT IN (SELECT order_id FROM held_orders)),
        (SELECT count(*) FROM due_orders_2 d JOIN held_orders h USING (order_id) WHERE d.record_hash <> h.record_hash), 0
    UNION ALL
    SELECT '{BATCH[2]}', 'payments_silver', (
        SELECT count(*) FROM batch_payments_2 WHERE {VALID['payments']}
            AND order_id NOT IN (SELECT order_id FROM silver_orders_1) AND order_id NOT IN (SELECT order_id FROM early)
            AND (order_id IN (SELECT order_id FROM due_orders_1) OR order_id IN (SELECT order_id FROM due_orders_2))), 0, 0"""
    q["process_customers"] = "SELECT * EXCLUDE (ingested_at, pipeline_run_id, batch_id) FROM batch_customers_2"
    q["batch_transition"] = f"""
    WITH requests AS (
        SELECT CASE WHEN user_id % 11 = 0 THEN {stable_id("'new:' || pipeline_run_id")} ELSE batch_id END AS batch_id,
            CASE WHEN user_id % 7 = 0 THEN 'nightly' ELSE pipeline_name END AS pipeline_name
        FROM runs),
    judged AS (
        SELECT q.batch_id, q.pipeline_name, r.status AS current_status, r.pipeline_name AS owner,
            CASE WHEN r.batch_id IS NULL THEN 'CLAIM_NEW'
                WHEN r.pipeline_name <> q.pipeline_name THEN 'REJECT_OTHER_PIPELINE'
                WHEN r.status = 'FAILED' THEN 'CLAIM_RETRY'
                WHEN r.status = 'SUCCESS' THEN 'REJECT_SUCCESS' ELSE 'REJECT_RUNNING' END AS outcome
        FROM requests q LEFT JOIN runs r ON r.batch_id = q.batch_id)
    SELECT batch_id, pipeline_name, current_status, outcome,
        CASE WHEN outcome LIKE 'CLAIM%' THEN 'RUNNING' ELSE current_status END AS new_status,
        CASE outcome
            WHEN 'REJECT_OTHER_PIPELINE' THEN
                'Batch ' || batch_id || ' belongs to pipeline ''' || owner || ''', not ''' || pipeline_name || '''.'
            WHEN 'REJECT_SUCCESS' THEN 'Batch ' || batch_id || ' has already completed successfully.'
            WHEN 'REJECT_RUNNING' THEN 'Batch ' || batch_id || ' is already running.' END AS message
    FROM judged"""
    q["batch_request_stream"] = """
    SELECT batch_id, pipeline_name, seq, was AS current_status, outcome,
        CASE WHEN outcome LIKE 'CLAIM%' THEN 'RUNNING' ELSE was END AS new_status,
        CASE outcome
            WHEN 'REJECT_OTHER_PIPELINE' THEN
                'Batch ' || batch_id || ' belongs to pipeline ''' || owner || ''', not ''' || pipeline_name || '''.'
            WHEN 'REJECT_SUCCESS' THEN 'Batch ' || batch_id || ' has already completed successfully.'
            WHEN 'REJECT_RUNNING' THEN 'Batch ' || batch_id || ' is already running.' END AS message
    FROM (
        SELECT *, CASE WHEN was IS NULL THEN 'CLAIM_NEW' WHEN owner_before <> pipeline_name THEN 'REJECT_OTHER_PIPELINE'
            WHEN was = 'FAILED' THEN 'CLAIM_RETRY' WHEN was = 'SUCCESS' THEN 'REJECT_SUCCESS'
            ELSE 'REJECT_RUNNING' END AS outcome
        FROM request_fold WHERE is_claim)"""
    q["stage_attempts"] = "SELECT * FROM tries"
    q["logged_retry_events"] = """
    SELECT pipeline_run_id, batch_id, pipeline_name, stage_name,
        CASE state WHEN 'up_for_retry' THEN 'RETRY' ELSE 'RECOVERED' END AS event_type, ended_at AS event_time, try_number,
        CASE state WHEN 'up_for_retry' THEN coalesce(error_type, 'UnknownError') END AS error_type,
        CASE state WHEN 'up_for_retry' THEN coalesce(error_message, 'Task retry requested without an exception.')
            ELSE 'Task succeeded after one or more retries.' END AS event_message
    FROM tries WHERE state = 'up_for_retry' OR (state = 'success' AND try_number > 1)"""
    q["logged_failure_summary"] = """
    SELECT pipeline_run_id, stage_name, coalesce(error_type, 'UnknownError') AS error_type,
        coalesce(error_message, 'Task failed without an exception.') AS error_message, try_number
    FROM tries WHERE state IN ('failed', 'up_for_retry')
    QUALIFY row_number() OVER (PARTITION BY pipeline_run_id ORDER BY
        CASE stage_name WHEN 'prepare_run' THEN 1 WHEN 'bronze' THEN 2 ELSE 3 END, ended_at DESC, try_number DESC) = 1"""
    landed = "(SELECT count(*) FROM batch_customers_2)"
    q["customer_steps"] = f"""
    SELECT 'run' AS log, '' AS name, 'SUCCESS' AS status, CAST(NULL AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS error
    UNION ALL SELECT 'batch', '', 'SUCCESS', {landed}, NULL
    UNION ALL SELECT 'stage', 'extract', 'FAILED', NULL, 'ConnectionError'
    UNION ALL SELECT 'stage', 'customer_bronze', 'FAILED', NULL, 'ConnectionError'
    UNION ALL SELECT 'stage', 'extract', 'SUCCESS', 2 * (SELECT count(*) FROM customers_2), NULL
    UNION ALL SELECT 'stage', 'validate', 'SUCCESS', 2 * (SELECT count(*) FROM customers_2), NULL
    UNION ALL SELECT 'stage', 'quarantine_invalid_customers', 'SUCCESS', 2 * (SELECT count(*) FROM customer_errors_2), NULL
    UNION ALL SELECT 'stage', 'load_bronze_customers', 'SUCCESS', {landed}, NULL
    UNION ALL SELECT 'stage', 'customer_bronze', 'SUCCESS', {landed}, NULL
    UNION ALL SELECT 'stage', 'customer_silver', 'SUCCESS',
        (SELECT count(*) FROM changed_customers) + (SELECT count(*) FROM new_customers), NULL
    UNION ALL SELECT 'event', 'customer_bronze', 'RETRY', 2, 'ConnectionError'
    UNION ALL SELECT 'event', 'customer_bronze', 'RECOVERED', 2, NULL"""
    q["batch_complete"] = BATCH_STATE
    q["batch_is_successful"] = f"SELECT batch_id, rows_processed FROM ({BATCH_STATE}) WHERE status = 'SUCCESS'"
    q["run_entity"] = " UNION ALL ".join(
        f(entity, 2, f"'{BATCH[2]}' AS batch_id, ") for entity in ("customers", "orders") for f in (bronze_counts, _first_load)
    )
    q["run_commerce"] = " UNION ALL ".join(
        f(entity, n, f"'{BATCH[n]}' AS batch_id, ")
        for n in (1, 2) for entity in KEY for f in (bronze_counts, stage_counts)
    )
    q["run_customer"] = " UNION ALL ".join(
        f(n).replace("customers_", "customer_", 1)
        for n in (1, 2)
        for f in (
            lambda n: f"SELECT '{BATCH[n]}' AS batch_id, 'customers_bronze' AS stage_name, (SELECT count(*) FROM "
            f"batch_customers_{n}) AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_quarantined",
            lambda n: stage_counts("customers", n, f"'{BATCH[n]}' AS batch_id, "),
        )
    )
    def health_row(run: str, n: int, ok: bool, retry: int, recovered: int) -> str:
        loaded = f"(SELECT count(*) FROM batch_customers_{n})" if ok else "CAST(0 AS BIGINT)"
        changed = "(SELECT count(*) FROM changed_customers) + (SELECT count(*) FROM new_customers)" if n == 2 else loaded
        return (
            f"SELECT '{run}' AS pipeline_run_id, '{'SUCCESS' if ok else 'FAILED'}' AS status, "
            f"{loaded} AS bronze_rows_processed, {changed if ok else loaded} AS silver_rows_processed, "
            f"(SELECT count(DISTINCT customer_id) FROM customer_errors_{n}) AS invalid_customers, "
            f"(SELECT count(*) FROM customer_errors_{n}) AS validation_errors, "
            f"CAST({retry} AS BIGINT) AS retry_count, CAST({recovered} AS BIGINT) AS recovery_count"
        )

    q["customer_run_health"] = " UNION ALL ".join(
        (health_row(RUN[1], 1, True, 0, 0), health_row(INTERRUPTED_RUN, 2, False, 0, 0), health_row(RUN[2], 2, True, 1, 1))
    )
    q["retry_events"] = """
    SELECT pipeline_run_id, batch_id, pipeline_name, stage_name,
        CASE state WHEN 'up_for_retry' THEN 'RETRY' ELSE 'RECOVERED' END AS event_type, ended_at AS event_time,
        dag_run_id, try_number,
        CASE state WHEN 'up_for_retry' THEN coalesce(error_type, 'UnknownError') END AS error_type,
        CASE state WHEN 'up_for_retry' THEN coalesce(error_message, 'Task retry requested without an exception.')
            ELSE 'Task succeeded after one or more retries.' END AS event_message
    FROM attempts WHERE state = 'up_for_retry' OR (state = 'success' AND try_number > 1)"""
    q["failure_summary"] = """
    SELECT pipeline_run_id, coalesce(f.stage_name, 'unknown') AS stage_name,
        coalesce(f.type, 'PipelineFailure') AS error_type,
        coalesce(f.message, 'Airflow customer pipeline failed. See task logs for details.') AS error_message,
        f.try_number
    FROM (SELECT pipeline_run_id FROM runs WHERE status = 'FAILED') LEFT JOIN (
        SELECT pipeline_run_id, stage_name, try_number, coalesce(error_type, 'UnknownError') AS type,
            coalesce(error_message, 'Task failed without an exception.') AS message
        FROM attempts WHERE state = 'failed'
        QUALIFY row_number() OVER (PARTITION BY pipeline_run_id ORDER BY
            CASE stage_name WHEN 'prepare_run' THEN 1 WHEN 'bronze' THEN 2 ELSE 3 END, ended_at DESC) = 1) f
        USING (pipeline_run_id)"""
    return q


def _first_load(entity: str, n: int, prefix: str) -> str:
    """Counts of a load into an empty Silver table whose parents come from the same batch alone."""
    if entity == "customers":
        return (
            f"SELECT {prefix}'customers_silver' AS stage_name, (SELECT count(*) FROM batch_customers_{n}) "
            "AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, CAST(0 AS BIGINT) AS rows_quarantined"
        )
    present = f"customer_id IN (SELECT customer_id FROM batch_customers_{n})"
    good = f"{VALID['orders']} AND {present}"
    return (
        f"SELECT {prefix}'orders_silver' AS stage_name, (SELECT count(*) FROM batch_orders_{n} WHERE {good}) "
        f"AS rows_inserted, CAST(0 AS BIGINT) AS rows_updated, (SELECT count(*) FROM batch_orders_{n} WHERE NOT ({good})) "
        "AS rows_quarantined"
    )


def _contract() -> str:
    required = {
        "customers": ["customer_id"],
        "products": ["product_id", "product_name", "unit_cost", "unit_price"],
        "orders": ["order_id", "customer_id", "order_date", "status", "total_amount"],
        "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
        "payments": ["payment_id", "order_id", "payment_date", "payment_method", "amount", "status"],
    }
    widths = {
        "customers": {"first_name": 100, "last_name": 100, "email": 255, "phone": 50},
        "products": {"product_name": 255, "category": 100},
        "orders": {"status": 50},
        "payments": {"payment_method": 50, "status": 50},
    }
    parts = [
        "SELECT 'batches' AS table_name, 'status is not allowed' AS check_name, "
        "count(*) FILTER (status NOT IN ('RUNNING', 'SUCCESS', 'FAILED')) AS violations FROM runs",
        "SELECT 'events', 'event_type is not allowed', 0",
    ]
    for entity, names in required.items():
        names = names + (["first_name", "last_name"] if entity == "customers" else [])
        parts += [
            f"SELECT '{entity}', '{c} must not be null', count(*) FILTER ({c} IS NULL) FROM {entity}_2" for c in names
        ]
        parts += [
            f"SELECT '{entity}', '{c} is longer than {w}', count(*) FILTER (length({c}) > {w}) FROM {entity}_2"
            for c, w in widths.get(entity, {}).items()
        ]
        parts.append(f"SELECT '{entity}', 'record_hash must not be null', 0")
    return " UNION ALL ".join(parts)


def _with_ctes(sql: str) -> str:
    """Prefix the CTEs that ``sql`` refers to, directly or through others, in definition order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            todo.append(CTES[name])
    if not needed:
        return sql.strip()
    ordered: list[str] = []

    def place(name: str) -> None:
        if name not in ordered:
            for other in set(re.findall(r"\w+", CTES[name])) & CTES.keys() - {name}:
                place(other)
            ordered.append(name)

    for name in CTES:
        if name in needed:
            place(name)
    ctes = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    return f"WITH {ctes}\nSELECT * FROM ({sql.strip()})"


def oracle() -> dict[str, str]:
    return {name: _line_keys_as_text(name, _with_ctes(sql)) for name, sql in _queries().items()}


def _line_keys_as_text(name: str, sql: str) -> str:
    """Line keys are beyond what a double holds, and shown as text."""
    if "order_items" not in name:
        return sql
    return f"SELECT * REPLACE (order_item_id::VARCHAR AS order_item_id) FROM ({sql})"
