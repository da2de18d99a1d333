"""The five entities: columns, fingerprint inputs, rules and parents.

Everything here is plain data.  Predicates are Spark SQL text so that a spec can be declared without
a running session; they are turned into Columns where a plan is built.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

# Names and texts that results must carry exactly as written.
ORDER_STATUSES = ("Pending", "Processing", "Completed", "Cancelled")
PAYMENT_METHODS = ("CreditCard", "DebitCard", "PayPal", "BankTransfer")
PAYMENT_STATUSES = ("Pending", "Completed", "Failed", "Refunded")
RUN_STATUSES = ("RUNNING", "SUCCESS", "FAILED")
EVENT_TYPES = ("RETRY", "RECOVERED")
DUPLICATE_RULE = "DUPLICATE_CUSTOMER_ID"
COMMERCE_PIPELINE = "commerce"
CUSTOMER_PIPELINE = "customer_pipeline"
DEFAULT_INVALID_RATE_THRESHOLD = 0.05


def _in(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


@dataclass(frozen=True)
class Rule:
    """A field check: ``fails`` is a SQL predicate, ``message`` the text recorded when it holds."""

    message: str
    fails: str


@dataclass(frozen=True)
class ListRule:
    """A field check of the list-form validators; ``message`` is a SQL expression."""

    fails: str
    message: str
    name: str | None = None


@dataclass(frozen=True)
class Parent:
    """A reference that must resolve in another entity's Silver table.

    ``after_fields`` tells when a missing parent is reported: only for rows whose own fields all pass,
    or (False) whenever the referencing key is positive.
    """

    entity: str
    column: str
    message: str
    after_fields: bool


@dataclass(frozen=True)
class EntitySpec:
    name: str
    key: str
    columns: dict[str, str]
    hash_columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    widths: dict[str, int] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    list_rules: tuple[ListRule, ...] = ()
    parents: tuple[Parent, ...] = ()
    # Not null in Silver only; Bronze accepts what the source has.
    required_in_silver: tuple[str, ...] = ()
    # Columns a Silver load never fills: NULL on insert and untouched on update.
    unset_in_silver: tuple[str, ...] = ()
    # Columns whose time part is rounded to milliseconds on the way into Bronze.
    millis_columns: tuple[str, ...] = ()
    # Checked by its list rules before it lands: repeated ids and broken rows stay out, a gate may stop the load, and
    # quarantine holds a row for each failed rule and attempt.
    checked_before_bronze: bool = False
    # What takes an extract apart before it lands, instead of the list rules; see quality.Processor.
    processor: Callable | None = None
    # What ends the reason that tells of a missing parent.
    parent_suffix: str = "; "
    # Quarantine of a missing parent is held back only by an entry with that very reason, not by any entry.
    parent_reason_apart: bool = False

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.columns if c != self.key]

    @property
    def has_quarantine(self) -> bool:
        return bool(self.rules or self.parents)

    @property
    def processed(self) -> bool:
        """Whether rows are taken apart before they land."""
        return self.checked_before_bronze or self.processor is not None

    @property
    def quarantine_partition(self) -> str:
        return "pipeline_run_id" if self.processed else "batch_id"

    def ddl(self, extra: str = "") -> str:
        return ", ".join(f"{c} {t}" for c, t in self.columns.items()) + extra

    @property
    def stage_ddl(self) -> str:
        return self.ddl(", record_hash BINARY")

    @property
    def bronze_ddl(self) -> str:
        return self.ddl(
            ", ingested_at TIMESTAMP_NTZ, pipeline_run_id STRING, record_hash BINARY, batch_id STRING"
        )

    @property
    def silver_ddl(self) -> str:
        return self.ddl(
            ", record_hash BINARY, source_ingested_at TIMESTAMP_NTZ, processed_at TIMESTAMP_NTZ"
        )

    @property
    def quarantine_ddl(self) -> str:
        if self.processed:
            return (
                self.ddl(", validation_rule STRING, validation_message STRING")
                + ", quarantined_at TIMESTAMP_NTZ, resolved_at TIMESTAMP_NTZ, pipeline_run_id STRING"
            )
        return self.ddl(
            ", pipeline_run_id STRING, failure_reason STRING, quarantined_at TIMESTAMP_NTZ, batch_id STRING"
        )


@dataclass(frozen=True)
class RunContext:
    """``batch_id`` names the logical snapshot, ``pipeline_run_id`` one attempt at loading it.

    ``at`` is the attempt's single load time: a literal in every plan, so that a recomputed partition
    carries the same stamp as the original.
    """

    pipeline_run_id: str
    batch_id: str
    at: datetime

    def __post_init__(self) -> None:
        # Both ids name folders.
        for value in (self.pipeline_run_id, self.batch_id):
            if not re.fullmatch(r"[0-9A-Za-z][0-9A-Za-z._-]*", value):
                raise ValueError(f"not usable as an id: {value!r}")


CUSTOMERS = EntitySpec(
    name="customers",
    key="customer_id",
    columns={
        "customer_id": "BIGINT",
        "first_name": "STRING",
        "last_name": "STRING",
        "email": "STRING",
        "phone": "STRING",
        "created_at": "TIMESTAMP_NTZ",
    },
    hash_columns=("first_name", "last_name", "email", "phone"),
    required=("customer_id",),
    widths={"first_name": 100, "last_name": 100, "email": 255, "phone": 50},
    list_rules=(
        ListRule("first_name IS NULL OR first_name = ''", "'FirstName is required'", "FIRST_NAME_REQUIRED"),
        ListRule("last_name IS NULL OR last_name = ''", "'LastName is required'", "LAST_NAME_REQUIRED"),
        ListRule("email <> '' AND NOT contains(email, '@')", "concat('Invalid email \\'', email, '\\'')", "EMAIL_FORMAT"),
    ),
    required_in_silver=("first_name", "last_name"),
    unset_in_silver=("created_at",),
    millis_columns=("created_at",),
    checked_before_bronze=True,
)

PRODUCTS = EntitySpec(
    name="products",
    key="product_id",
    columns={
        "product_id": "BIGINT",
        "product_name": "STRING",
        "category": "STRING",
        "unit_cost": "DECIMAL(18,2)",
        "unit_price": "DECIMAL(18,2)",
    },
    hash_columns=("product_name", "category", "unit_cost", "unit_price"),
    required=("product_id", "product_name", "unit_cost", "unit_price"),
    widths={"product_name": 255, "category": 100},
)

ORDERS = EntitySpec(
    name="orders",
    key="order_id",
    columns={
        "order_id": "BIGINT",
        "customer_id": "BIGINT",
        "order_date": "TIMESTAMP_NTZ",
        "status": "STRING",
        "total_amount": "DECIMAL(18,2)",
    },
    hash_columns=("customer_id", "order_date", "status", "total_amount"),
    required=("order_id", "customer_id", "order_date", "status", "total_amount"),
    widths={"status": 50},
    rules=(
        Rule("OrderID must be greater than zero", "order_id <= 0"),
        Rule("CustomerID must be greater than zero", "customer_id <= 0"),
        Rule("Invalid order status", f"NOT {_in('status', ORDER_STATUSES)}"),
        Rule("TotalAmount must be greater than or equal to zero", "total_amount < 0"),
    ),
    list_rules=(
        ListRule("order_id <= 0", "'OrderID must be greater than zero'"),
        ListRule("customer_id <= 0", "'CustomerID must be greater than zero'"),
        ListRule("order_date IS NULL", "'OrderDate is required'"),
        ListRule(
            f"NOT coalesce({_in('status', ORDER_STATUSES)}, false)",
            "concat('Invalid order status: ', coalesce(status, 'None'))",
        ),
        ListRule("total_amount < 0", "'TotalAmount must be greater than or equal to zero'"),
    ),
    parents=(
        Parent("customers", "customer_id", "CustomerID does not exist in silver.Customers", after_fields=True),
    ),
    parent_suffix="",
    parent_reason_apart=True,
)

ORDER_ITEMS = EntitySpec(
    name="order_items",
    key="order_item_id",
    columns={
        "order_item_id": "DECIMAL(38,0)",
        "order_id": "BIGINT",
        "product_id": "BIGINT",
        "quantity": "INT",
        "unit_price": "DECIMAL(18,2)",
    },
    hash_columns=("order_id", "product_id", "quantity", "unit_price"),
    required=("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
    rules=(
        Rule("OrderItemID must be greater than zero", "order_item_id <= 0"),
        Rule("OrderID must be greater than zero", "order_id <= 0"),
        Rule("ProductID must be greater than zero", "product_id <= 0"),
        Rule("Quantity must be greater than zero", "quantity <= 0"),
        Rule("UnitPrice must be greater than zero", "unit_price <= 0"),
    ),
    list_rules=(
        ListRule("order_item_id <= 0", "'OrderItemID must be greater than zero'"),
        ListRule("order_id <= 0", "'OrderID must be greater than zero'"),
        ListRule("product_id <= 0", "'ProductID must be greater than zero'"),
        ListRule("quantity <= 0", "'Quantity must be greater than zero'"),
        ListRule("unit_price <= 0", "'UnitPrice must be greater than zero'"),
    ),
    parents=(
        Parent("orders", "order_id", "OrderID does not exist in silver.Orders", after_fields=False),
        Parent("products", "product_id", "ProductID does not exist in silver.Products", after_fields=False),
    ),
)

PAYMENTS = EntitySpec(
    name="payments",
    key="payment_id",
    columns={
        "payment_id": "BIGINT",
        "order_id": "BIGINT",
        "payment_date": "TIMESTAMP_NTZ",
        "payment_method": "STRING",
        "amount": "DECIMAL(18,2)",
        "status": "STRING",
    },
    hash_columns=("order_id", "payment_date", "payment_method", "amount", "status"),
    required=("payment_id", "order_id", "payment_date", "payment_method", "amount", "status"),
    widths={"payment_method": 50, "status": 50},
    rules=(
        Rule("PaymentID must be greater than zero", "payment_id <= 0"),
        Rule("OrderID must be greater than zero", "order_id <= 0"),
        Rule("Invalid payment method", f"NOT {_in('payment_method', PAYMENT_METHODS)}"),
        Rule("Amount must be greater than zero", "amount <= 0"),
        Rule("Invalid payment status", f"NOT {_in('status', PAYMENT_STATUSES)}"),
    ),
    list_rules=(
        ListRule("payment_id <= 0", "'PaymentID must be greater than zero'"),
        ListRule("order_id <= 0", "'OrderID must be greater than zero'"),
        ListRule("payment_date IS NULL", "'PaymentDate is required'"),
        ListRule(f"NOT coalesce({_in('payment_method', PAYMENT_METHODS)}, false)", "'Invalid payment method'"),
        ListRule("amount <= 0", "'Amount must be greater than zero'"),
        ListRule(f"NOT coalesce({_in('status', PAYMENT_STATUSES)}, false)", "'Invalid payment status'"),
    ),
    parents=(Parent("orders", "order_id", "OrderID does not exist in silver.Orders", after_fields=True),),
)

# Load order: a parent always comes before the entities that refer to it.
ENTITIES: dict[str, EntitySpec] = {
    spec.name: spec for spec in (CUSTOMERS, PRODUCTS, ORDERS, ORDER_ITEMS, PAYMENTS)
}

# Operational logs.  Each is append-only; the current row of an id is the one with the highest seq.
RUN_LOG_DDL = (
    "pipeline_run_id STRING, pipeline_name STRING, batch_id STRING, started_at TIMESTAMP_NTZ, "
    "completed_at TIMESTAMP_NTZ, status STRING, error_message STRING, seq BIGINT"
)
STAGE_LOG_DDL = (
    "stage_run_id STRING, pipeline_run_id STRING, stage_name STRING, started_at TIMESTAMP_NTZ, "
    "completed_at TIMESTAMP_NTZ, status STRING, rows_processed BIGINT, error_message STRING, seq BIGINT"
)
BATCH_LOG_DDL = (
    "batch_id STRING, pipeline_name STRING, started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, "
    "status STRING, rows_processed BIGINT, error_message STRING, seq BIGINT"
)
# As a warehouse keeps them: the stage with its error's type, the batch with the run that holds it.
STAGE_RECORD_DDL = STAGE_LOG_DDL + ", error_type STRING"
BATCH_RECORD_DDL = BATCH_LOG_DDL + ", pipeline_run_id STRING"
EVENT_LOG_DDL = (
    "pipeline_run_id STRING, batch_id STRING, pipeline_name STRING, stage_name STRING, event_type STRING, "
    "event_time TIMESTAMP_NTZ, dag_run_id STRING, try_number INT, error_type STRING, event_message STRING"
)
# Ledgers: what has been published.  A folder that no ledger row names does not count.
BRONZE_LEDGER_DDL = (
    "entity STRING, batch_id STRING, path STRING, pipeline_run_id STRING, rows_inserted BIGINT, "
    "published_at TIMESTAMP_NTZ"
)
SILVER_LEDGER_DDL = (
    "entity STRING, version BIGINT, path STRING, paths ARRAY<STRING>, pipeline_run_id STRING, batch_id STRING, "
    "rows_inserted BIGINT, rows_updated BIGINT, published_at TIMESTAMP_NTZ"
)
KEPT_LEDGER_DDL = "name STRING, path STRING"
# What runs that were completed on a day add up to, and the folder of their rows; the highest seq of a day is current.
DAILY_PARTS_DDL = (
    "pipeline_name STRING, metric_date DATE, path STRING, total_runs BIGINT, successful_runs BIGINT, failed_runs BIGINT, "
    "retry_count BIGINT, recovery_count BIGINT, invalid_customers BIGINT, validation_errors BIGINT, duration_sum BIGINT, "
    "duration_n BIGINT, max_duration_ms BIGINT, bronze_sum BIGINT, bronze_n BIGINT, silver_sum BIGINT, silver_n BIGINT, "
    "refreshed_on DATE, seq BIGINT"
)
