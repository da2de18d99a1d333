import hashlib
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from oreflow.functions import columns as fc
from oreflow.functions.rules import failure_reason, field_messages, fields_valid
from oreflow.model import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS
from oreflow.sources.local import local_rows
from tests import rows


def digest(spark, spec, row) -> str:
    return rows.frame(spark, spec, row).selectExpr(f"{fc.hash_hex(fc.record_hash(spec))} AS h").first().h


def python_digest(spec, row) -> str:
    values = dict(zip(spec.columns, row, strict=True))

    def text(value):
        if value is None:
            return ""
        return value.isoformat() if isinstance(value, datetime) else str(value)

    return hashlib.sha256("|".join(text(values[c]) for c in spec.hash_columns).encode()).hexdigest()


CASES = [
    (CUSTOMERS, rows.customer()),
    (CUSTOMERS, rows.customer(first=None, email=None, phone="")),
    (CUSTOMERS, rows.customer(first="Žofie", last="O|Neil")),
    (PRODUCTS, rows.product()),
    (PRODUCTS, rows.product(category=None, cost="0.00")),
    (ORDERS, rows.order()),
    (ORDERS, rows.order(date=datetime(2026, 10, 1, 10, 30, 5, 120), total="-0.50")),
    (ORDERS, rows.order(date=datetime(2026, 3, 8, 2, 30, 0, 500000))),
    (ORDER_ITEMS, rows.item()),
    (PAYMENTS, rows.payment()),
    (PAYMENTS, rows.payment(date=datetime(1999, 12, 31, 23, 59, 59, 999999))),
]


@pytest.mark.parametrize(("spec", "row"), CASES)
def test_record_hash_equals_python(spark, spec, row):
    assert digest(spark, spec, row) == python_digest(spec, row)
    kind = rows.frame(spark, spec, row).selectExpr(f"{fc.record_hash(spec)} AS h").first().h
    assert len(kind) == 32


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    gap = datetime(2026, 3, 8, 2, 30, 0, 1500)
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        df = local_rows(spark, [(gap, datetime(2026, 3, 8, 3, 30))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
        row = df.selectExpr(
            f"{fc.iso_timestamp('a')} AS iso", f"{fc.duration_ms('a', 'b')} AS ms", f"{fc.round_to_millis('a')} AS r"
        ).first()
        assert (row.iso, row.ms) == (gap.isoformat(), 3_599_999)
        assert row.r == datetime(2026, 3, 8, 2, 30, 0, 2000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("column", ["unit_cost", "unit_price", "product_name", "category"])
def test_product_hash_changes_with_each_column(spark, column):
    changed = {"unit_cost": {"cost": "10.01"}, "unit_price": {"price": "15.01"}, "product_name": {"name": "x"}, "category": {"category": "x"}}
    assert digest(spark, PRODUCTS, rows.product()) != digest(spark, PRODUCTS, rows.product(**changed[column]))


@pytest.mark.parametrize("change", [{"customer_id": 2}, {"status": "Pending"}, {"total": "125.01"}, {"date": datetime(2027, 1, 1)}])
def test_order_hash_changes_with_each_column(spark, change):
    assert digest(spark, ORDERS, rows.order()) != digest(spark, ORDERS, rows.order(**change))


@pytest.mark.parametrize("change", [{"order_id": 2}, {"product_id": 2}, {"quantity": 3}, {"price": "25.01"}])
def test_item_hash_changes_with_each_column(spark, change):
    assert digest(spark, ORDER_ITEMS, rows.item()) != digest(spark, ORDER_ITEMS, rows.item(**change))


@pytest.mark.parametrize(
    "change", [{"order_id": 2}, {"date": datetime(2027, 1, 1)}, {"method": "PayPal"}, {"amount": "100.01"}, {"status": "Failed"}]
)
def test_payment_hash_changes_with_each_column(spark, change):
    assert digest(spark, PAYMENTS, rows.payment()) != digest(spark, PAYMENTS, rows.payment(**change))


def test_hash_leaves_out_key_and_created_at(spark):
    assert digest(spark, CUSTOMERS, rows.customer()) == digest(spark, CUSTOMERS, rows.customer(key=9, created=None))


@pytest.mark.parametrize(
    ("micros", "rounded"), [(123_499, 123_000), (123_500, 124_000), (0, 0), (999_500, 1_000_000), (7, 0)]
)
def test_round_to_millis(spark, micros, rounded):
    df = local_rows(spark, [(datetime(2024, 1, 1, 0, 0, 0, micros),)], "ts TIMESTAMP_NTZ")
    got = df.selectExpr(f"{fc.round_to_millis('ts')} AS ts").first().ts
    assert (got - datetime(2024, 1, 1)).total_seconds() * 1_000_000 == pytest.approx(rounded)


def test_duration_counts_boundaries(spark):
    start, end = datetime(2024, 1, 1, 0, 0, 0, 999), datetime(2024, 1, 1, 0, 0, 0, 1000)
    df = local_rows(spark, [(start, end), (start, None)], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    assert [r.ms for r in df.selectExpr(f"{fc.duration_ms('a', 'b')} AS ms").collect()] == [1, None]


def test_stable_id_equals_uuid5(spark):
    names = [f"scheduled__2026-01-{i}" for i in range(1, 60)] + ["", "žluť"]
    df = local_rows(spark, [(n,) for n in names], "name STRING")
    for row in df.selectExpr("name", f"{fc.stable_id('name')} AS id").collect():
        assert row.id == str(uuid.uuid5(uuid.NAMESPACE_URL, row.name))


def messages(spark, spec, row) -> list[str]:
    return rows.frame(spark, spec, row).select(F.expr(field_messages(spec)).alias("m")).first().m


def test_order_messages(spark):
    assert messages(spark, ORDERS, rows.order()) == []
    assert messages(spark, ORDERS, rows.order(total="0.00")) == []
    assert messages(spark, ORDERS, (-1, -2, None, "Banana", rows.money("-50.00"))) == [
        "OrderID must be greater than zero",
        "CustomerID must be greater than zero",
        "OrderDate is required",
        "Invalid order status: Banana",
        "TotalAmount must be greater than or equal to zero",
    ]
    assert messages(spark, ORDERS, rows.order(status=None)) == ["Invalid order status: None"]
    assert messages(spark, ORDERS, rows.order(status="completed")) == ["Invalid order status: completed"]


def test_item_messages(spark):
    assert messages(spark, ORDER_ITEMS, rows.item()) == []
    assert messages(spark, ORDER_ITEMS, (0, 0, 0, 0, rows.money("0"))) == [
        f"{n} must be greater than zero" for n in ("OrderItemID", "OrderID", "ProductID", "Quantity", "UnitPrice")
    ]


def test_payment_messages(spark):
    assert messages(spark, PAYMENTS, rows.payment()) == []
    assert messages(spark, PAYMENTS, (0, 0, None, "Cash", rows.money("-100"), "Unknown")) == [
        "PaymentID must be greater than zero",
        "OrderID must be greater than zero",
        "PaymentDate is required",
        "Invalid payment method",
        "Amount must be greater than zero",
        "Invalid payment status",
    ]


def test_valid_and_reason_are_complements_without_nulls(spark):
    cases = {
        "orders": [rows.order(), rows.order(key=0), rows.order(status="x"), rows.order(total="-1")],
        "order_items": [rows.item(), rows.item(key=-1), rows.item(quantity=0), rows.item(price="0")],
        "payments": [rows.payment(), rows.payment(method="Cash"), rows.payment(amount="0"), rows.payment(status="x")],
    }
    for entity, given in cases.items():
        spec = ENTITIES[entity]
        df = rows.frame(spark, spec, *given).selectExpr(f"{fields_valid(spec)} AS ok", f"{failure_reason(spec)} AS r")
        assert [(r.ok, r.r == "") for r in df.collect()] == [(True, True)] + [(False, False)] * 3


def test_a_null_field_neither_passes_nor_gives_a_reason(spark):
    df = rows.orders(spark, rows.order(status=None))
    assert df.filter(fields_valid(ORDERS)).count() == 0
    assert df.selectExpr(f"{failure_reason(ORDERS)} AS r").first().r == ""
