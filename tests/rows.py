"""Tiny inputs shared by the tests."""

from datetime import datetime
from decimal import Decimal

from oreflow.model import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS, RunContext
from oreflow.operators.bronze import bronze_new_rows, fingerprint
from oreflow.sources.local import local_rows

DAY = datetime(2026, 10, 1, 10, 30)


def context(run: str = "run-1", batch: str = "batch-1", day: int = 1) -> RunContext:
    return RunContext(run, batch, datetime(2026, 11, day))


def money(text) -> Decimal:
    return Decimal(text).quantize(Decimal("0.01"))


def customer(key=1, first="Alice", last="Johnson", email="alice@example.com", phone="555-0100", created=DAY):
    return (key, first, last, email, phone, created)


def product(key=1, name="Widget", category="Widgets", cost="10.00", price="15.00"):
    return (key, name, category, money(cost), money(price))


def order(key=1001, customer_id=1, date=DAY, status="Completed", total="125.00"):
    return (key, customer_id, date, status, money(total))


def item(key=2001, order_id=1001, product_id=1, quantity=2, price="25.00"):
    return (key, order_id, product_id, quantity, money(price))


def payment(key=5001, order_id=1001, date=DAY, method="CreditCard", amount="100.00", status="Completed"):
    return (key, order_id, date, method, money(amount), status)


def frame(spark, spec, *rows):
    return local_rows(spark, list(rows), spec.ddl())


def customers(spark, *rows):
    return frame(spark, CUSTOMERS, *rows)


def products(spark, *rows):
    return frame(spark, PRODUCTS, *rows)


def orders(spark, *rows):
    return frame(spark, ORDERS, *rows)


def items(spark, *rows):
    return frame(spark, ORDER_ITEMS, *rows)


def payments(spark, *rows):
    return frame(spark, PAYMENTS, *rows)


def bronze(df, entity, ctx):
    spec = ENTITIES[entity]
    return bronze_new_rows(fingerprint(df, spec), None, spec, ctx)


def land(warehouse, entity, df, ctx):
    """Put rows straight into a batch, as the loads do after their checks."""
    spec = ENTITIES[entity]
    held = warehouse.bronze_batch(spec, ctx.batch_id)
    return warehouse.append_bronze(spec, ctx, bronze_new_rows(fingerprint(df, spec), held, spec, ctx))


def shuffle_files(spark) -> set[str]:
    """What shuffles have left on this machine's disk."""
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}
