import time
from decimal import Decimal

import pytest

from oreflow.model import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PRODUCTS, RunContext
from oreflow.operators.bronze import DuplicateKeyError, count_unique
from oreflow.operators.quality import DataQualityError
from oreflow.plans.loads import load_bronze
from oreflow.sources import jdbc
from tests import rows

ONE_ROW = {
    "customers": rows.customer(),
    "products": rows.product(),
    "orders": rows.order(),
    "order_items": rows.item(),
    "payments": rows.payment(),
}


@pytest.mark.parametrize("entity", ENTITIES)
def test_a_batch_loads_once_and_another_batch_again(spark, warehouse, entity):
    spec, df = ENTITIES[entity], rows.frame(spark, ENTITIES[entity], ONE_ROW[entity])
    assert not warehouse.batch_exists(spec, "b1")
    assert load_bronze(warehouse, spec, df, rows.context("r1", "b1")) == 1
    assert load_bronze(warehouse, spec, df, rows.context("r2", "b1")) == 0
    assert not warehouse._exists(f"{warehouse.root}/bronze/{entity}/batch_id=b1/r2")
    assert load_bronze(warehouse, spec, df, rows.context("r3", "b2")) == 1
    assert warehouse.batch_exists(spec, "b1")
    kept = warehouse.bronze(spec).select("pipeline_run_id", "batch_id").collect()
    assert sorted(map(tuple, kept)) == [("r1", "b1"), ("r3", "b2")]


def test_a_partial_batch_resumes(spark, warehouse):
    one, two = rows.customer(key=1), rows.customer(key=2)
    assert load_bronze(warehouse, CUSTOMERS, rows.customers(spark, one), rows.context("r1")) == 1
    assert load_bronze(warehouse, CUSTOMERS, rows.customers(spark, one, two), rows.context("r2")) == 1
    assert warehouse.bronze(CUSTOMERS).count() == 2


def test_a_key_twice_in_a_batch_stops_the_load(spark, warehouse):
    df = rows.orders(spark, rows.order(key=1), rows.order(key=2), rows.order(key=2, status="Pending"))
    with pytest.raises(DuplicateKeyError, match="order_id=2"):
        load_bronze(warehouse, ORDERS, df, rows.context())
    assert warehouse.bronze(ORDERS).count() == 0


@pytest.mark.parametrize("entity", ["products", "customers"])
def test_an_attempt_repeated_under_the_same_ids_loses_nothing(spark, warehouse, entity):
    spec, ctx = ENTITIES[entity], rows.context()
    make = {"products": rows.product, "customers": rows.customer}[entity]
    two, three = [rows.frame(spark, spec, *[make(key=k) for k in range(n)]) for n in (2, 3)]
    assert load_bronze(warehouse, spec, two, ctx) == 2
    assert load_bronze(warehouse, spec, two, ctx) == 0
    assert warehouse.bronze(spec).count() == 2
    assert load_bronze(warehouse, spec, three, ctx) == 1
    assert load_bronze(warehouse, spec, two, ctx) == 0
    fresh = type(warehouse)(spark, warehouse.root)
    for held in (warehouse, fresh):
        assert sorted(r[0] for r in held.bronze_batch(spec, ctx.batch_id).select(spec.key).collect()) == [0, 1, 2]


def test_a_repeat_that_brings_a_key_twice_leaves_what_was_published(spark, warehouse):
    ctx = rows.context()
    assert load_bronze(warehouse, ORDERS, rows.orders(spark, rows.order(key=1)), ctx) == 1
    twice = rows.orders(spark, rows.order(key=1), rows.order(key=2), rows.order(key=2, status="Pending"))
    with pytest.raises(DuplicateKeyError, match="order_id=2"):
        load_bronze(warehouse, ORDERS, twice, ctx)
    assert [r.order_id for r in warehouse.bronze(ORDERS).collect()] == [1]


def test_line_keys_are_exact_for_large_parts(spark):
    from oreflow.sources.testdata import MAPPINGS

    row = "1000000000000L + {o} AS l_orderkey, 9000000000L AS l_partkey, {s}L AS l_suppkey, 7 AS l_linenumber, 50.0D AS l_quantity"
    table = spark.sql(" UNION ALL ".join(f"SELECT {row.format(o=o, s=s)}, 1.0D AS l_extendedprice" for o in (0, 1) for s in (10**8, 10**8 + 1)))
    found = table.selectExpr(*MAPPINGS["order_items"][1])
    assert dict(found.dtypes)["order_item_id"] == "decimal(38,0)"
    keys = sorted(int(r.order_item_id) for r in found.collect())
    assert keys[0] == 10**12 * 10**23 + 7 * 10**21 + 50 * 10**19 + 9 * 10**9 * 10**9 + 10**8 and len(set(keys)) == 4


def test_repeats_of_a_key_the_batch_already_holds_are_skipped(spark, warehouse):
    load_bronze(warehouse, ORDERS, rows.orders(spark, rows.order(key=1)), rows.context("r1"))
    df = rows.orders(spark, rows.order(key=1), rows.order(key=1, status="Pending"))
    assert load_bronze(warehouse, ORDERS, df, rows.context("r2")) == 0


@pytest.mark.parametrize("bad", [rows.order(status=None), rows.order(status="x" * 51)])
def test_contract_breaks_fail_the_load(spark, warehouse, bad):
    with pytest.raises(Exception, match="orders: status"):
        load_bronze(warehouse, ORDERS, rows.orders(spark, bad), rows.context())
    assert warehouse.bronze(ORDERS).count() == 0


def test_nullable_fields_are_accepted(spark, warehouse):
    df = rows.products(spark, rows.product(category=None))
    assert load_bronze(warehouse, PRODUCTS, df, rows.context()) == 1


def test_stage_replaces_only_its_own_run(spark, warehouse):
    first, second = rows.context("r1"), rows.context("r2")
    warehouse.stage("orders", first, rows.orders(spark, rows.order(key=1)))
    warehouse.stage("orders", second, rows.orders(spark, rows.order(key=2), rows.order(key=3)))
    again = warehouse.stage("orders", second, rows.orders(spark, rows.order(key=4)))
    assert [r.order_id for r in again.collect()] == [4]
    assert [r.order_id for r in spark.read.parquet(f"{warehouse.root}/stage/orders/r1").collect()] == [1]
    warehouse.clear_stage("orders", second)
    assert not warehouse._exists(f"{warehouse.root}/stage/orders/r2")


def test_an_attempt_that_was_not_published_is_not_read(spark, warehouse):
    """A folder left behind by a lost driver has no ledger row."""
    load_bronze(warehouse, ORDERS, rows.orders(spark, rows.order(1)), rows.context("r1"))
    lost = rows.bronze(rows.orders(spark, rows.order(2)), "orders", rows.context("r2"))
    lost.drop("batch_id").write.parquet(f"{warehouse.root}/bronze/orders/batch_id=batch-1/r2")
    fresh = type(warehouse)(spark, warehouse.root)
    assert [r.order_id for r in fresh.bronze(ORDERS).collect()] == [1]
    both = rows.orders(spark, rows.order(1), rows.order(2))
    assert load_bronze(fresh, ORDERS, both, rows.context("r3")) == 1
    assert sorted(r.order_id for r in fresh.bronze_batch(ORDERS, "batch-1").collect()) == [1, 2]


def test_a_finished_load_leaves_no_stage_rows(spark, warehouse):
    load_bronze(warehouse, CUSTOMERS, rows.customers(spark, rows.customer()), rows.context())
    for name in ("customers", "customers_invalid"):
        assert not warehouse._exists(f"{warehouse.root}/stage/{name}/run-1")


def test_a_failed_load_leaves_no_stage_rows(spark, warehouse):
    with pytest.raises(DataQualityError):
        load_bronze(warehouse, CUSTOMERS, rows.customers(spark, rows.customer(first="")), rows.context())
    assert not warehouse._exists(f"{warehouse.root}/stage/customers/run-1")


def test_ids_that_cannot_name_a_folder_are_refused():
    for bad in ("", "a/b", "../x", "a=b"):
        with pytest.raises(ValueError, match="not usable as an id"):
            RunContext(bad, "b", rows.DAY)


class Reader:
    """Records what would be asked of the JDBC source."""

    def __init__(self):
        self.settings = {}

    def format(self, name):
        self.settings["format"] = name
        return self

    def options(self, **options):
        self.settings |= options
        return self

    def option(self, name, value):
        self.settings[name] = value
        return self

    def load(self):
        return self.settings


def test_jdbc_partitions_follow_the_rows_or_are_given():
    class Counted(Reader):
        def load(self):
            return self if "query" in self.settings and "dbtable" not in self.settings else self.settings

        def first(self):
            self.asked = self.settings.pop("query")
            return 5, 4_000_000, 3_500_001

        def jdbc(self, url, table, predicates, properties):
            return url, predicates, properties

    class Session:
        read = Counted()

    settings = jdbc.read_snapshot(Session, ORDERS, "dbo.Orders", {"url": "jdbc:x"})
    assert "count(*)" in Session.read.asked and settings["numPartitions"] == 4
    assert (settings["lowerBound"], settings["upperBound"]) == (5, 4_000_001)
    given = jdbc.read_snapshot(Session, ORDERS, "dbo.Orders", {"url": "jdbc:x", "user": "u"}, predicates=["OrderID < 5", "OrderID >= 5"])
    assert given == ("jdbc:x", ["OrderID < 5", "OrderID >= 5"], {"user": "u"})


def test_jdbc_extraction_is_partitioned_on_the_key():
    class Session:
        read = Reader()

    settings = jdbc.read_snapshot(Session, ORDERS, "dbo.Orders", {"url": "jdbc:x"}, key_range=(1, 999), partitions=16)
    assert settings["dbtable"] == (
        "(SELECT OrderID AS order_id, CustomerID AS customer_id, OrderDate AS order_date, Status AS status, "
        "TotalAmount AS total_amount FROM dbo.Orders) snapshot"
    )
    assert (settings["partitionColumn"], settings["lowerBound"], settings["upperBound"]) == ("order_id", 1, 1000)
    assert settings["numPartitions"] == 16


@pytest.mark.parametrize("bits", [64, 2])
def test_wide_keys_are_counted_by_hash_and_told_apart_exactly(spark, bits):
    """With two bits many different keys share a hash; only a key that is there twice stops the load."""
    ctx, some = rows.context(), [rows.item(key=Decimal(10**30 + n)) for n in range(20)]
    assert count_unique(rows.items(spark, *some), ORDER_ITEMS, ctx, bits) == 20
    assert count_unique(rows.items(spark), ORDER_ITEMS, ctx, bits) == 0
    with pytest.raises(DuplicateKeyError, match=f"order_item_id={10**30 + 7} "):
        count_unique(rows.items(spark, *some, some[7], some[9]), ORDER_ITEMS, ctx, bits)


def test_a_resumed_load_leaves_no_shuffle_on_disk_and_packs_its_files(spark, warehouse):
    """What the join with the keys held and the counts shuffled is gone when the load ends."""
    threshold, cleanup = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held, some = spark.conf.get(threshold), [rows.item(key=n) for n in range(1, 50)]
    spark.conf.set(threshold, "-1")
    try:
        before = rows.shuffle_files(spark)
        assert load_bronze(warehouse, ORDER_ITEMS, rows.items(spark, *some[:20]), rows.context("r1")) == 20
        assert load_bronze(warehouse, ORDER_ITEMS, rows.items(spark, *some), rows.context("r2")) == 29
        until = time.time() + 10
        while rows.shuffle_files(spark) - before and time.time() < until:
            time.sleep(0.2)
        assert not rows.shuffle_files(spark) - before
    finally:
        spark.conf.set(threshold, held)
    assert spark.conf.get(cleanup) == "false"
    files = warehouse.bronze(ORDER_ITEMS).inputFiles()
    assert files and all(x.endswith(".zstd.parquet") for x in files)
