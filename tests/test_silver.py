from datetime import datetime

import pytest

from oreflow.model import CUSTOMERS, ENTITIES, ORDER_ITEMS, ORDERS, PAYMENTS, PRODUCTS
from oreflow.operators import silver
from oreflow.plans.loads import load_silver
from oreflow.sources.warehouse import Warehouse
from tests import rows


def counts(result) -> tuple[int, int, int]:
    return result["rows_inserted"], result["rows_updated"], result["rows_quarantined"]


def load(warehouse, entity, df, ctx) -> tuple[int, int, int]:
    rows.land(warehouse, entity, df, ctx)
    return counts(load_silver(warehouse, ENTITIES[entity], ctx))


def reasons(warehouse, spec) -> list[str]:
    return sorted(r.failure_reason for r in warehouse.quarantine(spec).collect())


def test_insert_then_nothing_then_update(spark, warehouse):
    first = rows.context("r1", "b1", 1)
    assert load(warehouse, "products", rows.products(spark, rows.product(price="15.00")), first) == (1, 0, 0)
    assert counts(load_silver(warehouse, PRODUCTS, first)) == (0, 0, 0)
    second = rows.context("r2", "b2", 2)
    assert load(warehouse, "products", rows.products(spark, rows.product(price="17.50")), second) == (0, 1, 0)
    row = warehouse.silver(PRODUCTS).first()
    assert str(row.unit_price) == "17.50"
    assert (row.source_ingested_at, row.processed_at) == (second.at, second.at)


def test_an_unchanged_row_keeps_its_stamps(spark, warehouse):
    load(warehouse, "products", rows.products(spark, rows.product()), rows.context("r1", "b1", 1))
    load(warehouse, "products", rows.products(spark, rows.product()), rows.context("r2", "b2", 2))
    assert warehouse.silver(PRODUCTS).first().processed_at == datetime(2026, 11, 1)


def test_keys_missing_from_a_later_batch_stay(spark, warehouse):
    load(warehouse, "products", rows.products(spark, rows.product(1), rows.product(2)), rows.context("r1", "b1"))
    load(warehouse, "products", rows.products(spark, rows.product(2), rows.product(3)), rows.context("r2", "b2"))
    assert sorted(r.product_id for r in warehouse.silver(PRODUCTS).collect()) == [1, 2, 3]


def test_customers_never_receive_created_at(spark, warehouse):
    load(warehouse, "customers", rows.customers(spark, rows.customer(phone="1")), rows.context("r1", "b1"))
    load(warehouse, "customers", rows.customers(spark, rows.customer(phone="2")), rows.context("r2", "b2"))
    row = warehouse.silver(CUSTOMERS).first()
    assert (row.phone, row.created_at) == ("2", None)


def test_a_null_fingerprint_means_no_update(spark):
    ctx = rows.context()
    batch = rows.bronze(rows.products(spark, rows.product(name="new")), "products", ctx).selectExpr(
        "* EXCEPT (record_hash)", "CAST(NULL AS BINARY) AS record_hash"
    )
    held = silver.silver_merge(rows.bronze(rows.products(spark, rows.product(name="old")), "products", ctx), None, PRODUCTS, ctx)
    merged = silver.silver_merge(batch, held.drop("merge_action"), PRODUCTS, ctx).first()
    assert (merged.product_name, merged.merge_action) == ("old", "keep")


def test_an_orphan_order_is_promoted_once_its_customer_arrives(spark, warehouse):
    order, late = rows.orders(spark, rows.order(950001, customer_id=77)), rows.context("r1", "b1")
    assert load(warehouse, "orders", order, late) == (0, 0, 1)
    assert counts(load_silver(warehouse, ORDERS, rows.context("r2", "b1"))) == (0, 0, 0)
    load(warehouse, "customers", rows.customers(spark, rows.customer(77)), rows.context("r3", "b1"))
    assert counts(load_silver(warehouse, ORDERS, rows.context("r4", "b1"))) == (1, 0, 0)
    assert reasons(warehouse, ORDERS) == ["CustomerID does not exist in silver.Customers"]


def test_a_bad_order_has_one_row_with_all_its_reasons(spark, warehouse):
    load(warehouse, "customers", rows.customers(spark, rows.customer()), rows.context())
    bad = rows.orders(spark, rows.order(950002, status="InvalidStatus", total="-25.00"))
    assert load(warehouse, "orders", bad, rows.context()) == (0, 0, 1)
    assert reasons(warehouse, ORDERS) == [
        "Invalid order status; TotalAmount must be greater than or equal to zero; "
    ]
    assert warehouse.silver(ORDERS).count() == 0


def test_orphan_evidence_is_only_held_back_by_the_same_reason(spark):
    ctx = rows.context()
    rejected = rows.orders(spark, rows.order(1), rows.order(2), rows.order(3, status="x")).selectExpr(
        "*",
        "CASE WHEN order_id < 3 THEN 'CustomerID does not exist in silver.Customers' ELSE 'Invalid order status; ' END "
        "AS failure_reason",
    )
    held = rejected.selectExpr(
        "order_id", f"'{ctx.batch_id}' AS batch_id",
        "CASE WHEN order_id = 1 THEN failure_reason ELSE 'something else; ' END AS failure_reason",
    )
    new = silver.quarantine_new(rejected, held, ORDERS, ctx)
    assert [r.order_id for r in new.collect()] == [2]
    other = held.withColumn("batch_id", silver.F.lit("another"))
    assert silver.quarantine_new(rejected, other, ORDERS, ctx).count() == 3


def test_an_item_with_two_missing_parents(spark, warehouse):
    item = rows.items(spark, rows.item(970001, order_id=50, product_id=60))
    assert load(warehouse, "order_items", item, rows.context("r1")) == (0, 0, 1)
    assert reasons(warehouse, ORDER_ITEMS) == [
        "OrderID does not exist in silver.Orders; ProductID does not exist in silver.Products; "
    ]
    load(warehouse, "products", rows.products(spark, rows.product(60)), rows.context("r2"))
    assert counts(load_silver(warehouse, ORDER_ITEMS, rows.context("r3"))) == (0, 0, 0)
    load(warehouse, "customers", rows.customers(spark, rows.customer()), rows.context("r4"))
    load(warehouse, "orders", rows.orders(spark, rows.order(50)), rows.context("r4"))
    assert counts(load_silver(warehouse, ORDER_ITEMS, rows.context("r5"))) == (1, 0, 0)
    assert len(reasons(warehouse, ORDER_ITEMS)) == 1


def test_item_parents_are_reported_beside_field_failures(spark, warehouse):
    item = rows.items(spark, rows.item(-5, order_id=50, product_id=-1, quantity=0))
    assert load(warehouse, "order_items", item, rows.context()) == (0, 0, 1)
    assert reasons(warehouse, ORDER_ITEMS) == [
        "OrderItemID must be greater than zero; ProductID must be greater than zero; "
        "Quantity must be greater than zero; OrderID does not exist in silver.Orders; "
    ]


def test_payment_parents_are_reported_only_for_valid_fields(spark, warehouse):
    bad = rows.payment(980102, method="GoldBars", amount="-50.00", status="Exploded")
    orphan = rows.payment(980101, order_id=31)
    assert load(warehouse, "payments", rows.payments(spark, bad, orphan), rows.context()) == (0, 0, 2)
    assert reasons(warehouse, PAYMENTS) == [
        "Invalid payment method; Amount must be greater than zero; Invalid payment status; ",
        "OrderID does not exist in silver.Orders; ",
    ]


def test_a_key_that_turns_invalid_keeps_its_last_good_version(spark, warehouse):
    load(warehouse, "customers", rows.customers(spark, rows.customer()), rows.context())
    assert load(warehouse, "orders", rows.orders(spark, rows.order(status="Pending")), rows.context("r1", "b1")) == (1, 0, 0)
    assert load(warehouse, "orders", rows.orders(spark, rows.order(status="Gone")), rows.context("r2", "b2")) == (0, 0, 1)
    assert warehouse.silver(ORDERS).first().status == "Pending"


def test_an_attempt_that_dies_while_writing_changes_nothing(spark, warehouse):
    load(warehouse, "products", rows.products(spark, rows.product(1)), rows.context("r1", "b1"))
    broken = silver.as_inserted(
        rows.bronze(rows.products(spark, rows.product(2)), "products", rows.context("r2", "b2")),
        PRODUCTS, rows.context("r2", "b2"),
    ).selectExpr("* EXCEPT (category)", "raise_error('lost') AS category")
    with pytest.raises(Exception, match="lost"):
        warehouse.publish_silver(PRODUCTS, rows.context("r2", "b2"), broken)
    fresh = type(warehouse)(spark, warehouse.root)
    assert [r.product_id for r in fresh.silver(PRODUCTS).collect()] == [1]


def test_a_batch_without_changes_publishes_nothing(spark, warehouse):
    first = rows.context("r1", "b1")
    load(warehouse, "products", rows.products(spark, rows.product(1)), first)
    load_silver(warehouse, PRODUCTS, rows.context("r2", "b1"))
    assert [r.version for r in warehouse.log("silver_ledger").collect()] == [1]


def test_stepwise_changes_equal_the_one_pass_merge(spark):
    first, second = rows.context("r1", "b1", 1), rows.context("r2", "b2", 2)
    old = rows.bronze(rows.customers(spark, *[rows.customer(k, phone="1") for k in (1, 2, 3)]), "customers", first)
    new = rows.bronze(rows.customers(spark, rows.customer(2, phone="1"), rows.customer(3, phone="2"), rows.customer(4)), "customers", second)
    held = silver.as_inserted(old, CUSTOMERS, first).selectExpr(
        "* EXCEPT (created_at)", "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS created_at"
    )
    changes = silver.silver_changes(new, held, CUSTOMERS)
    assert sorted(map(tuple, changes.collect())) == [(3, "update"), (4, "insert")]
    stepwise = silver.apply_changes(new, held, changes, CUSTOMERS, second)
    merged = silver.silver_merge(new, held, CUSTOMERS, second).select(*stepwise.columns)
    assert sorted(map(tuple, stepwise.collect())) == sorted(map(tuple, merged.collect()))


def test_silver_customers_need_names(spark, warehouse):
    rows.land(warehouse, "customers", rows.customers(spark, rows.customer(first=None)), rows.context())
    with pytest.raises(Exception, match="customers: first_name must not be null"):
        load_silver(warehouse, CUSTOMERS, rows.context())
    assert warehouse.silver(CUSTOMERS) is None


def test_a_one_key_change_writes_one_bucket(spark, warehouse):
    first, second = rows.context("r1", "b1", 1), rows.context("r2", "b2", 2)
    many = [rows.product(k) for k in range(1, 200)]
    load(warehouse, "products", rows.products(spark, *many), first)
    before = set(warehouse.silver(PRODUCTS).inputFiles())
    assert load(warehouse, "products", rows.products(spark, rows.product(7, name="new")), second) == (0, 1, 0)
    for held in (warehouse, type(warehouse)(spark, warehouse.root)):
        assert held.silver(PRODUCTS).count() == 199
        assert held.silver(PRODUCTS).filter("product_id = 7").first().product_name == "new"
    paths = warehouse._versions(PRODUCTS)
    changed = [i for i, (a, b) in enumerate(zip(paths[0][2], paths[1][2], strict=True)) if a != b]
    assert len(changed) == 1 and len(paths[0][2]) == 32
    after = set(warehouse.silver(PRODUCTS).inputFiles())
    assert len(before - after) == 1


def test_evidence_is_counted_once_when_a_load_is_repeated(spark, warehouse):
    ctx = rows.context()
    assert load(warehouse, "orders", rows.orders(spark, rows.order(1, customer_id=77)), ctx) == (0, 0, 1)
    assert counts(load_silver(warehouse, ORDERS, ctx)) == (0, 0, 0)
    assert warehouse.quarantine(ORDERS).count() == 1


def test_superseded_versions_are_removed(spark, warehouse):
    warehouse.silver_buckets = 1
    for day in (1, 2, 3, 4):
        load(warehouse, "products", rows.products(spark, rows.product(day)), rows.context(f"r{day}", f"b{day}", day))
    ledger = sorted(warehouse.log("silver_ledger").collect(), key=lambda r: r.version)
    assert [r.version for r in ledger] == [1, 2, 3, 4]
    assert [warehouse._exists(f"{warehouse.root}/{r.path}") for r in ledger] == [False, False, True, True]
    assert warehouse.silver(PRODUCTS).count() == 4


def test_buckets_and_files_follow_the_rows(spark, tmp_path):
    sizes = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    held = {k: spark.conf.get(k, None) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        wide = spark.range(60_000).selectExpr(
            "id AS product_id", "concat(uuid(), uuid()) AS product_name", "uuid() AS category", "CAST(1 AS DECIMAL(18,2)) AS unit_cost",
            "CAST(2 AS DECIMAL(18,2)) AS unit_price")
        many = Warehouse(spark, str(tmp_path / "many"), bucket_rows=1_000)
        load(many, "products", wide, rows.context("r1", "b1", 1))
        assert len(many._versions(PRODUCTS)[0][2]) == 60 and many.silver(PRODUCTS).count() == 60_000

        warehouse = Warehouse(spark, str(tmp_path / "few"), silver_buckets=4)
        paths = lambda: warehouse._versions(PRODUCTS)[0][2]
        files = lambda: [len(spark.read.parquet(f"{warehouse.root}/{x}").inputFiles()) for x in paths()]
        load(warehouse, "products", wide, rows.context("r1", "b1", 1))
        first = paths()
        assert min(files()) >= 4  # a bucket of some megabytes is the work of several tasks
        some = wide.filter("product_id % 100 = 7").selectExpr("product_id", "'changed' AS product_name", "category", "unit_cost", "unit_price")
        assert load(warehouse, "products", some, rows.context("r2", "b2", 2)) == (0, 600, 0)
        second = paths()
        assert not set(first) & set(second) and min(files()) >= 4 and warehouse.silver(PRODUCTS).count() == 60_000
        load(warehouse, "products", some.limit(1).selectExpr("product_id", "'again' AS product_name", "category", "unit_cost", "unit_price"), rows.context("r3", "b3", 3))
        assert sum(a != b for a, b in zip(second, paths(), strict=True)) == 1
    finally:
        for k, v in held.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def scanned_rows(df) -> int:
    """Rows that the scans of a plan gave out, after what Parquet's statistics and filters left out."""
    df.collect()
    plan, total = [df._jdf.queryExecution().executedPlan()], 0
    while plan:
        node = plan.pop()
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        plan += [node.children().apply(i) for i in range(node.children().size())]
    return total


@pytest.mark.parametrize("wide", [False, True])
def test_a_small_batch_reads_little_of_a_large_silver(spark, tmp_path, wide):
    spec = ORDER_ITEMS if wide else PRODUCTS
    key = "CAST(id AS DECIMAL(38,0)) * CAST('10000000000000000000' AS DECIMAL(20,0))" if wide else "id * 3"
    make = lambda ids, n: ids.selectExpr(f"CAST({key} AS {spec.columns[spec.key]}) AS {spec.key}", *(
        [f"CAST({n} AS BIGINT) AS order_id", "CAST(1 AS BIGINT) AS product_id", "1 AS quantity", "CAST(1 AS DECIMAL(18,2)) AS unit_price"] if wide
        else [f"'{n}' AS product_name", "'c' AS category", "CAST(1 AS DECIMAL(18,2)) AS unit_cost", "CAST(1 AS DECIMAL(18,2)) AS unit_price"]))
    warehouse = Warehouse(spark, str(tmp_path / "w"), silver_buckets=64)
    first = silver.as_inserted(rows.bronze(make(spark.range(100_000), 1), spec.name, rows.context("r1", "b1", 1)), spec, rows.context("r1", "b1", 1))
    warehouse.publish_silver(spec, rows.context("r1", "b1", 1), first)
    read, found = {}, {}
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name, ids in (("few", spark.range(5, 40_000, 13_000)), ("some", spark.range(0, 100_000, 800)), ("all", spark.range(100_000))):
            batch = rows.context(f"r-{name}", name, 2)
            rows.land(warehouse, spec.name, make(ids, 2), batch)
            landed = warehouse.bronze_batch(spec, name)
            held = warehouse.silver_for(spec, landed, name)
            read[name] = scanned_rows(held.select(spec.key, "record_hash"))
            found[name] = [sorted(map(tuple, silver.silver_changes(landed, x, spec).collect())) for x in (held, warehouse.silver(spec))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    assert all(a == b for a, b in found.values()) and [len(found[x][0]) for x in ("few", "some", "all")] == [4, 125, 100_000]
    assert read["few"] <= 4 * 2_000 and read["few"] < read["some"] < read["all"] == 100_000


def test_a_reference_that_is_null_or_missing_has_no_parent(spark):
    df = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "order_id BIGINT, customer_id BIGINT").selectExpr(
        "order_id", "customer_id", "TIMESTAMP_NTZ '2026-01-01 00:00:00' AS order_date", "'Pending' AS status", "CAST(1 AS DECIMAL(18,2)) AS total_amount"
    )
    parents = {"customers": spark.createDataFrame([(1,), (2,)], "customer_id BIGINT")}
    missing = {"customers": silver.missing_keys(df, parents, ORDERS.parents[0])}
    assert [r.customer_id for r in missing["customers"].collect()] == [9]
    for given in (None, missing):
        keys = silver.with_parents(df, parents, ORDERS, given).select("order_id", "_customers_key").collect()
        assert sorted(map(tuple, keys)) == [(1, 1), (2, None), (3, None)]
        assert [r.order_id for r in silver.promotable(df, parents, ORDERS, given).collect()] == [1]
        assert [r.order_id for r in silver.orphans(df, parents, ORDERS, given).collect()] == [2]


def test_rows_named_for_promotion_are_read_from_bronze_once(spark, warehouse, monkeypatch):
    ctx, made = rows.context(), []
    rows.land(warehouse, "orders", rows.orders(spark, rows.order(1), rows.order(2), rows.order(3)), ctx)
    warehouse.publish_silver(CUSTOMERS, ctx, silver.as_inserted(rows.bronze(rows.customers(spark, rows.customer(1)), "customers", ctx), CUSTOMERS, ctx))
    stage = type(warehouse).stage
    monkeypatch.setattr(type(warehouse), "stage", lambda self, name, c, df: (made.append(name), stage(self, name, c, df))[1])
    keys = spark.createDataFrame([(2,), (3,)], "order_id BIGINT")
    assert load_silver(warehouse, ORDERS, ctx, keys)["rows_inserted"] == 2
    assert made[:3] == ["orders_named", "orders_no_customers", "orders_rejected"]
    assert not warehouse._children(f"{warehouse.root}/stage/orders_named")
    assert sorted(r.order_id for r in warehouse.silver(ORDERS).collect()) == [2, 3]
    assert load_silver(warehouse, ORDERS, ctx) == {"rows_inserted": 1, "rows_updated": 0, "rows_quarantined": 0}
    assert sorted(r.order_id for r in warehouse.silver(ORDERS).collect()) == [1, 2, 3]


def stored(spark, *prints):
    """Items with a stored fingerprint each: their own, or what else is given."""
    ctx, some = rows.context(), [rows.item(key=n, quantity=n) for n in range(1, len(prints) + 1)]
    batch = rows.bronze(rows.items(spark, *some), "order_items", ctx)
    arms = " ".join(f"WHEN order_item_id = {n} THEN {p}" for n, p in enumerate(prints, 1) if p != "own")
    return batch.withColumn("record_hash", silver.F.expr(f"CASE {arms} ELSE record_hash END"))


def test_packed_rows_give_back_any_stored_fingerprint(spark):
    batch = stored(spark, "own", "X'00'", "CAST(NULL AS BINARY)", "X''", "CAST(sha2('x', 256) AS BINARY)", "own").repartition(3)
    moved = silver.packed(batch, ORDER_ITEMS)
    lengths = {int(r.order_item_id): r.n for r in moved.selectExpr("order_item_id", "octet_length(_print) AS n").collect()}
    assert lengths == {1: 0, 2: 2, 3: None, 4: 1, 5: 65, 6: 0}
    back = silver.unpacked(moved.repartition(2), ORDER_ITEMS).select(*batch.columns)
    assert sorted(map(str, back.collect())) == sorted(map(str, batch.collect()))


def test_held_rows_leave_with_the_shuffle_of_the_layout(spark):
    """One shuffle, without fingerprints, takes keys out and deals rows out; rows without a key stay."""
    ctx = rows.context()
    some = [rows.item(key=k) for k in (1, 2, 3, None, None)]
    held = silver.as_inserted(rows.bronze(rows.items(spark, *some), "order_items", ctx), ORDER_ITEMS, ctx)
    gone = rows.items(spark, rows.item(key=2), rows.item(key=9), rows.item(key=None))
    place = silver.F.expr("pmod(hash(order_item_id), 4)")
    left = silver.without_keys(held, gone, ORDER_ITEMS, place)
    assert left.columns == held.columns
    want = [str(r) for r in held.collect() if r.order_item_id != 2]
    assert sorted(map(str, left.collect())) == sorted(want) and len(want) == 4
    text = left._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert text.count("Exchange") == 1
    coming = silver.ranked(held.filter("order_item_id = 3").withColumn("quantity", silver.F.lit(7)), silver.COMING)
    both = silver.settled(silver.ranked(held, silver.HELD).unionByName(coming), ORDER_ITEMS, place)
    assert sorted((int(r.order_item_id or 0), r.quantity) for r in both.collect()) == [(0, 2), (0, 2), (1, 2), (2, 2), (3, 7)]


@pytest.mark.parametrize("entity", ["order_items", "products"])
def test_changes_that_carry_their_rows_need_no_batch(spark, entity):
    first, second = rows.context("r1", "b1", 1), rows.context("r2", "b2", 2)
    if entity == "order_items":
        spec, held, new = ORDER_ITEMS, stored(spark, "own", "own", "X'00'", "CAST(NULL AS BINARY)"), stored(
            spark, "own", "X'01'", "own", "own", "own", "X'05'")
    else:
        make = lambda name, *keys: rows.bronze(rows.products(spark, *[rows.product(k, name=name) for k in keys]), entity, first)
        spec, held, new = PRODUCTS, make("old", 1, 2, 3), make("old", 2).unionByName(make("new", 3, 4))
    held = silver.as_inserted(held, spec, first)
    narrow = silver.silver_changes(new, held, spec)
    wide = silver.silver_changes(silver.packed(new, spec), held, spec, *spec.columns, "_print", "ingested_at")
    found = sorted(map(tuple, narrow.collect()))
    assert sorted(map(tuple, wide.select(*narrow.columns).collect())) == found
    assert {x[1] for x in found} == {"insert", "update"}
    want = silver.apply_changes(new, held, narrow, spec, second)
    place = silver.F.expr(f"pmod(hash({spec.key}), 3)")
    for given in (None, place):
        state = silver.apply_changes(None, held, wide, spec, second, place=given)
        assert sorted(map(str, state.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_small_bucket_is_one_file_however_it_was_made(spark, warehouse):
    """Rejected rows in the first batch, changed ones in the second: both states are dealt out by their place."""
    load(warehouse, "customers", rows.customers(spark, rows.customer()), rows.context("r1", "b1", 1))
    some = [rows.order(k, status="Gone" if k == 7 else "Pending") for k in range(1, 301)]
    assert load(warehouse, "orders", rows.orders(spark, *some), rows.context("r2", "b2", 2)) == (299, 0, 1)
    for day, total in ((3, "1.00"), (4, "2.00")):
        held = [x for x in warehouse._versions(ORDERS)[0][2] if x is not None]
        assert [len(spark.read.parquet(f"{warehouse.root}/{x}").inputFiles()) for x in held] == [1] * len(held)
        changed = [rows.order(k, total=total) for k in range(1, 302)]
        assert load(warehouse, "orders", rows.orders(spark, *changed), rows.context(f"r{day}", f"b{day}", day)) == (2 if day == 3 else 0, 299 if day == 3 else 301, 0)
