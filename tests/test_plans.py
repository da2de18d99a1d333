"""Plan shape: what has to hold when the tables are a million times larger."""

import re

import pytest
from pyspark.sql import functions as F

from oreflow.functions.rules import fields_valid
from oreflow.model import ORDERS, PAYMENTS, PRODUCTS
from oreflow.operators import customers as c
from oreflow.operators import quality, silver
from oreflow.operators.bronze import batch_scope
from oreflow.plans.catalog import catalog
from oreflow.plans.scenario import SECOND, Scenario
from tests import rows

SF = "/root/testdata/sf0.001"
# These write tables while they are built; their steps are the same operators.
WRITING = {"run_entity", "run_commerce", "run_customer", "stage_replace_run", "quarantine_append", "silver_publish", "ops_log_append",
           "batch_exists", "customer_run_health"}
LAZY = [name for name in catalog() if name not in WRITING and not name.startswith("bronze_append")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan after it has run."""
    df.write.format("noop").mode("overwrite").save()
    frame = df._jdf
    frame.collectToPython()
    return frame.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_python_or_global_window(spark, name):
    text = plan(catalog()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "ArrowEval"):
        assert bad not in text, bad
    # One partition is fine for the last step of a total (partial aggregates, a top-n), for nothing else.
    for line in text.splitlines():
        if re.search(r"\bWindow \[", line):
            assert not re.search(r"Window \[[^]]*\], \[[^]]*\]$", line), line


def test_parents_are_read_by_key_only(spark):
    text = plan(Scenario(spark, SF).trusted("order_items").select("order_item_id"))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert len(read) == 3 and {"order_id:bigint", "product_id:bigint"} < set(read)


@pytest.mark.parametrize(("entity", "scans"), [("orders", 4), ("order_items", 6), ("payments", 4)])
def test_a_silver_query_scans_its_source_and_its_parents_keys_once_a_batch(spark, entity, scans):
    text = plan(Scenario(spark, SF).silver(entity))
    assert text.count("FileScan parquet") == scans
    assert text.count("Join") == scans - 1


def test_stage_counts_read_written_tables(spark):
    text = plan(catalog()["stage_result_counts"](spark, SF))
    # Five merges of two batches and three sets of rejected rows, over sources and written keys alone.
    assert text.count("FileScan parquet") <= 27


def test_field_rules_reach_the_scan(spark, warehouse):
    rows.land(warehouse, "payments", rows.payments(spark, rows.payment()), rows.context())
    text = plan(warehouse.bronze_batch(PAYMENTS, "batch-1").filter(fields_valid(PAYMENTS)).select("payment_id"))
    pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", text).group(1)
    for want in ("GreaterThan(payment_id,0)", "GreaterThan(order_id,0)", "In(payment_method", "GreaterThan(amount,0.00)"):
        assert want in pushed
    assert "ingested_at" not in re.search(r"ReadSchema: struct<(.*)", text).group(1)


def test_a_merge_shuffles_each_side_once(spark, warehouse):
    first, second = rows.context("r1", "b1"), rows.context("r2", "b2")
    rows.land(warehouse, "products", rows.products(spark, rows.product(1)), first)
    warehouse.publish_silver(PRODUCTS, first, silver.as_inserted(warehouse.bronze_batch(PRODUCTS, "b1"), PRODUCTS, first))
    rows.land(warehouse, "products", rows.products(spark, rows.product(2)), second)
    merged = silver.silver_merge(warehouse.bronze_batch(PRODUCTS, "b2"), warehouse.silver(PRODUCTS), PRODUCTS, second)
    assert plan(merged).count("Exchange hashpartitioning") == 2


def test_rejected_rows_leave_with_the_shuffle_of_the_merge(spark):
    """Removing rejected keys and merging use one shuffle of the batch when the rejected set is large."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        s = Scenario(spark, SF)
        batch, rejected = s.batch("products"), s.batch("products").filter("unit_cost < 0").select("product_id")
        merged = silver.silver_merge(
            batch.join(rejected, "product_id", "left_anti"), s.batch("products", 1).selectExpr(
                "* EXCEPT (ingested_at, pipeline_run_id, batch_id)", "ingested_at AS source_ingested_at", "ingested_at AS processed_at"
            ), PRODUCTS, SECOND,
        )
        assert plan(merged).count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_batch_reads_one_folder(spark, warehouse):
    for batch in ("b1", "b2"):
        rows.land(warehouse, "orders", rows.orders(spark, rows.order()), rows.context(f"r-{batch}", batch))
    text = plan(batch_scope(warehouse.bronze(ORDERS), "b2"))
    assert re.search(r"PartitionFilters: \[isnotnull\(batch_id#\d+\), \(batch_id#\d+ = b2\)\]", text)
    assert warehouse.bronze_batch(ORDERS, "b2").inputFiles() and all("batch_id=b2" in f for f in warehouse.bronze_batch(ORDERS, "b2").inputFiles())


def test_latest_per_key_limits_ranks_before_the_shuffle(spark):
    text = plan(c.latest_customers(Scenario(spark, SF).bronze("customers")))
    shuffle = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[shuffle:], "no limit below the shuffle"


def test_duplicates_use_no_window(spark):
    assert "Window" not in plan(quality.duplicate_customers(Scenario(spark, SF).source("customers")))


@pytest.fixture
def small_skew(spark):
    """Thresholds at which a few megabytes count as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_orders(spark, n: int):
    """``n`` orders of which a third belong to one customer, written by several tasks."""
    return spark.range(1, n + 1, 1, 16).selectExpr(
        "id AS order_id",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS customer_id",
        "TIMESTAMP_NTZ '2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 100000) AS order_date",
        "'Pending' AS status",
        "CAST(id % 1000 AS DECIMAL(18,2)) AS total_amount",
    )


def test_a_hot_parent_is_split_and_nothing_is_lost(spark, small_skew):
    n = 120_000
    batch = rows.bronze(hot_orders(spark, n), "orders", rows.context())
    customers = spark.range(1, n + 1).selectExpr("id AS customer_id").filter("customer_id % 10 <> 0")
    for result in (
        silver.check_batch(batch, {"customers": customers}, ORDERS),
        silver.promotable(batch, {"customers": customers}, ORDERS),
        silver.orphans(batch, {"customers": customers}, ORDERS),
    ):
        assert "skew=true" in final_plan(result)
    kept = silver.promotable(batch, {"customers": customers}, ORDERS).count()
    orphaned = silver.orphans(batch, {"customers": customers}, ORDERS).count()
    # A third of the orders go to customer 7; of the rest those whose customer ends in 0 have no parent.
    want = sum(1 for i in range(1, n + 1) if i % 3 and i % 10 == 0)
    assert (kept, orphaned) == (n - want, want)


def test_a_hot_customer_id_is_validated_whole(spark, small_skew):
    n = 60_000
    df = spark.range(1, n + 1, 1, 16).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id + 100 END AS customer_id", "concat('first', id) AS first_name",
        "'last' AS last_name", "concat('c', id, '@x') AS email", "'1' AS phone",
        "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
    )
    duplicates = quality.duplicate_customers(df)
    assert "skew=true" in final_plan(duplicates) and "skew=true" in final_plan(quality.valid_customers(df))
    assert duplicates.count() == n // 3 - 1
    assert quality.valid_customers(df).count() == n - n // 3
    first = df.filter("customer_id = 7").agg(F.min("first_name")).first()[0]
    assert duplicates.filter(F.col("first_name") == first).count() == 0


def test_rows_of_one_id_are_counted_in_many_tasks(spark, small_skew):
    """Neither equal nor different rows of one id are dealt out by that id alone."""
    df = spark.range(40_000, numPartitions=8).selectExpr(
        "7L AS customer_id", "concat('f', id % 2) AS first_name", "'l' AS last_name", "'a@x' AS email", "'1' AS phone",
        "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
    )
    dealt = quality.dealt_rows(df, quality.invalid_ids(df).select("customer_id"), quality.CUSTOMERS)
    sizes = [r[1] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 and max(sizes) < 20_000
    assert quality.duplicate_customers(df).count() == 39_999


def test_rows_keep_their_salt_when_they_come_in_another_order(spark, small_skew):
    """As after a lost executor: every run of the snapshot's tasks gives its rows in a new order."""

    def shuffled(batches):
        import numpy as np

        for batch in batches:
            yield batch.take(np.random.default_rng().permutation(len(batch)))

    df = spark.range(2_000, numPartitions=4).selectExpr(
        "id % 40 AS customer_id", "concat('f', id % 80) AS first_name", "'l' AS last_name", "'a@x' AS email", "'1' AS phone",
        "CAST(NULL AS TIMESTAMP_NTZ) AS created_at",
    )
    ids = quality.invalid_ids(df).select("customer_id")
    dealt = quality.dealt_rows(df.mapInArrow(shuffled, df.schema), ids, quality.CUSTOMERS)
    salts = [dealt.groupBy(*dealt.columns).count().collect() for _ in range(2)]
    assert sum(r["count"] for r in salts[0]) == 2_000
    assert set(salts[0]) == set(salts[1])


def test_quarantine_counts_distinct_customers_in_two_steps(spark):
    text = plan(catalog()["quarantine_metrics"](spark, SF))
    assert text.count("HashAggregate") == 4
    assert re.search(r"Exchange hashpartitioning\(pipeline_run_id#\d+, customer_id#\d+L", text)




@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def fingerprints_shuffled(df) -> int:
    """Of the projections that make fingerprints, those whose rows a shuffle by some key moves on."""
    path, found = [], 0
    for line in plan(df).split("\n== Initial Plan ==")[0].splitlines():
        depth = len(re.match(r"[\s:|+-]*", line).group())
        path = [x for x in path if x[0] < depth] + [(depth, line)]
        found += "sha2(" in line and any("Exchange hashpartitioning" in x for _, x in path[:-1])
    return found


@pytest.mark.parametrize("query", ["silver_order_items", "silver_orders", "silver_payments"])
def test_a_silver_query_shuffles_no_fingerprint(spark, no_broadcast, query):
    df = catalog()[query](spark, SF)
    assert plan(df).count("sha2(") == 2 and fingerprints_shuffled(df) == 0


@pytest.mark.parametrize("query", ["silver_changed_order_items", "silver_new_order_items"])
def test_changes_are_found_without_shuffling_a_fingerprint(spark, no_broadcast, query):
    df = catalog()[query](spark, SF)
    assert "sha2(" in plan(df) and fingerprints_shuffled(df) == 0


def test_stage_counts_shuffle_no_fingerprint(spark, no_broadcast):
    df = catalog()["stage_result_counts"](spark, SF)
    assert plan(df).count("sha2(") == 10 and fingerprints_shuffled(df) == 0


def test_a_resumed_batch_shuffles_no_fingerprint(spark, no_broadcast):
    df = catalog()["bronze_new_rows_order_items"](spark, SF)
    assert "sha2(" in plan(df) and fingerprints_shuffled(df) == 0


def test_rows_meet_missing_parents_alone(spark):
    """A few missing parents are sent to the rows, however many there are in Silver."""
    batch = rows.bronze(hot_orders(spark, 30_000), "orders", rows.context())
    parents = {"customers": spark.range(1, 3_000_000).selectExpr("id AS customer_id").filter("customer_id <> 7")}
    for result in (silver.check_batch(batch, parents, ORDERS), silver.promotable(batch, parents, ORDERS), silver.orphans(batch, parents, ORDERS)):
        assert "Exchange hashpartitioning" not in plan(result) and "BroadcastHashJoin" in plan(result)
