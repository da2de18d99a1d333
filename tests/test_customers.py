from collections import Counter

import pytest
from pyspark.sql import functions as F

from oreflow.functions.columns import guid_sort_key
from oreflow.model import CUSTOMERS
from oreflow.operators import customers as c
from oreflow.operators import quality as q
from oreflow.sources.local import local_rows
from tests import rows


def errors(spark, *given):
    found = q.customer_errors(rows.customers(spark, *given)).collect()
    return Counter((r.customer_id, r.validation_rule, r.validation_message) for r in found)


def test_a_valid_customer_has_no_errors(spark):
    assert errors(spark, rows.customer()) == {}


@pytest.mark.parametrize("email", [None, ""])
def test_a_missing_email_is_fine(spark, email):
    assert errors(spark, rows.customer(email=email)) == {}


def test_each_failed_rule_gives_a_row(spark):
    assert errors(spark, rows.customer(first=None, last="", email="bad-email")) == {
        (1, "FIRST_NAME_REQUIRED", "FirstName is required"): 1,
        (1, "LAST_NAME_REQUIRED", "LastName is required"): 1,
        (1, "EMAIL_FORMAT", "Invalid email 'bad-email'"): 1,
    }


def test_second_and_later_rows_of_an_id_are_duplicates(spark):
    given = [rows.customer(key=10, email=f"{x}@example.com") for x in "abc"] + [rows.customer(key=11)]
    assert errors(spark, *given) == {(10, "DUPLICATE_CUSTOMER_ID", "Duplicate CustomerID=10"): 2}
    found = q.duplicate_customers(rows.customers(spark, *given)).collect()
    assert sorted(r.email for r in found) == ["b@example.com", "c@example.com"]


def test_identical_rows_are_counted_not_collapsed(spark):
    given = [rows.customer(key=7, first=None)] * 3 + [rows.customer(key=7, first="Zoe")] * 2
    found = errors(spark, *given)
    assert found[(7, "DUPLICATE_CUSTOMER_ID", "Duplicate CustomerID=7")] == 4
    assert found[(7, "FIRST_NAME_REQUIRED", "FirstName is required")] == 3


def test_a_row_repeated_more_often_than_a_chunk_is_kept_whole(spark):
    n = q.COPY_CHUNK * 3 + 17
    one = rows.customers(spark, rows.customer(key=5))
    many = one.crossJoin(spark.range(n).select()).unionByName(rows.customers(spark, rows.customer(key=6)))
    assert q.duplicate_customers(many).count() == n - 1
    assert q.valid_customers(many).count() == 1


def test_every_row_of_a_tainted_id_goes(spark):
    given = [rows.customer(key=1), rows.customer(key=2), rows.customer(key=2, email="b@x"), rows.customer(key=3, last=None)]
    df = rows.customers(spark, *given)
    assert [r.customer_id for r in q.valid_customers(df).collect()] == [1]
    metrics = q.customer_invalid_rate(df).first()
    assert (metrics.total_rows, metrics.invalid_ids, metrics.invalid_rate) == (4, 2, 0.5)
    invalid = q.invalid_ids(df)
    assert q.customer_invalid_rate(df, invalid=invalid).first() == metrics
    assert q.duplicate_customers(df, invalid=invalid).collect() == q.duplicate_customers(df).collect()


def test_gate(spark):
    df = rows.customers(spark, rows.customer(), rows.customer(key=2, first=None))
    metrics = q.customer_invalid_rate(df)
    q.customer_quality_gate(metrics, 0.60)
    q.customer_quality_gate(metrics, 0.5)
    for threshold in (0.05, 0):
        with pytest.raises(q.DataQualityError, match="Customer invalid rate 50.00% exceeds threshold"):
            q.customer_quality_gate(metrics, threshold)


def test_gate_passes_on_no_rows(spark):
    metrics = q.customer_invalid_rate(rows.customers(spark))
    assert metrics.first().invalid_rate == 0
    q.customer_quality_gate(metrics, 0)


@pytest.mark.parametrize("threshold", ["abc", "1.5", -0.1])
def test_threshold_is_checked(threshold):
    with pytest.raises(ValueError, match="threshold"):
        q.check_threshold(threshold)


def test_key_order_splits_equal_rows(spark):
    many = rows.customers(spark, rows.customer(5)).crossJoin(spark.range(20_000, numPartitions=4).select())
    parts = c.ordered(many.unionByName(rows.customers(spark, rows.customer(9), rows.customer(1))), "customer_id")
    assert parts.columns == list(CUSTOMERS.columns)
    keys = [r.customer_id for r in parts.select("customer_id").collect()]
    assert keys == sorted(keys) and len(keys) == 20_002


def test_latest_version_per_id(spark):
    first = rows.bronze(rows.customers(spark, rows.customer(key=1, phone="a"), rows.customer(key=2)), "customers", rows.context("r1", "b1", 1))
    second = rows.bronze(rows.customers(spark, rows.customer(key=1, phone="b")), "customers", rows.context("r2", "b2", 2))
    tie = rows.bronze(rows.customers(spark, rows.customer(key=1, phone="c")), "customers", rows.context("r3", "b3", 2))
    latest = c.latest_customers(first.unionByName(second).unionByName(tie))
    assert sorted((r.customer_id, r.phone, r.batch_id) for r in latest.collect()) == [(1, "c", "b3"), (2, "555-0100", "b1")]


def test_guid_order_compares_the_last_group_first(spark):
    low = "ffffffff-ffff-ffff-ffff-000000000001"
    high = "00000000-0000-0000-0000-000000000002"
    parts = [rows.bronze(rows.customers(spark, rows.customer(phone=b)), "customers", rows.context("r", b)) for b in (low, high)]
    both = parts[0].unionByName(parts[1])
    assert c.latest_customers(both).first().phone == low
    assert c.latest_customers(both, guid_order=True).first().phone == high
    # Within the first group the last byte weighs most.
    ids = ["01000000-0000-0000-0000-000000000000", "00000002-0000-0000-0000-000000000000", "00000001-0000-0000-0000-000000000000"]
    df = local_rows(spark, [(i,) for i in ids], "id STRING").orderBy(F.expr(guid_sort_key("id")))
    assert [r.id for r in df.collect()] == [ids[0], ids[2], ids[1]]


def test_hash_lookup(spark):
    ddl = "customer_id BIGINT, email STRING, record_hash BINARY"
    latest = local_rows(
        spark,
        [(1, "a@x.test", b"1"), (2, "b@x.test", b"2"), (3, "c@x.test", b"3"), (4, "d@other", b"4"), (5, "e@x.test", None)],
        ddl,
    )
    silver = local_rows(spark, [(1, "a", b"1"), (2, "b", b"9"), (4, "d", b"4")], ddl)
    assert tuple(c.silver_hash_lookup(latest, silver, "@x.test").first()) == (3, 1, 1, 1)
