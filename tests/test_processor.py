"""Entities with a processor of their own, and ranges of equal rows for JDBC reads."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oreflow.functions.columns import timestamp_literal
from oreflow.model import CUSTOMERS, EntitySpec
from oreflow.operators.quality import DataQualityError, ProcessResult, list_rule_processor, processor_of
from oreflow.plans import loads
from oreflow.sources.jdbc import depth_predicates, depth_query
from oreflow.sources.local import local_rows
from tests import rows


def known_makers(found, ctx, spec, stage):
    """Only rows of a known maker land; the gate asks for a majority of them."""
    suspects = stage("bad_makers", found.filter("maker NOT IN ('a', 'b')").select(spec.key))
    bad = found.join(suspects, spec.key, "left_semi")
    evidence = bad.select(
        *spec.columns, F.lit("UNKNOWN_MAKER").alias("validation_rule"), F.concat(F.lit("Maker "), "maker").alias("validation_message"),
        F.expr(f"{timestamp_literal(ctx.at)} AS quarantined_at"), F.expr("CAST(NULL AS TIMESTAMP_NTZ) AS resolved_at"),
        F.lit(ctx.pipeline_run_id).alias("pipeline_run_id"),
    )
    metrics = found.agg(F.count("*").alias("n"), F.count_if(F.col("maker").isin("a", "b")).alias("known"))

    def gate(facts, _):
        n, known = facts.first()
        if 2 * known <= n:
            raise DataQualityError(f"{known} of {n} machines have a known maker")

    return ProcessResult(found.join(suspects, spec.key, "left_anti"), evidence, metrics, gate, suspects)


MACHINES = EntitySpec(
    name="machines", key="machine_id", columns={"machine_id": "BIGINT", "maker": "STRING"}, hash_columns=("maker",),
    required=("machine_id",), processor=known_makers,
)


def machines(spark, *given):
    return lambda: local_rows(spark, list(given), MACHINES.ddl())


def test_an_entity_with_its_own_processor(spark, warehouse):
    bronze, silver = loads.run_entity(warehouse, MACHINES, machines(spark, (1, "a"), (2, "b"), (3, "x")), rows.context())
    assert (bronze.rows_inserted, silver.rows_inserted) == (2, 2)
    (bad,) = warehouse.quarantine(MACHINES).collect()
    assert (bad.machine_id, bad.validation_rule, bad.validation_message, bad.pipeline_run_id) == (3, "UNKNOWN_MAKER", "Maker x", "run-1")


def test_evidence_stays_when_its_own_gate_fails(spark, warehouse):
    for run in ("r1", "r2"):
        with pytest.raises(DataQualityError, match="1 of 3 machines"):
            loads.run_entity(warehouse, MACHINES, machines(spark, (1, "a"), (2, "y"), (3, "x")), rows.context(run))
    assert sorted((r.machine_id, r.pipeline_run_id) for r in warehouse.quarantine(MACHINES).collect()) == [
        (2, "r1"), (2, "r2"), (3, "r1"), (3, "r2")]
    assert warehouse.bronze(MACHINES).count() == 0
    with pytest.raises(ValueError, match="occurs twice"):
        loads.run_entity(warehouse, MACHINES, machines(spark, (1, "a"), (1, "a")), rows.context("r3", "b3"))


def test_customers_go_through_the_hook():
    assert processor_of(CUSTOMERS) is list_rule_processor


# --- ranges of equal rows -------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=40), st.integers(1, 9), st.lists(st.integers(-90, 90), max_size=9))
def test_conditions_part_every_table(keys, parts, later):
    known = sorted(x for x in keys if x is not None)
    tiles = [known[len(known) * i // parts : len(known) * (i + 1) // parts] for i in range(parts)]
    conditions = depth_predicates("k", [max(t) for t in tiles if t])
    met = lambda k, c: eval(c.replace("1 = 1", "True").replace("IS NULL", "== None").replace("AND", "and").replace("OR", "or"), {}, {"k": Key(k)})
    for k in [*keys, *later]:
        assert sum(bool(met(k, c)) for c in conditions) == 1
    assert len(conditions) <= parts


class Key:
    """SQL's comparisons: with a null nothing holds."""

    def __init__(self, value):
        self.value = value

    def __gt__(self, other):
        return self.value is not None and self.value > other

    def __le__(self, other):
        return self.value is not None and self.value <= other


Key.__eq__ = lambda self, other: self.value == other


def test_conditions_and_query_on_spark(spark):
    table = spark.range(1000).select((F.col("id") * F.col("id") * F.col("id")).alias("MachineID")).unionByName(spark.createDataFrame([(None,)], "MachineID long"))
    table.createOrReplaceTempView("clustered")
    greatest = [r.k for r in spark.sql(depth_query("clustered", "MachineID", 8)).collect()]
    conditions = depth_predicates("MachineID", greatest)
    sizes = [table.filter(c).count() for c in conditions]
    assert len(sizes) == 8 and sum(sizes) == 1001 and max(sizes) <= 126
    assert depth_predicates("k", []) == ["1 = 1"] == depth_predicates("k", [5, None])
    assert depth_predicates("k", ["b'c", "a", "z"])[1:] == ["(k > 'a' AND k <= 'b''c')", "k > 'b''c'"]
    assert depth_predicates("k", [datetime(2024, 1, 1), datetime(2024, 1, 2)])[1] == "k > '2024-01-01 00:00:00'"
