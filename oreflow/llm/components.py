"""Connected components of a large graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.sources.scratch import remove, scratch_path


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every end of an edge; the root is the component's smallest node.

    Alternates two steps until nothing changes: every node hands the smallest of its neighbours to the larger ones,
    then to the smaller ones.  A node's smallest neighbour is a combinable minimum, so a node with very many
    neighbours is no group of its own, and each round is a written table.
    """
    spark = edges.sparkSession
    paths: list[str] = []

    def kept(rows: DataFrame) -> DataFrame:
        paths.append(scratch_path(spark, "components"))
        rows.write.parquet(paths[-1])
        return spark.read.schema(rows.schema).parquet(paths[-1])

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    larger, smaller = F.greatest("u", "v"), F.least("u", "v")
    now = kept(edges.filter("u != v").select(larger.alias("u"), smaller.alias("v")).distinct())
    seen = state(now)
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        held = kept(large.filter("u != v").distinct())
        least = kept(held.groupBy("u").agg(F.min("v").alias("m")))
        small = held.join(least, "u")
        moved = small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = state(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError("the components did not settle")
    for path in paths[:-1]:
        remove(spark, path)
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
