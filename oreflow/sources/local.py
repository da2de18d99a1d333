"""A few rows the driver made itself, as a local relation (no Python worker, no job)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    names = [part.split()[0] for part in ddl.split(", ")]
    columns = {name: [row[i] for row in rows] for i, name in enumerate(names)}
    return spark.createDataFrame(pa.table(columns), schema=ddl)
