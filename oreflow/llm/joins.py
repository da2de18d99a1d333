"""Joins with a side whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000


def checked(keys: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Written rows of a few narrow columns, marked for broadcast if there are at most ``most``; else for Spark to plan."""
    return F.broadcast(keys) if keys.count() <= most else keys
