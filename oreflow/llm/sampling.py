"""Folds and bounded training samples, the same at every size of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id as text is a multiple of 5.  A row without an id is not one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _place(doc_id: str) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit("sample")), F.lit(_STEPS))


def labelled_sample(labels: DataFrame, label: str, most: int) -> DataFrame:
    """``doc_id, label`` of about ``most`` of the rows to learn from, chosen by a hash of the id.

    The share kept follows the number of rows, so the sample's size is bounded whatever the table's.  Rows without
    an id or label are left out; an id with several labels gets the highest.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return known.filter(_place("doc_id") < share(known.count(), most))


def share(rows: int, most: int) -> int:
    """The part of all hash places that holds about ``most`` of ``rows`` rows."""
    return _STEPS if rows <= most else max(1, _STEPS * most // rows)


def placed_below(part: int | Column, doc_id: str = "doc_id") -> Column:
    return _place(doc_id) < part
