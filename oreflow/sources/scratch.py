"""Where jobs put intermediate tables: the folder that driver and executors share.

That is ``spark.checkpoint.dir``, else the checkpoint folder given to the context.  There is no fallback to a
machine-local folder: a session that has neither is refused.  ``share_locally`` gives a single-machine session
one, for tests, benchmarks and the entry point.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()


def share_locally(spark: SparkSession) -> None:
    """Give a session of one machine a folder of its own; any other session has to bring one."""
    if shared_folder(spark):
        return
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise RuntimeError(f"{SETTING} must name a folder that driver and executors share (master is {master})")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="oreflow-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    base = shared_folder(spark)
    if not base:
        raise RuntimeError(f"{SETTING} must name a folder that driver and executors share")
    path = f"{base.rstrip('/')}/oreflow/{label}-{uuid.uuid4()}"
    _written.append(path)
    return path


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What an execution in the block shuffles leaves the executors' disks when that execution ends.

    Otherwise it stays until the driver happens to collect garbage, beside all that later steps shuffle and write.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows written once and read back: cuts lineage and survives lost executors."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, label)
    with shuffles_dropped(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def only_results(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is written in the block is removed when it ends, but for tables made with the ``written`` that this yields."""
    start, results = len(_written), set()

    def kept(rows: DataFrame, label: str) -> DataFrame:
        table = written(rows, label)
        results.add(_written[-1])
        return table

    try:
        yield kept
    finally:
        made, _written[start:] = _written[start:], [x for x in _written[start:] if x in results]
        for path in made:
            if path not in results:
                remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(hadoop_path, True)


def sweep(spark: SparkSession) -> None:
    """Remove what this process wrote, once no result that reads from it is in use any more."""
    while _written:
        remove(spark, _written.pop())
