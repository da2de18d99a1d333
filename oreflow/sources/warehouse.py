"""Parquet tables of the warehouse and the few writes that change them.

Layout below ``root``::

    stage/<name>/<run id>/                       rows of one attempt, removed after the load
    bronze/<entity>/batch_id=<id>/<write>/       append-only, one folder per write that added rows
    quarantine/<entity>/<batch_id|pipeline_run_id>=<id>/<write>/   append-only evidence
    silver/<entity>/<version>-<write>/silver_bucket=<n>/   current state in buckets of the key, never changed
    ops/<log>/part=<p>/day=<day>/                append-only logs, by a hash of the id and the day of the append, and the
                                                 ledgers of what is published

``<write>`` is the run id and a suffix that no other write has, so an attempt repeated under the same ids never
meets its earlier files.  A Bronze folder or Silver version counts only once its ledger row is there, and nothing
that a ledger row names is overwritten: an attempt that dies leaves at most a folder that nobody reads.  Counts are
read back from written files, so lost executors and repeated tasks cannot change them.  Readers name the folders
they need, so no job lists other batches or versions.  A warehouse has one writer; each object reads the ledgers
once and then keeps them up to date itself.
"""

from __future__ import annotations

import re
import uuid
import zlib
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.model import (
    BATCH_RECORD_DDL,
    BRONZE_LEDGER_DDL,
    DAILY_PARTS_DDL,
    EVENT_LOG_DDL,
    KEPT_LEDGER_DDL,
    RUN_LOG_DDL,
    SILVER_LEDGER_DDL,
    STAGE_RECORD_DDL,
    EntitySpec,
    RunContext,
)
from oreflow.operators.bronze import count_unique, guarded
from oreflow.operators.contracts import BATCH_CHECKS, EVENT_CHECKS
from oreflow.sources.local import local_rows
from oreflow.sources.scratch import shuffles_dropped

LOGS = {
    "pipeline_runs": RUN_LOG_DDL,
    "stage_runs": STAGE_RECORD_DDL,
    "batches": BATCH_RECORD_DDL,
    "events": EVENT_LOG_DDL,
    "bronze_ledger": BRONZE_LEDGER_DDL,
    "silver_ledger": SILVER_LEDGER_DDL,
    "kept_ledger": KEPT_LEDGER_DDL,
    "daily_parts": DAILY_PARTS_DDL,
}
# What each log is looked up by; its hash names the folder of the row.
LOG_KEYS = {
    "pipeline_runs": "pipeline_run_id",
    "stage_runs": "pipeline_run_id",
    "batches": "batch_id",
    "events": "pipeline_run_id",
    "bronze_ledger": "batch_id",
    "silver_ledger": "entity",
    "kept_ledger": "name",
    "daily_parts": "pipeline_name",
}
# Enforced on every row that enters a log: (column, checks).
LOG_CHECKS = {
    "pipeline_runs": ("status", BATCH_CHECKS),
    "stage_runs": ("status", BATCH_CHECKS),
    "batches": ("status", BATCH_CHECKS),
    "events": ("event_type", EVENT_CHECKS),
}
# Rows that a bucket of a Silver table is laid out for when the table is first published; the fewest and most buckets.
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS, MOST_BUCKETS = 32, 10_000
LOG_PARTS = 32
PUSHED_KEYS = 100  # keys of a batch that are named to the scan of Silver
CODEC = "zstd"  # of the tables that stay


def _any_of(conditions: list[Column]) -> Column:
    """One of them, as a shallow tree, which the scan takes as it is, where a long IN would become a range."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 1:
        pairs = zip(conditions[::2], conditions[1::2], strict=False)
        conditions = [a | b for a, b in pairs] + conditions[len(conditions) // 2 * 2 :]
    return conditions[0]


class Warehouse:
    def __init__(
        self, spark: SparkSession, root: str, keep_versions: int = 2, silver_buckets: int | None = None, bucket_rows: int = BUCKET_ROWS
    ):
        """``silver_buckets`` holds for tables not yet published: a Silver table keeps the number it began with.

        Without it the number follows the rows of the batch that is published first, ``bucket_rows`` for each bucket.
        """
        if keep_versions < 1:
            raise ValueError("at least one Silver version has to be kept")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep_versions = keep_versions
        self.silver_buckets = silver_buckets
        self.bucket_rows = bucket_rows
        self._published: dict[str, list[tuple[int, str, list[str | None]]]] = {}
        self._landed: dict[tuple[str, str], list[str]] = {}

    # --- files ---------------------------------------------------------------------------------------

    def _hadoop_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path

    def _exists(self, path: str) -> bool:
        files, hadoop_path = self._hadoop_path(path)
        return files.exists(hadoop_path)

    def _delete(self, path: str) -> None:
        files, hadoop_path = self._hadoop_path(path)
        files.delete(hadoop_path, True)

    def _children(self, path: str) -> set[str]:
        files, hadoop_path = self._hadoop_path(path)
        return {x.getPath().getName() for x in files.listStatus(hadoop_path)} if files.exists(hadoop_path) else set()

    def _bytes(self, path: str) -> int:
        files, hadoop_path = self._hadoop_path(path)
        return files.getContentSummary(hadoop_path).getLength()

    @staticmethod
    def write_name(ctx: RunContext) -> str:
        """A folder name that no other write has."""
        return f"{ctx.pipeline_run_id}-{uuid.uuid4().hex[:12]}"

    def _read(self, path: str, ddl: str, base: str | None = None) -> DataFrame | None:
        """A folder with a declared schema (no inference, no footer reads), or None when it is not there."""
        if not self._exists(path):
            return None
        reader = self.spark.read.schema(ddl)
        return (reader.option("basePath", base) if base else reader).parquet(path)

    def _write(self, rows: DataFrame, path: str, *partitions: str) -> None:
        """Write a folder of a table that stays."""
        with shuffles_dropped(self.spark):
            rows.write.option("compression", CODEC).partitionBy(*partitions).parquet(f"{self.root}/{path}")

    def remove(self) -> None:
        """Delete everything below the root."""
        self._delete(self.root)

    def empty(self, ddl: str) -> DataFrame:
        return local_rows(self.spark, [], ddl)

    def empty_log(self, name: str) -> DataFrame:
        return self.empty(LOGS[name])

    # --- stage ---------------------------------------------------------------------------------------

    def _stage_path(self, name: str, run_id: str) -> str:
        return f"{self.root}/stage/{name}/{run_id}"

    def stage(self, name: str, ctx: RunContext, rows: DataFrame) -> DataFrame:
        """Replace this run's rows of a stage table, leaving other runs alone, and return them re-read.

        Cuts lineage: a source is extracted once, and later steps read what was written.
        """
        path = self._stage_path(name, ctx.pipeline_run_id)
        schema = rows.schema
        with shuffles_dropped(self.spark):
            rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def clear_stage(self, name: str, ctx: RunContext) -> None:
        self._delete(self._stage_path(name, ctx.pipeline_run_id))

    # --- bronze --------------------------------------------------------------------------------------

    def _folders(self, spec: EntitySpec, batch_id: str) -> list[str]:
        """Paths of a batch's published Bronze folders: one for each write that added rows."""
        if (spec.name, batch_id) not in self._landed:
            ledger = self.log("bronze_ledger", batch_id).filter(F.col("entity") == spec.name)
            self._landed[spec.name, batch_id] = [row["path"] for row in ledger.select("path").collect()]
        return self._landed[spec.name, batch_id]

    def _read_bronze(self, spec: EntitySpec, paths: list[str]) -> DataFrame:
        reader = self.spark.read.schema(spec.bronze_ddl).option("basePath", f"{self.root}/bronze/{spec.name}")
        return reader.parquet(*[f"{self.root}/{path}" for path in paths])

    def bronze(self, spec: EntitySpec) -> DataFrame:
        """All batches; filters on ``batch_id`` prune folders.

        The one reader that needs the whole ledger of an entity: a path for each write that added rows.
        """
        ledger = self.log("bronze_ledger").filter(F.col("entity") == spec.name)
        paths = [row["path"] for row in ledger.select("path").collect()]
        return self._read_bronze(spec, paths) if paths else self.empty(spec.bronze_ddl)

    def bronze_writes(self, spec: EntitySpec, paths: list[str]) -> DataFrame:
        """The rows of some published writes, by the paths that the ledger has for them."""
        return self._read_bronze(spec, paths)

    def bronze_batch(self, spec: EntitySpec, batch_id: str) -> DataFrame | None:
        paths = self._folders(spec, batch_id)
        return self._read_bronze(spec, paths) if paths else None

    def batch_exists(self, spec: EntitySpec, batch_id: str) -> bool:
        return bool(self._folders(spec, batch_id))

    def append_bronze(self, spec: EntitySpec, ctx: RunContext, rows: DataFrame, unique: bool = False) -> int:
        """Write rows once into a folder of their own, check their keys as written, then publish; returns their number.

        ``unique`` tells that the rows are known to have no key twice.
        """
        path = f"bronze/{spec.name}/batch_id={ctx.batch_id}/{self.write_name(ctx)}"
        self._write(rows.drop("batch_id"), path)
        written = self._read_bronze(spec, [path])
        try:
            with shuffles_dropped(self.spark):
                count = written.count() if unique else count_unique(written, spec, ctx)
        except Exception:
            self._delete(f"{self.root}/{path}")
            raise
        if count:
            row = (spec.name, ctx.batch_id, path, ctx.pipeline_run_id, count, ctx.at)
            folders = self._folders(spec, ctx.batch_id)
            self.append_log("bronze_ledger", [row])
            folders.append(path)
        else:
            self._delete(f"{self.root}/{path}")
        return count

    # --- quarantine ----------------------------------------------------------------------------------

    def quarantine(self, spec: EntitySpec) -> DataFrame:
        found = self._read(f"{self.root}/quarantine/{spec.name}", spec.quarantine_ddl)
        return self.empty(spec.quarantine_ddl) if found is None else found

    def quarantine_part(self, spec: EntitySpec, ctx: RunContext) -> DataFrame | None:
        """This batch's evidence (this run's, for customers), or None."""
        base, column = f"{self.root}/quarantine/{spec.name}", spec.quarantine_partition
        return self._read(f"{base}/{column}={getattr(ctx, column)}", spec.quarantine_ddl, base)

    def append_quarantine(self, spec: EntitySpec, ctx: RunContext, rows: DataFrame) -> int:
        """Add evidence in a folder of its own; returns the number of rows that this call added."""
        column = spec.quarantine_partition
        target = f"quarantine/{spec.name}/{column}={getattr(ctx, column)}/{self.write_name(ctx)}"
        self._write(rows.drop(column), target)
        return self.spark.read.schema(spec.quarantine_ddl).parquet(f"{self.root}/{target}").count()

    # --- silver --------------------------------------------------------------------------------------

    def _versions(self, spec: EntitySpec) -> list[tuple[int, str, list[str | None]]]:
        """Version, folder, and path of every bucket, of the newest published versions, newest first."""
        if spec.name not in self._published:
            newest = self.log("silver_ledger", spec.name).orderBy(F.desc("version")).limit(self.keep_versions)
            self._published[spec.name] = [tuple(row) for row in newest.select("version", "path", "paths").collect()]
        return self._published[spec.name]

    def _first_buckets(self, spec: EntitySpec, batch_id: str) -> int:
        """Buckets of a table that a batch begins, by the rows that the ledger has of it."""
        if self.silver_buckets is not None:
            return self.silver_buckets
        ledger = self.log("bronze_ledger", batch_id).filter(F.col("entity") == spec.name)
        rows = ledger.agg(F.coalesce(F.sum("rows_inserted"), F.lit(0))).first()[0]
        return min(max(LEAST_BUCKETS, -(-rows // self.bucket_rows)), MOST_BUCKETS)

    def silver_bucket(self, spec: EntitySpec, buckets: int | None = None) -> Column:
        """The bucket that a key belongs to."""
        versions = self._versions(spec)
        n = len(versions[0][2]) if versions else buckets or self.silver_buckets or LEAST_BUCKETS
        return F.pmod(F.xxhash64(F.col(spec.key).cast("string")), F.lit(n)).cast("int")

    def _part_bytes(self) -> int:
        """Half of what adaptive execution gives a task: parts are dealt out by a hash, so some tasks get two."""
        n, unit = re.match(r"(\d+)\s*([kmgt]?)", self.spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").lower()).groups()
        return max(1, int(n) * 1024 ** " kmgt".index(unit or " ") // 2)

    def place(self, spec: EntitySpec, batch_id: str) -> Column:
        """Where a key's rows go while the next state is made: its bucket, or a part of it where buckets have many bytes."""
        versions = self._versions(spec)
        if versions:
            n, paths = len(versions[0][2]), {x.rsplit("/", 1)[0] for x in versions[0][2] if x is not None}
        else:
            n, paths = self._first_buckets(spec, batch_id), self._folders(spec, batch_id)
        parts = -(-sum(self._bytes(f"{self.root}/{x}") for x in paths) // (n * self._part_bytes())) or 1
        return self.silver_bucket(spec, n) * parts + F.pmod(F.hash(spec.key), F.lit(parts))

    def silver(self, spec: EntitySpec, buckets: set[int] | None = None) -> DataFrame | None:
        """The current state, or some buckets of it."""
        versions = self._versions(spec)
        if not versions:
            return None
        paths = [x for i, x in enumerate(versions[0][2]) if x is not None and (buckets is None or i in buckets)]
        if not paths:
            return self.empty(spec.silver_ddl)
        return self.spark.read.schema(spec.silver_ddl).parquet(*[f"{self.root}/{x}" for x in paths])

    def silver_for(self, spec: EntitySpec, batch: DataFrame, batch_id: str) -> DataFrame | None:
        """The current state as far as a batch's keys may be in it: all of it, or less where the batch is small.

        A batch with fewer rows than there are buckets leaves buckets out.  Of one with very few rows the keys are part of
        the scan's filter: files are sorted by the key, so Parquet's ranges of it skip pages that hold none of them.
        """
        versions = self._versions(spec)
        if not versions:
            return None
        ledger = self.log("bronze_ledger", batch_id).filter(F.col("entity") == spec.name)
        rows = ledger.agg(F.coalesce(F.sum("rows_inserted"), F.lit(0))).first()[0]
        if not 0 < rows <= 4 * len(versions[0][2]):
            return self.silver(spec)
        held = self.silver(spec, self.touched_buckets(spec, batch))
        if rows <= PUSHED_KEYS:
            held = held.filter(_any_of([F.col(spec.key) == F.lit(x[0]) for x in batch.select(spec.key).distinct().collect()]))
        return held

    def last_published(self, spec: EntitySpec) -> datetime | None:
        """When Silver last got a new version."""
        return self.log("silver_ledger", spec.name).agg(F.max("published_at")).first()[0]

    def silver_or_empty(self, spec: EntitySpec) -> DataFrame:
        found = self.silver(spec)
        return self.empty(spec.silver_ddl) if found is None else found

    def touched_buckets(self, spec: EntitySpec, changes: DataFrame) -> set[int]:
        """Buckets with a changed key: at most as many values as there are buckets."""
        with shuffles_dropped(self.spark):
            return {row[0] for row in changes.select(self.silver_bucket(spec)).distinct().collect()}

    def publish_silver(
        self,
        spec: EntitySpec,
        ctx: RunContext,
        rows: DataFrame,
        counts: dict[str, int] | None = None,
        buckets: set[int] | None = None,
        dealt: bool = False,
    ) -> dict[str, int]:
        """Write the next state, then make it current by one ledger row.  Without counts all rows are new.

        With ``buckets``, ``rows`` is the state of these alone; the others keep the files they have.  Files of a bucket
        follow its bytes, or its parts where rows were ``dealt`` out by their place.
        """
        versions = self._versions(spec)
        if versions:
            version, held = versions[0][0] + 1, versions[0][2]
        else:
            version, held = 1, [None] * self._first_buckets(spec, ctx.batch_id)
        path = f"silver/{spec.name}/{version}-{self.write_name(ctx)}"
        placed = rows.withColumn("silver_bucket", self.silver_bucket(spec, len(held)))
        if not dealt:
            # Adaptive execution gives a large bucket as many tasks and files as its bytes want, and small ones share a task.
            placed = placed.hint("rebalance", "silver_bucket")
        placed = placed.sortWithinPartitions("silver_bucket", spec.key)
        self._write(placed, path, "silver_bucket")
        found = self._children(f"{self.root}/{path}")
        paths = [
            f"{path}/silver_bucket={i}" if f"silver_bucket={i}" in found
            else None if buckets is None or i in buckets else old
            for i, old in enumerate(held)
        ]
        if counts is None:
            new = [f"{self.root}/{x}" for x in paths if x is not None and x.startswith(f"{path}/")]
            written = self.spark.read.schema(spec.silver_ddl).parquet(*new).count() if new else 0
            counts = {"rows_inserted": written, "rows_updated": 0}
        self.append_log(
            "silver_ledger",
            [
                (spec.name, version, path, paths, ctx.pipeline_run_id, ctx.batch_id, counts["rows_inserted"],
                 counts["rows_updated"], ctx.at)
            ],
        )
        current = [(version, path, paths), *versions]
        self._forget(current[: self.keep_versions], current[self.keep_versions :])
        self._published[spec.name] = current[: self.keep_versions]
        return counts

    def _forget(self, kept: list[tuple], dropped: list[tuple]) -> None:
        """Remove files of dropped versions that no kept version names."""
        named = {x for _, _, paths in kept for x in paths if x is not None}
        folders = {x.rsplit("/", 1)[0] for x in named}
        for _, folder, paths in dropped:
            gone = [x for x in paths if x is not None and x not in named]
            for x in {y.rsplit("/", 1)[0] for y in gone} - folders:
                self._delete(f"{self.root}/{x}")
            for x in gone:
                if x.rsplit("/", 1)[0] in folders:
                    self._delete(f"{self.root}/{x}")

    # --- logs ----------------------------------------------------------------------------------------

    def log(self, name: str, key: str | None = None) -> DataFrame:
        """A log, or its rows of one id, for which only the folder of that id's hash is listed and read."""
        base = f"{self.root}/ops/{name}"
        if key is None:
            found = self._read(base, LOGS[name] + ", part STRING, day DATE")
        else:
            part = f"p{zlib.crc32(key.encode()) % LOG_PARTS:02d}"
            found = self._read(f"{base}/part={part}", LOGS[name] + ", part STRING, day DATE", base)
            found = found if found is None else found.filter(F.col(LOG_KEYS[name]) == key)
        return self.empty(LOGS[name]) if found is None else found.drop("part", "day")

    def log_since(self, name: str, day: date | None) -> DataFrame:
        """The rows appended on a day or later; no file of an earlier day is listed."""
        if day is None:
            return self.log(name)
        base = f"{self.root}/ops/{name}"
        files, pattern = self._hadoop_path(f"{base}/part=*/day=*")
        found = [x.getPath() for x in files.globStatus(pattern) or ()]
        # Dates as text sort like dates.
        paths = [x.toString() for x in found if x.getName() >= f"day={day.isoformat()}"]
        if not paths:
            return self.empty(LOGS[name])
        rows = self.spark.read.schema(LOGS[name] + ", part STRING, day DATE").option("basePath", base).parquet(*paths)
        return rows.drop("part", "day")

    def append_log(self, name: str, rows: list[tuple] | DataFrame, day: date | None = None) -> None:
        """A row may leave out the last columns of its log.  ``day`` is the day of the append, by default today's in UTC."""
        bulk = isinstance(rows, DataFrame)
        if not bulk:
            columns = len(LOGS[name].split(", "))
            rows = local_rows(self.spark, [(*row, *[None] * (columns - len(row))) for row in rows], LOGS[name]).coalesce(1)
        if name in LOG_CHECKS:
            rows = guarded(rows, name, *LOG_CHECKS[name])
        part = F.format_string("p%02d", F.crc32(F.coalesce(F.col(LOG_KEYS[name]), F.lit("")).cast("binary")) % LOG_PARTS)
        placed = rows.withColumns({"part": part, "day": F.lit(day or datetime.now(timezone.utc).date())})
        if bulk:
            placed = placed.hint("rebalance", "part")  # a file for each part, and more where one is large
        placed.write.mode("append").partitionBy("part", "day").parquet(f"{self.root}/ops/{name}")
