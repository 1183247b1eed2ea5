"""Partitioned lake tables on the Spark catalog.

Each table is an external Parquet table ``<prefix><layer>.<name>`` stored at
``<root>/<layer>/<name>`` and partitioned by ``trip_month``. The month is
the replace unit:

* replace  — months are written into a fresh folder and published month by
  month by a change of place (``versions.py``): readers see a month whole,
  old or new, and a job that fails before publishing leaves no trace. Months
  that are not in the new data are untouched; a re-run lands the same rows.
* clear    — months that must become empty (no input rows) are dropped from
  the catalog and their folders deleted.
* evolve   — ``ALTER TABLE ADD COLUMNS``; old files read NULL.
* write    — ``REBALANCE(trip_month)`` lets AQE split a hot month over
  several tasks and pack small months together, instead of funnelling one
  month into one task. A byte budget is kept by prefix sums of row bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import session_conf
from strata.plans import versions
from strata.plans.versions import PARTITION_COLUMN, VERSION_PREFIX, fresh_version
from strata.sources import storage

# Fixed value: write-size target property and its value (2 GiB).
WRITE_TARGET_PROPERTY = "write.target-file-size-bytes"
WRITE_TARGET_FILE_SIZE_BYTES = 2 * 1024 * 1024 * 1024
# Bytes of shuffle data per write task when no target is given.
DEFAULT_ADVISORY_BYTES = 256 * 1024 * 1024
# Bytes of files that one task of a dealt write takes, if a file is smaller.
DEALT_TASK_BYTES = 64 * 1024 * 1024
# Months that a write task keeps open at a time. Up to so many its rows go to
# their files as they come; only a task of more months sorts the rows of the
# others, and that sort holds them uncompressed, many times their shuffled bytes.
OPEN_MONTHS = 128
# Coalesced write tasks a core, at least, of a write of many files a month.
TASKS_A_CORE = 8
# A local file costs a process that sets its mode, and so does its side file of
# checksums. Writes of many small files go without the latter (Parquet pages
# have their own). Other file systems are not concerned.
SMALL_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
_IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def check_identifier(name: str) -> str:
    if not _IDENTIFIER.match(name):
        raise ValueError(f"invalid identifier: {name!r}")
    return name


@dataclass(frozen=True)
class Lake:
    """A lake root plus a namespace prefix (lets several lakes share a session)."""

    spark: SparkSession
    root: str
    prefix: str = ""

    def namespace(self, layer: str) -> str:
        return check_identifier(f"{self.prefix}{layer}")

    def table(self, layer: str, name: str) -> "Table":
        return Table(self, layer, check_identifier(name))

    def ensure_namespace(self, layer: str) -> str:
        ns = self.namespace(layer)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns} LOCATION '{self.root}/{layer}'")
        return ns


@dataclass(frozen=True)
class Table:
    lake: Lake
    layer: str
    name: str

    @property
    def spark(self) -> SparkSession:
        return self.lake.spark

    @property
    def qualified(self) -> str:
        return f"{self.lake.namespace(self.layer)}.{self.name}"

    @property
    def location(self) -> str:
        return f"{self.lake.root}/{self.layer}/{self.name}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.qualified)

    def read(self) -> DataFrame:
        return self.spark.table(self.qualified)



def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_table(
    table: Table,
    schema: T.StructType,
    *,
    partition_cols: Sequence[str] = (PARTITION_COLUMN,),
    properties: dict[str, str] | None = None,
    location: str | None = None,
) -> bool:
    """Create if absent; returns whether it was created."""
    if table.exists():
        return False
    table.lake.ensure_namespace(table.layer)
    where = location or table.location
    storage.mkdirs(table.spark, where)
    props = ""
    if properties:
        props = " TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")"
    parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    table.spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.qualified} ({_ddl(schema)}) USING parquet"
        f"{parts} LOCATION '{where}'{props}"
    )
    if partition_cols:
        table.spark.sql(f"ALTER TABLE {table.qualified} RECOVER PARTITIONS")
    return True


def table_properties(table: Table) -> dict[str, str]:
    return {r.key: r.value for r in table.spark.sql(f"SHOW TBLPROPERTIES {table.qualified}").collect()}


def ensure_write_target(table: Table, target_bytes: int = WRITE_TARGET_FILE_SIZE_BYTES) -> bool:
    """Record the write-size target when missing or different; returns whether it changed."""
    desired = str(target_bytes)
    if table_properties(table).get(WRITE_TARGET_PROPERTY) == desired:
        return False
    table.spark.sql(
        f"ALTER TABLE {table.qualified} SET TBLPROPERTIES ('{WRITE_TARGET_PROPERTY}'='{desired}')"
    )
    return True


def write_target(table: Table) -> int:
    return int(table_properties(table).get(WRITE_TARGET_PROPERTY, DEFAULT_ADVISORY_BYTES))


def evolve(table: Table, columns: dict[str, T.DataType]) -> bool:
    """Add the columns the table lacks; returns whether the schema changed."""
    present = {f.name for f in table.read().schema.fields}
    missing = {n: t for n, t in columns.items() if n not in present}
    if not missing:
        return False
    cols = ", ".join(f"`{n}` {t.simpleString()}" for n, t in missing.items())
    table.spark.sql(f"ALTER TABLE {table.qualified} ADD COLUMNS ({cols})")
    return True


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order columns as ``schema`` and cast where types differ; drop extras.

    A target column absent from ``df`` is an error (callers evolve first).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name not in have:
            raise ValueError(f"column {f.name!r} missing from frame")
        c = F.col(f.name)
        cols.append(c if have[f.name] == f.dataType else c.cast(f.dataType).alias(f.name))
    return df.select(cols)


def drop_months(table: Table, months: Iterable[str]) -> list[str]:
    """Clear months: drop the catalog partitions (one statement) and delete their folders."""
    return versions.drop(table.spark, table.qualified, table.location, months)


def row_bytes(df: DataFrame) -> Column:
    """Uncompressed size of a row: 8 bytes a fixed-width value, the bytes of a string."""
    widths = [
        F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8)
        for f in df.schema.fields
    ]
    return reduce(lambda a, b: a + b, widths, F.lit(0)).cast("bigint")


@dataclass(frozen=True)
class Staged:
    """Months written aside: the version folder, rows, the audit's counts, and
    the rows of each month if the write knows them."""

    path: str
    rows: int
    counts: dict[str, int]
    by_month: dict[str | None, int] | None = None


def _write_version(
    df: DataFrame, path: str, *, advisory_bytes: int, max_records_per_file: int | None, rebalance: bool, target_bytes: int | None = None
) -> None:
    """``target_bytes``: of a frame dealt to files, the bound of a file."""
    shared = target_bytes is not None and months_together(target_bytes) > 1
    conf = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory_bytes),
        # After REBALANCE(trip_month) a task holds one large month or several
        # small ones, all of them within the advisory size, encoded. A task
        # dealt one small file of each of many months sorts its few rows and
        # writes one file after another.
        "spark.sql.maxConcurrentOutputFileWriters": str(0 if shared else OPEN_MONTHS),
        # What a write shuffled is deleted when it ends, not when the driver
        # happens to collect garbage: a landing after it has the disk to itself.
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    if max_records_per_file:  # the files take the time, not the bytes: months are packed less
        cores = df.sparkSession.sparkContext.defaultParallelism
        conf["spark.sql.adaptive.coalescePartitions.minPartitionNum"] = str(TASKS_A_CORE * cores)
    # The writing session is the frame's own: a micro-batch runs in a clone.
    with session_conf(df.sparkSession, conf):
        out = df.hint("rebalance", PARTITION_COLUMN) if rebalance else df
        # Every task moves its own files into the folder, which nothing reads yet;
        # the driver need not move them one by one at the end.
        writer = out.write.partitionBy(PARTITION_COLUMN).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        if max_records_per_file or shared:
            writer = writer.options(**SMALL_FILES)
        writer.parquet(path)


def months_together(target_bytes: int) -> int:
    """Months that share the tasks of a dealt write."""
    return max(1, DEALT_TASK_BYTES // target_bytes)


def task_numbers(files: dict[str | None, int], target_bytes: int) -> tuple[dict[str | None, int], int]:
    """For months of so many files: the first task of each, and the number of
    tasks. File ``k`` of a month goes to its first task plus ``k``. Months
    share tasks as long as these hold ``DEALT_TASK_BYTES`` at most, so a task
    writes many small files, but never two of one month, which would be one."""
    together = months_together(target_bytes)
    months = sorted(files, key=lambda m: m or "")
    first, total = {}, 0
    for at in range(0, len(months), together):
        group = months[at : at + together]
        first |= dict.fromkeys(group, total)
        total += max(files[m] for m in group)
    return first, total


def numbered_files(df: DataFrame, target_bytes: int, *, batch_rows: int = 1) -> tuple[DataFrame, int]:
    """``df`` with ``_task``, the number of the task that writes each row, and
    the number of tasks. The rows of a month in one task are one file. ``df``
    must be read from files and have ``trip_month``.

    Prefix sums of row bytes over each month, in order of file and place in it:
    a window within a file, which one task wrote, and one over a month's files
    for the offsets. A file takes the batches of ``batch_rows`` rows that start
    within one stretch of ``target_bytes``, so it holds less than the target
    plus one batch. Only one row for each file read is joined to the rows.
    """
    spark = df.sparkSession
    rows = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    rows = rows.withColumn("_bytes", row_bytes(df))
    files = Window.partitionBy(PARTITION_COLUMN).orderBy("_path")
    earlier = files.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(PARTITION_COLUMN, "_path")
        .agg(F.sum("_bytes").alias("_total"))
        .select("_path", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_path").orderBy("_row")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = F.coalesce(F.sum("_bytes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = F.when(F.col("_row") % batch_rows == 0, F.col("_before"))
    opens = F.coalesce((F.col("_stretch") != F.lag("_stretch").over(inside)).cast("long"), F.lit(0))
    placed = (
        rows.withColumn("_before", before)
        .withColumn("_before", F.max(begins).over(so_far))
        .join(F.broadcast(offsets), "_path")
        .withColumn("_stretch", F.floor((F.col("_before") + F.col("_offset")) / target_bytes))
        .withColumn("_opens", opens)
        .withColumn("_in_path", F.sum("_opens").over(so_far))
    )
    # one row per file read; a stretch that goes on in the next one is one file
    paths = placed.groupBy(PARTITION_COLUMN, "_path").agg(
        F.min("_stretch").alias("_first"), F.max("_stretch").alias("_last"), F.max("_in_path").alias("_n")
    )
    goes_on = F.coalesce((F.col("_first") == F.lag("_last").over(files)).cast("long"), F.lit(0))
    base = F.coalesce(F.sum(F.col("_n") + 1).over(earlier), F.lit(0)) - F.sum("_goes_on").over(
        files.rowsBetween(Window.unboundedPreceding, 0)
    )
    found = paths.withColumn("_goes_on", goes_on).select(PARTITION_COLUMN, "_path", "_n", base.alias("_base")).collect()
    counts: dict[str | None, int] = {}
    for r in found:
        counts[r[PARTITION_COLUMN]] = max(counts.get(r[PARTITION_COLUMN], 0), int(r["_base"] + r["_n"]) + 1)
    first, total = task_numbers(counts, target_bytes)
    bases = spark.createDataFrame(
        [(r["_path"], first[r[PARTITION_COLUMN]] + int(r["_base"])) for r in found], "_path string, _first_task long"
    )
    task = (F.col("_first_task") + F.col("_in_path")).cast("int").alias("_task")
    return placed.join(F.broadcast(bases), "_path").select(*df.columns, task), total


def deal(df: DataFrame, tasks: int) -> DataFrame:
    """One task for each number in ``_task``, and so one file a month and number."""
    return df.repartitionById(max(1, tasks), F.col("_task")).drop("_task")


def stage_months(
    df: DataFrame,
    table: Table,
    *,
    target_bytes: int | None = None,
    batch_rows: int = 1,
    max_records_per_file: int | None = None,
    audit: dict[str, Column] | None = None,
) -> Staged:
    """Write ``df`` into a fresh version folder of ``table``, unpublished.

    ``audit``: conditions counted over the written rows by the write itself.
    ``target_bytes`` bounds the uncompressed bytes of a file (plus one batch of
    ``batch_rows`` rows): the staged rows are then dealt to files once more.
    """
    if target_bytes is not None and target_bytes < 1:
        raise ValueError("target_bytes must be positive")
    if max_records_per_file is not None and max_records_per_file < 1:
        raise ValueError("max_records_per_file must be positive")
    spark = table.spark
    seen = Observation(f"staged-{table.name}")
    audited = df.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(name) for name, c in (audit or {}).items()]
    )
    counted = align(audited, table.read().schema)
    advisory = max(1 << 20, min(target_bytes or DEFAULT_ADVISORY_BYTES, DEFAULT_ADVISORY_BYTES))
    path = fresh_version(table.location)
    _write_version(counted, path, advisory_bytes=advisory, max_records_per_file=max_records_per_file, rebalance=True)
    if not versions.month_folders(spark, path):  # no rows; a plan without any may drop the observation
        return Staged(path, 0, dict.fromkeys(audit or {}, 0))
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    by_month = None
    if target_bytes is not None:
        staged, path = path, fresh_version(table.location)
        rows = spark.read.schema(table.read().schema).option("basePath", staged).parquet(staged)
        # from the footers of the few staged files, not of the many small ones
        by_month = {r[PARTITION_COLUMN]: int(r["count"]) for r in rows.groupBy(PARTITION_COLUMN).count().collect()}
        cut, tasks = numbered_files(rows, target_bytes, batch_rows=batch_rows)
        dealt = Observation(f"dealt-{table.name}")
        _write_version(
            deal(cut, tasks).observe(dealt, F.count(F.lit(1)).alias("rows")),
            path,
            advisory_bytes=advisory,
            max_records_per_file=max_records_per_file,
            rebalance=False,
            target_bytes=target_bytes,
        )
        if dealt.get["rows"] != sum(by_month.values()):
            raise RuntimeError(f"{dealt.get['rows']} rows written of {sum(by_month.values())} staged for {table.qualified}")
        storage.delete(spark, staged)
    return Staged(path, counts.pop("rows"), counts, by_month)


def publish(table: Table, staged: Staged, *, sessions: Sequence[SparkSession] = ()) -> list[str]:
    """Make the staged months the table's; returns them."""
    written = versions.publish(table.spark, table.qualified, table.location, staged.path)
    for session in sessions:  # a micro-batch runs in a clone
        session.catalog.refreshTable(table.qualified)
    return written


def discard(table: Table, staged: Staged) -> None:
    storage.delete(table.spark, staged.path)


def replace_months(
    df: DataFrame,
    table: Table,
    *,
    months: Sequence[str] | None = None,
    target_bytes: int | None = None,
    batch_rows: int = 1,
    max_records_per_file: int | None = None,
) -> dict[str, object]:
    """Swap the months present in ``df``; clear requested months left empty.

    ``target_bytes`` bounds the uncompressed bytes of a file. Rows without a
    month are written to the partition without one. ``rows_by_month`` of the
    result is None unless the write knows it.
    """
    staged = stage_months(df, table, target_bytes=target_bytes, batch_rows=batch_rows, max_records_per_file=max_records_per_file)
    written = publish(table, staged, sessions=[df.sparkSession])
    emptied = sorted(set(months or []) - set(written))
    if emptied:
        drop_months(table, emptied)
    known = None if staged.by_month is None else {m: staged.by_month[m] for m in written}
    return {"rows": staged.rows, "months_written": written, "months_cleared": emptied, "rows_by_month": known}


def current_location(table: Table) -> str | None:
    """Storage location the catalog entry points at (None if no table)."""
    if not table.exists():
        return None
    rows = table.spark.sql(f"DESCRIBE TABLE EXTENDED {table.qualified}").collect()
    for r in rows:
        if r.col_name == "Location":
            return r.data_type
    return None


def latest_version(table: Table) -> str | None:
    """Newest committed version folder of a rebuilt table (has ``_SUCCESS``)."""
    versions = sorted(
        (c for c in storage.list_children(table.spark, table.location) if c.startswith(VERSION_PREFIX)),
        reverse=True,
    )
    for v in versions:
        path = f"{table.location}/{v}"
        if storage.exists(table.spark, f"{path}/_SUCCESS"):
            return path
    return None


def _laid_out_as(table: Table, schema: T.StructType, partition_cols: Sequence[str]) -> bool:
    """Whether the catalog's table has these columns, and these (at most the
    month) as partitions, so that its folders can be swapped under it."""
    columns = [(f.name, f.dataType) for f in table.read().schema.fields]
    months = [c.name for c in table.spark.catalog.listColumns(table.qualified) if c.isPartition]
    return columns == [(f.name, f.dataType) for f in schema.fields] and months == list(partition_cols) and set(months) <= {PARTITION_COLUMN}


def overwrite_table(
    df: DataFrame,
    table: Table,
    *,
    partition_cols: Sequence[str] = (PARTITION_COLUMN,),
) -> str:
    """Full rebuild with write-then-swap.

    The new content is written to a fresh version folder; only after that
    job has committed is the catalog pointed at it. A table of the same
    columns is never dropped: its months and then the table itself change
    their places one statement after another, so a reader always finds the
    table, and every month whole, old or new. Only new columns (or none
    before) make the table anew. A failure before the swap leaves readers on
    the previous, complete version, whose folder is kept until the next
    rebuild for readers that still hold it. An empty frame makes an empty
    table. Returns the new location.
    """
    spark = table.spark
    version = fresh_version(table.location)
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = df.write.mode("errorifexists").format("parquet")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with session_conf(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_MONTHS)}):
        writer.save(version)

    previous = current_location(table)
    schema = df.schema
    ordered = T.StructType(
        [f for f in schema.fields if f.name not in partition_cols]
        + [schema[c] for c in partition_cols]
    )
    if previous is not None and _laid_out_as(table, ordered, partition_cols):
        if partition_cols:
            places = versions.month_folders(spark, version)
            versions.point_at(spark, table.qualified, places)
            versions.forget(spark, table.qualified, versions.catalog_months(spark, table.qualified) - set(places))
        spark.sql(f"ALTER TABLE {table.qualified} SET LOCATION '{version}'")
        spark.catalog.refreshTable(table.qualified)
    else:
        table.lake.ensure_namespace(table.layer)
        spark.sql(f"DROP TABLE IF EXISTS {table.qualified}")
        parts = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
        spark.sql(f"CREATE TABLE {table.qualified} ({_ddl(ordered)}) USING parquet{parts} LOCATION '{version}'")
        if partition_cols:
            spark.sql(f"ALTER TABLE {table.qualified} RECOVER PARTITIONS")
    held = {version.rsplit("/", 1)[-1], (previous or "").rstrip("/").rsplit("/", 1)[-1]}
    for name in storage.list_children(spark, table.location):
        if name.startswith(VERSION_PREFIX) and name not in held:
            storage.delete(spark, f"{table.location}/{name}")
    return version
