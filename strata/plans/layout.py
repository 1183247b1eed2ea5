"""File layout: per-partition file statistics, compaction, scan audits.

File facts come from the hidden ``_metadata`` columns of a distributed
scan that reads no data columns (row counts come from Parquet footers /
batches), so the inventory scales with the number of files, not the driver.
"""

from __future__ import annotations

import contextlib
import io
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import marts
from strata.plans import tables, versions
from strata.plans.tables import PARTITION_COLUMN, Table, ensure_write_target
from strata.session import session_conf, shared_scratch
from strata.sources import storage

#: Bytes that opening a file counts as when the files of a task are chosen: small
#: files come some hundred to a task, so that an inventory's shuffle stays narrow.
OPEN_COST_BYTES = 1024 * 1024
#: Files named one by one in a condition, so that a scan opens no others.
LISTED_FILES = 10_000
#: Files whose write task is sent to every task (about 30 bytes each).
BROADCAST_FILES = 1_000_000

STATS_COLUMNS = [
    "table",
    "partition_value",
    "file_count",
    "total_bytes",
    "min_bytes",
    "max_bytes",
    "median_bytes",
    "record_count",
]


def file_inventory(table: Table) -> DataFrame:
    """One row per data file: ``(partition_value, file_path, file_size, record_count)``."""
    return (
        table.read()
        .select(
            F.col(PARTITION_COLUMN).alias("partition_value"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .groupBy("partition_value", "file_path", "file_size")
        .agg(F.count(F.lit(1)).cast("bigint").alias("record_count"))
    )


def partition_file_stats(table: Table, *, table_name: str | None = None, inventory: DataFrame | None = None) -> DataFrame:
    """Per partition: files, bytes (sum/min/max/median) and records, sorted by partition.

    Median of an even number of files is the mean of the middle two,
    truncated to an integer. ``inventory``: the table's, if it is at hand.
    """
    label = table_name or table.qualified
    return (
        (file_inventory(table) if inventory is None else inventory)
        .groupBy("partition_value")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("file_count"),
            F.sum("file_size").cast("bigint").alias("total_bytes"),
            F.min("file_size").cast("bigint").alias("min_bytes"),
            F.max("file_size").cast("bigint").alias("max_bytes"),
            F.percentile(F.col("file_size"), F.lit(0.5)).cast("bigint").alias("median_bytes"),
            F.sum("record_count").cast("bigint").alias("record_count"),
        )
        .select(F.lit(label).alias("table"), *STATS_COLUMNS[1:])
        .orderBy("partition_value")
    )


def collect_layout(layers: dict[str, Table], inventories: dict[str, DataFrame] | None = None) -> DataFrame:
    """Layout of several tables in one frame (``unionByName``). ``inventories``:
    the tables', if they are at hand."""
    known = inventories or {}
    frames = [partition_file_stats(t, table_name=label, inventory=known.get(label)) for label, t in layers.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def pack(sizes: Sequence[int], target_bytes: int) -> list[int]:
    """First-fit-decreasing: the bin of each size, so that no bin of several
    exceeds the target. Bins are numbered in order of opening.

    A tree over the bins holds the most room below each node, so that the first
    bin with room is found in as many steps as the tree is deep.
    """
    leaves = 1 << max(0, len(sizes) - 1).bit_length()
    room = [target_bytes] * (2 * leaves)
    placed = [0] * len(sizes)
    opened = 0
    for at in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        node = 1
        if sizes[at] > target_bytes:  # fits nowhere: a bin of its own
            node = leaves + opened
        while node < leaves:
            node *= 2
            node += room[node] < sizes[at]
        placed[at] = node - leaves
        opened = max(opened, placed[at] + 1)
        room[node] -= sizes[at]
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return placed


def _saved(df: DataFrame, folder: str) -> DataFrame:
    """``df``, one row per file, kept for several jobs."""
    path = f"{folder}/{time.time_ns():020d}"
    with session_conf(df.sparkSession, {"spark.sql.files.openCostInBytes": str(OPEN_COST_BYTES)}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def saved_inventory(table: Table, folder: str) -> DataFrame:
    """``file_inventory`` written to ``folder``, so that every file is opened once."""
    return _saved(file_inventory(table), folder)


def plan_compaction(inventory: DataFrame, target_bytes: int) -> tuple[DataFrame, dict[str, int], int] | None:
    """Bins of two or more files to be made one: ``(partition_value, file_path,
    _task)`` of every file that moves, the files that move by month, and the
    number of write tasks; None if nothing fits together. The files of a month
    with one task number are a bin.

    Files of the target or more never move, nor do rows without a month.
    Metadata only: the driver packs the sizes, the paths stay in the tasks.
    """
    small = inventory.filter((F.col("file_size") < target_bytes) & F.col("partition_value").isNotNull())
    # in order of path, so that equal inventories make equal plans
    files = F.sort_array(F.collect_list(F.struct("file_path", "file_size"))).alias("files")
    by_month = small.groupBy("partition_value").agg(files).filter(F.size("files") > 1)
    numbers: dict[str, list[int | None]] = {}
    bins: dict[str, int] = {}
    for r in by_month.select("partition_value", F.col("files.file_size").alias("sizes")).collect():
        placed = pack(r.sizes, target_bytes)
        held: dict[int, int] = {}
        for number in placed:
            held[number] = held.get(number, 0) + 1
        several = {number: k for k, number in enumerate(n for n in sorted(held) if held[n] > 1)}
        if several:
            numbers[r.partition_value] = [several.get(number) for number in placed]
            bins[r.partition_value] = len(several)
    if not bins:
        return None
    first, tasks = tables.task_numbers(bins, target_bytes)
    dealt = inventory.sparkSession.createDataFrame(
        [(m, [None if k is None else first[m] + k for k in ks]) for m, ks in numbers.items()], "partition_value string, tasks array<int>"
    )
    plan = by_month.join(dealt, "partition_value").select("partition_value", F.inline(F.arrays_zip("files", "tasks")))
    moved = {m: sum(k is not None for k in ks) for m, ks in numbers.items()}
    return plan.filter("tasks is not null").select("partition_value", "files.file_path", F.col("tasks").alias("_task")), moved, tasks


def _rewrite(table: Table, plan: DataFrame, moved: dict[str, int], files: dict[str, int], tasks: int, target_bytes: int) -> list[str]:
    """Write every bin as one file and put it in its files' place; returns the
    names of the new files.

    ``moved`` and ``files``: files of the months that move, and all they have.
    A month all of whose files were in bins is published as a new folder. In a
    month that keeps files where they are, the new files are moved in beside
    them (see ``versions.swap_files``).
    """
    spark = table.spark
    # literal conditions on months and file sizes: other files are not opened
    rows = table.read().filter(F.col(PARTITION_COLUMN).isin(*moved) & (F.col("_metadata.file_size") < target_bytes))
    columns, path = table.read().columns, F.col("_metadata.file_path")
    moving = sum(moved.values())
    if moving <= min(LISTED_FILES, sum(files[m] for m in moved) // 2):  # most files stay
        rows = rows.filter(path.isin([r.file_path for r in plan.select("file_path").collect()]))
    # by a hash of the path, which is shorter, unless two paths share one
    hashed = plan.select(F.count_distinct(F.xxhash64("file_path")) == F.count(F.lit(1))).first()[0]
    key = F.xxhash64 if hashed else (lambda c: c)
    numbers = plan.select(key(F.col("file_path")).alias("_path"), "_task")
    if hashed and moving <= BROADCAST_FILES:  # the rows are shuffled to their files only
        numbers = F.broadcast(numbers)
    rows = rows.select("*", key(path).alias("_path")).join(numbers, "_path")
    version = versions.fresh_version(table.location)
    dealt = tables.deal(rows.select(*columns, "_task"), tasks)
    tables._write_version(
        dealt, version, advisory_bytes=tables.DEFAULT_ADVISORY_BYTES, max_records_per_file=None, rebalance=False, target_bytes=target_bytes
    )
    folders = versions.month_folders(spark, version).values()
    new = [c for folder in folders for c in storage.list_children(spark, folder) if not c.startswith(("_", "."))]

    for month in sorted(m for m in moved if files[m] > moved[m]):
        replaced = [r.file_path for r in plan.filter(F.col("partition_value") == month).select("file_path").collect()]
        versions.swap_files(spark, table.location, f"{version}/{PARTITION_COLUMN}={month}", sorted(replaced))
    versions.publish(spark, table.qualified, table.location, version)
    return new


def compact_partitions(
    table: Table,
    *,
    table_name: str | None = None,
    max_bytes_per_file: int | None = None,
    inventory: DataFrame | None = None,
) -> DataFrame:
    """Make few files of many small ones; rows are unchanged.

    The files of a month are packed into bins of at most ``max_bytes_per_file``
    (default: the table's recorded write target); every bin of several files
    becomes one, and files that are alone in a bin stay where they are. All
    months go by one job, and the new sizes are packed again until nothing fits
    together, so that a later call finds nothing to do. The files are looked at
    once before the first round (unless their saved ``inventory`` is given) and
    only the new ones after each. Returns ``(table, partition_value,
    files_before, files_after, rows, rewritten)`` for every partition.
    """
    spark: SparkSession = table.spark
    label = table_name or table.qualified
    ensure_write_target(table)
    target = max_bytes_per_file or tables.write_target(table)
    finished = versions.finish_swaps(spark, table.location)
    spark.catalog.refreshTable(table.qualified)
    scratch = shared_scratch(spark, "compaction")
    if inventory is None or finished:
        inventory = saved_inventory(table, scratch)

    def stats() -> dict:
        return {r.partition_value: r for r in partition_file_stats(table, table_name=label, inventory=inventory).collect()}

    before = after = stats()
    rewritten: set[str] = set()
    while found := plan_compaction(inventory, target):
        plan, moved, tasks = found
        files = {m: int(r.file_count) for m, r in after.items()}
        plan = _saved(plan, scratch)
        new = _rewrite(table, plan, moved, files, tasks, target)  # each round leaves fewer files
        spark.catalog.refreshTable(table.qualified)
        rewritten |= set(moved)
        found = file_inventory(table)
        if len(new) <= LISTED_FILES:  # the files that stay are known
            stay = inventory.join(plan.select("file_path"), "file_path", "left_anti").select(*inventory.columns)
            found = stay.unionByName(found.filter(F.substring_index("file_path", "/", -1).isin(new)))
        inventory = _saved(found, scratch)
        after = stats()
    storage.delete(spark, scratch)
    rows = [
        (label, m, int(before[m].file_count), int(after[m].file_count), int(after[m].record_count), m in rewritten)
        for m in sorted(after, key=lambda m: m or "")
        if m in before
    ]
    return spark.createDataFrame(
        rows,
        "table string, partition_value string, files_before bigint, files_after bigint, "
        "rows bigint, rewritten boolean",
    )


def benchmark_queries(table: DataFrame, month: str) -> dict[str, DataFrame]:
    """Month-pruned benchmark pair: row count and daily count / mean fare.

    A table without ``pickup_date`` (bronze) only gets the count."""
    out = {"month_count": marts.month_count(table, month)}
    if "pickup_date" in table.columns:
        out["daily_fare"] = marts.daily_fare(table, month)
    return out


def files_read(df: DataFrame) -> int:
    """Distinct data files behind ``df`` after partition pruning."""
    return df.select(F.col("_metadata.file_path")).distinct().count()


def explain_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        df.explain(mode)
    return buffer.getvalue()


def timed(action: Callable[[], object]) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


NODES = "array<struct<depth:int,node:string,rows:bigint,millis:double>>"


def plan_nodes(df: DataFrame) -> list[tuple[int, str, int | None, float | None]]:
    """``(depth, node, rows, millis)`` of every node of the plan that ran for
    ``df`` (call after an action on ``df`` itself; a node that counts no rows or
    takes no time has ``None``). Adaptive plans are followed into their stages."""
    out = []

    def visit(node, depth: int) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan(), depth)
        if kind.endswith("QueryStageExec"):
            return visit(node.plan(), depth)
        rows, millis = None, None
        metrics = node.metrics().iterator()
        while metrics.hasNext():
            entry = metrics.next()
            name, metric = entry._1(), entry._2()
            if name == "numOutputRows":
                rows = int(metric.value())
            elif metric.metricType() in ("timing", "nsTiming"):
                millis = (millis or 0.0) + metric.value() / (1 if metric.metricType() == "timing" else 1e6)
        out.append((depth, str(node.nodeName()).strip(), rows, millis))
        children = node.children()
        for k in range(children.size()):
            visit(children.apply(k), depth + 1)

    visit(df._jdf.queryExecution().executedPlan(), 0)
    return out


def scan_audit(tables: dict[str, Table], month: str, *, queries: Sequence[str] | None = None) -> DataFrame:
    """Per table and benchmark query: files read under the month filter, rows,
    wall seconds of the one run, whether the plan shows a partition filter, the
    plan's text, and rows and time of every node as that run counted them. The
    results are a month's days at most. Bronze lacks ``pickup_date``, so only
    the count runs there."""
    rows = []
    spark = None
    for label, t in tables.items():
        spark = t.spark
        df = t.read()
        pruned = df.filter(F.col(PARTITION_COLUMN) == month)
        nfiles = files_read(pruned)
        for name, q in benchmark_queries(df, month).items():
            if queries and name not in queries:
                continue
            found = []
            secs = timed(lambda q=q, found=found: found.extend(q.collect()))
            plan = explain_text(q)
            rows.append((label, name, month, nfiles, len(found), float(secs), "PartitionFilters" in plan, plan, plan_nodes(q)))
    return spark.createDataFrame(
        rows,
        "table string, query string, trip_month string, files_read bigint, result_rows bigint, "
        f"seconds double, partition_pruned boolean, plan string, nodes {NODES}",
    )


def compact_tables(
    tables: dict[str, Table], *, max_bytes_per_file: int | None = None, inventories: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Compact several tables (bronze and silver) into one report. ``inventories``:
    the tables' saved ones, if they are at hand."""
    known = inventories or {}
    reports = [
        compact_partitions(t, table_name=label, max_bytes_per_file=max_bytes_per_file, inventory=known.get(label))
        for label, t in tables.items()
    ]
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def review(tables: dict[str, Table], month: str, *, compact: bool = True) -> dict[str, DataFrame]:
    """Layout + scan audit, then (optionally) compaction and the same again.

    Returns bounded, already-computed frames: ``layout_before``,
    ``audit_before`` and, when compacting, ``compaction``, ``layout_after``,
    ``audit_after``.
    """
    spark = next(iter(tables.values())).spark

    def snapshot(df: DataFrame) -> DataFrame:
        return spark.createDataFrame(df.collect(), df.schema)

    # one look at the files, for the report and for the compaction
    scratch = shared_scratch(spark, "review")
    inventories = {label: saved_inventory(t, scratch) for label, t in tables.items()}
    out = {
        "layout_before": snapshot(collect_layout(tables, inventories)),
        "audit_before": scan_audit(tables, month),
    }
    if compact:
        out["compaction"] = compact_tables(tables, inventories=inventories)
        out["layout_after"] = snapshot(collect_layout(tables))
        out["audit_after"] = scan_audit(tables, month)
    storage.delete(spark, scratch)
    return out
