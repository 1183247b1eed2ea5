"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Gold-level queries share one lake built from the given tables per content of
the tables and code version (bronze → silver → gold, written under the shared
checkpoint folder, re-attached by later sessions). Maintenance scenarios
(replace, clear, evolve, compact, stream, ...) each build their own scratch
lake, run the scenario, keep the table state it leaves behind (one row per
month or check) and remove the lake again.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import threading
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import serving
from strata.operators import contract as contract_mod
from strata.operators import gold, marts, quality
from strata.operators import rules as rules_mod
from strata.operators import silver as silver_mod
from strata.operators.rules import TABLE_TRIP_LIMITS
from strata.params import (
    BENCH_MONTH,
    CLEARED_MONTHS,
    COARSE_DUP_KEY,
    COMPACT_MAX_RECORDS,
    FILTER_MONTHS,
    LOADED_AT,
    PLAN_END,
    PLAN_START,
    PROCESSED_AT,
    SMALL_FILE_BYTES,
    SMALL_TARGET_BYTES,
    SOURCE_BASE_URL,
    SPLIT_MONTH,
    STAGING_DIR,
    TOP_K,
)
from strata.plans import jobs, layout, tables
from strata.plans.tables import Lake
from strata.session import ensure_checkpoint_dir, shared_scratch
from strata.sources import catalog, months, storage, testdata, trips

LIMITS = TABLE_TRIP_LIMITS
#: Rows of a file that a month is delivered in, about.
DELIVERED_ROWS = 500_000
LAKE_TABLES = ("lineitem", "orders", "nation", "region")
_LOCK = threading.Lock()
_SHARED: dict[tuple[str, str], Lake] = {}


def new_lake(spark: SparkSession, purpose: str) -> Lake:
    return Lake(spark, shared_scratch(spark, purpose), prefix=f"{purpose}_{uuid.uuid4().hex[:8]}_")


@contextlib.contextmanager
def scratch_lake(spark: SparkSession, purpose: str):
    """A lake for one scenario, removed with its tables afterwards."""
    lake = new_lake(spark, purpose)
    try:
        yield lake
    finally:
        for layer in ("gold", "silver", "bronze"):
            spark.sql(f"DROP DATABASE IF EXISTS {lake.namespace(layer)} CASCADE")
        storage.delete(spark, lake.root)


def kept(df: DataFrame) -> DataFrame:
    """A report of one row per month, file or check, held beyond its lake."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def bronze_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.bronze_from_tables(spark, sf_dir, loaded_at=LOADED_AT)


def _code_version() -> str:
    """Hash of the package source: a lake built by other code is never reused."""
    root = Path(__file__).resolve().parent
    digest = hashlib.sha1()
    for path in sorted(p for p in root.rglob("*.py") if p.parent.name != "llm"):
        digest.update(path.relative_to(root).as_posix().encode())
        digest.update(path.read_bytes())
    return digest.hexdigest()[:12]


def _inputs(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the files behind the shared lake: a lake of
    other contents at the same path is never reused."""
    files = [(t, storage.listing(spark, testdata.table_path(sf_dir, t))) for t in LAKE_TABLES]
    return repr(files)


def _pointer(spark: SparkSession, sf_dir: str) -> str:
    tag = hashlib.sha1(f"{sf_dir.rstrip('/')}|{_inputs(spark, sf_dir)}|{_code_version()}".encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark)}/strata/shared/{tag}"


def _reuse(spark: SparkSession, pointer: str) -> Lake | None:
    """Attach a lake an earlier session built from the same tables and code."""
    if not storage.exists(spark, f"{pointer}/_SUCCESS"):
        return None
    row = spark.read.json(pointer).first()
    if row is None or not storage.exists(spark, row.root):
        return None
    lake = Lake(spark, row.root, prefix=row.prefix)
    jobs.attach(lake, limits=LIMITS)
    return lake if spark.catalog.tableExists(lake.table("gold", "fact_trips").qualified) else None


def shared_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Bronze, silver and gold built once per content of the tables and code version.

    Within a session the lake is cached; a later session (another process)
    re-attaches it through a small pointer in the shared checkpoint folder.
    """
    pointer = _pointer(spark, sf_dir)
    key = (spark.sparkContext.applicationId, pointer)
    with _LOCK:
        lake = _SHARED.get(key)
        if lake is not None and spark.catalog.tableExists(lake.table("gold", "fact_trips").qualified):
            return lake
        lake = _reuse(spark, pointer)
        if lake is None:
            lake = new_lake(spark, "lake")
            jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
            jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
            jobs.build_gold(lake, trips.zones_from_tables(spark, sf_dir))
            spark.createDataFrame([(lake.root, lake.prefix)], "root string, prefix string").coalesce(1).write.mode(
                "overwrite"
            ).json(pointer)
        _SHARED[key] = lake
        return lake


def _gold(spark, sf_dir):
    return jobs.gold_tables(shared_lake(spark, sf_dir))


def _silver(spark, sf_dir) -> DataFrame:
    return shared_lake(spark, sf_dir).table("silver", jobs.TRIPS).read()


def _prepared(spark, sf_dir) -> DataFrame:
    return silver_mod.prepared(bronze_frame(spark, sf_dir))


def _projected_all(spark, sf_dir) -> DataFrame:
    return silver_mod.project(_prepared(spark, sf_dir), processed_at=PROCESSED_AT)


def _silver_frame(spark, sf_dir) -> DataFrame:
    cleaned = silver_mod.clean(bronze_frame(spark, sf_dir), LIMITS)
    return silver_mod.project(cleaned, processed_at=PROCESSED_AT)


def _rules():
    return rules_mod.silver_rules(LIMITS)


def _month_rows(df: DataFrame) -> DataFrame:
    return jobs.rows_by_month(df)


# ------------------------------------------------------------------ sources


def q_scan_trips(spark, sf_dir):
    return trips.raw_trips_from_tables(spark, sf_dir)


def q_scan_month(spark, sf_dir):
    return _silver(spark, sf_dir).filter(F.col("trip_month") == BENCH_MONTH)


def q_month_range(spark, sf_dir):
    return months.month_range_of(testdata.read_table(spark, sf_dir, "orders"), "o_orderdate")


def q_month_manifest(spark, sf_dir):
    return months.manifest(q_month_range(spark, sf_dir), base_url=SOURCE_BASE_URL, staging_dir=STAGING_DIR)


def q_register_view(spark, sf_dir):
    lake = shared_lake(spark, sf_dir)
    view = f"{lake.prefix}silver_yellow_taxi_trips"
    catalog.register_view(spark, view, lake.table("silver", jobs.TRIPS).qualified)
    return spark.table(view)


def q_backfill_coverage(spark, sf_dir):
    planned = months.month_range(spark, PLAN_START, PLAN_END)
    return jobs.backfill_coverage(shared_lake(spark, sf_dir), planned)


def q_rows_by_month(spark, sf_dir):
    return _month_rows(shared_lake(spark, sf_dir).table("bronze", jobs.TRIPS).read())


# ------------------------------------------------------------ bronze/silver


def q_bronze_enrich(spark, sf_dir):
    return bronze_frame(spark, sf_dir)


def q_bronze_land(spark, sf_dir):
    return shared_lake(spark, sf_dir).table("bronze", jobs.TRIPS).read()


def q_silver_rename(spark, sf_dir):
    return silver_mod.rename_bronze(trips.raw_trips_from_tables(spark, sf_dir))


def q_trip_duration(spark, sf_dir):
    return silver_mod.derive(trips.event_trips_from_tables(spark, sf_dir))


def q_silver_clean(spark, sf_dir):
    return silver_mod.clean(bronze_frame(spark, sf_dir), LIMITS)


def q_rule_reject_counts(spark, sf_dir):
    return rules_mod.reject_counts(_prepared(spark, sf_dir), _rules())


def q_clean_stats(spark, sf_dir):
    return rules_mod.clean_stats(_prepared(spark, sf_dir), _rules())


def q_stats_by_month(spark, sf_dir):
    return rules_mod.stats_by_month(_prepared(spark, sf_dir), _rules())


def q_silver_project(spark, sf_dir):
    return _silver_frame(spark, sf_dir)


def q_align_schema(spark, sf_dir):
    drifted = _silver_frame(spark, sf_dir).withColumns(
        {"_silver_version": F.col("_silver_version").cast("bigint"), "passenger_count": F.col("passenger_count").cast("double")}
    )
    drifted = drifted.select(list(reversed(drifted.columns)))
    return tables.align(drifted, contract_mod.silver_contract(LIMITS).schema())


def q_silver_evolve(spark, sf_dir):
    """Old months written before the evolution read NULL in the new columns."""
    with scratch_lake(spark, "evolve") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        silver_t = lake.table("silver", jobs.TRIPS)
        lake.ensure_namespace("silver")
        tables.create_table(silver_t, jobs.silver_table_schema(LIMITS))
        old = _silver_frame(spark, sf_dir).filter(F.col("trip_month") < SPLIT_MONTH)
        tables.replace_months(old.drop(*silver_mod.EVOLUTION_COLUMNS), silver_t)
        new_months = [
            r.trip_month
            for r in lake.table("bronze", jobs.TRIPS).read().select("trip_month").distinct().collect()
            if r.trip_month >= SPLIT_MONTH
        ]
        jobs.build_silver(lake, new_months, processed_at=PROCESSED_AT, limits=LIMITS)
        return kept(
            silver_t.read()
            .groupBy("trip_month")
            .agg(
                F.count(F.lit(1)).cast("bigint").alias("rows"),
                F.count_if(F.col("pickup_date").isNull()).cast("bigint").alias("null_pickup_date"),
                F.max("_silver_version").alias("silver_version"),
            )
        )


# ---------------------------------------------------------------- contract


def _contract():
    return contract_mod.silver_contract(LIMITS)


def q_contract_columns(spark, sf_dir):
    rep = contract_mod.report(_projected_all(spark, sf_dir), _contract())
    return rep.filter(F.col("check_name").isin("present", "unexpected", "not_null"))


def q_contract_coerce(spark, sf_dir):
    drifted = _silver_frame(spark, sf_dir).withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("string"),
            "trip_distance": F.col("trip_distance").cast("string"),
            "_silver_version": F.col("_silver_version").cast("bigint"),
        }
    )
    return contract_mod.coerce(drifted, _contract())


def q_contract_nulls(spark, sf_dir):
    return contract_mod.data_failures(_projected_all(spark, sf_dir), _contract()).filter(
        F.col("check_name") == "not_null"
    )


def q_contract_ranges(spark, sf_dir):
    return contract_mod.data_failures(_projected_all(spark, sf_dir), _contract()).filter(
        F.col("check_name").isin("ge", "le")
    )


def q_contract_report(spark, sf_dir):
    return contract_mod.report(_projected_all(spark, sf_dir), _contract())


# ------------------------------------------------------------------- sinks


def _bronze_table(lake: Lake):
    return lake.table("bronze", jobs.TRIPS)


def q_replace_month_rerun(spark, sf_dir):
    with scratch_lake(spark, "rerun") as lake:
        for _ in range(2):
            jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        return kept(_month_rows(_bronze_table(lake).read()))


def q_replace_month_newcount(spark, sf_dir):
    with scratch_lake(spark, "newcount") as lake:
        b = bronze_frame(spark, sf_dir)
        jobs.land_bronze(lake, b.unionByName(b))
        jobs.land_bronze(lake, b)
        return kept(_month_rows(_bronze_table(lake).read()))


def q_replace_month_independent(spark, sf_dir):
    with scratch_lake(spark, "indep") as lake:
        b = bronze_frame(spark, sf_dir)
        jobs.land_bronze(lake, b.filter(F.col("trip_month") < SPLIT_MONTH))
        jobs.land_bronze(lake, b.filter(F.col("trip_month") >= SPLIT_MONTH))
        return kept(_month_rows(_bronze_table(lake).read()))


def q_clear_month(spark, sf_dir):
    with scratch_lake(spark, "clear") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        jobs.clear_months(_bronze_table(lake), CLEARED_MONTHS)
        return kept(_month_rows(_bronze_table(lake).read()))


def q_bronze_run_record(spark, sf_dir):
    """Rows landed per month as the bronze job itself reports them."""
    with scratch_lake(spark, "record") as lake:
        result = jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        return spark.createDataFrame(sorted(result["rows_by_month"].items()), "trip_month string, rows bigint")


def _monthly_files(spark, sf_dir, folder: str, files: int = 2) -> list[str]:
    """The raw trips as delivered: ``files`` Parquet files a month or, of large
    months, more, in folders named for the month."""
    raw = bronze_frame(spark, sf_dir).select(*trips.RAW_COLUMNS, "trip_month")
    dealt = raw.withColumn("delivery", F.pmod(F.xxhash64(*trips.RAW_COLUMNS), F.lit(files)))
    # a task's share is bounded: rebalancing cuts a large month into several files
    dealt.hint("rebalance", "delivery", "trip_month").write.partitionBy("delivery", "trip_month").parquet(folder)
    found = spark.read.parquet(folder).select("_metadata.file_path").distinct().collect()
    return sorted(r.file_path for r in found)  # a few names per month


def q_bronze_from_files(spark, sf_dir):
    """Raw files → bronze, several files a month in one call."""
    with scratch_lake(spark, "files") as lake:
        paths = _monthly_files(spark, sf_dir, f"{lake.root}/delivered")
        record = jobs.land_bronze(lake, jobs.bronze_from_files(spark, paths, loaded_at=LOADED_AT))
        return spark.createDataFrame(sorted(record["rows_by_month"].items()), "trip_month string, rows bigint")


def _silver_rows(lake: Lake) -> DataFrame:
    return _month_rows(lake.table("silver", jobs.TRIPS).read())


def q_silver_replace_month(spark, sf_dir):
    with scratch_lake(spark, "sreplace") as lake:
        b = bronze_frame(spark, sf_dir)
        jobs.land_bronze(lake, b.unionByName(b))
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        jobs.land_bronze(lake, b)
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        return kept(_silver_rows(lake))


def q_silver_empty_bronze_clears(spark, sf_dir):
    with scratch_lake(spark, "sempty") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        jobs.clear_months(_bronze_table(lake), CLEARED_MONTHS)
        jobs.build_silver(lake, CLEARED_MONTHS, processed_at=PROCESSED_AT, limits=LIMITS)
        return kept(_silver_rows(lake))


def q_silver_run_record(spark, sf_dir):
    """The silver job's own record per month, and whether it names its table."""
    with scratch_lake(spark, "srecord") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        record = jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        silver_t = lake.table("silver", jobs.TRIPS)
        named = (F.col("table_name") == silver_t.qualified) & (F.col("table_location") == silver_t.location)
        return record.select("trip_month", "input_rows", "output_rows", "rejected_rows", named.alias("names_table"))


def q_silver_null_month(spark, sf_dir):
    """Trips of the cleared months without times and month: reported as
    rejected under no month, every other month as usual."""
    with scratch_lake(spark, "snull") as lake:
        lost = F.col("trip_month").isin(CLEARED_MONTHS)
        bronze = bronze_frame(spark, sf_dir).withColumns(
            {c: F.when(~lost, F.col(c)) for c in ("tpep_pickup_datetime", "trip_month")}
        )
        jobs.land_bronze(lake, bronze)
        record = jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        return record.select("trip_month", "input_rows", "output_rows", "rejected_rows")


def q_contract_raises(spark, sf_dir):
    """Vendors go missing in landed months: the silver job raises, names the
    failing check, and leaves the silver rows as they were."""
    with scratch_lake(spark, "raises") as lake:
        b = bronze_frame(spark, sf_dir)
        jobs.land_bronze(lake, b)
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        broken = b.filter(F.col("trip_month").isin(FILTER_MONTHS)).withColumn("VendorID", F.lit(None).cast("bigint"))
        jobs.land_bronze(lake, broken)
        try:
            jobs.build_silver(lake, FILTER_MONTHS, processed_at=PROCESSED_AT, limits=LIMITS)
            failures = []
        except contract_mod.ContractError as error:
            failures = error.failures
        rows = lake.table("silver", jobs.TRIPS).read().count()
        found = [(c, k, int(n), rows) for c, k, n in failures]
        return spark.createDataFrame(found, "column_name string, check_name string, failures bigint, silver_rows bigint")


def q_stale_months(spark, sf_dir):
    """After a full build one month is landed again twice over, one is cleared
    and one is landed for the first time: these three, and no other, are stale."""
    with scratch_lake(spark, "stale") as lake:
        b = bronze_frame(spark, sf_dir)
        first, *_, last = CLEARED_MONTHS
        jobs.land_bronze(lake, b.filter(F.col("trip_month") != first))
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        changed = b.filter(F.col("trip_month") == SPLIT_MONTH)
        jobs.land_bronze(lake, changed.unionByName(changed))
        jobs.land_bronze(lake, b.filter(F.col("trip_month") == first))
        jobs.clear_months(_bronze_table(lake), [last])
        found = kept(jobs.stale_months(lake))
        jobs.build_silver(lake, [r.trip_month for r in found.collect()], processed_at=PROCESSED_AT, limits=LIMITS)
        left = jobs.stale_months(lake).count()
        return found.withColumn("left_after_build", F.lit(left).cast("bigint"))


def q_write_sized_files(spark, sf_dir):
    """Bronze rows of very unequal width under a small byte budget: every file,
    measured here in its own way, holds less than the budget and one row, and
    no month has more files than its bytes fill."""
    with scratch_lake(spark, "sized") as lake:
        wide = F.repeat(F.lit("w"), F.pmod(F.xxhash64("total_amount", "tpep_pickup_datetime"), F.lit(13)).cast("int") * 40)
        jobs.land_bronze(
            lake, bronze_frame(spark, sf_dir).withColumn("store_and_fwd_flag", wide), target_bytes=SMALL_TARGET_BYTES
        )
        texts = ("store_and_fwd_flag", "trip_month", "_loaded_at", "_source_file")
        fixed = 8 * (len(trips.RAW_COLUMNS) + 3 - len(texts))
        width = sum((F.octet_length(c) for c in texts), F.lit(fixed))
        files = _bronze_table(lake).read().groupBy("trip_month", "_metadata.file_path").agg(
            F.count(F.lit(1)).alias("n"), F.sum(width).alias("bytes"), F.max(width).alias("widest")
        )
        return kept(
            files.groupBy("trip_month").agg(
                F.sum("n").cast("bigint").alias("rows"),
                F.bool_and(F.col("bytes") < SMALL_TARGET_BYTES + F.col("widest")).alias("within_budget"),
                (F.count(F.lit(1)) <= F.ceil(F.sum("bytes") / SMALL_TARGET_BYTES)).alias("no_more_than_needed"),
            )
        )


def q_table_properties(spark, sf_dir):
    """The write target a landed table records, and that its files keep it."""
    t = _bronze_table(shared_lake(spark, sf_dir))
    target = tables.write_target(t)
    return layout.file_inventory(t).agg(
        F.lit(target).cast("bigint").alias("target_bytes"),
        F.count_if(F.col("file_size") > target).cast("bigint").alias("files_above"),
        F.sum("record_count").cast("bigint").alias("rows"),
    )


def q_compact_partitions(spark, sf_dir):
    with scratch_lake(spark, "compact") as lake:
        t = _bronze_table(lake)
        lake.ensure_namespace("bronze")
        b = bronze_frame(spark, sf_dir)
        tables.create_table(t, b.schema)
        tables.replace_months(b, t, max_records_per_file=COMPACT_MAX_RECORDS)
        return layout.compact_partitions(t).drop("table")


def q_compact_settles(spark, sf_dir):
    """Months above the size bound: compacted to what the bound needs, and a
    second run rewrites nothing."""
    with scratch_lake(spark, "settle") as lake:
        t = _bronze_table(lake)
        lake.ensure_namespace("bronze")
        b = bronze_frame(spark, sf_dir)
        tables.create_table(t, b.schema)
        tables.replace_months(b, t, max_records_per_file=COMPACT_MAX_RECORDS)
        first = layout.compact_partitions(t, max_bytes_per_file=SMALL_FILE_BYTES)
        second = layout.compact_partitions(t, max_bytes_per_file=SMALL_FILE_BYTES).select(
            "partition_value", F.col("rewritten").alias("rewritten_again"), F.col("files_after").alias("files")
        )
        return kept(
            first.join(second, "partition_value").select(
                "partition_value",
                "rows",
                (F.col("files_after") <= F.col("files_before")).alias("not_more_files"),
                (F.col("files") == F.col("files_after")).alias("settled"),
                "rewritten_again",
            )
        )


def q_compact_bins(spark, sf_dir):
    """Small files packed up to a size: a file of that size or more keeps its
    path, nothing that is left fits together, and no new file is above it."""
    with scratch_lake(spark, "bins") as lake:
        t = _bronze_table(lake)
        lake.ensure_namespace("bronze")
        b = bronze_frame(spark, sf_dir)
        tables.create_table(t, b.schema)
        tables.replace_months(b, t, max_records_per_file=COMPACT_MAX_RECORDS)
        inventory = layout.saved_inventory(t, f"{lake.root}/files-before")  # every file is opened once
        before = inventory.select("file_path", F.col("file_size").alias("size_before"))
        target = before.agg(F.max("size_before")).first()[0]  # the largest file is not to be touched
        layout.compact_partitions(t, max_bytes_per_file=target, inventory=inventory)
        after = layout.saved_inventory(t, f"{lake.root}/files-after").join(before, "file_path", "left")
        in_order = F.sort_array(F.collect_list("file_size"))
        large_before = before.filter(F.col("size_before") >= target).count()
        large_kept = after.filter(F.col("size_before") >= target).count()
        return kept(
            after.groupBy(F.col("partition_value").alias("trip_month")).agg(
                F.sum("record_count").cast("bigint").alias("rows"),
                F.coalesce(F.get(in_order, F.lit(0)) + F.get(in_order, F.lit(1)) > target, F.lit(True)).alias("nothing_fits"),
                (F.max("file_size") <= target).alias("none_above"),
                F.lit(large_before == large_kept > 0).alias("large_stay"),
            )
        )


def q_month_swap(spark, sf_dir):
    """A run that ends after two of its months were pointed at their new rows
    (every landed month twice over): each month is whole, old or new; the
    run after it finishes the rest."""
    from strata.plans import versions

    with scratch_lake(spark, "swap") as lake:
        b, t = bronze_frame(spark, sf_dir), _bronze_table(lake)
        jobs.land_bronze(lake, b)
        staged = tables.stage_months(b.unionByName(b), t)
        storage.write_bytes(spark, f"{staged.path}/{versions.PUBLISHED}", b"")
        places = versions.month_folders(spark, staged.path)
        versions.point_at(spark, t.qualified, {m: places[m] for m in sorted(places)[:2]})
        cut = kept(_month_rows(t.read()).withColumnRenamed("rows", "rows_when_cut"))
        jobs.land_bronze(lake, b.filter(F.col("trip_month") == BENCH_MONTH))
        return kept(_month_rows(t.read()).join(cut, "trip_month"))


def q_compact_tables(spark, sf_dir):
    """Both layers compacted in one call."""
    with scratch_lake(spark, "both") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir), target_bytes=SMALL_TARGET_BYTES)
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS, target_bytes=SMALL_TARGET_BYTES)
        report = layout.compact_tables(_both_layers(lake))
        return kept(report.select("table", "partition_value", "files_after", "rows"))


def q_compact_skips_single(spark, sf_dir):
    with scratch_lake(spark, "single") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        return layout.compact_partitions(_bronze_table(lake)).drop("table")


def _both_layers(lake: Lake) -> dict:
    return {
        "bronze.yellow_taxi_trips": _bronze_table(lake),
        "silver.yellow_taxi_trips": lake.table("silver", jobs.TRIPS),
    }


def _file_stats(spark, sf_dir):
    return layout.collect_layout(_both_layers(shared_lake(spark, sf_dir)))


def q_partition_file_stats(spark, sf_dir):
    """Layout of both layers; byte columns, which depend on the writer, as the
    relations that must hold between them (one file a month here)."""
    one = (F.col("min_bytes") == F.col("max_bytes")) & (F.col("median_bytes") == F.col("min_bytes"))
    return _file_stats(spark, sf_dir).select(
        "table",
        "partition_value",
        "file_count",
        "record_count",
        (one & (F.col("total_bytes") == F.col("median_bytes")) & (F.col("total_bytes") > 0)).alias("bytes_agree"),
    )


def q_file_stats_median(spark, sf_dir):
    """Months of one to several files: the report's median against the middle of
    the sorted sizes, of an even number the truncated mean of the middle two."""
    with scratch_lake(spark, "median") as lake:
        t = _bronze_table(lake)
        lake.ensure_namespace("bronze")
        b = bronze_frame(spark, sf_dir)
        tables.create_table(t, b.schema)
        tables.replace_months(b, t, max_records_per_file=COMPACT_MAX_RECORDS)
        inventory = layout.saved_inventory(t, f"{lake.root}/files")  # every file is opened once
        in_order = F.sort_array(F.collect_list("file_size"))
        sizes = inventory.groupBy("partition_value").agg(in_order.alias("s"))
        n = F.size("s")
        low, high = F.get("s", F.floor((n - 1) / 2).cast("int")), F.get("s", F.floor(n / 2).cast("int"))
        report = layout.partition_file_stats(t, inventory=inventory).join(sizes, "partition_value")
        return kept(
            report.select(
                "partition_value",
                "file_count",
                "record_count",
                (F.col("median_bytes") == F.floor((low + high) / 2)).alias("median_agrees"),
            )
        )


def q_partition_file_counts(spark, sf_dir):
    """Per-partition file and record counts of bronze and silver (the byte
    columns of the layout report left out, so the counts can be checked)."""
    return _file_stats(spark, sf_dir).select("table", "partition_value", "file_count", "record_count")


def q_scan_audit(spark, sf_dir):
    """Files read, result rows and pruning of the benchmark pair on both layers
    (its times and plan texts are left to the review)."""
    audit = layout.scan_audit(_both_layers(shared_lake(spark, sf_dir)), BENCH_MONTH)
    return audit.select("table", "query", "trip_month", "files_read", "result_rows", "partition_pruned")


def q_scan_audit_rows(spark, sf_dir):
    """Rows that the scans and the whole plans of the benchmark pair gave, as
    the executed plans counted them."""
    audit = layout.scan_audit(_both_layers(shared_lake(spark, sf_dir)), BENCH_MONTH)
    scans = F.filter("nodes", lambda n: n.node.startswith("Scan") & n.rows.isNotNull())
    timed = F.exists("nodes", lambda n: n.millis.isNotNull())
    return audit.select(
        "table",
        "query",
        F.aggregate(scans, F.lit(0).cast("bigint"), lambda total, n: total + n.rows).alias("scanned_rows"),
        "result_rows",
        timed.alias("timed"),
    )


def q_layout_review(spark, sf_dir):
    """Before and after: files of the month that the benchmark pair reads."""
    with scratch_lake(spark, "review") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir), target_bytes=SMALL_TARGET_BYTES)
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        review = layout.review({"bronze.yellow_taxi_trips": _bronze_table(lake)}, BENCH_MONTH)
        before, after = (
            review[f"audit_{when}"].select("table", "query", "result_rows", F.col("files_read").alias(when))
            for when in ("before", "after")
        )
        return kept(
            before.join(after, ["table", "query", "result_rows"]).select(
                "table", "query", "result_rows", (F.col("before") > 1).alias("several_before"), F.col("after").alias("files_after")
            )
        )


def q_stream_landing(spark, sf_dir):
    """Several files a month in a landing folder, drained by the file stream in
    micro-batches that cut through months."""
    from strata.streaming.landing import start_landing

    with scratch_lake(spark, "stream") as lake:
        landing = f"{lake.root}/landing"
        files = _monthly_files(spark, sf_dir, landing)
        query = start_landing(
            lake, landing, checkpoint=f"{lake.root}/landing-checkpoint", loaded_at=LOADED_AT,
            max_files_per_trigger=max(1, len(files) // 4 + 1),
        )
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(str(query.exception()))
        return kept(_month_rows(_bronze_table(lake).read()))


def q_stream_redelivered(spark, sf_dir):
    """A month's file delivered again under its path, with every trip twice,
    after the stream has landed it: the next drain lands the new rows."""
    from strata.streaming.landing import start_landing

    with scratch_lake(spark, "again") as lake:
        landing = f"{lake.root}/landing"
        raw = bronze_frame(spark, sf_dir).filter(F.col("trip_month").isin(FILTER_MONTHS)).select(*trips.RAW_COLUMNS, "trip_month")
        storage.mkdirs(spark, landing)

        def deliver(rows: DataFrame, folder: str) -> None:
            """The rows as files of a month, a part of about ``DELIVERED_ROWS`` rows each,
            in place of files of the same names."""
            rows.repartitionById(parts * len(FILTER_MONTHS), at).write.partitionBy("trip_month", "part").parquet(folder)
            for month in (c for c in storage.list_children(spark, folder) if c.startswith("trip_month=")):
                for part in storage.list_children(spark, f"{folder}/{month}"):
                    (file,) = [c for c in storage.list_children(spark, f"{folder}/{month}/{part}") if c.endswith(".parquet")]
                    name = f"{landing}/yellow_tripdata_{month.split('=')[1]}_{part.split('=')[1]}.parquet"
                    storage.delete(spark, name)
                    storage.rename(spark, f"{folder}/{month}/{part}/{file}", name)

        most = max((r.rows for r in _month_rows(raw).collect()), default=0)
        parts = max(1, -(-most // DELIVERED_ROWS))
        raw = raw.withColumn("part", F.pmod(F.xxhash64(*trips.RAW_COLUMNS), F.lit(parts)).cast("int"))
        at = (F.array_position(F.lit(FILTER_MONTHS), F.col("trip_month")) - 1).cast("int") * parts + F.col("part")

        def drain():
            query = start_landing(lake, landing, checkpoint=f"{lake.root}/landing-checkpoint", loaded_at=LOADED_AT)
            query.awaitTermination()

        deliver(raw, f"{lake.root}/out/first")
        drain()
        again = raw.filter(F.col("trip_month") == FILTER_MONTHS[0])
        deliver(again.unionByName(again), f"{lake.root}/out/again")
        drain()
        return kept(_month_rows(_bronze_table(lake).read()))


def q_backfill_files(spark, sf_dir):
    """Bronze and silver of the planned months from delivered files, the range
    taken from the environment."""
    with scratch_lake(spark, "backfill") as lake, _environment(
        {months.START_ENV: PLAN_START, months.END_ENV: PLAN_END}
    ):
        paths = jobs.paths_by_month(_monthly_files(spark, sf_dir, f"{lake.root}/delivered"))
        record = jobs.backfill_files(lake, paths, limits=LIMITS)
        return record.select("trip_month", "input_rows", "output_rows", "rejected_rows")


@contextlib.contextmanager
def _environment(values: dict[str, str]):
    before = {k: os.environ.get(k) for k in values}
    os.environ.update(values)
    try:
        yield
    finally:
        for k, v in before.items():
            os.environ.pop(k) if v is None else os.environ.__setitem__(k, v)


# -------------------------------------------------------------------- gold


def q_stg_trips(spark, sf_dir):
    lake = shared_lake(spark, sf_dir)
    return spark.table(f"{lake.namespace('gold')}.{jobs.STAGING_VIEW}")


def q_dup_rank(spark, sf_dir):
    return gold.dup_rank(q_stg_trips(spark, sf_dir), COARSE_DUP_KEY)


def q_dup_rank_skew_safe(spark, sf_dir):
    """The same key with the pickup time alone: groups of many rows, cut into
    pieces by range."""
    return gold.dup_rank(q_stg_trips(spark, sf_dir), ["pickup_datetime"])


def q_dup_rank_histogram(spark, sf_dir):
    ranked = q_dup_rank(spark, sf_dir)
    return ranked.groupBy("trip_dup_rank").agg(F.count(F.lit(1)).cast("bigint").alias("rows"))


def q_surrogate_key(spark, sf_dir):
    fact, _, _ = _gold(spark, sf_dir)
    return fact.select("trip_sk", "pickup_datetime", "dropoff_datetime", "vendor_id", "total_amount")


def q_fact_trips(spark, sf_dir):
    return _gold(spark, sf_dir)[0]


def q_dim_zone(spark, sf_dir):
    return _gold(spark, sf_dir)[1]


def q_dim_date(spark, sf_dir):
    return _gold(spark, sf_dir)[2]


def q_dim_zone_seed(spark, sf_dir):
    """Zone dimension from a seed CSV file."""
    folder = shared_scratch(spark, "seed")
    trips.zones_from_tables(spark, sf_dir).write.option("header", True).csv(folder)
    found = gold.dim_zone(trips.read_zone_seed(spark, folder))
    return found


def q_dim_date_empty(spark, sf_dir):
    return gold.dim_date(q_stg_trips(spark, sf_dir).filter(F.col("trip_month").isNull()))


def q_gold_of_empty_silver(spark, sf_dir):
    """Silver landed, then cleared: the gold tables exist and are empty but for
    the zones."""
    with scratch_lake(spark, "gempty") as lake:
        record = jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        jobs.clear_months(_bronze_table(lake), record["months_written"])
        jobs.build_silver(lake, record["months_written"], processed_at=PROCESSED_AT, limits=LIMITS)
        jobs.build_gold(lake, trips.zones_from_tables(spark, sf_dir))
        fact, zones, dates = (t.count() for t in jobs.gold_tables(lake))
        return spark.createDataFrame(
            [(fact, zones, dates, record["rows"])], "fact_rows bigint, zone_rows bigint, date_rows bigint, landed_rows bigint"
        )


def q_open_gold(spark, sf_dir):
    """Opening a lake: fails clearly without gold tables, else gives the fact."""
    empty = new_lake(spark, "unopened")
    try:
        serving.open_gold(spark, empty.root, empty.prefix)
        failed = False
    except FileNotFoundError:
        failed = True
    lake = shared_lake(spark, sf_dir)
    opened = serving.open_gold(spark, lake.root, lake.prefix)
    return jobs.gold_tables(opened)[0].agg(
        F.lit(failed).alias("missing_fails"), F.count(F.lit(1)).cast("bigint").alias("fact_rows")
    )


def q_gold_tables_present(spark, sf_dir):
    lake = shared_lake(spark, sf_dir)
    ns = catalog.gold_namespace(spark, prefix=lake.prefix)
    present = catalog.gold_tables_present(spark, ns)
    n_tables = sum(spark.catalog.tableExists(f"{ns}.{t}") for t in catalog.GOLD_TABLES)
    fact = lake.table("gold", "fact_trips").read()
    return fact.agg(F.count(F.lit(1)).cast("bigint").alias("fact_rows")).select(
        F.lit(present).alias("tables_present"), F.lit(n_tables).cast("bigint").alias("table_count"), "fact_rows"
    )


# ----------------------------------------------------------------- quality


def _seed(spark, sf_dir):
    return trips.zones_from_tables(spark, sf_dir)


def q_dq_unique(spark, sf_dir):
    fact, zones, dates = _gold(spark, sf_dir)
    return (
        quality.unique_failures(dates, "date_key", model="dim_date")
        .unionByName(quality.unique_failures(zones, "zone_key", model="dim_zone"))
        .unionByName(quality.unique_failures(fact, "trip_sk", model="fact_trips"))
        .unionByName(quality.unique_failures(_seed(spark, sf_dir), "LocationID", model="taxi_zone_lookup"))
    )


def q_dq_not_null(spark, sf_dir):
    fact, zones, dates = _gold(spark, sf_dir)
    return (
        quality.not_null_failures(dates, ["date_key", "year"], model="dim_date")
        .unionByName(quality.not_null_failures(zones, ["zone_key", "borough", "zone_name"], model="dim_zone"))
        .unionByName(quality.not_null_failures(fact, ["trip_sk", "date_key", "total_amount"], model="fact_trips"))
        .unionByName(quality.not_null_failures(_seed(spark, sf_dir), ["LocationID"], model="taxi_zone_lookup"))
    )


def q_gold_test_report(spark, sf_dir):
    """The 16 tests as the gold job runs them after building its models."""
    with scratch_lake(spark, "gtests") as lake:
        jobs.land_bronze(lake, bronze_frame(spark, sf_dir))
        jobs.build_silver(lake, processed_at=PROCESSED_AT, limits=LIMITS)
        return kept(jobs.run_gold(lake, trips.zones_from_tables(spark, sf_dir), fail_on_error=False))


def q_dq_relationships_date(spark, sf_dir):
    fact, _, dates = _gold(spark, sf_dir)
    return quality.relationship_failures(fact, "date_key", dates, "date_key", model="fact_trips")


def q_dq_relationships_pickup(spark, sf_dir):
    fact, zones, _ = _gold(spark, sf_dir)
    return quality.relationship_failures(fact, "pickup_zone_key", zones, "zone_key", model="fact_trips")


def q_dq_relationships_dropoff(spark, sf_dir):
    fact, zones, _ = _gold(spark, sf_dir)
    return quality.relationship_failures(fact, "dropoff_zone_key", zones, "zone_key", model="fact_trips")


# ------------------------------------------------------------------- marts


def _fact(spark, sf_dir):
    return _gold(spark, sf_dir)[0]


def q_list_trip_months(spark, sf_dir):
    return marts.list_trip_months(_fact(spark, sf_dir))


def q_latest_month_default(spark, sf_dir):
    return marts.latest_month(_fact(spark, sf_dir))


def q_daily_trip_volume(spark, sf_dir):
    return marts.daily_trip_volume(_fact(spark, sf_dir))


def q_monthly_revenue(spark, sf_dir):
    return marts.monthly_revenue(_fact(spark, sf_dir))


def q_top_pickup_zones(spark, sf_dir):
    fact, zones, _ = _gold(spark, sf_dir)
    return marts.top_pickup_zones(fact, zones, limit=TOP_K)


def q_trips_by_payment_type(spark, sf_dir):
    return marts.trips_by_payment_type(_fact(spark, sf_dir))


def q_payment_labels(spark, sf_dir):
    return marts.payment_mix(_fact(spark, sf_dir))


def q_zone_labels(spark, sf_dir):
    fact, zones, _ = _gold(spark, sf_dir)
    return marts.zone_labels(fact, zones, limit=TOP_K)


def q_avg_fare_by_dow(spark, sf_dir):
    fact, _, dates = _gold(spark, sf_dir)
    return marts.avg_fare_by_day_of_week(fact, dates)


def q_dashboard_kpis(spark, sf_dir):
    return marts.dashboard_kpis(_fact(spark, sf_dir), FILTER_MONTHS)


def q_month_filter_subset(spark, sf_dir):
    return marts.daily_trip_volume(_fact(spark, sf_dir), FILTER_MONTHS)


def q_month_filter_empty(spark, sf_dir):
    return marts.monthly_revenue(_fact(spark, sf_dir), [])


def q_bench_month_count(spark, sf_dir):
    return marts.month_count(_silver(spark, sf_dir), BENCH_MONTH)


def q_bench_daily_fare(spark, sf_dir):
    return marts.daily_fare(_silver(spark, sf_dir), BENCH_MONTH)


def _utc(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Run with the session clock on UTC (lineage stamps and date rendering
    of naive timestamps must not depend on the host zone)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: _utc(fn) for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}

# Queries without a statement (checked by row count only): none.
ROWS_ONLY: set[str] = set()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw tables → clean → contract → fact → top pickup zones."""
    return QUERIES["top_pickup_zones"](spark, sf_dir)
