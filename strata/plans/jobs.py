"""Layer jobs: bronze landing, silver transform, gold build and checks.

Every job handles a whole month range in ONE Spark job per step (the month
is a column, not a driver loop). Only bounded metadata reaches the driver:
per-month statistics and contract counts (one row per month / per check).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.calendar import month_key
from strata.operators import contract as contract_mod
from strata.operators import gold, quality
from strata.operators import silver as silver_mod
from strata.operators.marts import month_filter
from strata.operators.rules import TripLimits, all_pass, silver_rules
from strata.plans import versions
from strata.plans.layout import file_inventory
from strata.plans.tables import (
    WRITE_TARGET_FILE_SIZE_BYTES,
    WRITE_TARGET_PROPERTY,
    Lake,
    Table,
    create_table,
    discard,
    drop_months,
    ensure_write_target,
    evolve,
    latest_version,
    overwrite_table,
    publish,
    replace_months,
    stage_months,
)
from strata.sources import months as months_mod
from strata.sources import storage
from strata.sources.trips import (
    RAW_COLUMNS,
    month_file_name,
    raw_trips_from_tables,
    re_month,
    read_raw_files,
)

TRIPS = "yellow_taxi_trips"
STAGING_VIEW = "stg_yellow_taxi_trips"


def utc_now_iso() -> str:
    return datetime.now(tz=timezone.utc).isoformat()


# ---------------------------------------------------------------- bronze


def enrich(raw: DataFrame, *, trip_month: Column, source_file: Column, loaded_at: str) -> DataFrame:
    """Raw columns + ``trip_month``, ``_loaded_at`` (ISO string), ``_source_file``."""
    return raw.select(
        *RAW_COLUMNS,
        trip_month.alias("trip_month"),
        F.lit(loaded_at).alias("_loaded_at"),
        source_file.alias("_source_file"),
    )


def bronze_from_tables(spark: SparkSession, sf_dir: str, *, loaded_at: str) -> DataFrame:
    raw = raw_trips_from_tables(spark, sf_dir)
    m = month_key(F.col("tpep_pickup_datetime"))
    return enrich(raw, trip_month=m, source_file=month_file_name(m), loaded_at=loaded_at)


def bronze_from_files(spark: SparkSession, paths: Sequence[str], *, loaded_at: str) -> DataFrame:
    raw = read_raw_files(spark, paths)
    return enrich(
        raw, trip_month=F.col("_file_month"), source_file=F.col("_file_path"), loaded_at=loaded_at
    )


def rows_by_month(df: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    return (
        month_filter(df, trip_months)
        .groupBy("trip_month")
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
    )


def land_bronze(
    lake: Lake,
    bronze: DataFrame,
    *,
    months: Sequence[str] | None = None,
    target_bytes: int | None = None,
) -> dict[str, object]:
    """Create the table if needed and replace the given months (all present
    months when ``months`` is None). Idempotent: re-running lands the same rows.

    The result holds ``rows``, ``months_written``, ``months_cleared``, the table
    and its location, and ``rows_by_month`` as the table now has them."""
    table = lake.table("bronze", TRIPS)
    if months is not None and not months:  # an empty month list lands nothing
        return {"rows": 0, "months_written": [], "months_cleared": [], "table": table.qualified,
                "table_location": table.location, "rows_by_month": {}}
    lake.ensure_namespace("bronze")
    create_table(
        table, bronze.schema, properties={WRITE_TARGET_PROPERTY: str(WRITE_TARGET_FILE_SIZE_BYTES)}
    )
    ensure_write_target(table)
    scoped = month_filter(bronze, months)
    result = replace_months(scoped, table, months=months, target_bytes=target_bytes)
    landed = _rows_written(table, result["months_written"], result["rows_by_month"])
    return {
        **result,
        "table": table.qualified,
        "table_location": table.location,
        "rows_by_month": landed | {m: 0 for m in result["months_cleared"]},
    }


def _rows_written(table: Table, written: Sequence[str], known: Mapping[str | None, int] | None) -> dict[str, int]:
    """Rows of the months written: as the write knows them, else counted from
    file footers (no column is read)."""
    if known is not None or not written:
        return {m: known[m] for m in written}
    return {r.trip_month: int(r.rows) for r in rows_by_month(table.read(), written).collect()}


# ---------------------------------------------------------------- silver

RUN_RECORD = (
    "trip_month string, input_rows bigint, output_rows bigint, rejected_rows bigint, "
    "table_name string, table_location string"
)


def silver_table_schema(limits: TripLimits = TripLimits()) -> T.StructType:
    """Schema the silver table is FIRST created with (no evolution columns)."""
    return contract_mod.silver_contract(limits).schema(exclude=silver_mod.EVOLUTION_COLUMNS)


EVOLVED_COLUMNS: dict[str, T.DataType] = {"pickup_date": T.DateType(), "_silver_version": T.IntegerType()}


def silver_frames(
    bronze: DataFrame,
    *,
    processed_at: str,
    limits: TripLimits = TripLimits(),
    silver_version: int = silver_mod.SILVER_SCHEMA_VERSION,
) -> tuple[DataFrame, Column]:
    """Projected (unfiltered) silver rows and the rule conjunction."""
    prepared = silver_mod.prepared(bronze)
    projected = silver_mod.project(prepared, processed_at=processed_at, silver_version=silver_version)
    return projected, all_pass(silver_rules(limits))


def silver_month_checks(projected: DataFrame, kept: Column, contract: contract_mod.Contract) -> DataFrame:
    """ONE aggregation per month: rows in, rows kept, and every contract
    data check counted over the kept rows (so stats and validation share
    one scan of bronze)."""
    checks = contract_mod.data_checks(projected, contract)
    # The rule conjunction is materialised once as a column; inlined, the
    # optimizer would re-evaluate it inside every check.
    flagged = projected.withColumn("_kept", kept)
    k = F.col("_kept")
    return flagged.groupBy("trip_month").agg(
        F.count(F.lit(1)).cast("bigint").alias("input_rows"),
        F.count_if(k).cast("bigint").alias("output_rows"),
        *[F.count_if(k & cond).cast("bigint").alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)],
    )


def _contract_failures(
    projected: DataFrame, kept: Column, contract: contract_mod.Contract
) -> list[tuple[str, str, int]]:
    """Which checks failed and how often, after a write that failed its audit."""
    checks = contract_mod.data_checks(projected, contract)
    per_month = silver_month_checks(projected, kept, contract).collect()  # one row per month
    totals = [sum(int(r[f"c{i}"]) for r in per_month) for i in range(len(checks))]
    return [(col, kind, n) for (col, kind, _), n in zip(checks, totals, strict=True) if n]


def build_silver(
    lake: Lake,
    months: Sequence[str] | None = None,
    *,
    processed_at: str | None = None,
    limits: TripLimits = TripLimits(),
    on_all_rejected: str = "keep",
    silver_version: int = silver_mod.SILVER_SCHEMA_VERSION,
    target_bytes: int | None = None,
) -> DataFrame:
    """Bronze months → silver months; returns the run record ``(trip_month,
    input_rows, output_rows, rejected_rows, table_name, table_location)``.

    * a requested month with no bronze rows clears its silver month;
    * a month whose rows are ALL rejected keeps its previous silver rows
      (``on_all_rejected='keep'``) or is cleared (``'clear'``);
    * any contract failure raises before anything is written; a kept row
      without a month is one (``trip_month:not_null``), rejected rows without a
      month are reported under a NULL month.
    """
    if on_all_rejected not in ("keep", "clear"):
        raise ValueError("on_all_rejected must be 'keep' or 'clear'")
    spark = lake.spark
    if months is not None and not months:  # an empty month list transforms nothing
        return spark.createDataFrame([], RUN_RECORD)
    bronze_t, silver_t = lake.table("bronze", TRIPS), lake.table("silver", TRIPS)
    contract = contract_mod.silver_contract(limits)
    stamp = processed_at or utc_now_iso()
    scoped = month_filter(bronze_t.read(), months)
    projected, kept = silver_frames(scoped, processed_at=stamp, limits=limits, silver_version=silver_version)

    structural = [f for f in contract_mod.structure_failures(projected, contract) if f[2]]
    if structural:
        raise contract_mod.ContractError(contract.name, structural)
    # Write, audit, publish: the rows kept are written aside in one scan of
    # bronze, the same job counts those that break the contract, and nothing
    # is published if there are any. Rows per month come from file footers.
    bad = reduce(or_, (F.coalesce(c, F.lit(False)) for _, _, c in contract_mod.data_checks(projected, contract)))
    lake.ensure_namespace("silver")
    create_table(silver_t, silver_table_schema(limits))
    evolve(silver_t, EVOLVED_COLUMNS)
    spark.catalog.refreshTable(silver_t.qualified)
    # taken first: bronze files that come later leave their month stale
    sources = month_filter(month_fingerprints(bronze_t), months).collect()
    rows = projected.filter(kept).withColumn("_bad", bad)
    staged = stage_months(
        contract_mod.coerce(rows, contract, keep=("_bad",)), silver_t, target_bytes=target_bytes, audit={"bad": F.col("_bad")}
    )
    if staged.counts["bad"]:
        discard(silver_t, staged)
        raise contract_mod.ContractError(contract.name, _contract_failures(projected, kept, contract))
    landed = {r.trip_month: int(r.rows) for r in sources}
    written = publish(silver_t, staged)
    out_rows = _rows_written(silver_t, written, staged.by_month)
    stats = {m: (n, out_rows.get(m, 0)) for m, n in landed.items()}
    empty = sorted(set(months or []) - set(stats))
    all_rejected = sorted(m for m, (i, o) in stats.items() if m is not None and i > 0 and o == 0)
    to_clear = empty + (all_rejected if on_all_rejected == "clear" else [])
    if to_clear:
        drop_months(silver_t, to_clear)
    done = [(r.trip_month, r.fingerprint) for r in sources if r.trip_month is not None] + [(m, "") for m in empty]
    if done:
        record_built(lake, spark.createDataFrame(done, "trip_month string, fingerprint string"))

    where = (silver_t.qualified, silver_t.location)
    out = [(m, i, o, i - o, *where) for m, (i, o) in stats.items()] + [(m, 0, 0, 0, *where) for m in empty]
    return spark.createDataFrame(sorted(out, key=lambda r: (r[0] is not None, r[0] or "")), RUN_RECORD)


# ---------------------------------------------------------------- gold


def staging_sql(silver_table: str) -> str:
    cols = ", ".join("`_source_file` AS source_file" if c == "source_file" else f"`{c}`" for c in gold.STAGING_COLUMNS)
    return f"SELECT {cols} FROM {silver_table}"


def build_gold(lake: Lake, zone_lookup: DataFrame) -> dict[str, object]:
    """Staging view → fact (partitioned by month), zone and date dimensions.

    Full rebuild, like a table materialisation. Only repeated trips are
    shuffled for the duplicate rank, then the write rebalances; dimensions are
    tiny. An empty silver layer gives three empty or seed-only tables.
    """
    spark = lake.spark
    silver_t = lake.table("silver", TRIPS)
    ns = lake.ensure_namespace("gold")
    spark.sql(f"CREATE OR REPLACE VIEW {ns}.{STAGING_VIEW} AS {staging_sql(silver_t.qualified)}")
    stg = spark.table(f"{ns}.{STAGING_VIEW}")
    overwrite_table(gold.fact_trips(stg), lake.table("gold", "fact_trips"))
    overwrite_table(gold.dim_zone(zone_lookup), lake.table("gold", "dim_zone"), partition_cols=())
    overwrite_table(gold.dim_date(stg), lake.table("gold", "dim_date"), partition_cols=())
    # Spine length: one outlier pickup date stretches the calendar (reported,
    # not corrected). The spine is one row per day, so this reads a tiny table.
    spine = lake.table("gold", "dim_date").read().agg(
        F.count(F.lit(1)).alias("days"), F.min("date_key").alias("first"), F.max("date_key").alias("last")
    ).first()
    return {
        "staging": f"{ns}.{STAGING_VIEW}",
        "fact_trips": f"{ns}.fact_trips",
        "dim_zone": f"{ns}.dim_zone",
        "dim_date": f"{ns}.dim_date",
        "calendar_days": int(spine.days),
        "calendar_first": str(spine.first),
        "calendar_last": str(spine.last),
    }


def gold_tables(lake: Lake) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        lake.table("gold", "fact_trips").read(),
        lake.table("gold", "dim_zone").read(),
        lake.table("gold", "dim_date").read(),
    )


def check_gold(lake: Lake, seed: DataFrame | None = None) -> DataFrame:
    fact, zones, dates = gold_tables(lake)
    return quality.gold_checks(fact, zones, dates, seed)


class QualityError(ValueError):
    pass


def run_gold(lake: Lake, zone_lookup: DataFrame, *, fail_on_error: bool = True) -> DataFrame:
    """Build order of the gold layer: staging → models → tests.

    Returns the test report; raises ``QualityError`` naming failing tests."""
    build_gold(lake, zone_lookup)
    report = check_gold(lake, zone_lookup)
    failing = [r for r in report.collect() if r.failures]
    if failing and fail_on_error:
        detail = ", ".join(f"{r.test_name}({r.model}.{r.column_name})={r.failures}" for r in failing)
        raise QualityError(f"gold tests failed: {detail}")
    return report


# ---------------------------------------------------------------- backfill


def bootstrap(lake: Lake) -> list[str]:
    """Create the layer namespaces (idempotent)."""
    return [lake.ensure_namespace(layer) for layer in ("bronze", "silver", "gold")]


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def paths_by_month(paths: Sequence[str]) -> dict[str, list[str]]:
    """Files of each month, in the order given; a file without a month in its
    folder or name is an error, as its rows could not be placed."""
    found: dict[str, list[str]] = {}
    for path in paths:
        month = re_month(path)
        if month is None:
            raise ValueError(f"no month (YYYY-MM) in the name of {path!r}")
        found.setdefault(month, []).append(path)
    return found


def backfill_files(
    lake: Lake,
    month_paths: Mapping[str, str | Sequence[str]],
    *,
    start: str | None = None,
    end: str | None = None,
    limits: TripLimits = TripLimits(),
) -> DataFrame:
    """Bronze + silver for a month range from delivered files, one job per layer.

    ``month_paths`` maps ``YYYY-MM`` to the landed file or files of the month;
    months of the range without a file are cleared in both layers. Returns the
    silver run record.
    """
    s, e = months_mod.resolve_range(start, end)
    wanted = months_mod.month_strings(s, e)
    bootstrap(lake)
    paths = [p for m in wanted for p in _as_list(month_paths.get(m, ()))]
    stamp = utc_now_iso()
    if paths:
        land_bronze(lake, bronze_from_files(lake.spark, paths, loaded_at=stamp), months=wanted)
    else:
        bronze_t = lake.table("bronze", TRIPS)
        if bronze_t.exists():
            drop_months(bronze_t, wanted)
    if not lake.table("bronze", TRIPS).exists():
        silver_t = lake.table("silver", TRIPS)
        return lake.spark.createDataFrame(
            [(m, 0, 0, 0, silver_t.qualified, silver_t.location) for m in wanted], RUN_RECORD
        )
    return build_silver(lake, wanted, limits=limits)


def backfill_coverage(lake: Lake, planned: DataFrame) -> DataFrame:
    """Planned months ⟕ landed bronze rows."""
    landed = rows_by_month(lake.table("bronze", TRIPS).read())
    return months_mod.backfill_coverage(planned, landed)


BUILT = "trip_month string, fingerprint string, built_at string"


def month_fingerprints(table: Table) -> DataFrame:
    """``(trip_month, fingerprint, rows)``: a digest of each month's data files, their
    names, sizes and rows, and the rows of them all; a month that is landed again
    gets another one. Metadata only."""
    files = file_inventory(table).select(
        F.col("partition_value").alias("trip_month"),
        F.concat_ws("|", "file_path", F.col("file_size").cast("string"), F.col("record_count").cast("string")).alias("f"),
        "record_count",
    )
    # an order-free digest: sums of hashes merge on the map side
    parts = [F.sum(F.xxhash64("f", F.lit(k)).cast("decimal(38,0)")).cast("string") for k in (1, 2)]
    return files.groupBy("trip_month").agg(
        F.concat_ws("-", F.count(F.lit(1)).cast("string"), *parts).alias("fingerprint"),
        F.sum("record_count").cast("bigint").alias("rows"),
    )


def _built_path(lake: Lake) -> str:
    return f"{lake.root}/silver/_built_months"


def record_built(lake: Lake, fingerprints: DataFrame) -> None:
    """Note from which bronze files silver months were built (rows: months)."""
    stamped = fingerprints.withColumn("built_at", F.lit(utc_now_iso()))
    stamped.coalesce(1).write.mode("append").parquet(_built_path(lake))


def stale_months(lake: Lake, planned: DataFrame | None = None) -> DataFrame:
    """``(trip_month, reason)``: months whose silver must be built: ``new`` (never
    built), ``changed`` (bronze files are others than it was built from), or
    ``gone`` (built, but bronze has no such month any more). ``planned``
    limits the months. Rows without a month are never built, so never stale."""
    now = month_fingerprints(lake.table("bronze", TRIPS)).filter("trip_month is not null")
    if storage.exists(lake.spark, _built_path(lake)):
        built = lake.spark.read.schema(BUILT).parquet(_built_path(lake))
    else:
        built = lake.spark.createDataFrame([], BUILT)
    then = built.groupBy("trip_month").agg(F.max_by("fingerprint", "built_at").alias("_then")).filter("_then != ''")
    reason = (
        F.when(F.col("_then").isNull(), "new")
        .when(F.col("fingerprint").isNull(), "gone")
        .when(F.col("fingerprint") != F.col("_then"), "changed")
    )
    found = now.join(then, "trip_month", "full").select("trip_month", reason.alias("reason")).filter("reason is not null")
    return found if planned is None else found.join(planned.select("trip_month").distinct(), "trip_month", "left_semi")


def clear_months(table: Table, months: Sequence[str]) -> list[str]:
    return drop_months(table, months)


# ---------------------------------------------------------------- attach

KNOWN_TABLES: tuple[tuple[str, str], ...] = (
    ("bronze", TRIPS),
    ("silver", TRIPS),
    ("gold", "fact_trips"),
    ("gold", "dim_zone"),
    ("gold", "dim_date"),
)


def attach(lake: Lake, *, limits: TripLimits = TripLimits()) -> list[str]:
    """Register tables already stored under the lake root (a new session with
    no persistent metastore). Silver gets its declared schema (old files may
    predate evolved columns); the others take the merged schema of their files
    (a distributed footer read). Returns the tables attached."""
    spark = lake.spark
    attached = []
    for layer, name in KNOWN_TABLES:
        t = lake.table(layer, name)
        if t.exists() or not storage.exists(spark, t.location):
            continue
        location = t.location
        if layer == "gold":  # rebuilt tables live in version folders
            location = latest_version(t)
            if location is None:
                continue
        months = versions.month_versions(spark, location)
        files = [c for c in storage.list_children(spark, location) if c.endswith(".parquet")]
        if not months and not files:
            continue
        if (layer, name) == ("silver", TRIPS):
            schema = contract_mod.silver_contract(limits).schema()
        else:  # without its partition column when the month folders are read themselves
            places = [paths[-1] for paths in months.values()] or [location]
            schema = spark.read.option("mergeSchema", "true").parquet(*places).schema
            if months and "trip_month" not in schema.names:
                schema = schema.add("trip_month", T.StringType())
        lake.ensure_namespace(layer)
        create_table(t, schema, partition_cols=("trip_month",) if months else (), location=location)
        if months:
            versions.catch_up(spark, t.qualified, location)
        if layer in ("bronze", "silver"):
            ensure_write_target(t)
        attached.append(t.qualified)
    silver_t = lake.table("silver", TRIPS)
    if silver_t.exists():
        ns = lake.ensure_namespace("gold")
        if not spark.catalog.tableExists(f"{ns}.{STAGING_VIEW}"):
            spark.sql(f"CREATE OR REPLACE VIEW {ns}.{STAGING_VIEW} AS {staging_sql(silver_t.qualified)}")
    return attached
