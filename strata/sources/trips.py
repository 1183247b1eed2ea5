"""Raw trip scans.

Two ways to obtain raw (bronze-input) trips:

* ``read_raw_files`` — monthly Parquet files as delivered. One distributed
  scan over all files with a declared schema: columns are matched
  case-insensitively, a column missing from one month reads NULL, and the
  month comes from the file name (``…YYYY-MM….parquet``).
* ``raw_trips_from_tables`` — the driver's TPC-H-style tables re-shaped
  into the raw trip schema (``lineitem ⋈ orders``), used by the checks and
  the benchmark because no real trip files ship with the test data.
"""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.sources import storage
from strata.sources.testdata import read_table, table_path

RAW_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.LongType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.LongType()),
        T.StructField("DOLocationID", T.LongType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
    ]
)
#: Error conditions of files whose schemas do not merge.
MERGE_FAILURES = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
# A month in a file name, not touching letters/hex digits (so the UUID of a
# Spark part file never matches): ``yellow_tripdata_2024-01.parquet``.
MONTH_IN_FILE_NAME = r"(?<![0-9A-Za-z])(\d{4}-(?:0[1-9]|1[0-2]))(?![0-9A-Za-z])"
MONTH_IN_FOLDER = r"trip_month=(\d{4}-\d{2})/[^/]*$"


def re_month(path: str) -> str | None:
    """Driver-side twin of ``month_of_file`` for a path string (CLI arguments)."""
    import re

    name = path.rstrip("/").rsplit("/", 1)[-1]
    m = re.search(r"trip_month=(\d{4}-\d{2})/[^/]*$", path) or re.search(MONTH_IN_FILE_NAME, name)
    return m.group(1) if m else None


def month_of_file() -> Column:
    """``YYYY-MM`` from a ``trip_month=`` folder, else from the file name."""
    by_folder = F.regexp_extract(F.col("_metadata.file_path"), MONTH_IN_FOLDER, 1)
    by_name = F.regexp_extract(F.col("_metadata.file_name"), MONTH_IN_FILE_NAME, 1)
    return F.coalesce(F.nullif(by_folder, F.lit("")), F.nullif(by_name, F.lit("")))


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in order: matched case-insensitively, cast to the
    declared type, NULL when the file lacks the column; extras dropped."""
    present = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(src).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """``(schema, paths)`` of files that one schema reads, every path once.

    A merge is one distributed read of the footers. Where a column changed its
    type between months (e.g. ``passenger_count`` as double) it fails, and the
    halves, in the order given, are tried by themselves: ``c`` changes of type
    along the months cost about ``c * log2(paths)`` merges, not a schema read
    per path. Neighbouring parts that came out alike, or that differ in
    missing columns only, are one group again.
    """
    try:
        return [(spark.read.option("mergeSchema", True).parquet(*paths).schema, list(paths))]
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or not any(condition in str(error) for condition in MERGE_FAILURES):
            raise
    half = len(paths) // 2
    groups: list[tuple[T.StructType, list[str]]] = []
    for found, part in schema_groups(spark, paths[:half]) + schema_groups(spark, paths[half:]):
        for k, (known, members) in enumerate(groups):
            if (both := _union(known, found)) is not None:
                groups[k] = (both, members + part)
                break
        else:
            groups.append((found, part))
    return groups


def _union(left: T.StructType, right: T.StructType) -> T.StructType | None:
    """All columns of both, whatever their case; None if one has two types."""
    types = {f.name.lower(): f.dataType for f in left.fields}
    if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in right.fields):
        return None
    return T.StructType(left.fields + [f for f in right.fields if f.name.lower() not in types])


def read_raw_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """Scan monthly raw files; adds ``_file_path``, ``_file_month``, ``_file_size``
    and ``_file_modified``.

    The files are matched to the declared schema by name. Footers are read
    and merged in tasks; if one schema reads all files that is one step and
    one scan, else :func:`schema_groups` finds the files that go together, and
    the groups, each cast to the declared types, are put together.
    """
    frames = [spark.read.schema(found).parquet(*group) for found, group in schema_groups(spark, paths)]
    out = None
    for raw in frames:
        conformed = _conform(raw, schema).withColumns(
            {
                "_file_path": F.col("_metadata.file_path"),
                "_file_month": month_of_file(),
                "_file_size": F.col("_metadata.file_size"),
                "_file_modified": F.col("_metadata.file_modification_time"),
            }
        )
        out = conformed if out is None else out.unionByName(conformed)
    return out


#: Bytes of the orders' files beyond which they are never broadcast.
BROADCAST_BYTES = 50_000_000


def raw_trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-trip-shaped rows from ``lineitem ⋈ orders`` (one row per line item).

    Mapping (fixed so the DuckDB checks can restate it): vendor from the
    line number, pickup = order date, dropoff = ship date, passengers =
    quantity - 2, distance = quantity * 11, zones = part/supplier key mod 27
    with one value turned into NULL, amounts from price, discount and tax.

    Line items are cut to what the trips need before they are shuffled. Of
    orders too large to broadcast every task holds its part, so that the line
    items, several to an order, are neither sorted nor spilled.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_shipdate",
        (F.col("l_linestatus") == "O").alias("_open"),
        F.nullif(F.col("l_partkey") % 27, F.lit(7)).cast("bigint").alias("PULocationID"),
        F.nullif(F.col("l_suppkey") % 27, F.lit(9)).cast("bigint").alias("DOLocationID"),
        F.when(F.col("l_suppkey") % 10 == 0, 1.75).otherwise(0.0).alias("Airport_fee"),
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    if storage.size(spark, table_path(sf_dir, "orders")) > BROADCAST_BYTES:
        orders = orders.hint("shuffle_hash")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey, "inner")
    ln = F.col("l_linenumber")
    return joined.select(
        (ln % 2 + 1).cast("bigint").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        (F.floor("l_quantity").cast("bigint") - 2).alias("passenger_count"),
        (F.col("l_quantity") * 11).alias("trip_distance"),
        F.nullif(ln % 6, F.lit(0)).cast("bigint").alias("RatecodeID"),
        F.when(F.col("_open"), "Y").otherwise("N").alias("store_and_fwd_flag"),
        "PULocationID",
        "DOLocationID",
        (ln - 1).cast("bigint").alias("payment_type"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("fare_amount"),
        F.col("l_discount").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"),
        F.lit(2.5).alias("congestion_surcharge"),
        "Airport_fee",
    )


def month_file_name(trip_month: Column) -> Column:
    """Delivery file name of a month (``yellow_tripdata_YYYY-MM.parquet``)."""
    return F.concat(F.lit("yellow_tripdata_"), trip_month, F.lit(".parquet"))


def zones_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup shaped like the seed CSV, from ``nation ⋈ region``."""
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "inner").select(
        F.col("n_nationkey").cast("bigint").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.when(F.col("n_nationkey") % 5 == 0, "Airports").otherwise("Boro Zone").alias(
            "service_zone"
        ),
    )


ZONE_SEED_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.LongType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)


def read_zone_seed(spark: SparkSession, csv_path: str) -> DataFrame:
    """Zone lookup CSV with header; ``N/A`` stays a string (no null token)."""
    return (
        spark.read.option("header", True)
        .schema(ZONE_SEED_SCHEMA)
        .csv(csv_path)
    )


def event_trips_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microsecond-precise pickup/dropoff pairs: event ``i`` → event ``i+1``.

    A shuffle equi-join of ``events`` with itself on ``event_id + 1`` (no
    global ordering, so it stays parallel at any size).
    """
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    nxt = ev.select(F.col("event_id").alias("next_id"), F.col("ts").alias("next_ts"))
    return ev.join(nxt, nxt.next_id == ev.event_id + 1, "inner").select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        F.col("next_ts").alias("dropoff_datetime"),
    )
