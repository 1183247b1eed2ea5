"""Land monthly raw files as they arrive (file stream → month replace).

The monthly batch job re-expressed for a landing folder that keeps
receiving files: a file-source stream with the declared raw schema, the
month taken from each file name, and a ``foreachBatch`` sink that replaces
the months present in the micro-batch (and, optionally, rebuilds those
silver months). Replacing whole months makes a replayed micro-batch
idempotent, so the checkpoint + month replace give exactly-once table
contents across restarts and executor loss.

A month may arrive in several files and in several micro-batches: a batch
replaces the rows of its own files and keeps the month's rows that came from
other files, so how files fall into batches does not matter. A file is known
by its path. The stream itself offers a path only once, so a ledger keeps
(path, size, modification time) of every file as it was landed; a file that
was delivered again under its path is found by it when the stream starts (or
by ``reland_changed`` at any time) and its rows are replaced by the batch
job. A file without a month in its folder or name stops the stream. A stream has one
schema: names match case-insensitively and missing columns read NULL, but a
month that re-types a column must go through the batch path
(``jobs.bronze_from_files``), which conforms each file-schema group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.rules import TripLimits
from strata.plans import jobs
from strata.plans.tables import Lake
from strata.session import shared_scratch
from strata.sources import storage
from strata.sources.trips import RAW_SCHEMA, month_of_file, read_raw_files


def raw_file_stream(spark: SparkSession, source_dir: str, *, max_files_per_trigger: int = 32) -> DataFrame:
    raw = (
        spark.readStream.schema(RAW_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )
    return raw.withColumns(
        {
            "_file_path": F.col("_metadata.file_path"),
            "_file_month": month_of_file(),
            "_file_size": F.col("_metadata.file_size"),
            "_file_modified": F.col("_metadata.file_modification_time"),
        }
    )


LEDGER = "path string, size bigint, modified timestamp, landed_at string"


def _ledger_path(lake: Lake) -> str:
    return f"{lake.root}/bronze/_landed_files"


def landed_files(lake: Lake) -> DataFrame:
    """``(path, size, modified)`` of every landed file, as it was last landed."""
    path = _ledger_path(lake)
    if not storage.exists(lake.spark, path):
        return lake.spark.createDataFrame([], LEDGER).drop("landed_at")
    last = F.max_by(F.struct("size", "modified"), "landed_at")
    return lake.spark.read.schema(LEDGER).parquet(path).groupBy("path").agg(last.alias("l")).select("path", "l.size", "l.modified")


def delivered_files(spark: SparkSession, source_dir: str) -> DataFrame:
    """``(path, size, modified)`` of the files now in the landing folder (a
    listing: no content is read)."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(source_dir)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("length").alias("size"),
            F.col("modificationTime").alias("modified"),
        )
    )


def changed_files(lake: Lake, source_dir: str) -> list[str]:
    """Paths that were landed and have since been delivered with other content."""
    then = landed_files(lake).select("path", F.struct("size", "modified").alias("then"))
    now = delivered_files(lake.spark, source_dir).select("path", F.struct("size", "modified").alias("now"))
    return sorted(r.path for r in now.join(then, "path").filter("now != then").select("path").collect())


def _land_files(lake: Lake, rows: DataFrame, *, loaded_at: str | None) -> list[str]:
    """Replace the bronze rows of the files behind ``rows``; returns the months.

    ``rows``: raw trips with ``_file_path``, ``_file_month``, ``_file_size`` and
    ``_file_modified``. Rows of the months' other files stay.
    """
    stamp = loaded_at or jobs.utc_now_iso()
    spark = rows.sparkSession  # of a micro-batch: a clone of the lake's
    bronze = jobs.enrich(rows, trip_month=F.col("_file_month"), source_file=F.col("_file_path"), loaded_at=stamp)
    # one row per file
    files = rows.select("_file_month", "_file_path", "_file_size", "_file_modified").distinct().collect()
    lost = [r["_file_path"] for r in files if r["_file_month"] is None]
    if lost:
        raise ValueError(f"no month (YYYY-MM) in the name of {lost[:3]}")
    if not files:
        return []
    months = sorted({r["_file_month"] for r in files})
    table = lake.table("bronze", jobs.TRIPS)
    if table.exists():
        spark.catalog.refreshTable(table.qualified)
        landed = spark.table(table.qualified).filter(F.col("trip_month").isin(months))
        others = landed.filter(~F.col("_source_file").isin([r["_file_path"] for r in files]))
        bronze = others.select(*bronze.columns).unionByName(bronze)
    result = jobs.land_bronze(lake, bronze)
    entries = [(r["_file_path"], r["_file_size"], r["_file_modified"], jobs.utc_now_iso()) for r in files]
    spark.createDataFrame(entries, LEDGER).coalesce(1).write.mode("append").parquet(_ledger_path(lake))
    return result["months_written"]


def reland_changed(
    lake: Lake, source_dir: str, *, loaded_at: str | None = None, build_silver: bool = False, limits: TripLimits = TripLimits()
) -> list[str]:
    """Land files again that were delivered again; returns their months."""
    paths = changed_files(lake, source_dir)
    if not paths:
        return []
    months = _land_files(lake, read_raw_files(lake.spark, paths), loaded_at=loaded_at)
    if build_silver and months:
        jobs.build_silver(lake, months, limits=limits)
    return months


def start_landing(
    lake: Lake,
    source_dir: str,
    *,
    checkpoint: str | None = None,
    loaded_at: str | None = None,
    build_silver: bool = False,
    limits: TripLimits = TripLimits(),
    available_now: bool = True,
    max_files_per_trigger: int = 32,
) -> StreamingQuery:
    """Start the landing stream; ``available_now`` drains what is there and stops.

    Files delivered again since they were landed are landed again first.
    Files may sit directly in ``source_dir`` (month in the file name) or in
    ``trip_month=YYYY-MM`` folders. ``max_files_per_trigger`` only sets the
    size of a micro-batch."""
    spark = lake.spark
    reland_changed(lake, source_dir, loaded_at=loaded_at, build_silver=build_silver, limits=limits)
    stream = raw_file_stream(spark, source_dir, max_files_per_trigger=max_files_per_trigger)

    def land(batch: DataFrame, batch_id: int) -> None:
        months = _land_files(lake, batch, loaded_at=loaded_at)
        if build_silver and months:
            jobs.build_silver(lake, months, limits=limits)

    writer = stream.writeStream.foreachBatch(land).option(
        "checkpointLocation", checkpoint or shared_scratch(spark, "landing-checkpoint")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
