"""Bronze → silver shaping: rename, derive, filter, project."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.calendar import seconds_between
from strata.operators.rules import TripLimits, apply_rules, silver_rules

# Raw column → silver column (applied only to columns present,
# matched case-insensitively so a month that ships ``airport_fee`` still maps).
BRONZE_RENAME: dict[str, str] = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pu_location_id",
    "DOLocationID": "do_location_id",
    "Airport_fee": "airport_fee",
}

# Silver column order.
SILVER_COLUMNS: list[str] = [
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "ratecode_id",
    "store_and_fwd_flag",
    "pu_location_id",
    "do_location_id",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    "airport_fee",
    "trip_duration_seconds",
    "pickup_date",
    "trip_month",
    "_bronze_loaded_at",
    "_source_file",
    "_silver_processed_at",
    "_silver_version",
]
# Columns added to silver after the table was first created.
EVOLUTION_COLUMNS: tuple[str, ...] = ("pickup_date", "_silver_version")
SILVER_SCHEMA_VERSION = 1


def rename_bronze(df: DataFrame) -> DataFrame:
    lookup = {k.lower(): v for k, v in BRONZE_RENAME.items()}
    mapping = {c: lookup[c.lower()] for c in df.columns if c.lower() in lookup and c != lookup[c.lower()]}
    return df.withColumnsRenamed(mapping) if mapping else df


def derive(df: DataFrame) -> DataFrame:
    """``trip_duration_seconds`` (whole seconds, truncated) and ``pickup_date``."""
    return df.withColumns(
        {
            "trip_duration_seconds": seconds_between(
                F.col("pickup_datetime"), F.col("dropoff_datetime")
            ).cast("double"),
            "pickup_date": F.to_date("pickup_datetime"),
        }
    )


def clean(bronze: DataFrame, limits: TripLimits = TripLimits()) -> DataFrame:
    """Rename → derive → filter; narrow (no shuffle)."""
    return apply_rules(derive(rename_bronze(bronze)), silver_rules(limits))


def prepared(bronze: DataFrame) -> DataFrame:
    """Rename + derive without filtering (input of rule statistics)."""
    return derive(rename_bronze(bronze))


def project(df: DataFrame, *, processed_at: str, silver_version: int = SILVER_SCHEMA_VERSION) -> DataFrame:
    """Ordered silver projection; lineage mapped, stamps added, absent columns skipped."""
    added = {
        "_silver_processed_at": F.lit(processed_at),
        "_silver_version": F.lit(silver_version).cast("int"),
    }
    if "_loaded_at" in df.columns:
        added["_bronze_loaded_at"] = F.col("_loaded_at")
    out = df.withColumns(added)
    return out.select([c for c in SILVER_COLUMNS if c in out.columns])
