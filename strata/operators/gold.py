"""Gold star schema: staging view, duplicate rank, trip fact, zone and date dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.calendar import date_attributes
from strata.functions.keys import surrogate_key
from strata.operators.ranking import skew_safe_rank

# Staging projection of silver (lineage stamps dropped).
STAGING_COLUMNS: list[str] = [
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
    "source_file",
]

# Columns identifying "the same trip".
DUP_KEY: list[str] = [
    "pickup_datetime",
    "dropoff_datetime",
    "vendor_id",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "trip_distance",
    "total_amount",
]

# Fact column order.
FACT_COLUMNS: list[str] = [
    "trip_sk",
    "date_key",
    "pickup_zone_key",
    "dropoff_zone_key",
    "vendor_id",
    "pickup_datetime",
    "dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "trip_duration_seconds",
    "ratecode_id",
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
    "trip_month",
    "source_file",
]


def staging(silver: DataFrame) -> DataFrame:
    """Silver → staging (23 columns, ``_source_file`` → ``source_file``)."""
    return silver.withColumnRenamed("_source_file", "source_file").select(STAGING_COLUMNS)


def dup_rank(
    stg: DataFrame,
    key: Sequence[str] = DUP_KEY,
    *,
    order: Sequence[str] = ("source_file",),
    rank_col: str = "trip_dup_rank",
) -> DataFrame:
    """``row_number()`` of each row among identical trips, first file first.

    Ties on ``order`` are broken by every remaining column, so the ranks are
    a deterministic function of the data (identical rows are interchangeable).
    Unrepeated trips get rank 1 without a shuffle and a group of any size is
    ranked by many tasks (see ``ranking``). No row is dropped: the rank only
    makes the surrogate key unique.
    """
    tiebreak = [c for c in stg.columns if c not in set(key) | set(order)]
    return skew_safe_rank(stg, key, [*order, *tiebreak], rank_col=rank_col)


def fact_trips(stg: DataFrame, key: Sequence[str] = DUP_KEY) -> DataFrame:
    """Trip fact with a null-safe 128-bit surrogate key over key + rank."""
    ranked = dup_rank(stg, key)
    return ranked.select(
        surrogate_key(ranked, [*key, "trip_dup_rank"]).alias("trip_sk"),
        F.col("pickup_date").alias("date_key"),
        F.col("pu_location_id").alias("pickup_zone_key"),
        F.col("do_location_id").alias("dropoff_zone_key"),
        *FACT_COLUMNS[4:],
    )


def dim_zone(zone_lookup: DataFrame) -> DataFrame:
    """Seed-shaped lookup → ``(zone_key, borough, zone_name, service_zone)``."""
    return zone_lookup.select(
        F.col("LocationID").cast("bigint").alias("zone_key"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        F.col("service_zone"),
    )


def dim_date(stg: DataFrame, date_col: str = "pickup_date") -> DataFrame:
    """Calendar spine from the min to the max pickup date.

    Bounds come from a global min/max (partial aggregation, one row reaches
    the final task); the spine then has one row per day, so its size is
    bounded by the date span, not by the number of trips. No bounds (empty
    input) → no rows.
    """
    bounds = stg.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).filter(
        F.col("lo").isNotNull() & F.col("hi").isNotNull()
    )
    spine = bounds.select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_key")
    )
    d = F.col("date_key")
    return spine.select("date_key", *[c.alias(n) for n, c in date_attributes(d).items()])
