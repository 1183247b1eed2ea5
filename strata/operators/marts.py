"""Dashboard marts over the gold fact (all accept an optional month list).

``trip_months=None`` or ``[]`` means no filter; otherwise an IN-list on the
partition column, which Spark turns into a partition filter on the fact.
Joins with dimensions happen AFTER aggregating the fact down to one row per
dimension key, so the big side never travels through a join; table
statistics and adaptive execution choose the kind of join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.labels import UNKNOWN_LABEL, payment_label, zone_label
from strata.functions.money import amount, exact, exact_sum, mean, rounded_mean, to_cents


def month_filter(df: DataFrame, trip_months: Sequence[str] | None, col: str = "trip_month") -> DataFrame:
    if not trip_months:
        return df
    return df.filter(F.col(col).isin(list(trip_months)))


def list_trip_months(fact: DataFrame) -> DataFrame:
    return (
        fact.select("trip_month")
        .filter(F.col("trip_month").isNotNull())
        .distinct()
        .orderBy("trip_month")
    )


def latest_month(fact: DataFrame) -> DataFrame:
    """Default month selection: the latest month present."""
    return fact.agg(F.max("trip_month").alias("latest_month"))


def daily_trip_volume(fact: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    return (
        month_filter(fact, trip_months)
        .filter(F.col("date_key").isNotNull())
        .groupBy(F.col("date_key").cast("date").alias("trip_date"))
        .agg(F.count(F.lit(1)).cast("bigint").alias("trip_count"))
        .orderBy("trip_date")
    )


def monthly_revenue(fact: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    return (
        month_filter(fact, trip_months)
        .filter(F.col("trip_month").isNotNull())
        .groupBy("trip_month")
        .agg(
            amount(exact_sum("total_amount")).alias("total_revenue"),
            F.count(F.lit(1)).cast("bigint").alias("trip_count"),
        )
        .orderBy("trip_month")
    )


def _zone_counts(fact: DataFrame, zones: DataFrame, trip_months: Sequence[str] | None) -> DataFrame:
    per_key = (
        month_filter(fact, trip_months)
        .groupBy("pickup_zone_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    dim = zones.select("zone_key", "zone_name", "borough")
    joined = per_key.join(dim, per_key.pickup_zone_key == dim.zone_key, "left")
    return joined.groupBy(
        F.coalesce("zone_name", F.lit(UNKNOWN_LABEL)).alias("zone_name"),
        F.coalesce("borough", F.lit(UNKNOWN_LABEL)).alias("borough"),
    ).agg(F.sum("n").cast("bigint").alias("trip_count"))


def top_pickup_zones(
    fact: DataFrame, zones: DataFrame, trip_months: Sequence[str] | None = None, limit: int = 10
) -> DataFrame:
    """Top-k zones by trips; groups by zone NAME (keys sharing a name merge).

    Ties are broken by name so the cut at ``limit`` is deterministic.
    """
    return (
        _zone_counts(fact, zones, trip_months)
        .orderBy(F.col("trip_count").desc(), "zone_name", "borough")
        .limit(limit)
    )


def zone_labels(
    fact: DataFrame, zones: DataFrame, trip_months: Sequence[str] | None = None, limit: int = 10
) -> DataFrame:
    top = top_pickup_zones(fact, zones, trip_months, limit)
    return top.withColumn("zone_label", zone_label(F.col("borough"), F.col("zone_name")))


def trips_by_payment_type(fact: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    return (
        month_filter(fact, trip_months)
        .filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(F.count(F.lit(1)).cast("bigint").alias("trip_count"))
        .orderBy("payment_type")
    )


def payment_mix(fact: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    """Payment counts with display labels."""
    return trips_by_payment_type(fact, trip_months).withColumn(
        "payment_label", payment_label(F.col("payment_type"))
    )


def avg_fare_by_day_of_week(
    fact: DataFrame, dates: DataFrame, trip_months: Sequence[str] | None = None
) -> DataFrame:
    """Mean ``total_amount`` per weekday, rounded once, half up to cents."""
    per_day = (
        month_filter(fact, trip_months)
        .groupBy("date_key")
        .agg(
            exact_sum("total_amount").alias("total"),
            F.count(exact("total_amount")).alias("amounts"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    dim = dates.select("date_key", "day_name", "iso_day_of_week")
    joined = per_day.join(dim, "date_key", "inner")
    return (
        joined.groupBy("day_name", "iso_day_of_week")
        .agg(F.sum("total").alias("total"), F.sum("amounts").alias("amounts"), F.sum("n").alias("n"))
        .select(
            "day_name",
            "iso_day_of_week",
            rounded_mean(F.col("total"), F.col("amounts")).alias("avg_total_amount"),
            F.col("n").cast("bigint").alias("trip_count"),
        )
        .orderBy("iso_day_of_week")
    )


def dashboard_kpis(fact: DataFrame, trip_months: Sequence[str] | None = None) -> DataFrame:
    """Trips (sum of the daily panel), revenue (sum of the rounded monthly
    panel — exact in cents), months in the filter.

    Two-level aggregation: per month first (partial aggregation, one row per
    month), then one row. No DISTINCT aggregate, so rows are not expanded.
    """
    per_month = month_filter(fact, trip_months).groupBy("trip_month").agg(
        F.count_if(F.col("date_key").isNotNull()).alias("trips"),
        to_cents(exact_sum("total_amount")).alias("revenue"),
    )
    months = (
        F.lit(len(trip_months)).cast("bigint")
        if trip_months
        else F.count(F.col("trip_month"))
    )
    return per_month.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).cast("bigint").alias("total_trips"),
        F.coalesce(F.sum(F.when(F.col("trip_month").isNotNull(), F.col("revenue"))).cast("double"), F.lit(0.0)).alias(
            "total_revenue"
        ),
        months.cast("bigint").alias("months_in_filter"),
    )


def month_count(table: DataFrame, month: str) -> DataFrame:
    """Partition-pruned row count of one month."""
    return (
        table.filter(F.col("trip_month") == month)
        .agg(F.count(F.lit(1)).cast("bigint").alias("rows"))
        .select(F.lit(month).alias("trip_month"), "rows")
    )


def daily_fare(table: DataFrame, month: str) -> DataFrame:
    """Per pickup date of one month: trips and mean fare (not rounded)."""
    return (
        table.filter(F.col("trip_month") == month)
        .groupBy("pickup_date")
        .agg(
            F.count(F.lit(1)).cast("bigint").alias("trips"),
            mean(exact_sum("fare_amount"), F.count(exact("fare_amount"))).alias("avg_fare"),
        )
    )
