"""Month keys: parsing, inclusive ranges, delivery manifests, coverage.

A month is the partition unit of every layer (``trip_month`` = ``YYYY-MM``).
Ranges are generated on the cluster with ``sequence``/``explode`` so the
same code serves a two-month backfill and a fifty-year one.
"""

from __future__ import annotations

import os
import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.trips import month_file_name

# Default range when neither argument nor environment is given.
DEFAULT_START = "2024-01"
DEFAULT_END = "2024-01"
START_ENV = "TRIPS_START_MONTH"
END_ENV = "TRIPS_END_MONTH"
_MONTH_KEY = re.compile(r"(?P<year>[0-9]{4})-(?P<month>0[1-9]|1[0-2])")


def month_number(month: str) -> int:
    """Months since year 0 of a ``YYYY-MM`` key, so ranges are plain ranges."""
    found = _MONTH_KEY.fullmatch(month)
    if found is None:
        raise ValueError(f"{month!r} is not a month key such as 2024-03")
    return int(found["year"]) * 12 + int(found["month"]) - 1


def month_key_of(number: int) -> str:
    return date(number // 12, number % 12 + 1, 1).strftime("%Y-%m")


def resolve_range(start: str | None = None, end: str | None = None) -> tuple[str, str]:
    """Arguments first, then environment, then the defaults."""
    return (
        start or os.environ.get(START_ENV, DEFAULT_START),
        end or os.environ.get(END_ENV, DEFAULT_END),
    )


def month_strings(start: str, end: str) -> list[str]:
    """Inclusive month list (bounded: one string per month)."""
    span = range(month_number(start), month_number(end) + 1)
    if not span:
        raise ValueError(f"the range {start} to {end} runs backwards")
    return [month_key_of(n) for n in span]


def months_between(first: Column, last: Column) -> Column:
    """Array of month-start dates from ``first`` to ``last`` inclusive."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def month_range(spark: SparkSession, start: str | None = None, end: str | None = None) -> DataFrame:
    """One row per month of an inclusive range: ``(trip_month, month_start)``."""
    wanted = month_strings(*resolve_range(start, end))
    first, last = (F.to_date(F.lit(f"{m}-01")) for m in (wanted[0], wanted[-1]))
    bounds = spark.range(1).select(first.alias("first"), last.alias("last"))
    return bounds.select(F.explode(months_between(F.col("first"), F.col("last"))).alias("d")).select(
        F.date_format("d", "yyyy-MM").alias("trip_month"), F.col("d").alias("month_start")
    )


def month_range_of(df: DataFrame, ts_col: str) -> DataFrame:
    """Months spanned by a timestamp column (min/max partial aggregation)."""
    bounds = df.agg(F.min(ts_col).alias("first"), F.max(ts_col).alias("last")).filter(
        F.col("first").isNotNull()
    )
    return bounds.select(
        F.explode(months_between(F.to_date("first"), F.to_date("last"))).alias("d")
    ).select(F.date_format("d", "yyyy-MM").alias("trip_month"), F.col("d").alias("month_start"))


def manifest(months: DataFrame, *, base_url: str, staging_dir: str) -> DataFrame:
    """Delivery manifest: ``(trip_month, local_path, source_url)`` per month."""
    name = month_file_name(F.col("trip_month"))
    return months.select(
        "trip_month",
        F.concat(F.lit(staging_dir.rstrip("/") + "/"), name).alias("local_path"),
        F.concat(F.lit(base_url.rstrip("/") + "/"), name).alias("source_url"),
    )


def backfill_coverage(planned: DataFrame, landed_counts: DataFrame) -> DataFrame:
    """Planned months ⟕ landed rows: ``(trip_month, rows, landed)``.

    ``landed_counts`` is ``(trip_month, rows)``, already aggregated, so both
    sides are bounded by the number of months.
    """
    return (
        planned.select("trip_month")
        .join(landed_counts, "trip_month", "left")
        .select(
            "trip_month",
            F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"),
            F.col("rows").isNotNull().alias("landed"),
        )
    )
