"""Dashboard surface over a built lake (same call shapes as the marts panels).

``open_gold`` attaches an existing lake and fails clearly when the gold
tables are missing; the panel functions take ``trip_months`` (``None`` or
``[]`` = all months) and return DataFrames. Only ``list_trip_months``
collects, and it returns one string per month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from strata.operators import marts
from strata.plans import jobs
from strata.plans.tables import Lake
from strata.sources import catalog

SILVER_VIEW = "silver_yellow_taxi_trips"


def open_gold(spark: SparkSession, root: str, prefix: str = "") -> Lake:
    lake = Lake(spark, root.rstrip("/"), prefix=prefix)
    jobs.attach(lake)
    catalog.require_gold(spark, catalog.gold_namespace(spark, prefix=prefix))
    return lake


def gold_tables_present(lake: Lake) -> bool:
    return catalog.gold_tables_present(lake.spark, catalog.gold_namespace(lake.spark, prefix=lake.prefix))


def register_silver_view(lake: Lake, view_name: str = SILVER_VIEW) -> dict[str, str]:
    return catalog.register_view(lake.spark, view_name, lake.table("silver", jobs.TRIPS).qualified)


def _fact(lake: Lake) -> DataFrame:
    return lake.table("gold", "fact_trips").read()


def list_trip_months(lake: Lake) -> list[str]:
    return [r.trip_month for r in marts.list_trip_months(_fact(lake)).collect()]


def daily_trip_volume(lake: Lake, *, trip_months: Sequence[str] | None = None) -> DataFrame:
    return marts.daily_trip_volume(_fact(lake), trip_months)


def monthly_revenue(lake: Lake, *, trip_months: Sequence[str] | None = None) -> DataFrame:
    return marts.monthly_revenue(_fact(lake), trip_months)


def top_pickup_zones(lake: Lake, *, trip_months: Sequence[str] | None = None, limit: int = 10) -> DataFrame:
    return marts.top_pickup_zones(_fact(lake), lake.table("gold", "dim_zone").read(), trip_months, limit)


def trips_by_payment_type(lake: Lake, *, trip_months: Sequence[str] | None = None) -> DataFrame:
    return marts.trips_by_payment_type(_fact(lake), trip_months)


def avg_fare_by_day_of_week(lake: Lake, *, trip_months: Sequence[str] | None = None) -> DataFrame:
    return marts.avg_fare_by_day_of_week(_fact(lake), lake.table("gold", "dim_date").read(), trip_months)


def kpis(lake: Lake, *, trip_months: Sequence[str] | None = None) -> DataFrame:
    return marts.dashboard_kpis(_fact(lake), trip_months)
