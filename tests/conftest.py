from __future__ import annotations

import datetime as dt
import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from strata.plans.tables import Lake  # noqa: E402
from strata.session import build_session  # noqa: E402
from strata.sources.trips import RAW_SCHEMA  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), prefix=f"t{uuid.uuid4().hex[:8]}_")


def raw_row(**overrides):
    """One raw trip (values from the reference fixture)."""
    row = {
        "VendorID": 1,
        "tpep_pickup_datetime": dt.datetime(2024, 1, 15, 10, 0, 0),
        "tpep_dropoff_datetime": dt.datetime(2024, 1, 15, 10, 20, 0),
        "passenger_count": 1,
        "trip_distance": 2.5,
        "RatecodeID": 1,
        "store_and_fwd_flag": "N",
        "PULocationID": 161,
        "DOLocationID": 162,
        "payment_type": 1,
        "fare_amount": 12.0,
        "extra": 0.0,
        "mta_tax": 0.5,
        "tip_amount": 2.0,
        "tolls_amount": 0.0,
        "improvement_surcharge": 0.0,
        "total_amount": 14.5,
        "congestion_surcharge": 0.0,
        "Airport_fee": 0.0,
    }
    row.update(overrides)
    return row


def raw_frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in RAW_SCHEMA.fields) for r in rows], RAW_SCHEMA)


def bronze_frame(spark, month: str, n: int, **overrides):
    from pyspark.sql import functions as F

    from strata.plans import jobs

    raw = raw_frame(spark, [raw_row(**overrides) for _ in range(n)])
    return jobs.enrich(
        raw,
        trip_month=F.lit(month),
        source_file=F.lit(f"yellow_tripdata_{month}.parquet"),
        loaded_at="2024-06-01T00:00:00+00:00",
    )
