"""Property tests: Spark operators against plain-Python statements of the same rules."""

import datetime as dt
import math
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.money import SCALE, amount, exact_sum, rounded_mean
from strata.operators import silver
from strata.operators.rules import TripLimits
from strata.plans import jobs
from strata.sources import months
from tests.conftest import raw_frame, raw_row

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
LIMITS = TripLimits()

maybe_long = st.one_of(st.none(), st.integers(min_value=-3, max_value=300))
maybe_double = st.one_of(
    st.none(), st.just(float("nan")), st.floats(min_value=-10, max_value=10_500, allow_nan=False)
)
base = dt.datetime(2024, 1, 1)
maybe_ts = st.one_of(st.none(), st.integers(min_value=0, max_value=10**6).map(lambda s: base + dt.timedelta(seconds=s)))

row = st.fixed_dictionaries(
    {
        "tpep_pickup_datetime": maybe_ts,
        "tpep_dropoff_datetime": maybe_ts,
        "passenger_count": maybe_long,
        "trip_distance": maybe_double,
        "total_amount": maybe_double,
        "PULocationID": maybe_long,
        "DOLocationID": maybe_long,
    }
)


def python_keep(r) -> bool:
    def ok_range(v, lo, hi):
        return v is not None and not (isinstance(v, float) and math.isnan(v)) and lo <= v <= hi

    p, d = r["tpep_pickup_datetime"], r["tpep_dropoff_datetime"]
    if p is None or d is None or d < p:
        return False
    if r["passenger_count"] is None or r["passenger_count"] < 0:
        return False
    if not ok_range(r["trip_distance"], 0, LIMITS.max_trip_distance):
        return False
    if not ok_range(r["total_amount"], 0, LIMITS.max_total_amount):
        return False
    for z in ("PULocationID", "DOLocationID"):
        if r[z] is not None and not LIMITS.min_zone_id <= r[z] <= LIMITS.max_zone_id:
            return False
    return True


@SETTINGS
@given(st.lists(row, min_size=1, max_size=12))
def test_rules_match_python(spark, rows):
    full = [raw_row(**r) for r in rows]
    b = jobs.enrich(raw_frame(spark, full), trip_month=F.lit("2024-01"), source_file=F.lit("f"), loaded_at="l")
    assert silver.clean(b, LIMITS).count() == sum(python_keep(r) for r in rows)


@SETTINGS
@given(st.lists(st.integers(min_value=0, max_value=10**7), min_size=1, max_size=20))
def test_money_sum_is_rounded_once(spark, mills):
    df = spark.createDataFrame([(m / 1000,) for m in mills], "x double")
    assert df.agg(amount(exact_sum("x")).alias("s")).first().s == (sum(mills) + 5) // 10 / 100


@SETTINGS
@given(st.integers(min_value=-(2**62), max_value=2**62), st.integers(min_value=1, max_value=2**40))
def test_rounded_mean_beyond_double_precision(spark, units, n):
    total = F.lit(Decimal(units).scaleb(-SCALE)).cast("decimal(38,9)")
    got = spark.range(1).select(rounded_mean(total, F.lit(n)).alias("q")).first().q
    whole = n * 10 ** (SCALE - 2)
    assert got == (2 * units + whole) // (2 * whole) / 100


@SETTINGS
@given(st.integers(1990, 2030), st.integers(1, 12), st.integers(0, 40))
def test_month_range_frame_matches_python(spark, year, month, span):
    start = f"{year:04d}-{month:02d}"
    end_index = year * 12 + month - 1 + span
    end = f"{end_index // 12:04d}-{end_index % 12 + 1:02d}"
    frame = [r.trip_month for r in months.month_range(spark, start, end).collect()]
    assert frame == months.month_strings(start, end) and len(frame) == span + 1
