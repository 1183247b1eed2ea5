import datetime as dt

from pyspark.sql import functions as F

from strata.functions.labels import payment_label
from strata.operators import gold, marts, quality
from strata.operators.silver import SILVER_COLUMNS


def _silver(spark):
    base = dict(
        vendor_id=1, passenger_count=1, ratecode_id=1, store_and_fwd_flag="N", extra=1.0, mta_tax=0.5,
        tolls_amount=0.0, improvement_surcharge=0.3, congestion_surcharge=2.5, airport_fee=0.0,
        trip_month="2024-01", _bronze_loaded_at="l", _source_file="yellow_tripdata_2024-01.parquet",
        _silver_processed_at="p", _silver_version=1,
    )
    rows = [
        dict(base, pickup_datetime=dt.datetime(2024, 1, 15, 8), dropoff_datetime=dt.datetime(2024, 1, 15, 8, 20),
             trip_distance=3.2, pu_location_id=161, do_location_id=236, payment_type=1, fare_amount=12.5,
             tip_amount=2.0, total_amount=16.3, trip_duration_seconds=1200.0, pickup_date=dt.date(2024, 1, 15)),
        dict(base, pickup_datetime=dt.datetime(2024, 1, 16, 9), dropoff_datetime=dt.datetime(2024, 1, 16, 9, 25),
             passenger_count=2, trip_distance=5.0, pu_location_id=161, do_location_id=237, payment_type=2,
             fare_amount=18.0, tip_amount=0.0, total_amount=20.0, trip_duration_seconds=1500.0,
             pickup_date=dt.date(2024, 1, 16)),
    ]
    schema = (
        "vendor_id long, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count long, "
        "trip_distance double, ratecode_id long, store_and_fwd_flag string, pu_location_id long, do_location_id long, "
        "payment_type long, fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
        "improvement_surcharge double, total_amount double, congestion_surcharge double, airport_fee double, "
        "trip_duration_seconds double, pickup_date date, trip_month string, _bronze_loaded_at string, "
        "_source_file string, _silver_processed_at string, _silver_version int"
    )
    return spark.createDataFrame([tuple(r[c] for c in SILVER_COLUMNS) for r in rows], schema)


def _zones(spark):
    return spark.createDataFrame(
        [(161, "Manhattan", "Midtown Center", "Yellow Zone"), (236, "Manhattan", "Upper East Side North", "Yellow Zone"),
         (56, "Queens", "Corona", "Boro Zone"), (57, "Queens", "Corona", "Boro Zone")],
        "LocationID long, Borough string, Zone string, service_zone string",
    )


def test_serving_golden_values(spark):
    stg = gold.staging(_silver(spark))
    fact = gold.fact_trips(stg)
    zones = gold.dim_zone(_zones(spark))
    dates = gold.dim_date(stg)
    assert [r.trip_month for r in marts.list_trip_months(fact).collect()] == ["2024-01"]
    daily = marts.daily_trip_volume(fact, ["2024-01"]).collect()
    assert len(daily) == 2 and sum(r.trip_count for r in daily) == 2
    rev = marts.monthly_revenue(fact, ["2024-01"]).collect()
    assert len(rev) == 1 and rev[0].total_revenue == 36.3
    zones_top = marts.top_pickup_zones(fact, zones, ["2024-01"], limit=5).collect()
    assert zones_top[0].zone_name == "Midtown Center" and zones_top[0].trip_count == 2
    pay = marts.trips_by_payment_type(fact, ["2024-01"]).collect()
    assert sum(r.trip_count for r in pay) == 2
    dow = marts.avg_fare_by_day_of_week(fact, dates, ["2024-01"]).collect()
    assert [(r.day_name, r.iso_day_of_week, r.avg_total_amount) for r in dow] == [("Monday", 1, 16.3), ("Tuesday", 2, 20.0)]
    kpi = marts.dashboard_kpis(fact).first()
    assert (kpi.total_trips, kpi.total_revenue, kpi.months_in_filter) == (2, 36.3, 1)
    assert marts.latest_month(fact).first().latest_month == "2024-01"
    checks = quality.gold_checks(fact, zones, dates).collect()
    assert len(checks) == 14
    failing = {(r.test_name, r.column_name): r.failures for r in checks if r.failures}
    assert failing == {("relationships", "dropoff_zone_key"): 1}  # zone 237 is not in the lookup


def test_empty_month_list_means_no_filter(spark):
    fact = gold.fact_trips(gold.staging(_silver(spark)))
    assert marts.monthly_revenue(fact, []).count() == marts.monthly_revenue(fact, None).count() == 1
    assert marts.monthly_revenue(fact, ["2030-01"]).count() == 0


def test_zone_names_merge_across_keys(spark):
    from pyspark.sql import Row

    stg = gold.staging(_silver(spark))
    fact = gold.fact_trips(stg).withColumn("pickup_zone_key", F.when(F.col("payment_type") == 1, 56).otherwise(57))
    top = marts.top_pickup_zones(fact, gold.dim_zone(_zones(spark))).collect()
    assert top == [Row(zone_name="Corona", borough="Queens", trip_count=2)]


def test_dim_date_attributes(spark):
    dates = gold.dim_date(gold.staging(_silver(spark))).orderBy("date_key").collect()
    d = dates[0]
    assert (d.date_key, d.year, d.month, d.day_of_month, d.day_name, d.iso_day_of_week) == (
        dt.date(2024, 1, 15), 2024, 1, 15, "Monday", 1)
    assert d.week_start_date == dt.date(2024, 1, 15) and d.month_start_date == dt.date(2024, 1, 1)
    sunday = gold.dim_date(
        spark.createDataFrame([(dt.date(2024, 1, 21),)], "pickup_date date")
    ).first()
    assert sunday.iso_day_of_week == 7 and sunday.week_start_date == dt.date(2024, 1, 15)


def test_dim_date_empty_input(spark):
    assert gold.dim_date(spark.createDataFrame([], "pickup_date date")).count() == 0


def test_duplicates_get_distinct_keys_and_ranks(spark):
    s = _silver(spark)
    dup = s.limit(1).withColumn("_source_file", F.lit("yellow_tripdata_2024-02.parquet"))
    stg = gold.staging(s.unionByName(dup))
    fact = gold.fact_trips(stg)
    assert fact.select("trip_sk").distinct().count() == 3
    ranks = gold.dup_rank(stg).filter(F.col("total_amount") == 16.3).orderBy("trip_dup_rank").collect()
    assert [(r.source_file, r.trip_dup_rank) for r in ranks] == [
        ("yellow_tripdata_2024-01.parquet", 1), ("yellow_tripdata_2024-02.parquet", 2)]


def test_surrogate_key_null_positions_do_not_collide(spark):
    s = _silver(spark).limit(1)
    a = s.withColumns({"pu_location_id": F.lit(None).cast("long"), "do_location_id": F.lit(1).cast("long")})
    b = s.withColumns({"pu_location_id": F.lit(1).cast("long"), "do_location_id": F.lit(None).cast("long")})
    fact = gold.fact_trips(gold.staging(a.unionByName(b)))
    assert fact.select("trip_sk").distinct().count() == 2


def test_payment_labels(spark):
    df = spark.createDataFrame([(1,), (9,), (None,), (0,)], "code long")
    got = [r.l for r in df.select(payment_label(F.col("code")).alias("l")).collect()]
    assert got == ["Credit card", "Type 9", "Unknown", "Flex fare"]


def test_unique_detects_duplicates(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,), ("c",), ("c",), ("c",)], "k string")
    assert quality.unique_failures(df, "k", model="m").first().failures == 2
    ok = spark.createDataFrame([("a",), ("b",)], "k string")
    assert quality.unique_failures(ok, "k", model="m").first().failures == 0


def test_model_tests_in_one_scan(spark):
    child = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (5, "c"), (5, "c"), (5, None), (None, "a")], "k long, v string")
    parent = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "k long")
    got = quality.model_failures(child, model="m", not_null=["v", "k"], relationships=[("k", parent, "k")])
    assert [tuple(r) for r in got.collect()] == [
        ("not_null", "m", "v", 2), ("not_null", "m", "k", 1), ("relationships", "m", "k", 3)]
    assert quality.relationship_failures(child, "k", parent, "k", model="m").first().failures == 3
    empty = quality.model_failures(child.limit(0), model="m", not_null=["v"], relationships=[("k", parent, "k")])
    assert [r.failures for r in empty.collect()] == [0, 0]


def test_keys_tell_close_amounts_apart(spark):
    one = _silver(spark).limit(1)
    close = one.withColumn("total_amount", F.lit(10.0000001)).unionByName(one.withColumn("total_amount", F.lit(10.0000002)))
    fact = gold.fact_trips(gold.staging(close))
    assert fact.count() == 2 and fact.select("trip_sk").distinct().count() == 2
    zeros = one.withColumn("trip_distance", F.lit(0.0)).unionByName(one.withColumn("trip_distance", F.lit(-0.0)))
    fact = gold.fact_trips(gold.staging(zeros))  # one value for grouping: ranks 1 and 2
    assert fact.select("trip_sk").distinct().count() == 2


def test_surrogate_key_ignores_session_time_zone(spark):
    stg = gold.staging(_silver(spark))
    spring_gap = stg.limit(1).withColumn("pickup_datetime", F.lit("2024-03-10 02:30:00").cast("timestamp_ntz"))
    keys = []
    for tz in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        keys.append(sorted(r.trip_sk for r in gold.fact_trips(stg.unionByName(spring_gap)).collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys[0] == keys[1]
