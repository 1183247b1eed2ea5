import datetime as dt

from pyspark.sql import functions as F

from strata.operators import rules, silver
from strata.plans import jobs
from tests.conftest import raw_frame, raw_row


def _bronze(spark):
    rows = [
        raw_row(),
        raw_row(tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 9, 0, 0), PULocationID=999),
        raw_row(passenger_count=-1),
    ]
    return jobs.enrich(
        raw_frame(spark, rows),
        trip_month=F.lit("2024-01"),
        source_file=F.lit("f.parquet"),
        loaded_at="2024-06-01T00:00:00+00:00",
    )


def test_clean_keeps_valid_row_and_counts(spark):
    b = _bronze(spark)
    r = rules.silver_rules()
    stats = rules.clean_stats(silver.prepared(b), r).first()
    assert (stats.input_rows, stats.output_rows, stats.rejected_rows) == (3, 1, 2)
    kept = silver.clean(b).collect()
    assert len(kept) == 1 and kept[0].pu_location_id == 161


def test_reject_counts_per_rule(spark):
    counts = {r.rule_name: r.rejected_rows for r in rules.reject_counts(silver.prepared(_bronze(spark)), rules.silver_rules()).collect()}
    assert counts["dropoff_not_before_pickup"] == 1
    assert counts["pickup_zone_valid"] == 1
    assert counts["passenger_count_valid"] == 1
    assert counts["trip_distance_valid"] == 0


def test_project_adds_version_and_pickup_date(spark):
    out = silver.project(silver.clean(_bronze(spark)), processed_at="x").first()
    assert out._silver_version == 1
    assert out.pickup_date == dt.date(2024, 1, 15)
    assert out._bronze_loaded_at == "2024-06-01T00:00:00+00:00"


def test_duration_truncates_sub_second(spark):
    rows = [raw_row(tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 10, 0, 1, 999999))]
    out = silver.derive(silver.rename_bronze(raw_frame(spark, rows))).first()
    assert out.trip_duration_seconds == 1.0


def test_nan_distance_rejected_and_null_zone_kept(spark):
    rows = [raw_row(trip_distance=float("nan")), raw_row(PULocationID=None)]
    b = jobs.enrich(raw_frame(spark, rows), trip_month=F.lit("2024-01"), source_file=F.lit("f"), loaded_at="x")
    kept = silver.clean(b).collect()
    assert len(kept) == 1 and kept[0].pu_location_id is None


def test_rename_is_case_insensitive_and_skips_absent(spark):
    df = raw_frame(spark, [raw_row()]).withColumnRenamed("Airport_fee", "airport_fee").drop("RatecodeID")
    out = silver.rename_bronze(df)
    assert "airport_fee" in out.columns and "ratecode_id" not in out.columns
    assert "vendor_id" in out.columns


def test_duration_and_month_ignore_session_time_zone(spark):
    from strata.functions.calendar import month_key

    rows = [raw_row(tpep_pickup_datetime=dt.datetime(2024, 3, 10, 1, 30), tpep_dropoff_datetime=dt.datetime(2024, 3, 10, 2, 45, 0, 600000))]
    got = []
    for tz in ("UTC", "America/Los_Angeles"):
        spark.conf.set("spark.sql.session.timeZone", tz)
        df = silver.derive(silver.rename_bronze(raw_frame(spark, rows)))
        got.append(df.select("trip_duration_seconds", month_key(F.col("dropoff_datetime")).alias("m")).first())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got[0] == got[1] and got[0].trip_duration_seconds == 4500.0 and got[0].m == "2024-03"
