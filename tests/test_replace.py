from strata.plans import jobs, tables
from tests.conftest import bronze_frame


def _counts(lake, layer="bronze"):
    t = lake.table(layer, jobs.TRIPS)
    return {r.trip_month: r.rows for r in jobs.rows_by_month(t.read()).collect()}


def test_rerun_does_not_duplicate(spark, lake):
    for _ in range(2):
        jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    assert _counts(lake) == {"2024-01": 2}


def test_new_count_replaces_month(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 5))
    assert _counts(lake) == {"2024-01": 5}


def test_months_are_independent(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 3))
    assert _counts(lake) == {"2024-01": 2, "2024-02": 3}


def test_first_landing_creates_table(spark, lake):
    out = jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 1))
    assert out["rows"] == 1 and out["table"].endswith("bronze.yellow_taxi_trips")
    props = tables.table_properties(lake.table("bronze", jobs.TRIPS))
    assert props[tables.WRITE_TARGET_PROPERTY] == str(2 * 1024**3)


def test_requested_month_without_rows_is_cleared(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 1).limit(0), months=["2024-01"])
    assert _counts(lake) == {}


def test_silver_follows_bronze(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 4))
    stats = jobs.build_silver(lake, ["2024-01"], processed_at="p").collect()
    assert [(r.input_rows, r.output_rows, r.rejected_rows) for r in stats] == [(4, 4, 0)]
    assert _counts(lake, "silver") == {"2024-01": 4}
    silver = lake.table("silver", jobs.TRIPS).read()
    assert "pickup_date" in silver.columns and "_silver_version" in silver.columns


def test_empty_bronze_month_clears_silver(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    jobs.clear_months(lake.table("bronze", jobs.TRIPS), ["2024-01"])
    stats = jobs.build_silver(lake, ["2024-01"], processed_at="p").collect()
    assert [(r.trip_month, r.input_rows) for r in stats] == [("2024-01", 0)]
    assert _counts(lake, "silver") == {}


def test_all_rejected_month_keeps_or_clears(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 3, passenger_count=-1))
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    assert _counts(lake, "silver") == {"2024-01": 2}
    jobs.build_silver(lake, ["2024-01"], processed_at="p", on_all_rejected="clear")
    assert _counts(lake, "silver") == {}


def test_evolution_adds_columns_old_rows_null(spark, lake):
    from pyspark.sql import types as T

    t = lake.table("silver", "evolving")
    lake.ensure_namespace("silver")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("trip_month", T.StringType())])
    tables.create_table(t, schema)
    tables.replace_months(spark.createDataFrame([(1, "2024-01")], schema), t)
    assert tables.evolve(t, {"pickup_date": T.DateType()}) is True
    assert tables.evolve(t, {"pickup_date": T.DateType()}) is False
    rows = t.read().collect()
    assert rows[0].pickup_date is None


def test_align_reorders_and_casts(spark):
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.IntegerType())])
    df = spark.createDataFrame([(2, 1)], "b long, a int")
    out = tables.align(df, target)
    assert out.schema == target or [f.dataType for f in out.schema] == [T.LongType(), T.IntegerType()]
    assert out.columns == ["a", "b"]


def test_contract_failure_raises_before_write_and_old_month_survives(spark, lake):
    import pytest

    from strata.operators.contract import ContractError

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 3, VendorID=None))
    with pytest.raises(ContractError) as err:
        jobs.build_silver(lake, ["2024-01"], processed_at="p")
    assert ("vendor_id", "not_null", 3) in err.value.failures
    assert _counts(lake, "silver") == {"2024-01": 2}


def test_namespace_and_table_creation_are_idempotent(spark, lake):
    from pyspark.sql import types as T

    assert jobs.bootstrap(lake) == jobs.bootstrap(lake)
    t = lake.table("bronze", "idem")
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("trip_month", T.StringType())])
    assert tables.create_table(t, schema) is True
    assert tables.create_table(t, schema) is False
    assert tables.ensure_write_target(t) is True and tables.ensure_write_target(t) is False


def test_empty_month_list_is_a_no_op_for_jobs(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    assert jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 1), months=[])["rows"] == 0
    assert jobs.build_silver(lake, [], processed_at="p").count() == 0
    assert _counts(lake) == {"2024-01": 2}


def test_run_record_names_rows_and_table(spark, lake):
    out = jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2).unionByName(bronze_frame(spark, "2024-02", 3)))
    assert out["rows_by_month"] == {"2024-01": 2, "2024-02": 3}
    record = jobs.build_silver(lake, processed_at="p").collect()
    t = lake.table("silver", jobs.TRIPS)
    assert [(r.trip_month, r.output_rows) for r in record] == [("2024-01", 2), ("2024-02", 3)]
    assert {(r.table_name, r.table_location) for r in record} == {(t.qualified, t.location)}


def test_rejected_trip_without_month_is_reported(spark, lake):
    from pyspark.sql import functions as F

    lost = bronze_frame(spark, "2024-01", 1).withColumns(
        {"trip_month": F.lit(None).cast("string"), "tpep_pickup_datetime": F.lit(None).cast("timestamp_ntz")}
    )
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2).unionByName(lost))
    record = jobs.build_silver(lake, processed_at="p").collect()
    assert [(r.trip_month, r.input_rows, r.output_rows) for r in record] == [(None, 1, 0), ("2024-01", 2, 2)]
    assert _counts(lake, "silver") == {"2024-01": 2}


def test_kept_trip_without_month_fails_the_contract(spark, lake):
    import pytest
    from pyspark.sql import functions as F

    from strata.operators.contract import ContractError

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2).withColumn("trip_month", F.lit(None).cast("string")))
    with pytest.raises(ContractError) as err:
        jobs.build_silver(lake, processed_at="p")
    assert ("trip_month", "not_null", 2) in err.value.failures


def test_emptied_silver_gives_empty_gold(spark, lake):
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, processed_at="p")
    jobs.clear_months(lake.table("bronze", jobs.TRIPS), ["2024-01"])
    jobs.build_silver(lake, ["2024-01"], processed_at="p")
    zones = spark.createDataFrame([(1, "b", "z", "s")], "LocationID long, Borough string, Zone string, service_zone string")
    jobs.build_gold(lake, zones)
    fact, dim_zone, dates = jobs.gold_tables(lake)
    assert (fact.count(), dim_zone.count(), dates.count()) == (0, 1, 0)
    assert dict(fact.dtypes)["trip_month"] == "string"


def test_months_in_statements_are_checked(spark, lake):
    import pytest

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    with pytest.raises(ValueError):
        jobs.clear_months(lake.table("bronze", jobs.TRIPS), ["2024-01') --"])


def _lost_driver(monkeypatch, name, after=0):
    """The driver ends in the middle of publishing: the call after ``after`` fails."""
    from strata.plans import versions

    real, calls = getattr(versions, name), []

    def failing(*args, **kwargs):
        calls.append(args)
        if len(calls) > after:
            raise OSError("driver lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(versions, name, failing)


def test_failure_between_write_and_publish_changes_nothing(spark, lake, monkeypatch):
    import pytest

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2).unionByName(bronze_frame(spark, "2024-02", 3)))
    _lost_driver(monkeypatch, "publish")
    with pytest.raises(OSError, match="driver lost"):
        jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 7).unionByName(bronze_frame(spark, "2024-02", 8)))
    monkeypatch.undo()
    assert _counts(lake) == {"2024-01": 2, "2024-02": 3}
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 9))  # the unpublished months stay unseen
    assert _counts(lake) == {"2024-01": 2, "2024-02": 9}


def test_failure_between_two_months_leaves_whole_months_and_is_caught_up(spark, lake, monkeypatch):
    import pytest

    from strata.plans import versions

    old = {"2024-01": 2, "2024-02": 3, "2024-03": 4}
    new = {"2024-01": 5, "2024-02": 6}

    def frame(counts):
        frames = [bronze_frame(spark, m, n) for m, n in counts.items()]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    jobs.land_bronze(lake, frame(old))
    _lost_driver(monkeypatch, "_spec", after=1)  # the second month's statement
    with pytest.raises(OSError, match="driver lost"):
        jobs.land_bronze(lake, frame(new))
    monkeypatch.undo()
    t = lake.table("bronze", jobs.TRIPS)
    spark.catalog.refreshTable(t.qualified)
    assert _counts(lake) == {"2024-01": 5, "2024-02": 3, "2024-03": 4}  # each month whole, old or new
    jobs.land_bronze(lake, frame({"2024-03": 1}))  # the next publish finishes the last
    assert _counts(lake) == {"2024-01": 5, "2024-02": 6, "2024-03": 1}
    spark.sql(f"DROP TABLE {t.qualified}")
    jobs.attach(lake)  # as does a new session
    assert _counts(lake) == {"2024-01": 5, "2024-02": 6, "2024-03": 1}
    assert set(versions.month_versions(spark, t.location)) == set(old)


def test_replaced_folders_are_kept_once_and_then_deleted(spark, lake):
    from strata.plans import versions
    from strata.sources import storage

    t = lake.table("bronze", jobs.TRIPS)
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 1))
    held = None
    for n in (1, 2, 3):
        jobs.land_bronze(lake, bronze_frame(spark, "2024-01", n))
        if n == 2:
            held = versions.month_versions(spark, t.location)["2024-01"][-1]
    assert spark.read.parquet(held).count() == 2  # for a reader that holds the folder before
    assert [len(v) for _, v in sorted(versions.month_versions(spark, t.location).items())] == [2, 1]
    jobs.clear_months(t, ["2024-01"])
    assert _counts(lake) == {"2024-02": 1}
    assert set(versions.month_versions(spark, t.location)) == {"2024-02"}
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 4))
    left = [c for c in storage.list_children(spark, t.location) if c.startswith(versions.VERSION_PREFIX)]
    assert len(left) == 2  # folders without a month are gone


def test_silver_reads_bronze_once_and_a_failed_audit_leaves_no_folder(spark, lake):
    import pytest

    from strata.operators.contract import ContractError
    from strata.sources import storage

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    scans = []
    real = jobs.stage_months

    def seen(df, *args, **kwargs):
        scans.append(df._jdf.queryExecution().executedPlan().toString().count("FileScan"))
        return real(df, *args, **kwargs)

    jobs.stage_months = seen
    try:
        jobs.build_silver(lake, processed_at="p")
    finally:
        jobs.stage_months = real
    assert scans == [1]  # checks and write in one scan; month counts come from footers
    counted = jobs.rows_by_month(lake.table("bronze", jobs.TRIPS).read())
    assert "ReadSchema: struct<>" in counted._jdf.queryExecution().toString()
    silver_t = lake.table("silver", jobs.TRIPS)
    folders = storage.list_children(spark, silver_t.location)
    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 3, VendorID=None))
    with pytest.raises(ContractError):
        jobs.build_silver(lake, processed_at="p")
    assert storage.list_children(spark, silver_t.location) == folders


def test_only_months_whose_bronze_changed_are_stale(spark, lake):
    def stale(planned=None):
        return {r.trip_month: r.reason for r in jobs.stale_months(lake, planned).collect()}

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2).unionByName(bronze_frame(spark, "2024-02", 3)))
    assert stale() == {"2024-01": "new", "2024-02": "new"}
    jobs.build_silver(lake, processed_at="p")
    assert stale() == {}
    jobs.land_bronze(lake, bronze_frame(spark, "2024-02", 3))  # the same rows in other files
    jobs.land_bronze(lake, bronze_frame(spark, "2024-03", 1))
    jobs.clear_months(lake.table("bronze", jobs.TRIPS), ["2024-01"])
    assert stale() == {"2024-01": "gone", "2024-02": "changed", "2024-03": "new"}
    assert stale(spark.createDataFrame([("2024-03",)], "trip_month string")) == {"2024-03": "new"}
    jobs.build_silver(lake, list(stale()), processed_at="p")
    assert stale() == {} and _counts(lake, "silver") == {"2024-02": 3, "2024-03": 1}


def test_a_landing_leaves_no_shuffle_files(spark, lake):
    import time
    from pathlib import Path

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffled = lambda: {p for d in folders for p in Path(d).rglob("shuffle_*.data")}
    before = shuffled()
    t = lake.table("bronze", "swept")
    lake.ensure_namespace("bronze")
    schema = "n long, trip_month string"
    tables.create_table(t, spark.createDataFrame([], schema).schema)
    tables.replace_months(spark.range(1000).selectExpr("id AS n", "'2024-01' AS trip_month").repartition(4), t)
    until = time.time() + 10
    while shuffled() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffled() - before
    assert t.read().count() == 1000
