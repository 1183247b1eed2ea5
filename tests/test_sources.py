import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from strata.plans import jobs
from strata.sources import catalog, trips
from tests.conftest import raw_row


def _write_month(path, month, rename=None, drop=None, n=2, as_double=None):
    rows = [raw_row() for _ in range(n)]
    cols = {k: [r[k] for r in rows] for k in rows[0]}
    if as_double:
        cols[as_double] = [float(v) for v in cols[as_double]]
    if drop:
        cols.pop(drop)
    if rename:
        cols[rename[1]] = cols.pop(rename[0])
    table = pa.table(cols)
    file = path / f"yellow_tripdata_{month}.parquet"
    pq.write_table(table, file)
    return str(file)


def test_raw_files_with_drifting_columns(spark, tmp_path, lake):
    files = [
        _write_month(tmp_path, "2024-01"),
        _write_month(tmp_path, "2024-02", rename=("Airport_fee", "airport_fee"), n=3),
        _write_month(tmp_path, "2024-03", drop="Airport_fee", n=1),
        _write_month(tmp_path, "2024-04", as_double="passenger_count", n=2),
    ]
    bronze = jobs.bronze_from_files(spark, files, loaded_at="l")
    rows = bronze.select("trip_month", "Airport_fee", "_source_file").collect()
    by_month = {}
    for r in rows:
        by_month.setdefault(r.trip_month, []).append(r.Airport_fee)
    assert {m: len(v) for m, v in by_month.items()} == {"2024-01": 2, "2024-02": 3, "2024-03": 1, "2024-04": 2}
    assert dict(bronze.dtypes)["passenger_count"] == "bigint"
    assert by_month["2024-02"] == [0.0, 0.0, 0.0]
    assert by_month["2024-03"] == [None]
    assert all(r._source_file.endswith(f"yellow_tripdata_{r.trip_month}.parquet") for r in rows)
    out = jobs.land_bronze(lake, bronze)
    assert out["rows"] == 8 and out["months_written"] == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_a_retyped_month_is_found_without_a_schema_read_per_path(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameReader

    months = [f"2024-{m:02d}" for m in range(1, 13)] + ["2025-01", "2025-02", "2025-03", "2025-04"]
    drop, rename = {"2024-02": "Airport_fee"}, {"2025-03": ("Airport_fee", "airport_fee")}
    files = [_write_month(tmp_path, m, n=1, drop=drop.get(m), rename=rename.get(m), as_double="passenger_count" if m == "2024-07" else None) for m in months]
    reads, real = [], DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda self, *paths, **k: reads.append(paths) or real(self, *paths, **k))
    groups = trips.schema_groups(spark, files)
    assert len(reads) == 9  # the whole, then two halves on each of four levels
    assert sorted(len(members) for _, members in groups) == [1, 15]
    assert sorted(sum((members for _, members in groups), [])) == sorted(files)
    assert {m[0][-15:-8] for _, m in groups if len(m) == 1} == {"2024-07"}
    rows = trips.read_raw_files(spark, files).collect()
    assert len(rows) == 16 and {r.passenger_count for r in rows} == {1}
    assert [r["_file_month"] for r in rows if r.Airport_fee is None] == ["2024-02"]


def test_zone_seed_keeps_na_strings(spark, tmp_path):
    csv = tmp_path / "zones.csv"
    csv.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
        '264,"Unknown","N/A","N/A"\n265,"N/A","Outside of City","N/A"\n'
    )
    rows = trips.read_zone_seed(spark, str(csv)).orderBy("LocationID").collect()
    assert [r.LocationID for r in rows] == [1, 264, 265]
    assert rows[1].Zone == "N/A" and rows[2].Borough == "N/A"


def test_register_view_and_gold_discovery(spark, lake):
    from tests.conftest import bronze_frame

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, processed_at="p")
    table = lake.table("silver", jobs.TRIPS).qualified
    view = f"{lake.prefix}silver_view"
    assert catalog.register_view(spark, view, table)["view"] == view
    assert spark.table(view).count() == 2
    with pytest.raises(ValueError):
        catalog.register_view(spark, "bad-name", table)
    with pytest.raises(FileNotFoundError):
        catalog.register_view(spark, "ok_name", f"{lake.prefix}silver.missing")
    assert catalog.try_register_view(spark, "ok_name", f"{lake.prefix}silver.missing") is None
    zones = spark.createDataFrame([(161, "Manhattan", "Midtown", "Yellow Zone")], trips.ZONE_SEED_SCHEMA)
    assert not catalog.gold_tables_present(spark, lake.namespace("gold"))
    jobs.build_gold(lake, zones)
    ns = catalog.gold_namespace(spark, prefix=lake.prefix)
    assert ns == lake.namespace("gold") and catalog.gold_tables_present(spark, ns)
    checks = {(r.test_name, r.column_name): r.failures for r in jobs.check_gold(lake, zones).collect()}
    assert checks[("unique", "trip_sk")] == 0 and checks[("relationships", "dropoff_zone_key")] == 2


def test_backfill_from_files_and_coverage(spark, tmp_path, lake):
    files = {
        "2024-01": _write_month(tmp_path, "2024-01", n=2),
        "2024-03": _write_month(tmp_path, "2024-03", n=1),
    }
    stats = {r.trip_month: (r.input_rows, r.output_rows) for r in jobs.backfill_files(lake, files, start="2024-01", end="2024-03").collect()}
    assert stats == {"2024-01": (2, 2), "2024-02": (0, 0), "2024-03": (1, 1)}
    from strata.sources import months

    cov = {r.trip_month: (r.rows, r.landed) for r in jobs.backfill_coverage(lake, months.month_range(spark, "2023-12", "2024-03")).collect()}
    assert cov == {"2023-12": (0, False), "2024-01": (2, True), "2024-02": (0, False), "2024-03": (1, True)}


def test_sized_write_rejects_non_positive_budget(spark, lake):
    from tests.conftest import bronze_frame

    with pytest.raises(ValueError):
        jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 1), target_bytes=0)


def test_review_compacts_both_layers(spark, lake):
    from strata.plans import layout, tables
    from tests.conftest import bronze_frame

    b = lake.table("bronze", jobs.TRIPS)
    lake.ensure_namespace("bronze")
    frame = bronze_frame(spark, "2024-01", 30)
    tables.create_table(b, frame.schema)
    tables.replace_months(frame, b, max_records_per_file=10)
    jobs.build_silver(lake, processed_at="p")
    out = layout.review({"bronze": b, "silver": lake.table("silver", jobs.TRIPS)}, "2024-01")
    before = {r.table: r.file_count for r in out["layout_before"].collect()}
    after = {r.table: r.file_count for r in out["layout_after"].collect()}
    assert before["bronze"] == 3 and after == {"bronze": 1, "silver": 1}
    audit = {(r.table, r.query): (r.files_read, r.partition_pruned) for r in out["audit_after"].collect()}
    assert audit[("bronze", "month_count")] == (1, True)
    assert ("bronze", "daily_fare") not in audit and ("silver", "daily_fare") in audit


def test_month_of_file_ignores_part_file_uuids(spark, tmp_path):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("2024-03", 1), ("2024-04", 2)], "trip_month string, n long")
    df.write.partitionBy("trip_month").parquet(str(tmp_path / "by_folder"))
    got = spark.read.parquet(str(tmp_path / "by_folder")).select(trips.month_of_file().alias("m"), "n").collect()
    assert sorted((r.m, r.n) for r in got) == [("2024-03", 1), ("2024-04", 2)]
    names = spark.createDataFrame(
        [("part-00000-a1b2c3d4-1234-1234-1234-123456789abc.c000.snappy.parquet",), ("yellow_tripdata_2024-01.parquet",)],
        "name string",
    )
    out = [r.m for r in names.select(F.regexp_extract("name", trips.MONTH_IN_FILE_NAME, 1).alias("m")).collect()]
    assert out == ["", "2024-01"]


def test_attach_reregisters_tables_after_catalog_loss(spark, tmp_path, lake):
    from tests.conftest import bronze_frame

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, processed_at="p")
    for layer in ("bronze", "silver"):
        spark.sql(f"DROP TABLE {lake.table(layer, jobs.TRIPS).qualified}")  # external: files stay
    attached = jobs.attach(lake)
    assert len(attached) == 2
    assert jobs.rows_by_month(lake.table("silver", jobs.TRIPS).read()).first().rows == 2
    assert "_silver_version" in lake.table("silver", jobs.TRIPS).read().columns


def test_cli_end_to_end(spark, tmp_path, capsys):
    import json

    from strata.__main__ import main

    files = [_write_month(tmp_path, "2024-01", n=2), _write_month(tmp_path, "2024-02", n=1)]
    zones = tmp_path / "zones.csv"
    zones.write_text('"LocationID","Borough","Zone","service_zone"\n161,"Manhattan","Midtown Center","Yellow Zone"\n162,"Manhattan","Midtown East","Yellow Zone"\n')
    root = str(tmp_path / "cli-lake")
    base = ["--root", root, "--prefix", "cli_"]
    assert trips.re_month(files[0]) == "2024-01"
    main(base + ["land", *files, "--start", "2024-01", "--end", "2024-02"])
    main(base + ["gold", "--zones", str(zones)])
    capsys.readouterr()
    main(base + ["marts", "--months", "2024-01"])
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    kpi = lines[lines.index({"section": "kpis"}) + 1]
    assert kpi["total_trips"] == 2 and kpi["total_revenue"] == 29.0


def test_serving_surface_over_a_reopened_lake(spark, tmp_path, lake):
    from strata import serving
    from tests.conftest import bronze_frame

    jobs.land_bronze(lake, bronze_frame(spark, "2024-01", 2))
    jobs.build_silver(lake, processed_at="p")
    zones = spark.createDataFrame([(161, "Manhattan", "Midtown", "Yellow Zone")], trips.ZONE_SEED_SCHEMA)
    jobs.build_gold(lake, zones)
    for layer, name in jobs.KNOWN_TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {lake.table(layer, name).qualified}")
    reopened = serving.open_gold(spark, lake.root, prefix=lake.prefix)
    assert serving.gold_tables_present(reopened)
    assert serving.list_trip_months(reopened) == ["2024-01"]
    assert serving.monthly_revenue(reopened, trip_months=["2024-01"]).first().total_revenue == 29.0
    assert serving.top_pickup_zones(reopened, limit=5).first().zone_name == "Midtown"
    assert serving.register_silver_view(reopened, f"{lake.prefix}sv")["view"] == f"{lake.prefix}sv"
    with pytest.raises(FileNotFoundError):
        serving.open_gold(spark, str(tmp_path / "empty-lake"), prefix="nothing_here_")


def test_delivered_months_are_several_files_and_no_row_is_lost(spark, tmp_path):
    from collections import Counter

    from strata import registry
    from strata.session import session_conf
    from strata.sources import trips

    sf = "/root/testdata/sf0.001"
    folder = str(tmp_path / "delivered")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8192", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1024"}
    with session_conf(spark, small):
        paths = registry._monthly_files(spark, sf, folder)
    months = Counter(trips.re_month(p) for p in paths)
    want = Counter(r.trip_month for r in registry.bronze_frame(spark, sf).select("trip_month").collect())
    assert set(months) == set(want) and max(months.values()) >= 2
    read = trips.read_raw_files(spark, paths).groupBy("_file_month").count().collect()
    assert {r["_file_month"]: r["count"] for r in read} == dict(want)
    # the write is not cut to a fixed number of tasks: names tell the task
    assert len({p.rsplit("/", 1)[-1].split("-")[1] for p in paths}) > 2


def test_a_month_delivered_again_in_several_files(spark, monkeypatch):
    from strata import registry

    monkeypatch.setattr(registry, "DELIVERED_ROWS", 20)
    sf = "/root/testdata/sf0.001"
    got = {r.trip_month: r.rows for r in registry.q_stream_redelivered(spark, sf).collect()}
    rows = registry.bronze_frame(spark, sf).groupBy("trip_month").count().collect()
    want = {r.trip_month: r["count"] for r in rows if r.trip_month in registry.FILTER_MONTHS}
    assert max(want.values()) > 20
    assert got == {m: n * (2 if m == registry.FILTER_MONTHS[0] else 1) for m, n in want.items()}
