import pytest

from strata.sources import months


def test_single_and_range():
    assert months.month_strings("2024-01", "2024-01") == ["2024-01"]
    assert months.month_strings("2024-01", "2024-03") == ["2024-01", "2024-02", "2024-03"]
    assert len(months.month_strings("2024-01", "2025-12")) == 24


def test_reversed_range_and_bad_format_raise():
    with pytest.raises(ValueError):
        months.month_strings("2024-06", "2024-01")
    for wrong in ("2024", "2024-1", "2024-13", "2024-00", "24-01", "2024-01-01", " 2024-01", ""):
        with pytest.raises(ValueError):
            months.month_number(wrong)


def test_month_range_dataframe(spark):
    rows = months.month_range(spark, "2024-11", "2025-02").collect()
    assert [r.trip_month for r in rows] == ["2024-11", "2024-12", "2025-01", "2025-02"]


def test_defaults_from_env(monkeypatch):
    monkeypatch.setenv(months.START_ENV, "2023-05")
    assert months.resolve_range(None, "2023-06") == ("2023-05", "2023-06")


def test_manifest(spark):
    m = months.manifest(months.month_range(spark, "2024-01", "2024-01"), base_url="s3://b/x/", staging_dir="/s")
    r = m.first()
    assert r.local_path == "/s/yellow_tripdata_2024-01.parquet"
    assert r.source_url == "s3://b/x/yellow_tripdata_2024-01.parquet"


def test_backfill_plan_keys():
    keys = months.month_strings("2024-01", "2025-12")
    assert keys[0] == "2024-01" and keys[-1] == "2025-12" and all(len(k) == 7 for k in keys)


def test_scale_settings():
    from strata.session import scale_settings

    conf = scale_settings(100 * 10**12, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) > 300_000
    assert scale_settings(10**6, total_cores=8)["spark.sql.shuffle.partitions"] == "24"
