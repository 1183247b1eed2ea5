import pytest

from strata.plans import jobs
from strata.streaming.landing import start_landing
from tests.test_sources import _write_month


def _counts(lake, layer):
    return {r.trip_month: r.rows for r in jobs.rows_by_month(lake.table(layer, jobs.TRIPS).read()).collect()}


def test_stream_lands_new_files_and_replays_nothing(spark, tmp_path, lake):
    src = tmp_path / "landing"
    src.mkdir()
    ckpt = str(tmp_path / "ckpt")
    _write_month(src, "2024-01", n=2)
    q = start_landing(lake, str(src), checkpoint=ckpt, loaded_at="l", build_silver=True)
    q.awaitTermination(120)
    assert _counts(lake, "bronze") == {"2024-01": 2}
    assert _counts(lake, "silver") == {"2024-01": 2}
    _write_month(src, "2024-02", n=3)
    q = start_landing(lake, str(src), checkpoint=ckpt, loaded_at="l", build_silver=True)
    q.awaitTermination(120)
    assert _counts(lake, "bronze") == {"2024-01": 2, "2024-02": 3}
    assert _counts(lake, "silver") == {"2024-01": 2, "2024-02": 3}


def test_month_in_several_files_one_file_per_batch(spark, tmp_path, lake):
    src = tmp_path / "landing"
    for k, n in enumerate((3, 5)):
        part = src / f"part{k}"
        part.mkdir(parents=True)
        _write_month(part, "2024-01", n=n)
    other = src / "part9"
    other.mkdir()
    _write_month(other, "2024-02", n=1)
    q = start_landing(lake, str(src), checkpoint=str(tmp_path / "c"), loaded_at="l", max_files_per_trigger=1)
    q.awaitTermination(120)
    assert q.exception() is None
    assert _counts(lake, "bronze") == {"2024-01": 8, "2024-02": 1}


def test_file_without_month_stops_the_stream(spark, tmp_path, lake):
    src = tmp_path / "landing"
    src.mkdir()
    _write_month(src, "2024-01", n=1)
    (src / "yellow_tripdata_2024-01.parquet").rename(src / "trips.parquet")
    q = start_landing(lake, str(src), checkpoint=str(tmp_path / "c"), loaded_at="l")
    with pytest.raises(Exception, match="no month"):
        q.awaitTermination(120)


def test_files_of_a_month_are_all_kept():
    found = jobs.paths_by_month(["a/yellow_tripdata_2024-01.parquet", "b/yellow_tripdata_2024-01.parquet", "c/x-2024-02.parquet"])
    assert {m: len(p) for m, p in found.items()} == {"2024-01": 2, "2024-02": 1}
    with pytest.raises(ValueError, match="trips.parquet"):
        jobs.paths_by_month(["a/trips.parquet"])


def test_file_delivered_again_replaces_its_rows(spark, tmp_path, lake):
    from strata.streaming.landing import changed_files, reland_changed

    src = tmp_path / "landing"
    (src / "a").mkdir(parents=True)
    (src / "b").mkdir()
    _write_month(src / "a", "2024-01", n=2)
    _write_month(src / "b", "2024-01", n=4)
    q = start_landing(lake, str(src), checkpoint=str(tmp_path / "c"), loaded_at="l")
    q.awaitTermination(120)
    assert _counts(lake, "bronze") == {"2024-01": 6} and changed_files(lake, str(src)) == []
    _write_month(src / "a", "2024-01", n=5)
    assert len(changed_files(lake, str(src))) == 1
    q = start_landing(lake, str(src), checkpoint=str(tmp_path / "c"), loaded_at="l", build_silver=True)
    q.awaitTermination(120)
    assert _counts(lake, "bronze") == _counts(lake, "silver") == {"2024-01": 9}
    assert reland_changed(lake, str(src)) == []
