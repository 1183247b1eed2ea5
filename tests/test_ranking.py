from pyspark.sql import functions as F

from strata.operators import gold, ranking
from strata.plans import jobs
from strata.registry import LIMITS
from strata.operators import silver
from strata.params import COARSE_DUP_KEY
from tests.conftest import SF_SMALL


def _stg(spark):
    b = jobs.bronze_from_tables(spark, SF_SMALL, loaded_at="l")
    s = silver.project(silver.clean(b, LIMITS), processed_at="p")
    return gold.staging(s)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def _plain(df, key):
    order = ["source_file", *(c for c in df.columns if c not in {*key, "source_file"})]
    return ranking.plain_rank(df, key, [F.col(c).asc_nulls_last() for c in order], "trip_dup_rank")


def test_rank_equals_plain_window(spark):
    stg = _stg(spark)
    for key in (COARSE_DUP_KEY, ["pickup_datetime"], ["vendor_id"], gold.DUP_KEY):
        ranked = gold.dup_rank(stg, key)
        assert ranked.columns == [*stg.columns, "trip_dup_rank"]
        assert _sorted(ranked) == _sorted(_plain(stg, key)), key


def test_one_giant_group_of_identical_rows(spark):
    base_row = _stg(spark).orderBy("pickup_datetime", "total_amount").first()
    big = spark.createDataFrame([base_row] * 300, _stg(spark).schema).unionByName(_stg(spark))
    ranked = gold.dup_rank(big, gold.DUP_KEY)
    assert _sorted(ranked) == _sorted(_plain(big, gold.DUP_KEY))
    same = F.lit(True)
    for k in gold.DUP_KEY:
        same = same & F.col(k).eqNullSafe(F.lit(base_row[k]))
    ranks = sorted(r.trip_dup_rank for r in ranked.filter(same).collect())
    assert ranks == list(range(1, 302))


def test_groups_with_null_keys_and_cut_pieces(spark):
    rows = [(None if k % 3 == 0 else k % 2, k % 7 if k % 5 else None, float(k % 11)) for k in range(4000)]
    df = spark.createDataFrame(rows, "a long, b long, c double").repartition(6)
    got = ranking.skew_safe_rank(df, ["a"], ["b", "c"], rank_col="r")
    want = ranking.plain_rank(df, ["a"], [F.col(c).asc_nulls_last() for c in ("b", "c")], "r")
    assert _sorted(got.fillna(-1)) == _sorted(want.fillna(-1))
    assert ranking.skew_safe_rank(df.limit(0), ["a"], ["b", "c"]).count() == 0


def test_identical_rows_span_pieces(spark, monkeypatch):
    half = spark.range(20_000).select(F.lit(7).cast("long").alias("a"), F.lit(1).cast("long").alias("b"))
    rest = spark.range(20_000).select((F.col("id") % 900).alias("a"), F.col("id").alias("b"))
    df = half.unionByName(rest).repartition(5)
    saved = {}
    real = ranking._save
    monkeypatch.setattr(ranking, "_save", lambda frame, purpose: saved.setdefault(purpose, real(frame, purpose)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranking.skew_safe_rank(df, ["a"], ["b"], rank_col="r")
        want = ranking.plain_rank(df, ["a"], [F.col("b").asc_nulls_last()], "r")
        assert _sorted(got) == _sorted(want)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in saved["rank-pieces"].groupBy("_piece").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_repeated_rows_are_dealt_by_their_number(spark, monkeypatch):
    # copies compress to next to nothing: by bytes one task would get them all
    df = spark.range(6000).select((F.col("id") % 40).alias("a"), F.lit(1).cast("long").alias("b"))
    saved = {}
    real = ranking._save
    monkeypatch.setattr(ranking, "_save", lambda frame, purpose: saved.setdefault(purpose, real(frame, purpose)))
    monkeypatch.setattr(ranking, "PIECE_ROWS", 500)
    got = ranking.skew_safe_rank(df, ["a"], ["b"], rank_col="r")
    assert _sorted(got) == _sorted(ranking.plain_rank(df, ["a"], [F.col("b").asc_nulls_last()], "r"))
    sizes = [r["count"] for r in saved["rank-pieces"].groupBy("_piece").count().collect()]
    assert len(sizes) >= 10 and max(sizes) < 1500


def test_only_large_groups_are_cut_into_pieces(spark, monkeypatch):
    pairs = spark.range(6000).select((F.col("id") % 3000).alias("a"), F.col("id").alias("b"))
    giant = spark.range(4000).select(F.lit(-1).cast("long").alias("a"), (F.col("id") % 9).alias("b"))
    nameless = spark.range(3).select(F.lit(None).cast("long").alias("a"), F.col("id").alias("b"))
    saved = {}
    real = ranking._save
    monkeypatch.setattr(ranking, "_save", lambda frame, purpose: saved.setdefault(purpose, real(frame, purpose)))
    df = pairs.unionByName(giant).unionByName(nameless).repartition(4)
    got = ranking.skew_safe_rank(df, ["a"], ["b"], rank_col="r")
    want = ranking.plain_rank(df, ["a"], [F.col("b").asc_nulls_last()], "r")
    assert _sorted(got.fillna(-9)) == _sorted(want.fillna(-9))
    assert saved["rank-pieces"].count() < 4100  # the giant, and what shares its bit
    saved.clear()
    monkeypatch.setattr(ranking, "PIECE_ROWS", 2000)  # dealt by number; groups of up to 8 rows stay whole
    few = pairs.unionByName(nameless)
    got = ranking.skew_safe_rank(few, ["a"], ["b"], rank_col="r")
    want = ranking.plain_rank(few, ["a"], [F.col("b").asc_nulls_last()], "r")
    assert _sorted(got.fillna(-9)) == _sorted(want.fillna(-9))
    assert set(saved) == {"rank-marks"}
