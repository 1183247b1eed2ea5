import pytest
from pyspark.sql import functions as F

from strata.functions.money import amount, exact, exact_sum, mean, rounded_mean
from strata.operators import contract, silver
from strata.plans import jobs
from tests.conftest import raw_frame, raw_row


def _projected(spark, rows):
    b = jobs.enrich(raw_frame(spark, rows), trip_month=F.lit("2024-01"), source_file=F.lit("f"), loaded_at="l")
    return silver.project(silver.clean(b), processed_at="p")


def test_valid_frame_passes(spark):
    out = contract.validate(_projected(spark, [raw_row()]), contract.silver_contract())
    assert out.columns == contract.silver_contract().names


def test_null_vendor_fails_contract(spark):
    df = _projected(spark, [raw_row(VendorID=None)])
    with pytest.raises(contract.ContractError) as err:
        contract.validate(df, contract.silver_contract())
    assert ("vendor_id", "not_null", 1) in err.value.failures


def test_missing_and_extra_columns_fail(spark):
    df = _projected(spark, [raw_row()]).drop("airport_fee").withColumn("junk", F.lit(1))
    with pytest.raises(contract.ContractError) as err:
        contract.validate(df, contract.silver_contract())
    kinds = {(c, k) for c, k, _ in err.value.failures}
    assert ("airport_fee", "present") in kinds and ("junk", "unexpected") in kinds


def test_coercion_and_failed_casts(spark):
    df = _projected(spark, [raw_row()]).withColumn("passenger_count", F.lit("x"))
    rep = {(r.column_name, r.check_name): r.failures for r in contract.report(df, contract.silver_contract()).collect()}
    assert rep[("passenger_count", "coerce")] == 1
    ok = _projected(spark, [raw_row()]).withColumn("passenger_count", F.col("passenger_count").cast("string"))
    out = contract.validate(ok, contract.silver_contract())
    assert dict(out.dtypes)["passenger_count"] == "bigint"


def test_totals_are_rounded_once(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (float("nan"),), (None,)], "x double")
    n = F.count(exact("x"))
    r = df.agg(amount(exact_sum("x")).alias("s"), rounded_mean(exact_sum("x"), n).alias("a"), mean(exact_sum("x"), n).alias("m")).first()
    assert r.s == 1.29 and r.a == 0.65 and r.m == 0.645
    many = spark.range(100).select(F.lit(1.004).alias("x"))
    assert many.agg(amount(exact_sum("x")).alias("s")).first().s == 100.4


def test_mean_of_two_million_amounts(spark):
    """(2,000,000 x 10 + 21.005) / 2,000,001 cents lies just below a half cent."""
    total, n = F.lit("210000.10").cast("decimal(38,9)"), F.lit(2_000_001)
    assert spark.range(1).select(rounded_mean(total, n).alias("a")).first().a == 0.1
    down = F.lit("-210000.10").cast("decimal(38,9)")
    assert spark.range(1).select(rounded_mean(down, n).alias("a")).first().a == -0.1
