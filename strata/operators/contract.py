"""Typed table contract: strict columns, coercion, nullability and ranges.

The whole data check is ONE aggregation (conditional counts, partial
aggregation on the map side) whose single row is unpivoted into a report
``(column_name, check_name, failures)``. Structural checks (missing or
unexpected columns) come from the schema and need no data pass.
``validate`` raises before anything is written, naming every failing check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.rules import TripLimits


@dataclass(frozen=True)
class FieldSpec:
    name: str
    dtype: T.DataType
    nullable: bool = False
    ge: float | None = None
    le: float | None = None


@dataclass(frozen=True)
class Contract:
    fields: tuple[FieldSpec, ...]
    strict: bool = True
    coerce: bool = True
    name: str = "contract"

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def schema(self, exclude: tuple[str, ...] = ()) -> T.StructType:
        return T.StructType(
            [T.StructField(f.name, f.dtype, f.nullable) for f in self.fields if f.name not in exclude]
        )


class ContractError(ValueError):
    def __init__(self, contract: str, failures: list[tuple[str, str, int]]):
        self.failures = failures
        detail = ", ".join(f"{c}:{k}={n}" for c, k, n in failures)
        super().__init__(f"{contract} violated: {detail}")


def silver_contract(limits: TripLimits = TripLimits()) -> Contract:
    L, D, S = T.LongType(), T.DoubleType(), T.StringType()
    ts = T.TimestampNTZType()
    zmin, zmax = float(limits.min_zone_id), float(limits.max_zone_id)
    return Contract(
        name="silver.yellow_taxi_trips",
        fields=(
            FieldSpec("vendor_id", L),
            FieldSpec("pickup_datetime", ts),
            FieldSpec("dropoff_datetime", ts),
            FieldSpec("passenger_count", L, ge=0),
            FieldSpec("trip_distance", D, ge=0.0, le=limits.max_trip_distance),
            FieldSpec("ratecode_id", L, nullable=True),
            FieldSpec("store_and_fwd_flag", S, nullable=True),
            FieldSpec("pu_location_id", L, nullable=True, ge=zmin, le=zmax),
            FieldSpec("do_location_id", L, nullable=True, ge=zmin, le=zmax),
            FieldSpec("payment_type", L, nullable=True),
            FieldSpec("fare_amount", D, nullable=True),
            FieldSpec("extra", D, nullable=True),
            FieldSpec("mta_tax", D, nullable=True),
            FieldSpec("tip_amount", D, nullable=True),
            FieldSpec("tolls_amount", D, nullable=True),
            FieldSpec("improvement_surcharge", D, nullable=True),
            FieldSpec("total_amount", D, ge=0.0, le=limits.max_total_amount),
            FieldSpec("congestion_surcharge", D, nullable=True),
            FieldSpec("airport_fee", D, nullable=True),
            FieldSpec("trip_duration_seconds", D, ge=0.0),
            FieldSpec("pickup_date", T.DateType()),
            FieldSpec("trip_month", S),
            FieldSpec("_bronze_loaded_at", S),
            FieldSpec("_source_file", S),
            FieldSpec("_silver_processed_at", S),
            FieldSpec("_silver_version", T.IntegerType(), ge=1),
        ),
    )


def structure_failures(df: DataFrame, contract: Contract) -> list[tuple[str, str, int]]:
    """Missing / unexpected columns (schema only, no data read)."""
    present = set(df.columns)
    out = [(n, "present", 0 if n in present else 1) for n in contract.names]
    if contract.strict:
        expected = set(contract.names)
        out += [(c, "unexpected", 1) for c in df.columns if c not in expected]
    return out


def _coerced(df: DataFrame, spec: FieldSpec) -> Column:
    c = F.col(spec.name)
    if df.schema[spec.name].dataType == spec.dtype:
        return c
    return c.try_cast(spec.dtype)


def coerce(df: DataFrame, contract: Contract, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """Cast to declared types (failed casts become NULL and are counted by the
    report); ``keep``: columns outside the contract that stay."""
    present = set(df.columns)
    return df.select(
        [_coerced(df, f).alias(f.name) for f in contract.fields if f.name in present]
        + [c for c in df.columns if c not in set(contract.names) and (c in keep or not contract.strict)]
    )


def data_checks(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    checks: list[tuple[str, str, Column]] = []
    present = set(df.columns)
    for spec in contract.fields:
        if spec.name not in present:
            continue
        raw = F.col(spec.name)
        val = _coerced(df, spec)
        if contract.coerce and df.schema[spec.name].dataType != spec.dtype:
            checks.append((spec.name, "coerce", raw.isNotNull() & val.isNull()))
        if not spec.nullable:
            checks.append((spec.name, "not_null", val.isNull()))
        if spec.ge is not None:
            checks.append((spec.name, "ge", val < F.lit(spec.ge)))
        if spec.le is not None:
            checks.append((spec.name, "le", val > F.lit(spec.le)))
    return checks


def data_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """``(column_name, check_name, failures)`` from one aggregation pass."""
    spark = df.sparkSession
    checks = data_checks(df, contract)
    if not checks:
        return spark.createDataFrame([], "column_name string, check_name string, failures bigint")
    aliases = [f"k{i}" for i in range(len(checks))]
    row = df.agg(*[F.count_if(cond).alias(a) for a, (_, _, cond) in zip(aliases, checks)])
    cols = F.create_map(*[x for a, (c, _, _) in zip(aliases, checks) for x in (F.lit(a), F.lit(c))])
    kinds = F.create_map(*[x for a, (_, k, _) in zip(aliases, checks) for x in (F.lit(a), F.lit(k))])
    return row.unpivot([], aliases, "check_id", "failures").select(
        F.element_at(cols, F.col("check_id")).alias("column_name"),
        F.element_at(kinds, F.col("check_id")).alias("check_name"),
        F.col("failures").cast("bigint").alias("failures"),
    )


def report(df: DataFrame, contract: Contract) -> DataFrame:
    """Structural + data checks, one row per check (failures may be 0)."""
    spark: SparkSession = df.sparkSession
    structural = spark.createDataFrame(
        structure_failures(df, contract), "column_name string, check_name string, failures bigint"
    )
    return structural.unionByName(data_failures(df, contract))


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Raise ``ContractError`` on any failure; return the coerced, ordered frame."""
    failures = [(c, k, n) for c, k, n in structure_failures(df, contract) if n]
    if not failures:
        rows = data_failures(df, contract).filter(F.col("failures") > 0).collect()
        failures = [(r.column_name, r.check_name, int(r.failures)) for r in rows]
    if failures:
        raise ContractError(contract.name, failures)
    return coerce(df, contract)
