"""Data tests on the gold models: unique, not_null, relationships.

Each test yields ``(test_name, model, column_name, failures)``; 0 = pass.
* unique — number of key values that occur more than once.
* not_null and relationships of one model are counted in ONE aggregate: the
  model is joined with the distinct key sets of its parents (dimension
  tables, whose statistics let the planner broadcast them) and every test is
  a conditional count, so a fact is scanned once for all of them.
Nothing is collected and no job runs while the plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCHEMA = "test_name string, model string, column_name string, failures bigint"


def unique_failures(df: DataFrame, column: str, *, model: str) -> DataFrame:
    """Key values that occur more than once.

    64-bit hashes of the key are counted first (an 8-byte shuffle, combined
    before it, instead of the full key); full keys are compared only where
    their hash repeats. Normally none does, and adaptive execution drops the
    second pass when the first comes out empty.
    """
    keys = df.select(F.col(column).alias("k")).filter(F.col("k").isNotNull()).withColumn("h", F.xxhash64("k"))
    repeated = keys.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    dups = keys.join(repeated, "h", "left_semi").groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return dups.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit("unique").alias("test_name"),
        F.lit(model).alias("model"),
        F.lit(column).alias("column_name"),
        "failures",
    )


def model_failures(
    df: DataFrame,
    *,
    model: str,
    not_null: Sequence[str] = (),
    relationships: Sequence[tuple[str, DataFrame, str]] = (),
) -> DataFrame:
    """not_null and relationship tests of one model in one scan.

    ``relationships``: ``(column, parent, parent column)``; a failure is a row
    whose non-null key has no parent row.
    """
    needed = list(dict.fromkeys([*not_null, *(c for c, _, _ in relationships)]))
    rows = df.select(*needed)
    tests: list[tuple[str, str, Column]] = [("not_null", c, F.col(c).isNull()) for c in not_null]
    for i, (column, parent, parent_column) in enumerate(relationships):
        keys = parent.select(F.col(parent_column).alias(f"_p{i}")).distinct()
        rows = rows.join(keys, F.col(column) == F.col(f"_p{i}"), "left")
        tests.append(("relationships", column, F.col(column).isNotNull() & F.col(f"_p{i}").isNull()))
    counts = rows.agg(*(F.count_if(t).cast("bigint").alias(f"t{i}") for i, (_, _, t) in enumerate(tests)))
    report = F.array(
        *(
            F.struct(
                F.lit(kind).alias("test_name"),
                F.lit(model).alias("model"),
                F.lit(column).alias("column_name"),
                F.col(f"t{i}").alias("failures"),
            )
            for i, (kind, column, _) in enumerate(tests)
        )
    )
    return counts.select(F.inline(report))


def not_null_failures(df: DataFrame, columns: Sequence[str], *, model: str) -> DataFrame:
    return model_failures(df, model=model, not_null=columns)


def relationship_failures(child: DataFrame, child_col: str, parent: DataFrame, parent_col: str, *, model: str) -> DataFrame:
    return model_failures(child, model=model, relationships=[(child_col, parent, parent_col)])


def gold_checks(
    fact: DataFrame, zones: DataFrame, dates: DataFrame, seed: DataFrame | None = None
) -> DataFrame:
    """The 16 model tests of the gold layer (4 unique, 9 not_null, 3 relationships)."""
    parts = [
        unique_failures(dates, "date_key", model="dim_date"),
        unique_failures(zones, "zone_key", model="dim_zone"),
        unique_failures(fact, "trip_sk", model="fact_trips"),
        not_null_failures(dates, ["date_key", "year"], model="dim_date"),
        not_null_failures(zones, ["zone_key", "borough", "zone_name"], model="dim_zone"),
        model_failures(
            fact,
            model="fact_trips",
            not_null=["trip_sk", "date_key", "total_amount"],
            relationships=[
                ("date_key", dates, "date_key"),
                ("pickup_zone_key", zones, "zone_key"),
                ("dropoff_zone_key", zones, "zone_key"),
            ],
        ),
    ]
    if seed is not None:
        parts.append(unique_failures(seed, "LocationID", model="taxi_zone_lookup"))
        parts.append(not_null_failures(seed, ["LocationID"], model="taxi_zone_lookup"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
