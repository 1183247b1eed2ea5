"""Plan shape checks: pruning, pushdown, shuffle count, no Python in the hot path."""

from strata.operators import contract, marts
from strata.params import BENCH_MONTH, FILTER_MONTHS
from strata.plans import jobs
from strata.plans.layout import explain_text
from strata.registry import LIMITS, QUERIES, shared_lake
from tests.conftest import SF_SMALL


def _lake(spark):
    return shared_lake(spark, SF_SMALL)


def test_mart_aggregates_fact_before_dimension_join(spark):
    fact, zones, _ = jobs.gold_tables(_lake(spark))
    plan = explain_text(marts.top_pickup_zones(fact, zones, FILTER_MONTHS))
    assert "PartitionFilters: [trip_month" in plan and "IN (1996-02,1998-08,2000-12)" in plan
    assert "ReadSchema: struct<pickup_zone_key:bigint>" in plan
    lines = plan.split("\n\n")[0].splitlines()
    join = next(i for i, line in enumerate(lines) if "BroadcastHashJoin" in line)
    assert "HashAggregate" in lines[join + 1]  # the fact side arrives aggregated
    assert any("TakeOrderedAndProject" in line for line in lines)


def test_silver_checks_are_one_scan_one_shuffle(spark):
    lake = _lake(spark)
    bronze = lake.table("bronze", jobs.TRIPS).read()
    projected, kept = jobs.silver_frames(bronze, processed_at="p", limits=LIMITS)
    plan = explain_text(jobs.silver_month_checks(projected, kept, contract.silver_contract(LIMITS)))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Scan parquet") == 1
    assert "fare_amount" not in plan.split("ReadSchema:")[1].split("\n")[0]  # unused columns pruned


def test_month_benchmarks_prune_partitions(spark):
    silver = _lake(spark).table("silver", jobs.TRIPS).read()
    for df in (marts.month_count(silver, BENCH_MONTH), marts.daily_fare(silver, BENCH_MONTH)):
        plan = explain_text(df)
        assert f"PartitionFilters: [isnotnull(trip_month" in plan and f"(trip_month" in plan


def test_no_python_udfs_in_registered_queries(spark):
    for name in ["fact_trips", "monthly_revenue", "avg_fare_by_dow", "payment_labels", "silver_clean", "contract_report"]:
        plan = explain_text(QUERIES[name](spark, SF_SMALL))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_landing_write_rebalances_by_month(spark):
    bronze = jobs.bronze_from_tables(spark, SF_SMALL, loaded_at="l")
    plan = explain_text(bronze.hint("rebalance", "trip_month"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_unrepeated_trips_pass_no_shuffle(spark):
    from strata.operators import gold

    lake = _lake(spark)
    stg = gold.staging(lake.table("silver", jobs.TRIPS).read())
    plan = explain_text(gold.fact_trips(stg))
    tree = plan.split("\n\n")[0]
    alone = tree[: tree.index("Window")]  # the union's first branch
    assert "Exchange" not in alone.replace("BroadcastExchange", "") and "BroadcastHashJoin" in alone
    assert "EvalPython" not in plan


def test_gold_checks_scan_the_fact_twice(spark):
    from strata.operators import quality

    fact, zones, dates = jobs.gold_tables(_lake(spark))
    plan = explain_text(quality.gold_checks(fact, zones, dates))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    wide = [x for x in schemas if "total_amount" in x]
    assert len(wide) == 1  # not_null and all relationships
    assert sum("trip_sk" in x for x in schemas) <= 3  # and the two passes of unique


def test_orders_too_large_to_broadcast_are_hashed_by_task(spark, monkeypatch):
    from strata.sources import trips

    small = sorted(map(repr, trips.raw_trips_from_tables(spark, SF_SMALL).collect()))
    monkeypatch.setattr(trips, "BROADCAST_BYTES", 0, raising=False)
    large = trips.raw_trips_from_tables(spark, SF_SMALL)
    tree = explain_text(large).split("\n\n")[0]
    assert "ShuffledHashJoin" in tree and "Sort" not in tree and "BroadcastExchange" not in tree
    assert sorted(map(repr, large.collect())) == small


def test_writes_do_not_sort_the_months_of_a_task(spark, lake, monkeypatch):
    from strata.plans import tables

    used = []
    real = tables.session_conf
    monkeypatch.setattr(tables, "session_conf", lambda s, conf: used.append(conf) or real(s, conf))
    bronze = jobs.bronze_from_tables(spark, SF_SMALL, loaded_at="l")
    months = bronze.select("trip_month").distinct().count()
    jobs.land_bronze(lake, bronze)
    tables.overwrite_table(bronze, lake.table("gold", "copy"))
    assert len(used) == 2 and months > 4
    assert all(int(c["spark.sql.maxConcurrentOutputFileWriters"]) >= months for c in used)
