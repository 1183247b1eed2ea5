import duckdb

import __spark_entry__ as entry
from strata.sources.testdata import TABLES
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["zone_name", "borough", "trip_count"]
    assert 0 < len(rows) <= 10


def test_every_query_has_oracle_or_is_rows_only():
    from strata.registry import QUERIES, ROWS_ONLY

    q, sql = entry.queries(), entry.oracle_sql()
    assert set(QUERIES) <= set(q) and set(sql) <= set(q)
    assert set(QUERIES) - set(sql) == ROWS_ONLY


def test_marts_match_duckdb_on_small_tables(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    q, sql = entry.queries(), entry.oracle_sql()
    for name in ["monthly_revenue", "avg_fare_by_dow", "fact_trips", "clean_stats", "dq_unique"]:
        s = sorted(tuple(r) for r in q[name](spark, SF_SMALL).collect())
        d = sorted(tuple(r) for r in con.execute(
            f"SELECT {', '.join(q[name](spark, SF_SMALL).columns)} FROM ({sql[name]}) x").fetchall())
        assert s == d, name
