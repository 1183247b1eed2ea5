"""Catalog lookups: view registration and gold-schema discovery."""

from __future__ import annotations

from pyspark.sql import SparkSession

from strata.plans.tables import check_identifier

GOLD_TABLES = ("fact_trips", "dim_zone", "dim_date")


def register_view(spark: SparkSession, view_name: str, table_name: str) -> dict[str, str]:
    """``CREATE OR REPLACE TEMP VIEW`` over a table; missing table → error."""
    check_identifier(view_name)
    if not spark.catalog.tableExists(table_name):
        raise FileNotFoundError(f"{table_name} does not exist; build it first")
    spark.sql(f"CREATE OR REPLACE TEMP VIEW {view_name} AS SELECT * FROM {table_name}")
    return {"view": view_name, "table": table_name}


def try_register_view(spark: SparkSession, view_name: str, table_name: str) -> dict[str, str] | None:
    try:
        return register_view(spark, view_name, table_name)
    except FileNotFoundError:
        return None


def gold_namespace(spark: SparkSession, prefix: str = "", default: str = "main_gold") -> str:
    """Namespace holding ``fact_trips``: ``gold`` first, then ``main_gold``,
    then any other namespace that has it, else the default."""
    candidates = [f"{prefix}gold", f"{prefix}main_gold"]
    for ns in candidates:
        if spark.catalog.databaseExists(ns) and spark.catalog.tableExists(f"{ns}.fact_trips"):
            return check_identifier(ns)
    for db in spark.catalog.listDatabases():
        if db.name.startswith(prefix) and spark.catalog.tableExists(f"{db.name}.fact_trips"):
            return check_identifier(db.name)
    return check_identifier(f"{prefix}{default}")


def gold_tables_present(spark: SparkSession, namespace: str) -> bool:
    if not spark.catalog.databaseExists(namespace):
        return False
    names = {t.name for t in spark.catalog.listTables(namespace)}
    return all(t in names for t in GOLD_TABLES)


def require_gold(spark: SparkSession, namespace: str) -> str:
    if not gold_tables_present(spark, namespace):
        raise FileNotFoundError(f"gold tables missing in {namespace!r}; build gold first")
    return namespace
