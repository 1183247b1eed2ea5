"""Independent DuckDB statements of every registered query (the check side).

Each statement restates, in plain SQL over the driver's tables, what the
Spark job computes. Limits, keys, column lists and contract checks are
written out here from the survey's fixtures; nothing of the operators is
imported, only the parameters of the checks (stamps, months, sizes).
"""

from __future__ import annotations

from strata.params import (
    BENCH_MONTH,
    CLEARED_MONTHS,
    COARSE_DUP_KEY,
    COMPACT_MAX_RECORDS,
    FILTER_MONTHS,
    LOADED_AT,
    PLAN_END,
    PLAN_START,
    PROCESSED_AT,
    SPLIT_MONTH,
    STAGING_DIR,
    SOURCE_BASE_URL,
    TOP_K,
)

RAW_SELECT = """
  CAST(l.l_linenumber % 2 + 1 AS BIGINT) AS VendorID,
  o.o_orderdate AS tpep_pickup_datetime,
  l.l_shipdate AS tpep_dropoff_datetime,
  CAST(floor(l.l_quantity) AS BIGINT) - 2 AS passenger_count,
  l.l_quantity * 11 AS trip_distance,
  CAST(nullif(l.l_linenumber % 6, 0) AS BIGINT) AS RatecodeID,
  CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
  CAST(nullif(l.l_partkey % 27, 7) AS BIGINT) AS PULocationID,
  CAST(nullif(l.l_suppkey % 27, 9) AS BIGINT) AS DOLocationID,
  CAST(l.l_linenumber - 1 AS BIGINT) AS payment_type,
  l.l_extendedprice * (1 - l.l_discount) AS fare_amount,
  l.l_discount AS extra,
  l.l_tax AS mta_tax,
  l.l_extendedprice * l.l_tax AS tip_amount,
  CAST(0.0 AS DOUBLE) AS tolls_amount,
  CAST(1.0 AS DOUBLE) AS improvement_surcharge,
  l.l_extendedprice AS total_amount,
  CAST(2.5 AS DOUBLE) AS congestion_surcharge,
  CASE WHEN l.l_suppkey % 10 = 0 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS Airport_fee"""

RAW_SQL = f"SELECT {RAW_SELECT}\nFROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"

BRONZE_SQL = f"""SELECT {RAW_SELECT},
  strftime(o.o_orderdate, '%Y-%m') AS trip_month,
  '{LOADED_AT}' AS _loaded_at,
  'yellow_tripdata_' || strftime(o.o_orderdate, '%Y-%m') || '.parquet' AS _source_file
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

RENAMED_SELECT = """VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, passenger_count, trip_distance,
  RatecodeID AS ratecode_id, store_and_fwd_flag, PULocationID AS pu_location_id,
  DOLocationID AS do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, Airport_fee AS airport_fee"""

PREPARED_SQL = f"""SELECT {RENAMED_SELECT},
  CAST(date_sub('second', tpep_pickup_datetime, tpep_dropoff_datetime) AS DOUBLE) AS trip_duration_seconds,
  CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
  trip_month, _loaded_at, _source_file
FROM ({BRONZE_SQL}) b"""


# Rules of the table-derived trips: 500 miles, prices to 100,000, zones 1 to 23.
RULES = [
    ("pickup_not_null", "pickup_datetime IS NOT NULL"),
    ("dropoff_not_null", "dropoff_datetime IS NOT NULL"),
    ("dropoff_not_before_pickup", "dropoff_datetime >= pickup_datetime"),
    ("passenger_count_valid", "passenger_count IS NOT NULL AND passenger_count >= 0"),
    ("trip_distance_valid", "trip_distance IS NOT NULL AND trip_distance >= 0 AND trip_distance <= 500.0"),
    ("total_amount_valid", "total_amount IS NOT NULL AND total_amount >= 0 AND total_amount <= 100000.0"),
    ("pickup_zone_valid", "pu_location_id IS NULL OR pu_location_id BETWEEN 1 AND 23"),
    ("dropoff_zone_valid", "do_location_id IS NULL OR do_location_id BETWEEN 1 AND 23"),
]

KEPT = " AND ".join(f"coalesce(({cond}), false)" for _, cond in RULES)

CLEAN_SQL = f"SELECT * FROM ({PREPARED_SQL}) p WHERE {KEPT}"


_SILVER_SELECT = f"""vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, ratecode_id,
  store_and_fwd_flag, pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, trip_duration_seconds,
  pickup_date, trip_month, _loaded_at AS _bronze_loaded_at, _source_file,
  '{PROCESSED_AT}' AS _silver_processed_at, CAST(1 AS INTEGER) AS _silver_version"""


PROJECTED_ALL_SQL = f"SELECT {_SILVER_SELECT} FROM ({PREPARED_SQL}) p"
SILVER_SQL = f"SELECT {_SILVER_SELECT} FROM ({CLEAN_SQL}) c"

STG_SQL = f"""SELECT vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, ratecode_id,
  store_and_fwd_flag, pu_location_id, do_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, trip_duration_seconds,
  pickup_date, trip_month, _source_file AS source_file
FROM ({SILVER_SQL}) s"""


def _canon(col: str, kind: str) -> str:
    if kind == "ts":
        text = f"CAST(epoch_us({col}) AS VARCHAR)"
    elif kind == "double":
        text = f"CASE WHEN {col} = 0 THEN '0.0' ELSE CAST({col} AS VARCHAR) END"
    else:
        text = f"CAST({col} AS VARCHAR)"
    return f"coalesce({text}, '~')"


_KIND = {
    "pickup_datetime": "ts",
    "dropoff_datetime": "ts",
    "trip_distance": "double",
    "total_amount": "double",
}


# The same trip: times, vendor, zones, passengers, distance and total.
DUP_KEY = [
    "pickup_datetime",
    "dropoff_datetime",
    "vendor_id",
    "pu_location_id",
    "do_location_id",
    "passenger_count",
    "trip_distance",
    "total_amount",
]
# First file first, then every other staged column.
RANK_ORDER = [
    "source_file", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "ratecode_id", "store_and_fwd_flag", "pu_location_id", "do_location_id", "payment_type", "fare_amount", "extra",
    "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
    "airport_fee", "trip_duration_seconds", "pickup_date", "trip_month",
]


def ranked_sql(key: list[str], source: str = STG_SQL) -> str:
    order = ", ".join(f"{c} ASC NULLS LAST" for c in RANK_ORDER)
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order}) AS trip_dup_rank "
        f"FROM ({source}) t"
    )


SURROGATE = "md5(concat_ws('|', " + ", ".join(
    _canon(c, _KIND.get(c, "other")) for c in [*DUP_KEY, "trip_dup_rank"]
) + "))"

FACT_SQL = f"""SELECT {SURROGATE} AS trip_sk, pickup_date AS date_key, pu_location_id AS pickup_zone_key,
  do_location_id AS dropoff_zone_key, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
  trip_duration_seconds, ratecode_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
  improvement_surcharge, total_amount, congestion_surcharge, airport_fee, trip_month, source_file
FROM ({ranked_sql(DUP_KEY)}) r"""

ZONES_SQL = """SELECT CAST(n.n_nationkey AS BIGINT) AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
  CASE WHEN n.n_nationkey % 5 = 0 THEN 'Airports' ELSE 'Boro Zone' END AS service_zone
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""

DIM_ZONE_SQL = f"""SELECT LocationID AS zone_key, Borough AS borough, Zone AS zone_name, service_zone
FROM ({ZONES_SQL}) z"""


def dim_date_sql(stg: str = STG_SQL) -> str:
    return f"""WITH bounds AS (SELECT min(pickup_date) AS lo, max(pickup_date) AS hi FROM ({stg}) s),
spine AS (
  SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date_key
  FROM bounds WHERE lo IS NOT NULL AND hi IS NOT NULL)
SELECT date_key,
  CAST(year(date_key) AS INTEGER) AS year,
  CAST(month(date_key) AS INTEGER) AS month,
  CAST(day(date_key) AS INTEGER) AS day_of_month,
  dayname(date_key) AS day_name,
  CAST(isodow(date_key) AS INTEGER) AS iso_day_of_week,
  CAST(date_trunc('week', date_key) AS DATE) AS week_start_date,
  CAST(date_trunc('month', date_key) AS DATE) AS month_start_date
FROM spine"""


DIM_DATE_SQL = dim_date_sql()


def _in_list(months: list[str]) -> str:
    return ", ".join(f"'{m}'" for m in months)


# The silver contract: column, nullable, least value, greatest value.
CONTRACT = [
    ("vendor_id", False, None, None),
    ("pickup_datetime", False, None, None),
    ("dropoff_datetime", False, None, None),
    ("passenger_count", False, "0.0", None),
    ("trip_distance", False, "0.0", "500.0"),
    ("ratecode_id", True, None, None),
    ("store_and_fwd_flag", True, None, None),
    ("pu_location_id", True, "1.0", "23.0"),
    ("do_location_id", True, "1.0", "23.0"),
    ("payment_type", True, None, None),
    ("fare_amount", True, None, None),
    ("extra", True, None, None),
    ("mta_tax", True, None, None),
    ("tip_amount", True, None, None),
    ("tolls_amount", True, None, None),
    ("improvement_surcharge", True, None, None),
    ("total_amount", False, "0.0", "100000.0"),
    ("congestion_surcharge", True, None, None),
    ("airport_fee", True, None, None),
    ("trip_duration_seconds", False, "0.0", None),
    ("pickup_date", False, None, None),
    ("trip_month", False, None, None),
    ("_bronze_loaded_at", False, None, None),
    ("_source_file", False, None, None),
    ("_silver_processed_at", False, None, None),
    ("_silver_version", False, "1.0", None),
]


def contract_checks_sql(frame_sql: str, *, kinds: set[str]) -> str:
    parts = []
    for name, nullable, least, greatest in CONTRACT:
        if "present" in kinds:
            parts.append(f"SELECT '{name}' AS column_name, 'present' AS check_name, CAST(0 AS BIGINT) AS failures")
        checks = [] if nullable else [("not_null", f"{name} IS NULL")]
        checks += [] if least is None else [("ge", f"{name} < {least}")]
        checks += [] if greatest is None else [("le", f"{name} > {greatest}")]
        parts += [
            f"SELECT '{name}' AS column_name, '{kind}' AS check_name, "
            f"CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS failures FROM ({frame_sql}) x"
            for kind, cond in checks
            if kind in kinds
        ]
    return "\nUNION ALL\n".join(parts)


def _month_counts(src: str, extra_where: str = "") -> str:
    where = f"WHERE {extra_where}" if extra_where else ""
    return f"SELECT trip_month, CAST(count(*) AS BIGINT) AS rows FROM ({src}) t {where} GROUP BY trip_month"


def _silver_month_counts(extra_where: str = "") -> str:
    return _month_counts(SILVER_SQL, extra_where)


ORACLE: dict[str, str] = {
    # ---- sources
    "scan_trips": RAW_SQL,
    "scan_month": f"SELECT * FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}'",
    "month_range": """WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)
SELECT strftime(d, '%Y-%m') AS trip_month, CAST(d AS DATE) AS month_start
FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS d FROM b) s""",
    "month_manifest": f"""WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders),
m AS (SELECT strftime(d, '%Y-%m') AS trip_month
      FROM (SELECT unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS d FROM b) s)
SELECT trip_month,
  '{STAGING_DIR}/yellow_tripdata_' || trip_month || '.parquet' AS local_path,
  '{SOURCE_BASE_URL}/yellow_tripdata_' || trip_month || '.parquet' AS source_url
FROM m""",
    "register_view": SILVER_SQL,
    "backfill_coverage": f"""WITH planned AS (
  SELECT strftime(unnest(generate_series(TIMESTAMP '{PLAN_START}-01', TIMESTAMP '{PLAN_END}-01', INTERVAL 1 MONTH)), '%Y-%m') AS trip_month),
landed AS ({_month_counts(BRONZE_SQL)})
SELECT p.trip_month, CAST(coalesce(l.rows, 0) AS BIGINT) AS rows, l.rows IS NOT NULL AS landed
FROM planned p LEFT JOIN landed l ON p.trip_month = l.trip_month""",
    "rows_by_month": _month_counts(BRONZE_SQL),
    # ---- bronze / silver
    "bronze_enrich": BRONZE_SQL,
    "bronze_land": BRONZE_SQL,
    "silver_rename": f"SELECT {RENAMED_SELECT} FROM ({RAW_SQL}) r",
    "trip_duration": """SELECT e.event_id, e.ts AS pickup_datetime, n.ts AS dropoff_datetime,
  CAST(date_sub('second', e.ts, n.ts) AS DOUBLE) AS trip_duration_seconds,
  CAST(e.ts AS DATE) AS pickup_date
FROM events e JOIN events n ON n.event_id = e.event_id + 1""",
    "silver_clean": CLEAN_SQL,
    "rule_reject_counts": "\nUNION ALL\n".join(
        f"SELECT '{name}' AS rule_name, CAST(count(*) FILTER (WHERE NOT coalesce(({cond}), false)) AS BIGINT) AS rejected_rows FROM ({PREPARED_SQL}) p"
        for name, cond in RULES
    ),
    "clean_stats": f"""SELECT CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE {KEPT}) AS BIGINT) AS output_rows,
  CAST(count(*) FILTER (WHERE NOT ({KEPT})) AS BIGINT) AS rejected_rows
FROM ({PREPARED_SQL}) p""",
    "stats_by_month": f"""SELECT trip_month, CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE {KEPT}) AS BIGINT) AS output_rows,
  CAST(count(*) FILTER (WHERE NOT ({KEPT})) AS BIGINT) AS rejected_rows
FROM ({PREPARED_SQL}) p GROUP BY trip_month""",
    "silver_run_record": f"""SELECT trip_month, CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE {KEPT}) AS BIGINT) AS output_rows,
  CAST(count(*) FILTER (WHERE NOT ({KEPT})) AS BIGINT) AS rejected_rows,
  true AS names_table FROM ({PREPARED_SQL}) p GROUP BY trip_month""",
    "backfill_files": f"""WITH planned AS (
  SELECT strftime(unnest(generate_series(TIMESTAMP '{PLAN_START}-01', TIMESTAMP '{PLAN_END}-01', INTERVAL 1 MONTH)), '%Y-%m') AS trip_month),
done AS (SELECT trip_month, CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE {KEPT}) AS BIGINT) AS output_rows,
  CAST(count(*) FILTER (WHERE NOT ({KEPT})) AS BIGINT) AS rejected_rows FROM ({PREPARED_SQL}) p GROUP BY trip_month)
SELECT p.trip_month, coalesce(input_rows, 0) AS input_rows, coalesce(output_rows, 0) AS output_rows,
  coalesce(rejected_rows, 0) AS rejected_rows FROM planned p LEFT JOIN done d ON p.trip_month = d.trip_month""",
    "silver_null_month": f"""WITH done AS (SELECT trip_month, CAST(count(*) AS BIGINT) AS input_rows,
  CAST(count(*) FILTER (WHERE {KEPT}) AS BIGINT) AS output_rows,
  CAST(count(*) FILTER (WHERE NOT ({KEPT})) AS BIGINT) AS rejected_rows FROM ({PREPARED_SQL}) p GROUP BY trip_month)
SELECT * FROM done WHERE trip_month NOT IN ({_in_list(CLEARED_MONTHS)})
UNION ALL
SELECT NULL, CAST(sum(input_rows) AS BIGINT), CAST(0 AS BIGINT), CAST(sum(input_rows) AS BIGINT)
FROM done WHERE trip_month IN ({_in_list(CLEARED_MONTHS)})""",
    "contract_raises": f"""SELECT 'vendor_id' AS column_name, 'not_null' AS check_name,
  CAST(count(*) FILTER (WHERE trip_month IN ({_in_list(FILTER_MONTHS)})) AS BIGINT) AS failures,
  CAST(count(*) AS BIGINT) AS silver_rows FROM ({SILVER_SQL}) s""",
    "silver_project": SILVER_SQL,
    "align_schema": SILVER_SQL,
    "silver_evolve": f"""SELECT trip_month, CAST(count(*) AS BIGINT) AS rows,
  CAST(count(*) FILTER (WHERE pickup_date IS NULL) AS BIGINT) AS null_pickup_date,
  CASE WHEN trip_month < '{SPLIT_MONTH}' THEN NULL ELSE CAST(1 AS INTEGER) END AS silver_version
FROM ({SILVER_SQL}) s GROUP BY trip_month""".replace(
        "CAST(count(*) FILTER (WHERE pickup_date IS NULL) AS BIGINT)",
        f"CAST(CASE WHEN trip_month < '{SPLIT_MONTH}' THEN count(*) ELSE 0 END AS BIGINT)",
    ),
    # ---- contract
    "contract_columns": contract_checks_sql(PROJECTED_ALL_SQL, kinds={"present", "not_null"}),
    "contract_coerce": SILVER_SQL,
    "contract_nulls": contract_checks_sql(PROJECTED_ALL_SQL, kinds={"not_null"}),
    "contract_ranges": contract_checks_sql(PROJECTED_ALL_SQL, kinds={"ge", "le"}),
    "contract_report": contract_checks_sql(PROJECTED_ALL_SQL, kinds={"present", "not_null", "ge", "le"}),
    # ---- sinks
    "replace_month_rerun": _month_counts(BRONZE_SQL),
    "stream_landing": _month_counts(BRONZE_SQL),
    "replace_month_newcount": _month_counts(BRONZE_SQL),
    "replace_month_independent": _month_counts(BRONZE_SQL),
    "clear_month": _month_counts(BRONZE_SQL, f"trip_month NOT IN ({_in_list(CLEARED_MONTHS)})"),
    "silver_replace_month": _silver_month_counts(),
    "silver_empty_bronze_clears": _silver_month_counts(f"trip_month NOT IN ({_in_list(CLEARED_MONTHS)})"),
    "write_sized_files": f"""SELECT trip_month, CAST(count(*) AS BIGINT) AS rows, true AS within_budget,
  true AS no_more_than_needed FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    "stale_months": f"""SELECT DISTINCT trip_month, CASE WHEN trip_month = '{SPLIT_MONTH}' THEN 'changed'
  WHEN trip_month = '{CLEARED_MONTHS[0]}' THEN 'new' ELSE 'gone' END AS reason, CAST(0 AS BIGINT) AS left_after_build
FROM ({BRONZE_SQL}) b WHERE trip_month IN ('{SPLIT_MONTH}', '{CLEARED_MONTHS[0]}', '{CLEARED_MONTHS[-1]}')""",
    "stream_redelivered": f"""SELECT trip_month, CAST(count(*) * (CASE WHEN trip_month = '{FILTER_MONTHS[0]}' THEN 2 ELSE 1 END) AS BIGINT) AS rows
FROM ({BRONZE_SQL}) b WHERE trip_month IN ({_in_list(FILTER_MONTHS)}) GROUP BY trip_month""",
    "compact_bins": f"""SELECT trip_month, CAST(count(*) AS BIGINT) AS rows, true AS nothing_fits, true AS none_above,
  true AS large_stay FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    "month_swap": f"""WITH m AS (SELECT trip_month, CAST(count(*) AS BIGINT) AS n, row_number() OVER (ORDER BY trip_month) AS k
  FROM ({BRONZE_SQL}) b GROUP BY trip_month)
SELECT trip_month, CASE WHEN trip_month = '{BENCH_MONTH}' THEN n ELSE 2 * n END AS rows,
  CASE WHEN k <= 2 THEN 2 * n ELSE n END AS rows_when_cut FROM m""",
    "file_stats_median": f"""SELECT trip_month AS partition_value,
  CAST(ceil(count(*) / {COMPACT_MAX_RECORDS}.0) AS BIGINT) AS file_count,
  CAST(count(*) AS BIGINT) AS record_count, true AS median_agrees FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    "table_properties": f"""SELECT CAST(2147483648 AS BIGINT) AS target_bytes, CAST(0 AS BIGINT) AS files_above,
  CAST(count(*) AS BIGINT) AS rows FROM ({BRONZE_SQL}) b""",
    "bronze_run_record": _month_counts(BRONZE_SQL),
    "bronze_from_files": _month_counts(BRONZE_SQL),
    "compact_settles": f"""SELECT trip_month AS partition_value, CAST(count(*) AS BIGINT) AS rows, true AS not_more_files,
  true AS settled, false AS rewritten_again FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    "compact_tables": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", trip_month AS partition_value,
  CAST(1 AS BIGINT) AS files_after, CAST(count(*) AS BIGINT) AS rows FROM ({BRONZE_SQL}) b GROUP BY trip_month
UNION ALL
SELECT 'silver.yellow_taxi_trips', trip_month, CAST(1 AS BIGINT), CAST(count(*) AS BIGINT)
FROM ({SILVER_SQL}) s GROUP BY trip_month""",
    "compact_partitions": f"""SELECT trip_month AS partition_value,
  CAST(ceil(count(*) / {COMPACT_MAX_RECORDS}.0) AS BIGINT) AS files_before,
  CAST(1 AS BIGINT) AS files_after, CAST(count(*) AS BIGINT) AS rows,
  count(*) > {COMPACT_MAX_RECORDS} AS rewritten
FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    "partition_file_stats": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", trip_month AS partition_value,
  CAST(1 AS BIGINT) AS file_count, CAST(count(*) AS BIGINT) AS record_count, true AS bytes_agree
FROM ({BRONZE_SQL}) b GROUP BY trip_month
UNION ALL
SELECT 'silver.yellow_taxi_trips', trip_month, CAST(1 AS BIGINT), CAST(count(*) AS BIGINT), true
FROM ({SILVER_SQL}) s GROUP BY trip_month""",
    "scan_audit": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", 'month_count' AS query, '{BENCH_MONTH}' AS trip_month,
  CAST(1 AS BIGINT) AS files_read, CAST(1 AS BIGINT) AS result_rows, true AS partition_pruned
UNION ALL SELECT 'silver.yellow_taxi_trips', 'month_count', '{BENCH_MONTH}', CAST(1 AS BIGINT), CAST(1 AS BIGINT), true
UNION ALL SELECT 'silver.yellow_taxi_trips', 'daily_fare', '{BENCH_MONTH}', CAST(1 AS BIGINT),
  (SELECT CAST(count(DISTINCT pickup_date) AS BIGINT) FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}'), true""",
    "scan_audit_rows": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", 'month_count' AS query,
  (SELECT CAST(count(*) AS BIGINT) FROM ({BRONZE_SQL}) b WHERE trip_month = '{BENCH_MONTH}') AS scanned_rows,
  CAST(1 AS BIGINT) AS result_rows, true AS timed
UNION ALL SELECT 'silver.yellow_taxi_trips', 'month_count', count(*), 1, true FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}'
UNION ALL SELECT 'silver.yellow_taxi_trips', 'daily_fare', count(*), count(DISTINCT pickup_date), true
FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}'""",
    "layout_review": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", 'month_count' AS query, CAST(1 AS BIGINT) AS result_rows,
  count(*) > 1 AS several_before, CAST(1 AS BIGINT) AS files_after FROM ({BRONZE_SQL}) b WHERE trip_month = '{BENCH_MONTH}'""",
    "partition_file_counts": f"""SELECT 'bronze.yellow_taxi_trips' AS "table", trip_month AS partition_value,
  CAST(1 AS BIGINT) AS file_count, CAST(count(*) AS BIGINT) AS record_count
FROM ({BRONZE_SQL}) b GROUP BY trip_month
UNION ALL
SELECT 'silver.yellow_taxi_trips', trip_month, CAST(1 AS BIGINT), CAST(count(*) AS BIGINT)
FROM ({SILVER_SQL}) s GROUP BY trip_month""",
    "compact_skips_single": f"""SELECT trip_month AS partition_value, CAST(1 AS BIGINT) AS files_before,
  CAST(1 AS BIGINT) AS files_after, CAST(count(*) AS BIGINT) AS rows, false AS rewritten
FROM ({BRONZE_SQL}) b GROUP BY trip_month""",
    # ---- gold
    "stg_trips": STG_SQL,
    "dup_rank": ranked_sql(COARSE_DUP_KEY),
    "dup_rank_skew_safe": ranked_sql(["pickup_datetime"]),
    "dup_rank_histogram": f"SELECT trip_dup_rank, CAST(count(*) AS BIGINT) AS rows FROM ({ranked_sql(COARSE_DUP_KEY)}) r GROUP BY trip_dup_rank",
    "surrogate_key": f"SELECT trip_sk, pickup_datetime, dropoff_datetime, vendor_id, total_amount FROM ({FACT_SQL}) f",
    "fact_trips": FACT_SQL,
    "dim_zone": DIM_ZONE_SQL,
    "dim_date": DIM_DATE_SQL,
    "dim_date_empty": dim_date_sql(f"SELECT * FROM ({STG_SQL}) s WHERE trip_month IS NULL"),
    "dim_zone_seed": DIM_ZONE_SQL,
    "gold_of_empty_silver": f"""SELECT CAST(0 AS BIGINT) AS fact_rows, (SELECT CAST(count(*) AS BIGINT) FROM ({ZONES_SQL}) z) AS zone_rows,
  CAST(0 AS BIGINT) AS date_rows, (SELECT CAST(count(*) AS BIGINT) FROM ({BRONZE_SQL}) b) AS landed_rows""",
    "open_gold": f"SELECT true AS missing_fails, CAST(count(*) AS BIGINT) AS fact_rows FROM ({SILVER_SQL}) s",
    "gold_tables_present": f"SELECT true AS tables_present, CAST(3 AS BIGINT) AS table_count, (SELECT CAST(count(*) AS BIGINT) FROM ({SILVER_SQL}) s) AS fact_rows",
    # ---- quality
    "dq_unique": f"""SELECT 'unique' AS test_name, 'dim_date' AS model, 'date_key' AS column_name,
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT date_key FROM ({DIM_DATE_SQL}) d WHERE date_key IS NOT NULL GROUP BY date_key HAVING count(*) > 1) x) AS failures
UNION ALL SELECT 'unique', 'dim_zone', 'zone_key',
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT zone_key FROM ({DIM_ZONE_SQL}) z GROUP BY zone_key HAVING count(*) > 1) x)
UNION ALL SELECT 'unique', 'fact_trips', 'trip_sk',
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT trip_sk FROM ({FACT_SQL}) f GROUP BY trip_sk HAVING count(*) > 1) x)
UNION ALL SELECT 'unique', 'taxi_zone_lookup', 'LocationID',
  (SELECT CAST(count(*) AS BIGINT) FROM (SELECT LocationID FROM ({ZONES_SQL}) z GROUP BY LocationID HAVING count(*) > 1) x)""",
    "dq_not_null": f"""SELECT 'not_null' AS test_name, 'dim_date' AS model, 'date_key' AS column_name, CAST(count(*) FILTER (WHERE date_key IS NULL) AS BIGINT) AS failures FROM ({DIM_DATE_SQL}) d
UNION ALL SELECT 'not_null', 'dim_date', 'year', CAST(count(*) FILTER (WHERE year IS NULL) AS BIGINT) FROM ({DIM_DATE_SQL}) d
UNION ALL SELECT 'not_null', 'dim_zone', 'zone_key', CAST(count(*) FILTER (WHERE zone_key IS NULL) AS BIGINT) FROM ({DIM_ZONE_SQL}) z
UNION ALL SELECT 'not_null', 'dim_zone', 'borough', CAST(count(*) FILTER (WHERE borough IS NULL) AS BIGINT) FROM ({DIM_ZONE_SQL}) z
UNION ALL SELECT 'not_null', 'dim_zone', 'zone_name', CAST(count(*) FILTER (WHERE zone_name IS NULL) AS BIGINT) FROM ({DIM_ZONE_SQL}) z
UNION ALL SELECT 'not_null', 'fact_trips', 'trip_sk', CAST(count(*) FILTER (WHERE trip_sk IS NULL) AS BIGINT) FROM ({FACT_SQL}) f
UNION ALL SELECT 'not_null', 'fact_trips', 'date_key', CAST(count(*) FILTER (WHERE date_key IS NULL) AS BIGINT) FROM ({FACT_SQL}) f
UNION ALL SELECT 'not_null', 'fact_trips', 'total_amount', CAST(count(*) FILTER (WHERE total_amount IS NULL) AS BIGINT) FROM ({FACT_SQL}) f
UNION ALL SELECT 'not_null', 'taxi_zone_lookup', 'LocationID', CAST(count(*) FILTER (WHERE LocationID IS NULL) AS BIGINT) FROM ({ZONES_SQL}) z""",
    "dq_relationships_date": f"""SELECT 'relationships' AS test_name, 'fact_trips' AS model, 'date_key' AS column_name,
  CAST(count(*) AS BIGINT) AS failures FROM ({FACT_SQL}) f
WHERE date_key IS NOT NULL AND date_key NOT IN (SELECT date_key FROM ({DIM_DATE_SQL}) d WHERE date_key IS NOT NULL)""",
    "dq_relationships_pickup": f"""SELECT 'relationships' AS test_name, 'fact_trips' AS model, 'pickup_zone_key' AS column_name,
  CAST(count(*) AS BIGINT) AS failures FROM ({FACT_SQL}) f
WHERE pickup_zone_key IS NOT NULL AND pickup_zone_key NOT IN (SELECT zone_key FROM ({DIM_ZONE_SQL}) z WHERE zone_key IS NOT NULL)""",
    "dq_relationships_dropoff": f"""SELECT 'relationships' AS test_name, 'fact_trips' AS model, 'dropoff_zone_key' AS column_name,
  CAST(count(*) AS BIGINT) AS failures FROM ({FACT_SQL}) f
WHERE dropoff_zone_key IS NOT NULL AND dropoff_zone_key NOT IN (SELECT zone_key FROM ({DIM_ZONE_SQL}) z WHERE zone_key IS NOT NULL)""",
    # ---- marts
    "list_trip_months": f"SELECT DISTINCT trip_month FROM ({SILVER_SQL}) s WHERE trip_month IS NOT NULL",
    "latest_month_default": f"SELECT max(trip_month) AS latest_month FROM ({SILVER_SQL}) s",
    "daily_trip_volume": f"SELECT CAST(pickup_date AS DATE) AS trip_date, CAST(count(*) AS BIGINT) AS trip_count FROM ({SILVER_SQL}) s WHERE pickup_date IS NOT NULL GROUP BY 1",
    "monthly_revenue": f"SELECT trip_month, round(sum(total_amount), 2) AS total_revenue, CAST(count(*) AS BIGINT) AS trip_count FROM ({SILVER_SQL}) s WHERE trip_month IS NOT NULL GROUP BY 1",
    "top_pickup_zones": f"""SELECT coalesce(z.zone_name, 'Unknown') AS zone_name, coalesce(z.borough, 'Unknown') AS borough, CAST(count(*) AS BIGINT) AS trip_count
FROM ({FACT_SQL}) f LEFT JOIN ({DIM_ZONE_SQL}) z ON z.zone_key = f.pickup_zone_key
GROUP BY 1, 2 ORDER BY trip_count DESC, zone_name, borough LIMIT {TOP_K}""",
    "trips_by_payment_type": f"SELECT payment_type, CAST(count(*) AS BIGINT) AS trip_count FROM ({SILVER_SQL}) s WHERE payment_type IS NOT NULL GROUP BY 1",
    "payment_labels": f"""SELECT payment_type, CAST(count(*) AS BIGINT) AS trip_count,
  CASE WHEN payment_type IS NULL THEN 'Unknown'
       WHEN payment_type = 0 THEN 'Flex fare' WHEN payment_type = 1 THEN 'Credit card'
       WHEN payment_type = 2 THEN 'Cash' WHEN payment_type = 3 THEN 'No charge'
       WHEN payment_type = 4 THEN 'Dispute' WHEN payment_type = 5 THEN 'Unknown'
       WHEN payment_type = 6 THEN 'Voided' ELSE 'Type ' || CAST(payment_type AS VARCHAR) END AS payment_label
FROM ({SILVER_SQL}) s WHERE payment_type IS NOT NULL GROUP BY 1""",
    "zone_labels": f"""SELECT *, concat_ws(' — ', borough, zone_name) AS zone_label FROM (
SELECT coalesce(z.zone_name, 'Unknown') AS zone_name, coalesce(z.borough, 'Unknown') AS borough, CAST(count(*) AS BIGINT) AS trip_count
FROM ({FACT_SQL}) f LEFT JOIN ({DIM_ZONE_SQL}) z ON z.zone_key = f.pickup_zone_key
GROUP BY 1, 2 ORDER BY trip_count DESC, zone_name, borough LIMIT {TOP_K}) t""",
    "avg_fare_by_dow": f"""SELECT d.day_name, d.iso_day_of_week,
  round(avg(total_amount), 2) AS avg_total_amount,
  CAST(count(*) AS BIGINT) AS trip_count
FROM ({SILVER_SQL}) f JOIN ({DIM_DATE_SQL}) d ON d.date_key = f.pickup_date
GROUP BY 1, 2""",
    "dashboard_kpis": f"""SELECT CAST(count(*) FILTER (WHERE pickup_date IS NOT NULL) AS BIGINT) AS total_trips,
  (SELECT CAST(coalesce(sum(CAST(revenue AS DECIMAL(38,2))), 0) AS DOUBLE) FROM (
     SELECT round(sum(total_amount), 2) AS revenue FROM ({SILVER_SQL}) m
     WHERE trip_month IN ({_in_list(FILTER_MONTHS)}) GROUP BY trip_month) r) AS total_revenue,
  CAST({len(FILTER_MONTHS)} AS BIGINT) AS months_in_filter
FROM ({SILVER_SQL}) s WHERE trip_month IN ({_in_list(FILTER_MONTHS)})""",
    "month_filter_subset": f"SELECT CAST(pickup_date AS DATE) AS trip_date, CAST(count(*) AS BIGINT) AS trip_count FROM ({SILVER_SQL}) s WHERE pickup_date IS NOT NULL AND trip_month IN ({_in_list(FILTER_MONTHS)}) GROUP BY 1",
    "month_filter_empty": f"SELECT trip_month, round(sum(total_amount), 2) AS total_revenue, CAST(count(*) AS BIGINT) AS trip_count FROM ({SILVER_SQL}) s WHERE trip_month IS NOT NULL GROUP BY 1",
    "bench_month_count": f"SELECT '{BENCH_MONTH}' AS trip_month, CAST(count(*) AS BIGINT) AS rows FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}'",
    "bench_daily_fare": f"""SELECT pickup_date, CAST(count(*) AS BIGINT) AS trips,
  CAST(sum(CAST(fare_amount AS DECIMAL(38,9))) AS DOUBLE) / count(fare_amount) AS avg_fare
FROM ({SILVER_SQL}) s WHERE trip_month = '{BENCH_MONTH}' GROUP BY pickup_date""",
}
ORACLE["gold_test_report"] = "\nUNION ALL\n".join(
    f"SELECT * FROM ({ORACLE[name]}) {name}"
    for name in ("dq_unique", "dq_not_null", "dq_relationships_date", "dq_relationships_pickup", "dq_relationships_dropoff")
)
