"""Parameters of the registered checks (stamps, months, sizes).

Stamps are fixed so the independent DuckDB statements can restate them.
"""

# Fixed lineage stamps used by the checks (a real run stamps "now").
LOADED_AT = "2024-06-01T00:00:00+00:00"
PROCESSED_AT = "2024-06-01T01:00:00+00:00"
# Month of the month-pruned benchmark pair and scans.
BENCH_MONTH = "1998-08"
# Months selected in the dashboard month filter.
FILTER_MONTHS = ["1996-02", "1998-08", "2000-12"]
# Months cleared by the clear / empty-bronze scenarios.
CLEARED_MONTHS = ["1995-01", "1998-08"]
# First month written after the silver schema evolution.
SPLIT_MONTH = "1998-01"
# Planned backfill range (wider than the data on both ends).
PLAN_START = "1994-07"
PLAN_END = "2002-06"
# Manifest locations (placeholders: no download is performed).
SOURCE_BASE_URL = "https://trips.invalid/trip-data"
STAGING_DIR = "/lake/staging/trips"
# Rows per file when forcing small files before compaction.
COMPACT_MAX_RECORDS = 250
# Uncompressed byte budget and file size bound that make several files a month.
SMALL_TARGET_BYTES = 40_000
SMALL_FILE_BYTES = 20_000
# Top-k of the zone panel.
TOP_K = 10
# Coarser "same trip" key that does repeat in the table-derived trips.
COARSE_DUP_KEY = ["pickup_datetime", "vendor_id", "pu_location_id"]
