"""strata — a Spark-native medallion lake for trip-style event data.

Layers: raw monthly Parquet → bronze (raw + lineage) → silver (renamed,
rule-filtered, contract-checked) → gold (trip fact + zone/date dimensions)
→ month-filterable marts, plus the table maintenance such a lake needs.
Every operator is a DataFrame / Spark SQL expression; nothing is pulled
through the driver except bounded metadata (month lists, check counts).
"""

__version__ = "0.1.0"
