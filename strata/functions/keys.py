"""Portable, null-safe surrogate keys.

Spark's ``hash``/``xxhash64`` skip NULL inputs, so ``(NULL, 1)`` and
``(1, NULL)`` collide. The key is instead the MD5 of a canonical text
record: every field rendered to a time-zone-independent string without loss
(timestamps as integer microseconds, doubles as their shortest decimal text
that reads back as the same double), NULL as a marker that no rendered value
can take, fields joined by a separator. Two values get one text exactly when
grouping treats them as equal: zero has one sign and all NaNs are one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed rendering choices (they define the key, change them and every key changes).
NULL_MARKER = "~"
SEPARATOR = "|"
EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def canonical(df: DataFrame, name: str) -> Column:
    """Lossless text rendering of one column."""
    dtype = df.schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        # wall-clock microseconds since 1970-01-01 via NTZ − NTZ interval arithmetic:
        # no session time zone is involved (functions that take TIMESTAMP would
        # convert through it and shift local times inside a DST gap)
        text = F.expr(
            f"cast(cast(cast(`{name}` - {EPOCH_NTZ} as interval second) as decimal(24,6)) * 1000000 as bigint)"
        ).cast("string")
    elif isinstance(dtype, T.TimestampType):
        text = F.unix_micros(c).cast("string")
    elif isinstance(dtype, T.DateType):
        text = F.date_format(c, "yyyy-MM-dd")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARKER))


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit hex key over ``columns``; distinct NULL patterns never collide."""
    return F.md5(F.concat_ws(SEPARATOR, *[canonical(df, c) for c in columns]))
