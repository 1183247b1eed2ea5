"""Calendar attributes of a date column (date dimension)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_name(d: Column) -> Column:
    """Full English weekday name (``Monday``)."""
    return F.date_format(d, "EEEE")


def iso_day_of_week(d: Column) -> Column:
    """ISO weekday, Monday = 1 … Sunday = 7."""
    return (F.weekday(d) + F.lit(1)).cast("int")


def week_start(d: Column) -> Column:
    """Monday of the ISO week containing ``d``."""
    return F.trunc(d, "week")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_key(ts: Column) -> Column:
    """``YYYY-MM`` partition value of a naive timestamp (or date).

    Read from the value's own text: no session time zone is involved."""
    return F.substring(ts.cast("string"), 1, 7)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end`` (naive timestamps), truncated
    toward zero. Computed on the NTZ interval, so no session time zone can
    shift a local time inside a DST gap."""
    return ((end - start).cast("interval second").cast("decimal(24,6)")).cast("bigint")


def date_attributes(d: Column) -> dict[str, Column]:
    return {
        "year": F.year(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day_of_month": F.dayofmonth(d).cast("int"),
        "day_name": day_name(d),
        "iso_day_of_week": iso_day_of_week(d),
        "week_start_date": week_start(d),
        "month_start_date": month_start(d),
    }
