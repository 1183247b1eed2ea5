"""Exact money arithmetic.

Summing doubles depends on the order of addition. Amounts are therefore
turned into decimals with ``SCALE`` places (far below a cent), summed
exactly, and rounded once, at the end: half up to cents where the result is
an amount, not at all where it is a mean for further use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 9
CENT_PLACES = 2


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def exact(col: Column | str) -> Column:
    """The amount as a decimal; NaN and infinities, which have no amount, as NULL."""
    return _c(col).try_cast(f"decimal(38,{SCALE})")


def exact_sum(col: Column | str) -> Column:
    return F.sum(exact(col))


def to_cents(total: Column) -> Column:
    """Exact total → cents, half up, as decimal(38,2) (sums stay exact)."""
    return F.round(total, CENT_PLACES).cast(f"decimal(38,{CENT_PLACES})")


def amount(total: Column) -> Column:
    """Exact total rounded to cents, as a double."""
    return to_cents(total).cast("double")


def rounded_mean(total: Column, count: Column) -> Column:
    """Half-up cents of ``total / count``, by integers: no digit is lost in a
    quotient before it is rounded."""
    units = (total * F.lit(10**SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    per_cent = F.lit(10 ** (SCALE - CENT_PLACES)).cast("decimal(8,0)")
    whole = (count.cast("decimal(20,0)") * per_cent).cast("decimal(28,0)")
    twice = (units * 2 + whole).cast("decimal(38,0)")
    double = (whole * 2).cast("decimal(29,0)")
    # pmod keeps the division a floor for negative totals too
    floor = F.call_function("div", (twice - F.pmod(twice, double)).cast("decimal(38,0)"), double)
    return F.when(count > 0, floor.cast("double") / F.lit(100.0))


def mean(total: Column, count: Column) -> Column:
    """Plain mean of an exact total, not rounded to cents."""
    return F.when(count > 0, total.cast("double") / count)
