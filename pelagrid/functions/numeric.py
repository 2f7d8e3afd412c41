"""Null-aware arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_numeric(value: Column) -> Column:
    """Text or number to double; NaN and anything unparseable become NULL."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def capped(value: Column, ceiling: float) -> Column:
    """``least`` that stays NULL for NULL input (Spark's own skips NULLs)."""
    return F.when(value.isNotNull(), F.least(value, F.lit(float(ceiling))))


def floored(value: Column, floor: float = 0.0) -> Column:
    """``greatest`` that stays NULL for NULL input."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(float(floor))))


# Sums and quotients are settled at this many decimals before halves are judged, so
# that a result does not depend on the order in which partial sums were added.
SETTLED_DECIMALS = 12
# Doubles from here on are whole numbers.
WHOLE_FROM = 2.0**52


def rounded(value: Column, digits: int) -> Column:
    """``round`` with halves away from zero, judged on the settled value."""
    return F.round(F.round(value, SETTLED_DECIMALS), digits)


def whole_steps(value: Column, digits: int) -> Column:
    """``rounded`` as a whole number of 10^-digits, for columns of many rows.

    Plain arithmetic: ``round`` on doubles goes through a decimal object per row. The
    result stays a double: NaN and infinities are kept, and a value so large that
    doubles have no fractions there is whole already.
    """
    per_unit = 10.0**digits
    half = 0.5 + 0.5 * per_unit / 10.0**SETTLED_DECIMALS
    scaled = F.abs(value) * F.lit(per_unit)
    steps = F.when(scaled < F.lit(WHOLE_FROM), F.floor(scaled + F.lit(half)).cast("double")).otherwise(scaled)
    return F.when(value < 0, -steps).otherwise(steps)


def to_ms(kmh: Column) -> Column:
    """km/h to m/s at four decimals."""
    return whole_steps(kmh / F.lit(3.6), 4) / F.lit(10_000.0)


def share(hits: Column, total: Column) -> Column:
    """Ratio that is NULL rather than an error for an empty group."""
    return F.try_divide(hits, total)
