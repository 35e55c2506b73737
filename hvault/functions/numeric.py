"""Exact rounding of ratios and money.

Rates in the mart are ``round(a / b, s)``. Decimal division differs between
engines (result scale, double vs decimal), so ratios are computed in integer
arithmetic -- ``round_half_up(a * 10^s / b)`` as a long -- and scaled back with
an exact decimal multiplication. All inputs here are non-negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def idiv(a: Column, b: Column) -> Column:
    """Exact floor division of non-negative longs; NULL when b is 0 or NULL."""
    a = a.cast("long")
    b = F.nullif(b.cast("long"), F.lit(0))
    return ((a - a % b) / b).cast("long")


def half_up_units(num: Column, den: Column, scale: int) -> Column:
    """round_half_up(num * 10^scale / den) as a long."""
    num = num.cast("long")
    den = den.cast("long")
    return idiv(num * (2 * 10**scale) + den, den * 2)


def units_to_decimal(units: Column, scale: int) -> Column:
    return (units.cast(DecimalType(18, 0)) * F.lit(10**-scale).cast(DecimalType(18, scale))).cast(
        DecimalType(18, scale)
    )


def ratio(num: Column, den: Column, scale: int) -> Column:
    """round(num / den, scale) as DECIMAL(18, scale), half up; NULL when den is 0."""
    return units_to_decimal(half_up_units(num, den, scale), scale)


def money_units(amount: Column, scale: int = 2) -> Column:
    """DECIMAL(18, scale) money as a long count of 10^-scale units (exact)."""
    return (amount * F.lit(10**scale)).cast("long")
