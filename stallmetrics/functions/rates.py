"""Guarded ratios in integer arithmetic.

Double division rounds differently from engine to engine (``201 / 20000 * 100`` is either 1.01 or 1.00 at two
places), so every ratio is computed as ``(2·scaled + d) div (2·d)``: exact, rounded half up, 0 on a zero
denominator. A quotient below zero (a correction) is rounded half away from zero.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _guarded(scaled: Column, den: Column, places: int) -> Column:
    """Quotient of two whole numbers, the first already scaled by twice the unit."""
    units = F.call_function("div", F.abs(scaled) + den, den * 2)
    units = F.when(scaled < 0, -units).otherwise(units)
    # 15 digits times the unit stay within 18, which Spark keeps in one machine word
    ratio = units.cast("decimal(15,0)") * F.lit(Decimal(1).scaleb(-places))
    return F.when(den > 0, ratio).otherwise(F.lit(0)).cast(f"decimal(18,{places})")


def count_ratio(num: Column | str, den: Column | str, places: int, times: int = 1) -> Column:
    """``num / den * times`` of two counts, rounded half up to ``places``; 0 when ``den`` is 0 or NULL."""
    num, den = (F.coalesce(_col(c), F.lit(0)).cast("bigint") for c in (num, den))
    return _guarded(num * F.lit(2 * times * 10**places), den, places)


def money_ratio(num: Column | str, den: Column | str, places: int, times: int = 1) -> Column:
    """The same where either side is money (two decimals)."""
    num, den = (F.coalesce(_col(c), F.lit(0)).cast("decimal(20,2)") for c in (num, den))
    # in hundredths both sides are whole numbers
    scaled = (num * F.lit(2 * 100 * times * 10**places)).cast("decimal(36,0)")
    return _guarded(scaled, (den * F.lit(100)).cast("decimal(24,0)"), places)


def percent(num: Column | str, den: Column | str, places: int = 2) -> Column:
    """One count in percent of another."""
    return count_ratio(num, den, places, times=100)
