"""Casts from raw warehouse text to typed columns.

Raw layers hold ids, money, flags and times as text. Under ANSI mode a bad cast raises, so every helper
here yields NULL for blank or malformed input instead, and accepts values that are already typed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# holds every long, and fractions that are cut off rather than rounded up
NUMBER = "decimal(38,18)"


def _text(col: Column | str) -> Column:
    col = F.col(col) if isinstance(col, str) else col
    text = F.trim(col.cast("string"))
    return F.when(text != "", text)


def as_id(col: Column | str) -> Column:
    """Identifier as long, however it is written or typed (``7``, ``7.0``, ``1.2E7``); no number becomes NULL."""
    return _text(col).try_cast(NUMBER).try_cast("bigint")


def as_text(col: Column | str) -> Column:
    """Trimmed text; blank becomes NULL."""
    return _text(col)


def as_int(col: Column | str) -> Column:
    """Small code or quantity as int; a fraction is cut off."""
    return _text(col).try_cast(NUMBER).try_cast("int")


def as_money(col: Column | str) -> Column:
    """Money as decimal(18,2)."""
    return _text(col).try_cast(MONEY)


def as_flag(col: Column | str) -> Column:
    """True for ``1`` or ``true`` in any spelling, false for anything else (NULL included)."""
    return F.coalesce(F.lower(_text(col)).isin("1", "true"), F.lit(False))


def as_moment(col: Column | str) -> Column:
    """Timestamp from ``yyyy-MM-dd HH:mm:ss`` text; malformed becomes NULL."""
    return _text(col).try_cast("timestamp")


def as_day(col: Column | str) -> Column:
    """Date from ``yyyy-MM-dd`` or ``yyyyMMdd`` text; malformed becomes NULL."""
    text = _text(col)
    dashless = F.regexp_replace(text, "^([0-9]{4})([0-9]{2})([0-9]{2})$", "$1-$2-$3")
    return dashless.try_cast("date")
