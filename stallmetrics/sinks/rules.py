"""Slice and retention rules of result tables as pure functions: existing rows and new rows in, next rows out.

A slice is replaced also when the new frame is empty, unless ``skip_empty`` is set.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import month_back


def replace_where(existing: DataFrame, new: DataFrame, gone: Column, skip_empty: bool = False) -> DataFrame:
    """Existing rows that are not ``gone``, then the new rows. NULL in the condition keeps the row."""
    if skip_empty and new.isEmpty():
        return existing
    return existing.filter(~F.coalesce(gone, F.lit(False))).unionByName(new, allowMissingColumns=True)


def stat_date_slice(day: date) -> Column:
    """Rows of one statistics date."""
    return F.col("stat_date") == F.lit(day)


def keep_only_new_slice() -> Column:
    """Everything."""
    return F.lit(True)


def rolling_month_slice(day: date) -> Column:
    """The day itself, and rows up to the same day last month."""
    return (F.col("stat_date") <= F.lit(month_back(day))) | stat_date_slice(day)


def rolling_two_days_slice(day: date, now: datetime) -> Column:
    """The day itself and, in the first two hours of the clock, the day before yesterday."""
    gone = stat_date_slice(day)
    return gone | stat_date_slice(day - timedelta(days=2)) if now.hour <= 1 else gone


def period_slice(day: date, tag: str, time_type: int) -> Column:
    """Days go by date; weeks and months by their tag; other types by all three."""
    same_type = F.col("time_type") == time_type
    same_day, same_tag = stat_date_slice(day), F.col("date_time") == tag
    return {1: same_day & same_type, 2: same_tag & same_type, 3: same_tag & same_type}.get(
        time_type, same_day & same_tag & same_type
    )


def time_period_slice(day: date, tag: str, match_tag: bool = True) -> Column:
    """Known tags (``7``, ``30``, a month) go by tag; others by date, with the tag if ``match_tag``."""
    known = tag in ("7", "30") or (len(tag) == 6 and tag.isdigit())
    same_tag = F.col("time_period") == tag
    return same_tag if known else (stat_date_slice(day) & same_tag if match_tag else stat_date_slice(day))


def all_or_month_slice(tag: str) -> Column:
    """Everything for trailing windows; the dates of a month for a month."""
    return F.lit(True) if tag in ("7", "30") else F.date_format("stat_date", "yyyyMM") == tag


def current_day_slice(day: date) -> Column:
    """Rows of one ``current_day``."""
    return F.col("current_day") == F.lit(day)


def replace_stat_date(existing: DataFrame, new: DataFrame, day: date, delete: bool = True) -> DataFrame:
    """Replace the rows of one statistics date; without ``delete``, append only."""
    return replace_where(existing, new, stat_date_slice(day) & F.lit(delete))


def keep_only_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Drop everything old."""
    return replace_where(existing, new, keep_only_new_slice())


def rolling_month(existing: DataFrame, new: DataFrame, day: date) -> DataFrame:
    """Keep one month: rows up to the same day last month go, and the day itself is replaced."""
    return replace_where(existing, new, rolling_month_slice(day))


def rolling_two_days(existing: DataFrame, new: DataFrame, day: date, now: datetime) -> DataFrame:
    """Keep two days: the day is replaced, and in the first two hours of the clock the day before yesterday goes."""
    return replace_where(existing, new, rolling_two_days_slice(day, now))


def replace_period(existing: DataFrame, new: DataFrame, day: date, tag: str, time_type: int) -> DataFrame:
    """Days are replaced by date; weeks and months by their tag; other types by all three."""
    return replace_where(existing, new, period_slice(day, tag, time_type))


def replace_time_period(
    existing: DataFrame, new: DataFrame, day: date, tag: str, match_tag: bool = True
) -> DataFrame:
    """Known tags (``7``, ``30``, a month) replace their tag; others the date, with the tag if ``match_tag``."""
    return replace_where(existing, new, time_period_slice(day, tag, match_tag))


def analysis_table(base: str, tag: str) -> str:
    """Name of the analysis table of a window: ``base`` with the tag appended."""
    return f"{base}_{tag}"


def replace_all_or_month(existing: DataFrame, new: DataFrame, tag: str) -> DataFrame:
    """Trailing windows replace everything; a month replaces its own dates (the month the table is named for)."""
    return replace_where(existing, new, all_or_month_slice(tag))


def replace_current_day(existing: DataFrame, new: DataFrame, day: date) -> DataFrame:
    """Replace the rows of ``current_day``."""
    return replace_where(existing, new, current_day_slice(day))


# Key columns of the result tables.
MERCHANT_KEY = ("prod_id", "shop_id", "stat_date", "status_filter")
PLATFORM_KEY = ("prod_id", "stat_date", "status_filter")


def duplicate_keys(df: DataFrame, keys: Sequence[str] = MERCHANT_KEY) -> DataFrame:
    """Keys that occur more than once, with their row count; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def assert_unique_key(df: DataFrame, keys: Sequence[str] = MERCHANT_KEY) -> None:
    """Raise when a key of the result table is not unique."""
    clash = duplicate_keys(df, keys).first()
    if clash is not None:
        raise ValueError(f"key {tuple(keys)} is not unique, e.g. {clash.asDict()}")
