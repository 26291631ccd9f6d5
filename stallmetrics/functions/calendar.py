"""Reporting windows derived from an explicit ``as_of`` moment (never the wall clock)."""

from __future__ import annotations

import calendar as _calendar
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

DAY_END = time(23, 59, 59)


@dataclass(frozen=True)
class ReportWindow:
    """A span of time with the tags its report rows carry.

    Both ends are whole seconds and inside the window, to their last fraction, unless ``start_open`` / ``end_open`` say
    otherwise: a day that ends at 23:59:59 holds all there is before midnight.
    """

    start: datetime
    end: datetime
    tag: str
    stat_date: date
    time_type: int = 0
    start_open: bool = False
    end_open: bool = False

    @property
    def first_day(self) -> date:
        return self.start.date()

    @property
    def last_day(self) -> date:
        return self.end.date()


def _opening(day: date) -> datetime:
    return datetime.combine(day, time.min)


def _closing(day: date) -> datetime:
    return datetime.combine(day, DAY_END)


def _span(first: date, last: date, tag: str, stat_date: date, time_type: int = 0) -> ReportWindow:
    return ReportWindow(_opening(first), _closing(last), tag, stat_date, time_type)


def month_back(day: date) -> date:
    """Same day of the previous month, clamped to its last day."""
    year, month = (day.year - 1, 12) if day.month == 1 else (day.year, day.month - 1)
    return date(year, month, min(day.day, _calendar.monthrange(year, month)[1]))


def trailing_window(as_of: datetime, days: int) -> ReportWindow:
    """The last ``days`` whole days, ending yesterday; filed under today."""
    last = as_of.date() - timedelta(days=1)
    return _span(last - timedelta(days=days - 1), last, str(days), as_of.date())


def month_window(as_of: datetime) -> ReportWindow:
    """Month so far up to yesterday; on the first of a month, the whole previous month. Filed under its last day."""
    last = as_of.date() - timedelta(days=1)
    return _span(last.replace(day=1), last, f"{last:%Y%m}", last)


def standard_windows(as_of: datetime) -> list[ReportWindow]:
    """7 days, 30 days and the month."""
    return [trailing_window(as_of, 7), trailing_window(as_of, 30), month_window(as_of)]


def period_to_date(as_of: datetime, period: str) -> ReportWindow:
    """Day, ISO week or month containing ``as_of``, up to the end of its day; time types 1, 2, 3."""
    today = as_of.date()
    if period == "day":
        return _span(today, today, f"{today:%Y%m%d}", today, 1)
    if period == "week":
        iso = today.isocalendar()
        return _span(today - timedelta(days=iso.weekday - 1), today, f"{iso.year:04d}{iso.week:02d}", today, 2)
    if period == "month":
        return _span(today.replace(day=1), today, f"{today:%Y%m}", today, 3)
    raise ValueError(f"unknown period: {period!r}")


def intraday_window(as_of: datetime) -> ReportWindow:
    """Midnight up to ``as_of``; in hour 0, the whole of yesterday."""
    if as_of.hour == 0:
        return single_day(as_of)
    today = as_of.date()
    return ReportWindow(_opening(today), as_of.replace(microsecond=0), f"{today:%Y-%m-%d}", today)


def month_back_window(as_of: datetime) -> ReportWindow:
    """After the end of the same day last month, up to the end of today."""
    today = as_of.date()
    return ReportWindow(
        _closing(month_back(today)), _closing(today), f"{today:%Y-%m-%d}", today, start_open=True
    )


def whole_day(day: date) -> ReportWindow:
    """One calendar day."""
    return _span(day, day, f"{day:%Y-%m-%d}", day)


def single_day(as_of: datetime) -> ReportWindow:
    """Yesterday."""
    return whole_day(as_of.date() - timedelta(days=1))
