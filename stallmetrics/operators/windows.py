"""Marking facts with the reporting windows they fall into.

Several windows are answered in one scan and without copies of rows. Where windows overlap, a row carries one bit per
window (``Slots``): folding rows of one key adds the bits up with ``bit_or`` and keeps one sum per window, and only the
finished rows of a report are unfolded into one row per window. Windows that share no day need no bits: a row carries the number
of its window. The union of the spans is an ordinary filter, so it reaches the scan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow, whole_day

WIN = "win"
#: Bits of the windows a row, or any row folded into it, lies in.
MASK = "win_mask"
SECOND = timedelta(seconds=1)


def moment(at: datetime) -> Column:
    """Literal of a wall-clock moment in the session's time zone, whatever zone the driver's machine is in."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def inside(ts: Column | str, window: ReportWindow) -> Column:
    """Timestamp lies in the window."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    # ends are whole seconds: one that is outside (start) or inside (end) is so with all its fractions
    start = window.start + SECOND if window.start_open else window.start
    end = window.end if window.end_open else window.end + SECOND
    return (ts >= moment(start)) & (ts < moment(end))


def inside_days(day: Column | str, window: ReportWindow) -> Column:
    """Date lies in the window's days; on a partition column this prunes."""
    day = F.col(day) if isinstance(day, str) else day
    return day.between(F.lit(window.first_day), F.lit(window.last_day))


def per_window(windows: Sequence[ReportWindow], test: Callable[[ReportWindow], Column]) -> Column:
    """``test`` of the window a tagged row belongs to."""
    if len(windows) == 1:
        return test(windows[0])
    picked = F.when(F.col(WIN) == 0, test(windows[0]))
    for number, window in enumerate(windows[1:], start=1):
        picked = picked.when(F.col(WIN) == number, test(window))
    return picked


def tag_windows(
    facts: DataFrame, windows: Sequence[ReportWindow], test: Callable[[ReportWindow], Column]
) -> DataFrame:
    """One copy of a row per window whose ``test`` it passes, numbered in column ``win``."""
    if len(windows) == 1:
        return facts.filter(test(windows[0])).withColumn(WIN, F.lit(0))
    numbers = F.array(*[F.when(test(w), F.lit(i)) for i, w in enumerate(windows)])
    return facts.filter(reduce(or_, [test(w) for w in windows])).withColumn(
        WIN, F.explode(F.array_compact(numbers))
    )


def _separate_days(windows: Sequence[ReportWindow]) -> bool:
    days = {w.first_day for w in windows}
    return len(windows) > 1 and len(days) == len(windows) and all(w == whole_day(w.first_day) for w in windows)


def _day_number(windows: Sequence[ReportWindow], day: Column) -> Column:
    """Number of the one-day window a date is, 0 when there is none."""
    return F.array_position(F.array(*[F.lit(w.first_day) for w in windows]), day).cast("int")


def tag_by_time(facts: DataFrame, windows: Sequence[ReportWindow], ts: str) -> DataFrame:
    """Rows tagged with the windows their timestamp lies in. A list of single days costs one lookup per row,
    however long it is."""
    if not _separate_days(windows):
        return tag_windows(facts, windows, lambda w: inside(ts, w))
    day = F.to_date(ts)
    return facts.filter(day.isin([w.first_day for w in windows])).withColumn(WIN, _day_number(windows, day) - 1)


def tag_by_day(facts: DataFrame, windows: Sequence[ReportWindow], day: str) -> DataFrame:
    """Rows tagged with the windows whose days hold their date."""
    if not _separate_days(windows):
        return tag_windows(facts, windows, lambda w: inside_days(day, w))
    return facts.filter(F.col(day).isin([w.first_day for w in windows])).withColumn(
        WIN, _day_number(windows, F.col(day)) - 1
    )


def any_window(windows: Sequence[ReportWindow], test: Callable[[ReportWindow], Column]) -> Column:
    """Row passes ``test`` for at least one window."""
    return reduce(or_, [test(w) for w in windows])


def window_value(windows: Sequence[ReportWindow], value: Callable[[ReportWindow], object]) -> Column:
    """A property of the window a tagged row belongs to."""
    return per_window(windows, lambda w: F.lit(value(w)))


# --- windows that overlap -------------------------------------------------------------------------------------------


def mask_of(tests: Sequence[Column]) -> Column:
    """Bit ``i`` is set where test ``i`` holds; a test that is NULL does not."""
    bits = [F.when(test, F.lit(1 << i)).otherwise(F.lit(0)) for i, test in enumerate(tests)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bit(mask: Column | str, number: int) -> Column:
    """Whether a bit of ``mask`` is set."""
    return (F.col(mask) if isinstance(mask, str) else mask).bitwiseAND(F.lit(1 << number)) != 0


@dataclass(frozen=True)
class Slots:
    """How the rows of a plan remember their windows: by one bit for each (``shared``), or by their window's number, a key.

    A measure is one column for each slot: as many as windows if these are shared, else one.
    """

    windows: tuple[ReportWindow, ...] = ()

    @property
    def shared(self) -> bool:
        return len(self.windows) > 1 and not _separate_days(self.windows)

    @property
    def numbers(self) -> range:
        return range(len(self.windows) if self.shared else 1)

    @property
    def keys(self) -> list[str]:
        """Key columns that rows have because of their windows. A single window is none: reports join on the other keys alone,
        and rows that were dealt by a constant as well would have to be dealt again."""
        return [WIN] if len(self.windows) > 1 and not self.shared else []

    @property
    def unfolded(self) -> list[str]:
        """Key columns that tell the windows of unfolded rows apart."""
        return [WIN] if len(self.windows) > 1 else []

    @property
    def carried(self) -> list[str]:
        """Columns besides keys that rows have because of their windows."""
        return [MASK] if self.shared else []

    def each(self, test: Callable[[ReportWindow], Column]) -> list[Column]:
        """``test`` for each slot."""
        return [test(w) for w in self.windows] if self.shared else [per_window(self.windows, test)]

    def mark(self, facts: DataFrame, test: Callable[[ReportWindow], Column]) -> DataFrame:
        """Rows that pass ``test`` for a window, with the columns that tell for which."""
        if not self.shared:
            return tag_windows(facts, self.windows, test)
        return facts.filter(any_window(self.windows, test)).withColumn(MASK, mask_of([test(w) for w in self.windows]))

    def mark_time(self, facts: DataFrame, ts: str) -> DataFrame:
        return self.mark(facts, lambda w: inside(ts, w)) if self.shared else tag_by_time(facts, self.windows, ts)

    def mark_day(self, facts: DataFrame, day: str) -> DataFrame:
        return self.mark(facts, lambda w: inside_days(day, w)) if self.shared else tag_by_day(facts, self.windows, day)

    def name(self, measure: str, number: int) -> str:
        return f"{measure}__{number}" if self.shared else measure

    def names(self, *measures: str) -> list[str]:
        return [self.name(m, i) for m in measures for i in self.numbers]

    def here(self, number: int, mask: Column | str = MASK) -> Column:
        """Whether a row, or any row folded into it, lies in the slot's window."""
        return bit(mask, number) if self.shared else F.lit(True)

    def only(self, number: int, value: Column) -> Column:
        """``value`` where a row lies in the slot's window, else NULL."""
        return F.when(self.here(number), value) if self.shared else value

    def folded(self) -> list[Column]:
        """Aggregate columns that keep the windows of the rows of a group."""
        return [F.bit_or(MASK).alias(MASK)] if self.shared else []

    def measures(self, **values: Callable[[int], Column]) -> list[Column]:
        """One column for each measure and slot; ``values`` give a slot's column."""
        return [value(i).alias(self.name(measure, i)) for measure, value in values.items() for i in self.numbers]

    def unfold(self, rows: DataFrame) -> DataFrame:
        """One row for each window that any fact of the row lies in, numbered in ``win``, with this window's measures."""
        if not self.shared:
            return rows
        end = self.name("", 0)
        names = [c.removesuffix(end) for c in rows.columns if c.endswith(end)]
        others = [c for c in rows.columns if c != MASK and not any(c == self.name(n, i) for n in names for i in self.numbers)]
        windows = [
            F.when(self.here(i), F.struct(F.lit(i).alias(WIN), *[F.col(self.name(n, i)).alias(n) for n in names])) for i in self.numbers
        ]
        return rows.select(*others, F.inline(F.array_compact(F.array(*windows))))


#: For steps that know of no windows.
ONE = Slots()
