"""Day filters on raw tables in the spellings their partitions are named with, so that the catalog prunes before anything is read.

A typed ``dt`` is computed from a text one, and a filter on it is a filter on an expression: it drops files once they are
listed, but a metastore cannot evaluate it. Here the same days are asked for as plain comparisons with the raw column.
Days are written ``2024-01-30`` or ``20240130``, as text or as a number; text compares like the days it stands for, and a
day of one spelling never lies between two of the other.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def on_days(raw: DataFrame, first: date, last: date, column: str = "dt") -> DataFrame:
    """Rows of the days ``first`` to ``last``; a table without the column stays as it is."""
    kind = {f.name: f.dataType for f in raw.schema.fields}.get(column)
    return raw if kind is None else raw.filter(_within(F.col(column), kind, first, last))


def _within(day: Column, kind: T.DataType, first: date, last: date) -> Column:
    if isinstance(kind, T.StringType):
        spelled = [(f"{first:%Y-%m-%d}", f"{last:%Y-%m-%d}"), (f"{first:%Y%m%d}", f"{last:%Y%m%d}")]
        if first == last:
            return day.isin([a for a, _ in spelled])
        (a, b), (c, d) = spelled
        return day.between(a, b) | day.between(c, d)
    if isinstance(kind, T.NumericType):
        return day.between(int(f"{first:%Y%m%d}"), int(f"{last:%Y%m%d}"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(day).between(F.lit(first), F.lit(last))
    return day.between(F.lit(first), F.lit(last))
