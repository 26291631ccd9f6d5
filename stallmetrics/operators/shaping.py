"""Shaping of report rows: spines, fan-out, filters, keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.operators.catalog import first_per_key
from stallmetrics.operators.windows import MASK, ONE, Slots


def stack_measures(keys: Sequence[str], *frames: DataFrame) -> DataFrame:
    """Every key any frame holds, with all measures side by side and 0 where nothing was measured.

    Measures are additive: a frame may hold several rows per key (one per user, client or refund, each carrying 1
    for itself) and they are summed here; masks of windows are added up bit by bit. Stacking the rows and folding them once replaces a union of keys, one
    outer join per frame, and the last grouping of every frame.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    types = dict(stacked.dtypes)
    measures = [c for c in types if c not in keys and c != MASK]
    return stacked.groupBy(*keys).agg(
        *[F.bit_or(MASK).alias(MASK)] * (MASK in types),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast(types[c] if types[c].startswith("decimal") else "bigint").alias(c)
            for c in measures
        ],
    )


def read_whole(df: DataFrame) -> DataFrame:
    """The same rows, read with all of their columns by all that follows.

    Every row passes the filter, which the optimizer cannot know: no column is left out below it and no later filter goes below it. Branches
    that start here stay on the same shuffles, whatever each of them needs.
    """
    return df.filter((F.monotonically_increasing_id() >= 0) | (F.hash(*df.columns) == 0))


def one_if(test: Column) -> Column:
    """1 where the test holds, else 0: a row's share in an additive count."""
    return F.when(test, 1).otherwise(0)


# Status filter -> product statuses it admits (None: every status above -1).
STATUS_FILTERS: Mapping[int, int | None] = {0: None, 1: 1, 2: 0, 3: 3}


def _admits(col: Column, wanted: int | None) -> Column:
    return col > -1 if wanted is None else col == wanted


def admitted(status: str = "status", filters: Mapping[int, int | None] = STATUS_FILTERS) -> Column:
    """Whether any of the status filters admits a row: to drop others before the joins."""
    return reduce(or_, [_admits(F.col(status), wanted) for wanted in filters.values()])


def status_fanout(df: DataFrame, status: str = "status", filters: Mapping[int, int | None] = STATUS_FILTERS) -> DataFrame:
    """One copy of a row per status filter that admits it, in column ``status_filter``."""
    col = F.col(status)
    marks = [
        F.when(_admits(col, wanted), F.lit(str(number)))
        for number, wanted in filters.items()
    ]
    return df.withColumn("status_filter", F.explode(F.array_compact(F.array(*marks))))


# The two lists of measures reports filter on.
TEN_MEASURES = (
    "expose", "expose_person_num", "place_order_person", "place_order_num", "place_order_amount",
    "pay_person", "pay_num", "pay_amount", "refund_num", "refund_success_amount",
)
MEASURES_WITHOUT_EXPOSURE = (
    "place_order_person", "place_order_num", "place_order_amount", "pay_person", "pay_num", "pay_amount",
    "refund_num", "refund_success_amount", "add_cart_person", "add_cart",
)


def any_positive(measures: Sequence[str]) -> Column:
    return reduce(or_, [F.col(m) > 0 for m in measures])


def drop_all_zero(df: DataFrame, measures: Sequence[str] = TEN_MEASURES, slots: Slots = ONE) -> DataFrame:
    """Rows where at least one listed measure is above 0, in any slot; listed measures the frame lacks count as 0."""
    return df.filter(any_positive([n for n in slots.names(*measures) if n in df.columns]))


def dedup_by_sink_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key of the result table, chosen by a total order."""
    return first_per_key(df, keys, *order)
