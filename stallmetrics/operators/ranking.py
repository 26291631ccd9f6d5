"""Positions within groups of any size.

``row_number() over (partition by shop)`` sorts a whole shop in one task. Here the position is the sum of counts, each taken over a
bounded piece: rows in higher magnitude bands of the group, and rows before this one in its band. A crowded band is divided into cells
of one value and one span of tiebreaks; there the rows in earlier cells of the band are added.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.operators.shaping import read_whole

_BAND_BITS = 4
_SPAN_BITS = 16
#: Rows of a band from which it is divided into cells.
CROWDED = 100_000


def _band(value: Column) -> Column:
    """Coarse bucket that never orders two values the wrong way: binary magnitude plus leading bits."""
    bits = F.length(F.bin(value))
    shift = F.greatest(bits - (_BAND_BITS + 1), F.lit(0)).cast("int")
    lead = bits * (2 << _BAND_BITS) + F.call_function("shiftright", value, shift)
    # never NULL, so that joins on it filter neither branch and both keep reading the same shuffle
    return F.coalesce(F.when(value > 0, lead), F.lit(0))


def rank_in_group(
    df: DataFrame, group: Sequence[str], value: str, tiebreak: str, name: str = "rank_num", crowded: int = CROWDED,
    same: Sequence[str] = (),
) -> DataFrame:
    """Exact 1-based position by ``value`` (descending, non-negative, at most two decimals), then ``tiebreak``.

    ``tiebreak`` is a long, unique within the group. A band holds values that share their leading bits, a cell rows of one value and
    one span of 65536 tiebreak values: both are bounded, and only the few bands of ``crowded`` rows have cells to be counted. Columns that are the ``same`` in all rows of a group are
    not dealt with every row, but come with the counts of its bands.
    """
    by, before = list(group), Window.unboundedPreceding
    # none of the keys is ever NULL, so that joins on them filter neither branch
    cents = F.coalesce((F.col(value) * 100).cast("bigint"), F.lit(0))
    span = F.coalesce(F.call_function("shiftright", F.col(tiebreak), F.lit(_SPAN_BITS)), F.lit(0))
    band = [*by, "_band"]
    cell = [*band, "_v", "_span"]
    # both branches stay on the shuffles that the rows come from
    keyed = read_whole(df).withColumn("_band", _band(cents))

    def counted(rows: DataFrame, keys: list[str], also: Sequence[str] = ()) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in also])

    above = Window.partitionBy(*by).orderBy(F.desc("_band")).rowsBetween(before, 0)
    bands = counted(keyed, band, same).withColumn("_above", F.sum("_n").over(above) - F.col("_n"))
    # at most one row for every so many of the input
    full = F.broadcast(bands.filter(F.col("_n") >= crowded).select(*band, F.lit(True).alias("_full")))
    marked = keyed.join(full, band, "left").withColumns({
        "_v": F.when(F.col("_full"), cents).otherwise(-1), "_span": F.when(F.col("_full"), span).otherwise(0),
    }).drop("_full")
    cells = counted(marked.filter(F.col("_v") >= 0), cell)
    in_band = Window.partitionBy(*band).orderBy(F.desc("_v"), F.asc("_span")).rowsBetween(before, 0)
    divided = cells.withColumn("_prior", F.sum("_n").over(in_band) - F.col("_n")).join(bands.select(*band, *same, "_above"), band)
    whole = bands.filter(F.col("_n") < crowded).select(*band, *same, F.lit(-1).cast("bigint").alias("_v"), F.lit(0).cast("bigint").alias("_span"), F.col("_above").alias("_offset"))
    offsets = whole.unionByName(divided.select(*cell, *same, (F.col("_above") + F.col("_prior")).alias("_offset")))
    local = F.row_number().over(Window.partitionBy(*cell).orderBy(F.desc(cents), F.asc(tiebreak)))
    return (
        marked.drop(*same).repartition(*cell).withColumn("_local", local)
        .join(offsets, cell)
        .withColumn(name, (F.col("_offset") + F.col("_local")).cast("bigint"))
        .select(*df.columns, name)
    )
