"""Measures of a product that stay bits until all of its rows have met.

A line carries what it counts for as bits, one for each window, beside its pieces and money. Folding lines into one column for each
measure and window before they are dealt makes rows many times wider where a group has few lines. Here lines are dealt narrow twice: by
key and part of the people, where a person's bits are given to one of the lines, then by key, where the measures are taken. Lines of
one part that count for the same are one row by then, so that a hot product has a bounded number of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.functions.casts import MONEY
from stallmetrics.operators.windows import MASK, Slots

#: What a line is of.
TRADE, REFUND, SEEN = 0, 1, 2
_KINDS = 2  # bits
#: Measures, like beside like: where windows agree, so do neighbouring stretches of a row, which makes it short in a shuffle.
MEASURES = (
    "place_order_person", "place_order_num", "place_order_amount", "pay_person", "pay_num", "pay_amount", "expose", "expose_person_num",
    "refund_num", "refund_person", "refund_success_num", "refund_success_person", "refund_success_amount",
)
#: Parts in which the people of a key are dealt, and its lines of nobody.
PARTS = 256


def _packed(*fields: tuple[Column, int]) -> Column:
    """Fields with the place of their first bit, in one number."""
    return reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.coalesce(field, F.lit(0)).cast("bigint"), at) for field, at in fields])


def what(kind: int, first: Column, second: Column, slots: Slots, here: Column | None = None) -> Column:
    """What a line is of, and the windows it lies in, of its ``first`` measures (placed, asked, seen) and its ``second`` ones (paid, done)."""
    n = len(slots.numbers)
    here = here if here is not None else F.col(MASK) if slots.shared else F.lit(1)
    return _packed((F.lit(kind), 0), (here, _KINDS), (first, _KINDS + n), (second, _KINDS + 2 * n)).alias("_what")


def lines_of(
    rows: DataFrame, keys: Sequence[str], who: str, slots: Slots, what: Column, pieces: Column | None = None, money: Column | None = None,
    once: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Narrow lines. ``once`` are the windows in which a line counts for the refund it belongs to, asked for and done."""
    n, none = len(slots.numbers), F.lit(None)
    return rows.select(
        *keys, F.col(who).alias("_who"), what.alias("_what"),
        (F.lit(0).cast("bigint") if once is None else _packed((once[0], 2 * n), (once[1], 3 * n))).alias("_whom"),
        (none if pieces is None else pieces).cast("bigint").alias("_pieces"), (none if money is None else money).cast(MONEY).alias("_money"),
    )


def by_part(lines: DataFrame, keys: Sequence[str], slots: Slots) -> DataFrame:
    """Lines folded by part of the people: one line of each person carries the windows the person is counted in."""
    n, known = len(slots.numbers), F.col("_who").isNotNull()
    # nobody is never counted as a person, so that these lines need not meet
    spread = F.when(known, F.xxhash64("_who")).otherwise(F.xxhash64("_what", "_whom", "_pieces", "_money"))
    group = [*keys, "_part"]
    part = F.pmod(spread, F.lit(PARTS)).cast("int")
    # dealt by the part, which is not sent along
    dealt = lines.repartition(*keys, part).withColumn("_part", part)
    sums = [F.sum("_pieces").alias("_pieces"), F.sum("_money").cast(MONEY).alias("_money")]
    alike = dealt.groupBy(*group, "_who", "_what", "_whom").agg(F.count(F.lit(1)).alias("_n"), *sums)
    person = Window.partitionBy(*group, "_who", F.col("_what").bitwiseAND((1 << _KINDS) - 1))
    windows = F.bit_or(F.shiftrightunsigned("_what", _KINDS + n)).over(person)
    lead = known & (F.row_number().over(person.orderBy("_what", "_whom")) == 1)
    told = alike.withColumn("_by", F.when(lead, windows).otherwise(0)).withColumn("_whom", F.col("_whom").bitwiseOR(F.col("_by")))
    people = F.count_if(F.col("_by") != 0).alias("_people")
    return told.groupBy(*group, "_what", "_whom").agg(F.sum("_n").alias("_n"), people, *sums).drop("_part")


def met(folded: DataFrame, keys: Sequence[str], slots: Slots) -> DataFrame:
    """Exposures folded per key already, several rows for a key, as lines that ``by_part`` has folded."""
    def line(i: int) -> Column:
        in_slot = F.lit(1 << i)
        seen, people = F.col(slots.name("expose", i)), F.col(slots.name("expose_person_num", i))
        return F.when(slots.here(i), F.struct(
            what(SEEN, in_slot, F.lit(0), slots, here=in_slot), in_slot.cast("bigint").alias("_whom"), F.lit(0).cast("bigint").alias("_n"),
            people.cast("bigint").alias("_people"), seen.cast("bigint").alias("_pieces"), F.lit(None).cast(MONEY).alias("_money"),
        ))

    return folded.select(*keys, F.inline(F.array_compact(F.array(*[line(i) for i in slots.numbers]))))


def measured(folded: DataFrame, keys: Sequence[str], slots: Slots, distinct_refunds: bool) -> DataFrame:
    """One row for each key, with the measures of every window and 0 where nothing was measured.

    ``distinct_refunds`` says whether a refund is counted once for each key or by its lines.
    """
    n = len(slots.numbers)
    kind = F.col("_what").bitwiseAND((1 << _KINDS) - 1)

    def where(column: str, at: int, of: int) -> Column:
        return F.col(column).bitwiseAND(F.lit(1 << at).cast("bigint")).cast("boolean") & (kind == of)

    def total(value: str, column: str, at: int, of: int):
        summed = F.coalesce(F.sum(F.when(where(column, at, of), F.col(value))), F.lit(0))
        return summed.cast(MONEY if value == "_money" else "bigint")

    def first(value: str, of: int):
        return lambda i: total(value, "_what", _KINDS + n + i, of)

    def second(value: str, of: int):
        return lambda i: total(value, "_what", _KINDS + 2 * n + i, of)

    def people(group: int, of: int):
        return lambda i: total("_people", "_whom", group * n + i, of)

    def once(group: int):
        return lambda i: total("_n", "_whom", (2 + group) * n + i, REFUND)

    here = F.bit_or(F.shiftrightunsigned("_what", _KINDS)).bitwiseAND((1 << n) - 1).cast("int")
    return folded.repartition(*keys).groupBy(*keys).agg(
        *[here.alias(MASK)] * slots.shared,
        *slots.measures(
            expose=first("_pieces", SEEN), expose_person_num=people(0, SEEN),
            place_order_person=people(0, TRADE), pay_person=people(1, TRADE),
            place_order_num=first("_pieces", TRADE), pay_num=second("_pieces", TRADE),
            place_order_amount=first("_money", TRADE), pay_amount=second("_money", TRADE),
            refund_num=once(0) if distinct_refunds else first("_n", REFUND),
            refund_success_num=once(1) if distinct_refunds else second("_n", REFUND),
            refund_success_amount=second("_money", REFUND),
            refund_person=people(0, REFUND), refund_success_person=people(1, REFUND),
        ),
    ).select(*keys, *slots.carried, *[slots.name(m, i) for i in slots.numbers for m in MEASURES])
