"""Refund steps: attributing refunds to items, counting them, and the set of active products."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.functions.casts import MONEY
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.trade import item_side
from stallmetrics.operators.windows import MASK, ONE, Slots, bit

# Refund scope and state codes.
WHOLE_ORDER = 1
SINGLE_ITEM = 2
SUCCEEDED = 5

REFUND_FACT = [
    "refund_id", "order_id", "order_item_id", "user_id", "refund_type", "return_money_sts", "refund_amount",
    "apply_time",
]
_LINE = ["prod_id", "item_shop_id", "refund_id", "user_id", "return_money_sts", "item_total", "refund_amount"]


def item_refunds(refunds: DataFrame, items: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Refunds joined to the one item they name."""
    named = refunds.filter(F.col("order_item_id").isNotNull())
    return named.join(
        item_side(items, "order_item_id").drop("order_number", "prod_count"), "order_item_id"
    ).select(*carry, *_LINE, "refund_type")


def order_refunds(
    refunds: DataFrame, orders: DataFrame, items: DataFrame, carry: Sequence[str] = ()
) -> DataFrame:
    """Refunds joined to every item of their order. ``orders`` needs order_id, order_number and carried columns."""
    return (
        refunds.join(orders, "order_id")
        .join(item_side(items).drop("prod_count"), "order_number")
        .select(*carry, *_LINE, "refund_type")
    )


def refunded_lines(refunds: DataFrame, lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Refunds joined to the order lines of their order."""
    return refunds.join(lines.drop("user_id", "order_number"), "order_id").select(*carry, *_LINE, "refund_type")


def refund_rows(
    lines: DataFrame, keys: Sequence[str], amount: str = "refund_amount", count: str = "distinct", slots: Slots = ONE,
    counted: Column | None = None,
) -> DataFrame:
    """Additive requested and successful refunds, people and amount: one row per key and user.

    ``amount`` is the refund's own amount or the item's total. ``count`` is ``distinct`` (refund ids) or ``rows``. Lines that
    are not ``counted`` measure nothing; they only make their key (and window) appear.
    """
    counted = F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))
    ok = counted & F.coalesce(F.col("return_money_sts") == SUCCEEDED, F.lit(False))
    money, here = F.when(ok, F.col(amount)), slots.here
    if count == "rows":
        marked = lines.select(*keys, *slots.carried, "user_id", counted.alias("_in"), ok.alias("_ok"), money.alias("_amt"))
        people = marked.groupBy(*keys, "user_id").agg(
            *slots.folded(),
            *slots.measures(
                refund_num=lambda i: F.count_if(F.col("_in") & here(i)),
                refund_success_num=lambda i: F.count_if(F.col("_ok") & here(i)),
                refund_success_amount=lambda i: F.sum(slots.only(i, F.col("_amt"))).cast(MONEY),
            ),
        )
        known = F.col("user_id").isNotNull()

        def has(measure: str):
            return lambda i: one_if(known & (F.col(slots.name(measure, i)) > 0))

        kept = ("refund_num", "refund_success_num", "refund_success_amount")
        return people.select(
            *keys, *slots.carried, *slots.names(*kept),
            *slots.measures(refund_person=has("refund_num"), refund_success_person=has("refund_success_num")),
        )
    mask = F.col(MASK) if slots.shared else F.lit(1)
    marked = lines.select(
        *keys, *slots.carried, "refund_id", "user_id",
        F.when(counted, mask).otherwise(0).alias("_in"), F.when(ok, mask).otherwise(0).alias("_ok"), money.alias("_amt"),
    )
    asked = first_of_refund(marked, keys)
    per_user = asked.groupBy(*keys, "user_id").agg(
        *slots.folded(),
        F.bit_or("_in").alias("_in"), F.bit_or("_ok").alias("_ok"),
        *slots.measures(
            refund_num=lambda i: F.count_if(bit("_refund_in", i)), refund_success_num=lambda i: F.count_if(bit("_refund_ok", i)),
            refund_success_amount=lambda i: F.sum(slots.only(i, F.col("_amt"))).cast(MONEY),
        ),
    )
    known = F.col("user_id").isNotNull()
    return per_user.select(
        *keys, *slots.carried, *slots.names("refund_num", "refund_success_num", "refund_success_amount"),
        *slots.measures(
            refund_person=lambda i: one_if(known & bit("_in", i)), refund_success_person=lambda i: one_if(known & bit("_ok", i)),
        ),
    )


def first_of_refund(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lines with ``_refund_in`` and ``_refund_ok``: the windows (``_in``, ``_ok``) of all lines that a key has of a refund, at the first of them.

    Lines of a refund meet once. The first of them counts for the refund, so that all that is left is a fold per user.
    """
    of_refund = Window.partitionBy(*keys, "refund_id")
    first = (F.row_number().over(of_refund.orderBy("refund_id")) == 1) & F.col("refund_id").isNotNull()
    return marked.select(
        "*",
        F.when(first, F.bit_or("_in").over(of_refund)).otherwise(0).alias("_refund_in"),
        F.when(first, F.bit_or("_ok").over(of_refund)).otherwise(0).alias("_refund_ok"),
    )


def refund_metrics(lines: DataFrame, keys: Sequence[str], amount: str = "refund_amount", count: str = "distinct") -> DataFrame:
    """Requested and successful refunds, people and amount per key."""
    return stack_measures(keys, refund_rows(lines, keys, amount, count))


def shop_refund_rows(refunds: DataFrame, keys: Sequence[str], amount: str, orders: str, slots: Slots = ONE) -> DataFrame:
    """Additive refunded money and distinct refunded orders: one row per key and order."""
    money = {amount: lambda i: F.sum(slots.only(i, F.col("refund_amount"))).cast(MONEY)}
    return refunds.groupBy(*keys, "order_id").agg(*slots.folded(), *slots.measures(**money)).select(
        *keys, *slots.carried, *slots.names(amount),
        *slots.measures(**{orders: lambda i: one_if(F.col("order_id").isNotNull() & slots.here(i))}),
    )


def active_products(*sources: DataFrame, keys: Sequence[str] = ("win", "prod_id")) -> DataFrame:
    """Distinct products over all given facts."""
    return reduce(DataFrame.union, [s.select(*keys) for s in sources]).filter(
        F.col("prod_id").isNotNull()
    ).distinct()
