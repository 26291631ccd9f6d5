"""Order and payment steps.

Distinct users are counted in two levels: rows are first folded per (key, user), then per key. The first level
spreads a hot product or shop over its users, and several conditional user counts need no row expansion.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.functions.casts import MONEY
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.windows import ONE, Slots, bit, mask_of

ORDER_FACT = ["order_id", "order_number", "user_id", "shop_id", "create_time", "pay_time", "is_paid", "actual_total"]


def dedup_exact_rows(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Chosen columns without repeated rows; copies collapse before the shuffle."""
    return facts.select(*columns).distinct()


def one_of_each(facts: DataFrame, columns: Sequence[str], near: Sequence[str]) -> DataFrame:
    """As ``dedup_exact_rows``, dealt and sorted by ``near``: what joins or folds by it next needs no shuffle of its own.

    Copies are neighbours in that order, so that no table of all rows is held.
    """
    copies = Window.partitionBy(*near, *[c for c in columns if c not in near]).orderBy(*near)
    numbered = facts.select(*columns).repartition(*near).withColumn("_copy", F.row_number().over(copies))
    return numbered.filter(F.col("_copy") == 1).drop("_copy")


def item_side(items: DataFrame, *extra: str) -> DataFrame:
    """Item columns that lines need, with the names that clash with orders prefixed."""
    return items.select(
        "order_number", "prod_id", F.col("shop_id").alias("item_shop_id"), "prod_count",
        F.col("actual_total").alias("item_total"), *extra,
    )


def order_lines(orders: DataFrame, items: DataFrame, *extra: str) -> DataFrame:
    """Orders joined to their items; the shop is the order's."""
    return orders.join(item_side(items, *extra), "order_number")


# stands for a missing id; no row has it
NO_ID = -(2**63)


def shareable(lines: DataFrame) -> DataFrame:
    """Lines whose ids are never NULL (missing ones get an id nothing else has).

    Joins on nullable keys push "is not NULL" filters into each branch that reads the lines, which makes the
    branches differ. Without them, branches that read the same lines share one shuffle.
    """
    ids = ["order_id", "prod_id", "shop_id", "item_shop_id"]
    return lines.withColumns({c: F.coalesce(c, F.lit(NO_ID)) for c in ids})


def distinct_order_lines(orders: DataFrame, items: DataFrame) -> DataFrame:
    """As ``order_lines`` over facts that may hold copies.

    Orders and items are dealt by the order's number once, each without its copies. A pair of two that occur once occurs once.
    """
    sides = item_side(items, "order_item_id", "rec_time")
    unique = one_of_each(orders.filter(F.col("order_number").isNotNull()), ORDER_FACT, ["order_number"])
    return unique.join(one_of_each(sides.filter(F.col("order_number").isNotNull()), sides.columns, ["order_number"]), "order_number")


def trade_rows(
    lines: DataFrame, keys: Sequence[str], paid: Column | Sequence[Column], placed: Column | Sequence[Column] | None = None,
    slots: Slots = ONE,
) -> DataFrame:
    """Additive users, items and amount of placed and of paid lines: one row per key and user.

    ``placed`` and ``paid`` say which lines count as ordered and as paid, in each slot.
    """
    placed = F.lit(True) if placed is None else placed
    placed, paid = ([t] * len(slots.numbers) if isinstance(t, Column) else t for t in (placed, paid))
    flagged = lines.select(
        *keys, "user_id", "prod_count", "item_total", *slots.carried, mask_of(placed).alias("_placed"), mask_of(paid).alias("_paid")
    )

    def total(flag: str, value: str):
        return lambda i: F.sum(F.when(bit(flag, i), F.col(value))).cast("bigint" if value == "prod_count" else MONEY)

    per_user = flagged.groupBy(*keys, "user_id").agg(
        *slots.folded(),
        F.bit_or("_placed").alias("_placed"),
        F.bit_or("_paid").alias("_paid"),
        *slots.measures(
            place_order_num=total("_placed", "prod_count"), place_order_amount=total("_placed", "item_total"),
            pay_num=total("_paid", "prod_count"), pay_amount=total("_paid", "item_total"),
        ),
    )
    known = F.col("user_id").isNotNull()
    sums = ("place_order_num", "pay_num", "place_order_amount", "pay_amount")
    return per_user.select(
        *keys, *slots.carried,
        *slots.measures(
            place_order_person=lambda i: one_if(bit("_placed", i) & known), pay_person=lambda i: one_if(bit("_paid", i) & known),
        ),
        *slots.names(*sums),
    )


def trade_metrics(lines: DataFrame, keys: Sequence[str], paid: Column, placed: Column | None = None) -> DataFrame:
    """Users, items and amount of placed and of paid lines per key, in one pass."""
    return stack_measures(keys, trade_rows(lines, keys, paid, placed))


def order_rows(orders: DataFrame, keys: Sequence[str], flags: dict[str, Column]) -> DataFrame:
    """Additive order rows, users and amount for each flagged subset: one row per key and user.

    A flag named ``x`` yields ``x_orders``, ``x_users`` and ``x_amount``.
    """
    marked = orders.select(
        *keys, "user_id", "actual_total", *[F.coalesce(c, F.lit(False)).alias(f"_{n}") for n, c in flags.items()]
    )
    sums, measures = [], []
    for name in flags:
        flag = F.col(f"_{name}")
        sums += [
            F.count_if(flag).alias(f"{name}_orders"),
            F.sum(F.when(flag, F.col("actual_total"))).cast(MONEY).alias(f"{name}_amount"),
        ]
        measures += [
            f"{name}_orders", f"{name}_amount",
            one_if((F.col(f"{name}_orders") > 0) & F.col("user_id").isNotNull()).alias(f"{name}_users"),
        ]
    return marked.groupBy(*keys, "user_id").agg(*sums).select(*keys, *measures)
