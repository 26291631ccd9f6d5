"""Orders and refunds of a product in one pass: both ask for items, and what they ask for are lines of one tally."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.operators.refunds import SINGLE_ITEM, SUCCEEDED, WHOLE_ORDER
from stallmetrics.operators.tally import REFUND, TRADE, what
from stallmetrics.operators.windows import MASK, Slots, mask_of

def _under(by_order: bool, key: Column) -> Column:
    """A key that a line is found under: its item or its order."""
    return F.struct(F.lit(by_order).alias("_by_order"), key.alias("_key"))


def activity_lines(
    ordered: DataFrame, refunds: DataFrame, orders: DataFrame, items: DataFrame, placed: Sequence[Column], paid: Sequence[Column], slots: Slots
) -> DataFrame:
    """Items that an order or a refund is about, with ``_what`` happened to them (see ``tally``).

    ``ordered`` and ``refunds`` are marked. Orders ask for items under their number, refunds under the item they name and under the numbers of
    their order, and an item answers under both, so that one join serves all. A refund counts through its own scope alone, as a refund of
    a single item or of a whole order; through the other it measures nothing. Copies of an order multiply its own items alone.
    """
    carry = [*slots.keys, "user_id"]
    known = orders.filter(F.col("order_id").isNotNull()).select("order_id", "order_number").repartition("order_id")
    numbers = known.groupBy("order_id").agg(F.collect_list("order_number").alias("_numbers"))
    window = F.col(MASK) if slots.shared else F.lit(1)
    scope = F.when(F.col("refund_type") == SINGLE_ITEM, 1).when(F.col("refund_type") == WHOLE_ORDER, 2).otherwise(0)
    ok = F.coalesce(F.col("return_money_sts") == SUCCEEDED, F.lit(False))
    by_order = F.transform(F.coalesce("_numbers", F.array().cast("array<string>")), lambda n: _under(True, n))
    wanted = refunds.select(*carry, *slots.carried, "order_id", "order_item_id", scope.alias("_scope"), ok.alias("_ok")).join(numbers, "order_id", "left").select(
        *carry, *slots.carried, "_scope", "_ok", F.inline(F.concat(F.array(_under(False, F.col("order_item_id"))), by_order))
    )
    own = F.when(F.col("_scope") == F.when(F.col("_by_order"), 2).otherwise(1), window).otherwise(0)
    asking = [
        ordered.select(*carry, what(TRADE, mask_of(placed), mask_of(paid), slots), F.lit(True).alias("_by_order"), F.col("order_number").alias("_key")),
        wanted.select(*carry, what(REFUND, own, F.when(F.col("_ok"), own).otherwise(0), slots), "_by_order", "_key"),
    ]
    asked = reduce(DataFrame.unionByName, [x.filter(F.col("_key").isNotNull()) for x in asking])
    # pieces are only counted for orders
    offered = items.select(
        "prod_id", "prod_count", F.col("actual_total").alias("item_total"),
        F.inline(F.array(_under(False, F.col("order_item_id")), _under(True, F.col("order_number")))),
    ).filter(F.col("_key").isNotNull()).withColumn("prod_count", F.when(F.col("_by_order"), F.col("prod_count")))
    return asked.join(offered, ["_by_order", "_key"]).select(*carry, "_what", "prod_id", "prod_count", "item_total")
