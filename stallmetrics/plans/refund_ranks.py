"""Refund rankings by product and by reason."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import month_back_window
from stallmetrics.functions.ids import with_packed
from stallmetrics.functions.labels import UNKNOWN_PRODUCT, refund_reason_label
from stallmetrics.functions.rates import money_ratio
from stallmetrics.operators.refunds import SINGLE_ITEM, SUCCEEDED, WHOLE_ORDER
from stallmetrics.operators.trade import one_of_each
from stallmetrics.operators.windows import inside

#: Stands for a missing key; no packed text is empty.
NOTHING = b""


def _recent_successes(refunds: DataFrame, as_of: datetime) -> DataFrame:
    return refunds.filter(
        (F.col("return_money_sts") == SUCCEEDED) & inside("refund_time", month_back_window(as_of))
    )


def product_rank(
    refunds: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, as_of: datetime
) -> DataFrame:
    """Refunded pieces per product, for each shop that carries it, over the last month.

    Refunded items are those a single-item refund names and all items of fully refunded orders. Pieces are summed
    per product before the catalog joins, so catalog versions cannot multiply them.
    """
    refunds = refunds.withColumns(with_packed("order_item_id"))
    orders, items = orders.withColumns(with_packed("order_number")), items.withColumns(with_packed("order_number", "order_item_id"))
    refund_cols = ["order_item_id", "order_id", "refund_type", "refund_time", "goods_num"]
    back = _recent_successes(refunds, as_of).select(*refund_cols)
    # copies don't matter to whether an item is refunded
    named = back.filter((F.col("refund_type") == SINGLE_ITEM) & F.col("order_item_id").isNotNull())
    whole = back.filter(F.col("refund_type") == WHOLE_ORDER)
    # only refunds that name an item can say how many pieces came back
    with_item = one_of_each(back.filter(F.col("order_item_id").isNotNull()), refund_cols, ["order_item_id"]).select("order_item_id", "goods_num")

    # the keys of items are never NULL here, so that both branches read the same shuffles
    item_cols = ["order_item_id", "prod_id", "order_number", "prod_count", "prod_name"]
    keys = ["order_item_id", "order_number"]
    facts = items.filter(F.col("prod_id").isNotNull()).select(*item_cols).withColumns({c: F.coalesce(c, F.lit(NOTHING)) for c in keys})
    whole_orders = orders.join(whole.select("order_id").distinct(), "order_id", "left_semi").select("order_number")
    refunded = facts.join(named.select("order_item_id"), "order_item_id", "left_semi").unionByName(
        facts.join(whole_orders, "order_number", "left_semi")
    ).withColumns({c: F.nullif(F.col(c), F.lit(NOTHING)) for c in keys})
    # dealt by item, as the pieces are
    pieces = one_of_each(refunded, item_cols, ["order_item_id"]).join(with_item, "order_item_id", "left").groupBy("prod_id").agg(
        F.sum(F.coalesce("goods_num", "prod_count")).alias("refund_count"),
        F.max("prod_name").alias("refund_prod_name"),
    ).filter(F.col("refund_count") > 0)
    carried = products.filter(F.col("shop_id").isNotNull()).groupBy("prod_id", "shop_id").agg(
        F.max("pic").alias("pic")
    )
    return carried.join(pieces, "prod_id").select(
        "prod_id", "shop_id", "refund_count", "refund_prod_name", "pic", F.lit(as_of.date()).alias("stat_date")
    ).orderBy(F.desc("refund_count"))


def reason_rank(
    refunds: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame, as_of: datetime
) -> DataFrame:
    """Refunds per shop and reason over the last month, with the share of the shop's refunded money.

    Names are reduced to one per order and item first, so joins keep one row per refund. Refunds are then folded by shop, reason
    and product, so that a product with nearly all refunds meets its picture with a row per shop and reason.
    """
    refunds, items = refunds.withColumns(with_packed("order_item_id", "refund_id")), items.withColumns(with_packed("order_item_id"))
    back = _recent_successes(refunds, as_of).filter(F.col("shop_id").isNotNull()).select(
        "refund_id", "order_id", "order_item_id", "shop_id", "refund_amount", "buyer_reason"
    )
    # only orders and items that a refund names are folded
    order_names = (
        orders.join(back.select("order_id"), "order_id", "left_semi")
        .groupBy("order_id").agg(F.max("prod_name").alias("_order_name"))
    )
    item_cards = (
        items.join(back.select("order_item_id"), "order_item_id", "left_semi")
        .groupBy("order_item_id").agg(F.max("prod_name").alias("_item_name"), F.max("prod_id").alias("prod_id"))
    )
    # refunds of whole orders name no item: a key of their own spreads them instead of piling up on NULL
    spread = back.withColumn(
        "order_item_id", F.coalesce("order_item_id", F.concat(F.lit(b"\x01"), F.col("refund_id")))
    )
    described = spread.join(order_names, "order_id", "left").join(item_cards, "order_item_id", "left").select(
        "shop_id", "prod_id", "refund_amount",
        refund_reason_label("buyer_reason").alias("buyer_reason"),
        F.coalesce("_order_name", "_item_name", F.lit(UNKNOWN_PRODUCT)).alias("_name"),
    )
    money = F.sum("refund_amount").cast("decimal(18,2)")
    by_product = described.groupBy("shop_id", "buyer_reason", "prod_id").agg(
        F.max("_name").alias("_name"), F.count(F.lit(1)).alias("_rows"), money.alias("refund_amount")
    )
    pics = products.groupBy("prod_id").agg(F.max("pic").alias("_pic"))
    by_reason = by_product.join(pics, "prod_id", "left").groupBy("shop_id", "buyer_reason").agg(
        F.max("_name").alias("refund_prod_name"),
        F.sum("_rows").alias("refund_count"),
        money.alias("pay_actual_total"),
        F.max("_pic").alias("pic"),
    )
    # refunds without a reason count towards the shop's total but get no row; a shop has as many rows as there are reasons
    total = F.sum("pay_actual_total").over(Window.partitionBy("shop_id")).cast("decimal(18,2)")
    return by_reason.withColumn("_total", total).filter(F.col("buyer_reason").isNotNull()).select(
        "buyer_reason", "refund_prod_name", "refund_count", "pay_actual_total",
        money_ratio("pay_actual_total", "_total", 1, times=100).alias("percent_amount"),
        "pic", "shop_id", F.lit(as_of.date()).alias("stat_date"),
    ).orderBy(F.desc("refund_count"), F.desc("pay_actual_total"))
