"""Product and shop dimensions: one row per key, chosen by a total order.

``row_number() = 1`` is kept everywhere because Spark then also keeps only one row per key and map task before the
shuffle, so a key with very many versions does not weigh on one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in ``order``; what is left tied is settled by the remaining columns, highest first."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys]
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


_CARD = ["prod_id", "shop_id", "prod_name", "price", "supplier_price", "status", "pic"]


def latest_product(products: DataFrame, keys: Sequence[str] = ("prod_id", "shop_id")) -> DataFrame:
    """Newest version per key by update time."""
    return first_per_key(
        products.select(*_CARD, "update_time"), keys, F.col("update_time").desc_nulls_last()
    ).drop("update_time")


def merge_snapshot_increment(
    snapshot: DataFrame, increment: DataFrame, keys: Sequence[str], *order: Column
) -> DataFrame:
    """One row per key out of both; a key the snapshot knows keeps its snapshot row."""
    both = snapshot.withColumn("_src", F.lit(1)).unionByName(increment.withColumn("_src", F.lit(2)))
    return first_per_key(both, keys, F.col("_src"), *order).drop("_src")


def merged_products(snapshot: DataFrame, increment: DataFrame, day) -> DataFrame:
    """Undeleted products: snapshot, completed by the day's increment."""
    cols = [*_CARD, "update_time"]
    return merge_snapshot_increment(
        snapshot.filter(F.col("status") > -1).select(*cols),
        increment.filter((F.col("status") > -1) & (F.col("dt") == F.lit(day))).select(*cols),
        ["prod_id"],
        F.col("update_time").desc_nulls_last(),
    ).drop("update_time")


def _named(shops: DataFrame) -> DataFrame:
    return shops.filter(F.trim("shop_name") != "").select("shop_id", "shop_name")


def merged_shops(snapshot: DataFrame, increment: DataFrame, day) -> DataFrame:
    """Shop names: snapshot, completed by the day's increment; the smallest name wins within a source."""
    return merge_snapshot_increment(
        _named(snapshot), _named(increment.filter(F.col("dt") == F.lit(day))), ["shop_id"], F.col("shop_name").asc()
    )


def one_name_per_shop(shops: DataFrame) -> DataFrame:
    """Smallest non-blank name per shop."""
    return _named(shops).groupBy("shop_id").agg(F.min("shop_name").alias("shop_name"))


def with_shop_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Rows with the name of their shop, NULL where there is none; one shop may have nearly all rows.

    ``names`` has one row per shop and so comes from an aggregate. A join on the column it was grouped by would take it as it is
    partitioned, and then AQE, which divides a hot partition only between two plain shuffles, could not split a giant shop. As a
    measure of the group, the shop is a column like any other: names are shuffled by the join itself, what is heavy is read
    off the shuffle's sizes, and its few names are sent to each part of it, while all other shops are joined as they are.
    """
    split = names.groupBy(F.col("shop_id").alias("_shop")).agg(F.max("shop_id").alias("shop_id"), F.min("shop_name").alias("shop_name"))
    return rows.join(split.drop("_shop"), "shop_id", "left")


def latest_item_snapshot(orders_inc: DataFrame, items_inc: DataFrame, day) -> DataFrame:
    """Newest name, price and status of a product among the day's order items, by order time."""
    on_day = F.col("dt") == F.lit(day)
    lines = items_inc.filter(on_day).select(
        "order_number", "prod_id", F.col("prod_name").alias("item_name"), F.col("price").alias("item_price"),
        F.col("status").alias("item_status"),
    ).join(orders_inc.filter(on_day).select("order_number", "shop_id", "create_time"), "order_number")
    return first_per_key(
        lines.drop("order_number"), ["prod_id", "shop_id"], F.col("create_time").desc_nulls_last()
    ).drop("create_time")


def latest_status_today(products_inc: DataFrame, day) -> DataFrame:
    """Newest status per product and shop in the day's increment, deleted rows left out."""
    live = products_inc.filter((F.col("dt") == F.lit(day)) & ~F.col("is_deleted"))
    return first_per_key(
        live.select("prod_id", "shop_id", F.col("status").alias("today_status"), "update_time"),
        ["prod_id", "shop_id"],
        F.col("update_time").desc_nulls_last(),
    ).drop("update_time")
