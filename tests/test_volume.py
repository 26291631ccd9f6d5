"""Rows that are dealt: each once where one pass can serve several steps, and no wider than they have to be."""

import re
from datetime import datetime

import micro as m
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_skew import final_plan, shops, small_pieces

from stallmetrics.functions import calendar as cal
from stallmetrics.operators.ranking import rank_in_group
from stallmetrics.plans import analysis, refund_ranks, sales

T = "2024-01-30 10:00:00"
WINDOWS = cal.standard_windows(datetime(2024, 1, 31, 9))
DAY = dict(dt="2024-01-30")


def _trade(spark):
    """Orders 1 and 2 of a guest and a user, each with items of products 3 and 4; a refund of one item, and two of whole orders."""
    order = dict(order_id=1, shop_id=1, create_time=T, pay_time=T, is_paid=True, actual_total=9, **DAY)
    orders = m.orders(spark, order, order | dict(order_id=2, user_id=7, is_paid=False), order | dict(order_id=None, order_number="n9"))
    item = dict(order_item_id="a", order_number="n1", prod_id=3, shop_id=1, prod_count=2, actual_total=4, rec_time=T, prod_name="p", **DAY)
    items = m.items(
        spark, item, item | dict(order_item_id="b", prod_id=4, actual_total=5), item | dict(order_item_id=None, order_number="n2"),
        item | dict(order_item_id="d", order_number="n2", actual_total=1), item | dict(order_item_id="e", order_number=None, prod_id=4),
    )
    refund = dict(refund_id="r", order_id=1, order_item_id="a", refund_type=2, return_money_sts=5, refund_amount=4, apply_time=T, refund_time=T, **DAY)
    refunds = m.refunds(
        spark, refund, refund | dict(refund_id="s", order_id=2, order_item_id=None, refund_type=1, user_id=7, return_money_sts=1),
        refund | dict(refund_id="t", order_id=None, order_item_id="e", user_id=7),
    )
    products = m.products(spark, *[dict(prod_id=i, shop_id=1, prod_name="p", price=4, pic="q", create_time=T, **DAY) for i in (3, 4)])
    return orders, items, refunds, products


def test_orders_and_refunds_meet_items_in_one_pass(spark):
    orders, items, refunds, products = _trade(spark)
    log = m.app_log(spark, dict(prod_id=3, shop_id=1, cid="a", dt="2024-01-30"))
    with small_pieces(spark):
        out = analysis.platform_analysis(products, shops(spark), log, orders, items.repartition("prod_id"), refunds, WINDOWS)
        plan = final_plan(out)
        got = {r.prod_id: r for r in out.filter("status_filter = '0' AND time_period = '30'").collect()}
    # items are dealt once, under both keys, and lines are folded where they are dealt
    assert "Exchange hashpartitioning(order_number" not in plan and plan.count("Exchange hashpartitioning(_by_order") == 2
    measures = (
        "place_order_person", "place_order_num", "place_order_amount", "pay_person", "pay_num", "pay_amount",
        "refund_num", "refund_person", "refund_success_num", "refund_success_person", "refund_success_amount",
    )
    assert [tuple(int(got[p][x]) for x in measures) for p in (3, 4)] == [(1, 6, 9, 0, 2, 4, 3, 1, 1, 0, 4), (0, 2, 5, 0, 2, 5, 1, 1, 1, 1, 4)]


def test_crowded_bands_are_ranked_by_cells(spark):
    ids = spark.range(30000).withColumn("g", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 11))
    value = F.when(F.col("id") % 5 < 2, F.lit(19.99)).when(F.col("id") % 5 == 2, F.lit(0)).otherwise(F.hash("id") % 1000 + 1000)
    df = ids.select("g", (F.col("id") * 7919 % 1000003 + 2**60).alias("k"), value.cast("decimal(18,2)").alias("v"), F.concat(F.lit("n"), "g").alias("name"))
    expected = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "k")))
    for crowded in (1, 500, 10**9):
        got = rank_in_group(df, ["g"], "v", "k", "r", crowded=crowded, same=["name"])
        assert got.columns == expected.columns and got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_a_ranking_deals_its_rows_once(spark):
    orders, items, _, products = _trade(spark)
    with small_pieces(spark):
        out = sales.sales_rank(items, orders, products, shops(spark), WINDOWS)
        plan = final_plan(out)
        assert {(r.prod_id, r.shop_name, r.rank_num) for r in out.collect()} == {(3, "shop 1", 2), (4, "shop 1", 1)}
    # the rows of all windows are dealt by their bands, and their cells are not shuffled beside them
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(win" in x and "REPARTITION" in x]
    assert len(dealt) == 1 and "_band" in dealt[0]


def test_refunded_items_and_refunds_are_dealt_by_item_alone(spark):
    orders, items, refunds, products = _trade(spark)
    with small_pieces(spark):
        out = refund_ranks.product_rank(
            refunds.withColumn("goods_num", F.lit(1)), orders, items.repartition("prod_id"), products, datetime(2024, 1, 30, 12))
        plan = final_plan(out)
        assert {r.prod_id: r.refund_count for r in out.collect()} == {3: 1, 4: 1}
    # no other shuffle is spent on leaving out their copies
    assert not re.search(r"Exchange hashpartitioning\((prod_id#\d+L, order_|order_id#\d+L, refund_type)", plan)
