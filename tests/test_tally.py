"""Measures as bits, short keys and shuffles that several tables read."""

import re
from datetime import datetime
from decimal import Decimal

import micro as m
from pyspark.sql import functions as F
from test_skew import final_plan, shops, small_pieces

from stallmetrics.functions import calendar as cal
from stallmetrics.functions.ids import packed
from stallmetrics.operators.tally import REFUND, TRADE, by_part, lines_of, measured, what
from stallmetrics.operators.windows import Slots, mask_of
from stallmetrics.plans import analysis
from stallmetrics.sources.retail_binding import RetailTables

T, EARLY = "2024-01-30 10:00:00", "2024-01-05 10:00:00"
WINDOWS = cal.standard_windows(datetime(2024, 1, 31, 9))


def test_packed_texts_are_equal_where_the_texts_are(spark):
    texts = ["", "0", "00", "000", "1", "12", "012", "1-2", "1.2", "a", "A", "ab", "c", "cd", "1a", "-", "--", "a-", "12-3.4_5:6", "é", "12é", " 12", "12 ", "\0", "\0" "12"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in [*texts, None, "12"]], "t string").select(packed("t")).collect()]
    assert got[-2] is None and got[-1] == got[texts.index("12")] and None not in got[:-2]
    assert len({bytes(b) for b in got[:-2]}) == len(texts) and b"" not in got
    assert len(got[texts.index("12-3.4_5:6")]) == 6


def test_people_are_counted_once_in_all_windows_of_their_lines(spark):
    slots = Slots(tuple(WINDOWS))
    # of user 1: an order line of 30 days, a like one, and one of 7 days too; of nobody: two; and a refund of two lines
    rows = [(1, 1, 6, 6, 2, "5"), (1, 1, 6, 6, 2, "5"), (1, 1, 7, 0, 1, "1"), (1, None, 7, 7, 3, "2"), (1, None, 7, 7, 3, "2"), (2, 1, 1, 0, None, None)]
    trade = spark.createDataFrame([(p, u, a, b, n, s and Decimal(s)) for p, u, a, b, n, s in rows], "prod_id long, user_id long, a int, b int, n int, s decimal(18,2)")
    lines = lines_of(trade.withColumn("win_mask", F.col("a")), ["prod_id"], "user_id", slots, what(TRADE, F.col("a"), F.col("b"), slots), F.col("n"), F.col("s"))
    back = spark.createDataFrame([(1, 9, 7, 7), (1, 9, 7, 0)], "prod_id long, user_id long, win_mask int, once int")
    refund = lines_of(
        back, ["prod_id"], "user_id", slots, what(REFUND, F.col("win_mask"), F.col("win_mask"), slots), money=F.lit(4), once=(F.col("once"), F.col("once")))
    folded = by_part(lines.unionByName(refund), ["prod_id"], slots)
    for distinct, refunds in ((True, 1), (False, 2)):
        got = {r.prod_id: r for r in measured(folded, ["prod_id"], slots, distinct).collect()}
        one, two = got[1], got[2]
        assert (one.place_order_person__0, one.place_order_person__1, one.pay_person__0, one.pay_person__1) == (1, 1, 0, 1)
        assert (one.place_order_num__0, one.place_order_num__1, one.pay_num__0, one.pay_num__1) == (7, 11, 6, 10)
        assert (one.place_order_amount__0, one.pay_amount__2) == (5, 14) and one.win_mask == 7
        assert (one.refund_num__0, one.refund_success_num__1, one.refund_person__2, one.refund_success_amount__0) == (refunds, refunds, 1, 8)
        assert (two.win_mask, two.place_order_person__0, two.place_order_person__1, two.place_order_num__0, two.pay_amount__0) == (1, 1, 0, 0, 0)


def test_facts_of_a_product_are_dealt_narrow(spark):
    order = dict(order_id=1, user_id=5, shop_id=1, create_time=T, pay_time=T, is_paid=True, actual_total=9, dt="2024-01-30")
    orders = m.orders(spark, order, order | dict(order_id=2, create_time=EARLY, pay_time=EARLY, is_paid=False))
    item = dict(order_item_id="a", order_number="n1", prod_id=3, shop_id=1, prod_count=2, actual_total=4, rec_time=T)
    items = m.items(spark, item, item, item | dict(order_item_id="b", order_number="n2", actual_total=1))
    refund = dict(refund_id="r", order_id=1, order_item_id="a", user_id=5, refund_type=2, return_money_sts=5, refund_amount=4, apply_time=T)
    refunds = m.refunds(spark, refund, refund, refund | dict(refund_id="s", order_item_id=None, refund_type=1, return_money_sts=1))
    products = m.products(spark, dict(prod_id=3, shop_id=1, prod_name="p", price=4, pic="q", create_time=T))
    log = m.app_log(spark, *[dict(prod_id=3, shop_id=1, cid=c, dt="2024-01-30") for c in ("a", "a", None)])
    with small_pieces(spark):
        out = analysis.merchant_analysis(products, shops(spark), log, orders, items, refunds, WINDOWS)
        plan = final_plan(out)
        got = {r.time_period: r for r in out.filter("status_filter = '0'").collect()}
    measures = ("expose", "expose_person_num", "place_order_person", "place_order_num", "place_order_amount", "pay_num", "refund_num", "refund_person", "refund_success_num", "refund_success_amount")
    assert [int(got["7"][x]) for x in measures] == [3, 1, 1, 2, 4, 2, 2, 1, 1, 4]
    assert [int(got["30"][x]) for x in measures] == [3, 1, 1, 4, 5, 2, 2, 1, 1, 4] and got["202401"].place_order_num == 4
    # lines are dealt before they are spread over measures and windows
    assert "partial_sum(place_order_num__0" not in plan and re.search(r"Exchange hashpartitioning\(prod_id#\d+L, shop_id#\d+L, 8\), REPARTITION_BY_COL", plan)


def test_orders_items_and_refunds_read_one_shuffle_of_lines(spark, tmp_path):
    at = datetime(2000, 1, 1)
    spark.createDataFrame([(1, 5, "F", at), (None, 5, "F", at)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame([(1, 1, 1, i, 1.0, 2.0, f, "O", at) for i, f in enumerate("RN")] + [(None, 1, 1, 1, 1.0, 2.0, "R", "O", at)], columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = {}
    for shared in (False, True):
        t = RetailTables(spark, str(tmp_path), shared)
        with small_pieces(spark):
            both = t.orders.join(t.items.drop("shop_id", "user_id", "dt", "actual_total"), "order_number").join(t.refunds.select("order_id", "refund_amount"), "order_id")
            plan = final_plan(both)
            rows[shared] = sorted(map(str, both.collect()))
        dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning(l_orderkey" in x and "Reused" not in x]
        assert not shared or len(dealt) == 2
    assert rows[False] == rows[True] and len(rows[True]) == 2
