"""How often rows are dealt, and that folding them where they lie gives the same numbers."""

import re
from datetime import date, datetime
from decimal import Decimal

import micro as m
from test_skew import small_pieces

from stallmetrics.functions import calendar as cal
from stallmetrics.operators.refunds import refund_metrics
from stallmetrics.operators.trade import distinct_order_lines
from stallmetrics.operators.windows import Slots
from stallmetrics.sources.retail_binding import RetailTables

T = "2024-01-30 10:00:00"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_orders_and_their_items_are_dealt_once_and_sorted_not_hashed(spark):
    order = dict(order_id=1, order_number="n1", user_id=1, shop_id=1, create_time=T, actual_total=4)
    item = dict(order_item_id="i1", order_number="n1", prod_id=3, shop_id=1, prod_count=2, actual_total=4, rec_time=T)
    other = item | dict(order_item_id="i2")
    lines = distinct_order_lines(m.orders(spark, order, order, order | dict(user_id=None)), m.items(spark, item, item, other, item | dict(order_number=None)))
    assert lines.count() == 4
    with small_pieces(spark):
        plan = _plan(lines)
    assert len(re.findall(r"Exchange hashpartitioning\(order_number", plan)) == plan.count("Exchange ") == 2 and "HashAggregate" not in plan


def test_a_single_window_is_no_key():
    day = cal.whole_day(date(2024, 1, 30))
    assert Slots((day,)).keys == [] and Slots((day, cal.whole_day(date(2024, 1, 29)))).keys == ["win"]


def test_a_refund_of_several_users_and_lines_counts_once(spark):
    line = dict(prod_id=1, refund_id="r", user_id=1, return_money_sts=5, refund_amount=Decimal(2), item_total=Decimal(3))
    rows = [line, line, line | dict(user_id=2, return_money_sts=1), line | dict(user_id=None), line | dict(refund_id=None), line | dict(refund_id="s", user_id=2, return_money_sts=None)]
    schema = "prod_id long, refund_id string, user_id long, return_money_sts int, refund_amount decimal(18,2), item_total decimal(18,2)"
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    got = refund_metrics(frame, ["prod_id"]).collect()
    assert [(r.refund_num, r.refund_success_num, r.refund_person, r.refund_success_person, r.refund_success_amount) for r in got] == [(2, 1, 2, 1, 8)]
    assert _plan(refund_metrics(frame, ["prod_id"])).count("Generate") == 0


def test_orders_of_headers_that_occur_twice(spark, tmp_path):
    at = datetime(2000, 1, 1)
    spark.createDataFrame([(1, 5, "F", at), (1, 5, "F", at), (1, 6, "F", at), (None, 5, "F", at), (2, 7, "O", at)], "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    columns = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    line = lambda order, shop, price: (order, 1, shop, 1, 1.0, price, "N", "O", at)
    spark.createDataFrame([line(1, 1, 2.0), line(1, 1, 2.5), line(1, None, 1.0), line(None, 1, 9.0), line(2, 1, None), line(3, 1, 4.0)], columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = RetailTables(spark, str(tmp_path)).orders
    got = {(r.order_id, r.order_number, r.user_id, r.shop_id): r.actual_total for r in orders.collect()}
    assert got == {
        (100001, "1-1", 5, 1): 9, (100001, "1-1", 6, 1): Decimal("4.5"), (None, "1", 5, None): 2, (None, "1", 6, None): 1, (200001, "2-1", 7, 1): None,
    }
    assert "HashAggregate" not in _plan(orders)
