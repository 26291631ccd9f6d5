"""Edge cases of the reports with hand-computed answers."""

from datetime import date, datetime
from decimal import Decimal

import micro as m

from stallmetrics.functions import calendar as cal
from stallmetrics.plans import analysis, labels_expand, merchant, overview, refund_ranks, sales

DAY = date(2024, 1, 30)
NOON = datetime(2024, 1, 30, 12)
T = "2024-01-30 10:00:00"
WINDOW = [cal.whole_day(DAY)]


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_refund_rate_is_100_without_orders(spark):
    orders = m.orders(spark, dict(order_id=1, shop_id=1, status=2, pay_time=T), dict(order_id=2, shop_id=1, status=1, pay_time=T))
    refunds = m.refunds(
        spark,
        dict(refund_id="a", order_id=9, shop_id=2, return_money_sts=5, refund_time=T, refund_amount=3),
        dict(refund_id="b", order_id=9, shop_id=2, return_money_sts=5, refund_time=T, refund_amount=4),
        dict(refund_id="c", order_id=8, shop_id=None, return_money_sts=5, refund_time=T, refund_amount=4),
        dict(refund_id="d", order_id=7, shop_id=1, return_money_sts=1, refund_time=T, refund_amount=4),
    )
    got = rows(merchant.refund_stats(orders, refunds, NOON), "shop_id")
    assert set(got) == {(1,), (2,)}
    assert (got[2,].refund_count, got[2,].pay_actual_total, got[2,].refund_rate) == (1, Decimal("7.00"), Decimal(100))
    assert (got[1,].pay_order_count, got[1,].refund_rate) == (1, Decimal(0))


def test_comprehensive_does_not_multiply_orders_by_items(spark):
    orders = m.orders(
        spark, dict(order_id=1, shop_id=1, user_id=5, create_time=T, is_paid=True, actual_total=10),
        dict(order_id=2, shop_id=1, user_id=5, create_time=T, actual_total=4),
        dict(order_id=3, shop_id=1, user_id=None, create_time=T, actual_total=1),
    )
    items = m.items(spark, dict(order_number="n1", prod_count=2), dict(order_number="n1", prod_count=3), dict(order_number="n2", prod_count=1))
    (row,) = merchant.comprehensive(orders, items, m.refunds(spark), [cal.period_to_date(NOON, "day")]).collect()
    assert (row.order_amount, row.order_nums, row.user_nums, row.product_nums) == (Decimal(15), 3, 1, 6)
    assert (row.pay_amount, row.pay_order_nums, row.pay_user_nums, row.pay_product_nums) == (Decimal(10), 1, 1, 5)
    assert (row.order_to_pay_rate, row.customer_unit_price, row.refund_rate) == (Decimal("33.33"), Decimal(10), Decimal(0))


def test_order_pay_agg_lists_only_shops_paid_today(spark):
    orders = m.orders(
        spark, dict(order_id=1, shop_id=1, is_paid=True, pay_time=T, actual_total=5),
        dict(order_id=2, shop_id=1, is_paid=True, pay_time="2024-01-02 00:00:00", actual_total=7),
        dict(order_id=3, shop_id=2, is_paid=True, pay_time="2024-01-02 00:00:00", actual_total=7),
    )
    (row,) = merchant.order_pay_agg(orders, NOON).collect()
    assert (row.shop_id, row.pay_order_count, row.month_amount, row.month_to_date_amount) == (1, 1, Decimal(5), Decimal(12))


def _overview_tables(spark):
    orders = m.orders(
        spark,
        dict(order_id=1, shop_id=1, create_time=T, is_paid=True, dt="2024-01-30"),
        dict(order_id=2, shop_id=2, create_time=T, dt="2024-01-30"),  # no items yet
        dict(order_id=3, shop_id=None, create_time=T, dt="2024-01-30"),
    )
    items = m.items(spark, dict(order_number="n1", prod_id=7, prod_count=2, dt="2024-01-30"), dict(order_number="n3", prod_id=7, prod_count=1, dt="2024-01-30"))
    new = [dict(prod_id=i, shop_id=i, create_time=T, dt="2024-01-30") for i in (1, 2, 3)]
    products = m.products(spark, *new, dict(prod_id=9, shop_id=9, status=-1, create_time=T, dt="2024-01-30"))
    log = m.app_log(
        spark, dict(prod_id=7, shop_id=3, cid="a", dt="2024-01-30", label='{"isShare":1}'),
        dict(prod_id=8, shop_id=3, cid="a", dt="2024-01-30", label='{"isShare":"1"}'),
        dict(prod_id=8, shop_id=3, cid="b", dt="2024-01-30", label="not json"),
        dict(prod_id=8, shop_id=4, cid="b", dt="2024-01-30"), dict(prod_id=None, shop_id=3, cid="c", dt="2024-01-30"),
    )
    return orders, items, products, log


def test_daily_overview_keeps_new_only_shops_despite_null_shop(spark):
    got = rows(overview.daily_overview(*_overview_tables(spark), [DAY]), "shop_id")
    assert set(got) == {(None,), (1,), (2,), (3,)}
    assert (got[1,].order_num, got[1,].pay_num, got[1,].dynamic_sale, got[1,].new_prod) == (2, 2, 1, 1)
    assert (got[2,].order_num, got[2,].dynamic_sale) == (0, 0)
    only_new = got[3,]
    assert (only_new.expose, only_new.visited_prod, only_new.visitor, only_new.share_visit) == (3, 2, 2, 2)


def test_intraday_overview_leaves_out_shops_whose_orders_have_no_items(spark):
    orders, items, products, log = _overview_tables(spark)
    got = rows(overview.intraday_overview(orders, items, products, log, cal.intraday_window(NOON)), "shop_id")
    assert set(got) == {(None,), (1,), (3,)}


def test_period_overview_lists_traffic_only_shops(spark):
    got = rows(overview.period_overview(*_overview_tables(spark), WINDOW), "shop_id")
    assert set(got) == {(1,), (2,), (3,), (4,)}


def _refund_tables(spark):
    orders = m.orders(spark, dict(order_id=1, shop_id=1, create_time=T), dict(order_id=2, shop_id=1, create_time=T, prod_name="order name"))
    items = m.items(
        spark,
        dict(order_item_id="i1", order_number="n1", prod_id=7, shop_id=1, prod_count=2, prod_name="a", actual_total=20),
        dict(order_item_id="i2", order_number="n2", prod_id=7, shop_id=1, prod_count=5, prod_name="b", actual_total=50),
        dict(order_item_id="i3", order_number="n2", prod_id=8, shop_id=1, prod_count=1, prod_name="c", actual_total=10),
    )
    base = dict(shop_id=1, return_money_sts=5, refund_time="2024-01-10 00:00:00", apply_time=T, user_id=4)
    refunds = m.refunds(
        spark,
        base | dict(refund_id="r1", order_id=1, order_item_id="i1", refund_type=2, goods_num=1, refund_amount=10, buyer_reason="9"),
        base | dict(refund_id="r2", order_id=2, refund_type=1, refund_amount=30, buyer_reason="0"),
        base | dict(refund_id="r3", order_id=1, order_item_id="i1", refund_type=2, refund_amount=60, buyer_reason=None),
        base | dict(refund_id="r4", order_id=1, order_item_id="i1", refund_type=2, refund_amount=5, return_money_sts=1, buyer_reason="0"),
        base | dict(refund_id="r5", order_id=1, refund_type=2, order_item_id="i1", refund_amount=5, refund_time="2023-12-30 23:59:59"),
    )
    products = m.products(
        spark, dict(prod_id=7, shop_id=1, pic="p1"), dict(prod_id=7, shop_id=1, pic="p2", update_time="2024-01-02"),
        dict(prod_id=7, shop_id=2, pic="p3"), dict(prod_id=8, shop_id=1, pic="p4"), dict(prod_id=8, shop_id=None),
    )
    return refunds, orders, items, products


def test_product_rank_counts_pieces_once_per_carrying_shop(spark):
    got = rows(refund_ranks.product_rank(*_refund_tables(spark), NOON), "prod_id", "shop_id")
    # i1: 1 piece (r1) and all its 2 pieces (r3, no number given); i2, i3 through the whole order: 5 and 1
    assert {k: r.refund_count for k, r in got.items()} == {(7, 1): 8, (7, 2): 8, (8, 1): 1}
    assert (got[7, 1].pic, got[7, 1].refund_prod_name) == ("p2", "b")


def test_reason_rank(spark):
    got = rows(refund_ranks.reason_rank(*_refund_tables(spark), NOON), "shop_id", "buyer_reason")
    assert set(got) == {(1, "9"), (1, "拍错/多拍/不喜欢")}
    raw = got[1, "9"]
    # the refund without a reason has no row but is part of the shop's 100
    assert (raw.refund_count, raw.pay_actual_total, raw.percent_amount, raw.pic) == (1, Decimal(10), Decimal(10), "p3")
    assert raw.refund_prod_name == "a"
    named = got[1, "拍错/多拍/不喜欢"]
    assert (named.refund_prod_name, named.percent_amount, named.pic) == ("order name", Decimal(30), None)


def test_merchant_analysis_with_copies_and_refund_kinds(spark):
    refunds, orders, items, products = _refund_tables(spark)
    paid = m.orders(spark, dict(order_id=3, shop_id=1, user_id=6, create_time=T, is_paid=True, pay_time="2024-02-02 00:00:00"))
    more = m.items(spark, dict(order_item_id="i4", order_number="n3", prod_id=8, shop_id=1, prod_count=4, actual_total=40))
    log = m.app_log(spark, dict(prod_id=7, shop_id=1, cid="a", dt="2024-01-30"), dict(prod_id=7, shop_id=None, cid="b", dt="2024-01-30"))
    shops = m.shops(spark, dict(shop_id=1, shop_name=" "), dict(shop_id=1, shop_name="b"), dict(shop_id=1, shop_name="a"), dict(shop_id=1))
    args = [products, shops, log, orders.union(paid), items.union(more), refunds]
    once = analysis.merchant_analysis(*args, WINDOW)
    twice = analysis.merchant_analysis(*args[:3], *[a.union(a) for a in args[3:]], WINDOW)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    got = rows(once, "prod_id", "shop_id", "status_filter")
    assert set(got) == {(7, 1, "0"), (7, 1, "1"), (8, 1, "0"), (8, 1, "1")}
    seven, eight = got[7, 1, "0"], got[8, 1, "0"]
    assert (seven.expose, seven.place_order_num, seven.place_order_amount, seven.shop_name) == (1, 7, Decimal(70), "a")
    # r1, r3, r4, r5 name item i1; r2 gives its full amount to every product of order 2
    assert (seven.refund_num, seven.refund_success_num, seven.refund_person, seven.refund_success_amount) == (5, 4, 1, Decimal(105))
    assert (eight.refund_num, eight.refund_success_amount) == (1, Decimal(30))
    # paid, but not inside the window
    assert (eight.place_order_person, eight.pay_person, eight.pay_num) == (1, 0, 0)
    assert seven.refund_success_rate == Decimal(80)


def test_today_falls_back_to_items_and_made_up_names(spark):
    products = m.products(spark, dict(prod_id=7, shop_id=1, status=None, prod_name=None, price=None), dict(prod_id=8, shop_id=2, status=0, prod_name=None, price=3))
    orders = m.orders(spark, dict(order_id=1, shop_id=1, user_id=1, create_time=T, dt="2024-01-30"), dict(order_id=2, shop_id=2, user_id=1, create_time="2024-01-29 00:00:00", pay_time=T, is_paid=True, dt="2024-01-30"))
    items = m.items(
        spark, dict(order_item_id="a", order_number="n1", prod_id=7, shop_id=1, prod_count=1, actual_total=5, price=5, prod_name="x", status=3, dt="2024-01-30"),
        dict(order_item_id="b", order_number="n2", prod_id=8, shop_id=2, prod_count=2, actual_total=8, dt="2024-01-30"),
    )
    inc = m.products(spark, dict(prod_id=8, shop_id=2, status=1, dt="2024-01-30"), dict(prod_id=8, shop_id=2, status=3, is_deleted=True, update_time="2024-01-09", dt="2024-01-30"))
    got = rows(
        analysis.merchant_analysis_today(products, m.shops(spark), m.app_log(spark), orders, items, m.refunds(spark), inc, DAY),
        "prod_id", "status_filter",
    )
    assert set(got) == {(7, "0"), (7, "3"), (8, "0"), (8, "1")}
    seven, eight = got[7, "0"], got[8, "0"]
    assert (seven.prod_name, seven.price, seven.status, seven.shop_name) == ("x", Decimal(5), 3, "商家_1")
    assert (eight.prod_name, eight.status, eight.place_order_num, eight.pay_num) == ("商品_8", 1, 0, 2)


def test_platform_analysis_lists_active_products_without_measures(spark):
    refunds, orders, items, products = _refund_tables(spark)
    early = m.orders(spark, dict(order_id=5, shop_id=3, user_id=1, create_time="2024-01-01 00:00:00", pay_time=T, is_paid=True))
    more = m.items(spark, dict(order_item_id="i5", order_number="n5", prod_id=5, shop_id=3, prod_count=1, actual_total=1))
    cards = products.union(m.products(spark, dict(prod_id=5, shop_id=3), dict(prod_id=6, shop_id=3, status=4), dict(prod_id=4, shop_id=3)))
    log = m.app_log(spark, dict(prod_id=6, shop_id=1, cid="a", dt="2024-01-30"), dict(prod_id=6, shop_id=3, cid="a", dt="2024-01-30"))
    got = rows(analysis.platform_analysis(cards, m.shops(spark), log, orders.union(early), items.union(more), refunds, WINDOW), "prod_id", "status_filter")
    assert {k[0] for k in got} == {5, 6, 7, 8}
    assert (got[5, "0"].place_order_num, got[5, "0"].pay_num) == (0, 0)
    assert (got[6, "0"].expose, got[6, "0"].prod_status) == (1, "")
    assert (6, "1") not in got
    # counted per row and worth the item's total
    assert (got[7, "0"].refund_num, got[7, "0"].refund_success_num, got[7, "0"].refund_success_amount) == (5, 4, Decimal(20 * 3 + 50))


def test_platform_today_keeps_the_snapshot_card_and_open_refund_end(spark):
    end = datetime(2024, 1, 30, 12)
    snapshot = m.products(spark, dict(prod_id=7, shop_id=1, prod_name="old", dt="2024-01-30"), dict(prod_id=9, shop_id=1, status=-1))
    inc = m.products(spark, dict(prod_id=7, shop_id=1, prod_name="new", dt="2024-01-30"), dict(prod_id=8, shop_id=1, prod_name="fresh", dt="2024-01-30"))
    orders = m.orders(spark, dict(order_id=1, shop_id=1, user_id=1, create_time=T, dt="2024-01-30"))
    items = m.items(spark, *[dict(order_item_id=f"i{p}", order_number="n1", prod_id=p, shop_id=1, prod_count=1, actual_total=2, dt="2024-01-30") for p in (7, 8, 9)])
    refunds = m.refunds(
        spark, dict(refund_id="a", order_item_id="i7", refund_type=2, apply_time="2024-01-30 12:00:00", dt="2024-01-30"),
        dict(refund_id="b", order_item_id="i8", refund_type=2, apply_time="2024-01-30 11:59:59", dt="2024-01-30"),
    )
    shops = m.shops(spark, dict(shop_id=1, shop_name="s"))
    got = rows(
        analysis.platform_analysis_today(snapshot, inc, shops, shops, m.app_log(spark), orders, items, refunds, cal.intraday_window(end)),
        "prod_id", "status_filter",
    )
    assert {k[0] for k in got} == {7, 8}
    assert (got[7, "0"].prod_name, got[7, "0"].refund_num) == ("old", 0)
    assert (got[8, "0"].prod_name, got[8, "0"].refund_num) == ("fresh", 1)


def test_sales_rank_and_conversion_are_not_multiplied_by_versions(spark):
    products = m.products(
        spark, dict(prod_id=7, shop_id=1, prod_name="a"), dict(prod_id=7, shop_id=1, prod_name="b", update_time="2024-01-05"),
        dict(prod_id=8, shop_id=1, prod_name="c"), dict(prod_id=9, shop_id=1, prod_name="d", status=-1),
    )
    orders = m.orders(spark, dict(order_id=1, shop_id=1, is_paid=True, pay_time=T))
    items = m.items(spark, *[dict(order_number="n1", prod_id=p, user_id=3, prod_count=2, actual_total=a, rec_time=T) for p, a in ((7, 5), (8, 5), (9, 99))])
    shops = m.shops(spark, dict(shop_id=1, shop_name="z"), dict(shop_id=1, shop_name="y"))
    got = rows(sales.sales_rank(items, orders, products, shops, WINDOW), "prod_id")
    assert {k: (r.pay_amount, r.rank_num, r.prod_name, r.shop_name) for k, r in got.items()} == {
        (7,): (Decimal(5), 1, "b", "y"), (8,): (Decimal(5), 2, "c", "y")}
    log = m.app_log(spark, *[dict(prod_id=8, shop_id=1, cid=c, dt="2024-01-30") for c in "aabbc"])
    got = rows(sales.visitor_conversion(log, items, orders, products, shops, WINDOW), "prod_id")
    assert (got[8,].visitor_num, got[8,].visitor_to_pay_rate, got[8,].rank_num) == (3, Decimal("0.3333"), 1)
    assert (got[7,].visitor_num, got[7,].pay_user_count, got[7,].visitor_to_pay_rate) == (0, 1, Decimal(0))


def test_label_schema_is_found_over_all_rows(spark):
    log = m.app_log(
        spark, dict(cid="a", dt="2024-01-30", label='{"x":1}'), dict(cid="b", dt="2024-01-30", label='{"y":"t","isShare":"1"}'),
        dict(cid="c", dt="2024-01-30", label="broken"), dict(cid="d", dt="2024-01-30", label=None),
    )
    out = labels_expand.expand_label(log, DAY)
    assert {"x", "y", "isShare"} <= set(out.columns) and "label" not in out.columns
    got = rows(out, "cid")
    assert (got["a",].x, got["b",].y, got["c",].x) == (1, "t", None) and len(got) == 4
    assert labels_expand.expand_label(log, date(2020, 1, 1)).count() == 0
