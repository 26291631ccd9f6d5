"""Fractions of a second, late rows, other spellings of numbers and odd labels keep their place."""

from datetime import date, datetime

import micro as m
import pytest
from pyspark.sql import functions as F

from stallmetrics.functions import calendar as cal
from stallmetrics.functions import casts
from stallmetrics.operators.windows import inside, tag_by_time
from stallmetrics.plans import analysis, labels_expand, merchant, overview, refund_ranks, sales
from stallmetrics.sources import canonical
from stallmetrics.streaming import hourly

AS_OF = datetime(2024, 1, 31, 9)
LAST = "2024-01-30 23:59:59.5"


@pytest.mark.parametrize("window", [
    cal.single_day(AS_OF), cal.trailing_window(AS_OF, 7), cal.month_window(AS_OF), cal.period_to_date(datetime(2024, 1, 30, 9), "day"),
    cal.whole_day(date(2024, 1, 30)), cal.month_back_window(datetime(2024, 1, 30, 9)),
])
def test_last_second_belongs_to_its_day(spark, window):
    rows = spark.createDataFrame([(LAST,), ("2024-01-31 00:00:00",)], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    assert [r.t for r in rows.where(inside("ts", window)).collect()] == [LAST]


def test_open_start_leaves_out_its_whole_second(spark):
    window = cal.month_back_window(datetime(2024, 1, 30, 9))
    rows = spark.createDataFrame([("2023-12-30 23:59:59.5",), ("2023-12-31 00:00:00",)], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    assert [r.t for r in rows.where(inside("ts", window)).collect()] == ["2023-12-31 00:00:00"]


def test_single_days_hold_their_last_second(spark):
    days = [cal.whole_day(date(2024, 1, d)) for d in (29, 30)]
    rows = spark.createDataFrame([(LAST,)], "t string").withColumn("ts", F.col("t").cast("timestamp"))
    assert tag_by_time(rows, days, "ts").count() == 1


def test_numbers_keep_their_value(spark):
    rows = spark.createDataFrame([("7",), ("3.0",), ("1.2345678E7",), ("x",), (" ",), ("9223372036854775807",)], "a string")
    assert [r[0] for r in rows.select(casts.as_id("a")).collect()] == [7, 3, 12345678, None, None, 9223372036854775807]
    doubles = spark.createDataFrame([(7.0,), (12345678.0,)], "a double")
    assert [tuple(r) for r in doubles.select(casts.as_id("a"), casts.as_int("a")).collect()] == [(7, 7), (12345678, 12345678)]


def test_text_filters_reach_the_scan(spark, tmp_path):
    m.app_log(spark, dict(prod_id=1)).write.parquet(str(tmp_path / "log"))
    log = canonical.app_log(spark.read.parquet(str(tmp_path / "log"))).where("action = 'enter' AND page_id = '1005'")
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(action,enter)" in plan and "EqualTo(page_id,1005)" in plan


def test_odd_labels_cost_only_themselves(spark):
    log = m.app_log(spark, *[dict(label=x, dt="2024-01-30") for x in ('{"a":"1"}', "5", "[1]", "{")])
    out = labels_expand.expand_label(log, date(2024, 1, 30))
    assert "a" in out.columns and sorted(str(r.a) for r in out.collect()) == ["1", "None", "None", "None"]


def test_older_named_version_is_kept(spark):
    cards = m.products(spark, dict(prod_id=1, shop_id=2, prod_name="a", update_time="2024-01-01"), dict(prod_id=1, shop_id=2, prod_name=None, update_time="2024-01-09"))
    assert sales._cards(cards.where("prod_name IS NOT NULL")).collect()[0].prod_name == "a"


def test_stream_has_no_lateness_of_its_own(spark, tmp_path):
    m.orders(spark, dict(order_id=1)).write.parquet(str(tmp_path / "o"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "o")).schema).parquet(str(tmp_path / "o"))
    assert "EventTimeWatermark" not in hourly.hourly_stream(stream)._jdf.queryExecution().analyzed().toString()


def _one_late_order(spark):
    """An order, its payment, its refund and a new product, all in the last half second of a day."""
    orders = m.orders(spark, dict(order_id=1, shop_id=1, user_id=5, create_time=LAST, pay_time=LAST, is_paid=True, status=2, actual_total=4, dt="2024-01-30"))
    items = m.items(spark, dict(order_item_id="i", order_number="n1", prod_id=7, shop_id=1, user_id=5, prod_count=2, actual_total=4, rec_time=LAST, dt="2024-01-30"))
    refunds = m.refunds(spark, dict(refund_id="r", order_id=1, order_item_id="i", shop_id=1, user_id=5, refund_type=2, return_money_sts=5,
                                    refund_amount=4, goods_num=1, apply_time=LAST, refund_time=LAST, buyer_reason="0", dt="2024-01-30"))
    products = m.products(spark, dict(prod_id=7, shop_id=1, prod_name="a", create_time=LAST, dt="2024-01-30"))
    return orders, items, refunds, products, m.shops(spark, dict(shop_id=1, shop_name="s")), m.app_log(spark)


DAYS = [cal.single_day(AS_OF)]
SPANS = cal.standard_windows(AS_OF)
END = datetime(2024, 1, 30, 23, 59, 59)
PERIODS = [cal.period_to_date(END, p) for p in ("day", "week", "month")]
LATE = {
    "paid": lambda o, i, r, p, s, a: (merchant.paid_by_shop(o, date(2024, 1, 30)), "payOrderCount", 1),
    "hourly": lambda o, i, r, p, s, a: (merchant.hourly_gmv(o, END), "order_count", 1),
    "daily_order_pay": lambda o, i, r, p, s, a: (merchant.daily_order_pay(o, r, END), "pay_order_count", 1),
    "order_pay_agg": lambda o, i, r, p, s, a: (merchant.order_pay_agg(o, END), "pay_order_count", 1),
    "refund_stats": lambda o, i, r, p, s, a: (merchant.refund_stats(o, r, END), "refund_count", 1),
    "comprehensive": lambda o, i, r, p, s, a: (merchant.comprehensive(o, i, r, PERIODS), "order_nums", 3),
    "by_window": lambda o, i, r, p, s, a: (merchant.paid_by_window(o, SPANS), "pay_order_count", 3),
    "product_rank": lambda o, i, r, p, s, a: (refund_ranks.product_rank(r, o, i, p, END), "refund_count", 1),
    "reason_rank": lambda o, i, r, p, s, a: (refund_ranks.reason_rank(r, o, i, p, END), "refund_count", 1),
    "overview_one": lambda o, i, r, p, s, a: (overview.period_overview(o, i, p, a, DAYS), "order_num", 2),
    "overview_all": lambda o, i, r, p, s, a: (overview.period_overview(o, i, p, a, SPANS), "pay_num", 6),
    "overview_new": lambda o, i, r, p, s, a: (overview.period_overview(o, i, p, a, SPANS), "new_prod", 3),
    "overview_daily": lambda o, i, r, p, s, a: (overview.daily_overview(o, i, p, a, [date(2024, 1, 30)]), "order_num", 2),
    "overview_backfill": lambda o, i, r, p, s, a: (overview.daily_overview(o, i, p, a, [date(2024, 1, d) for d in (29, 30)]), "order_num", 2),
    "overview_intraday": lambda o, i, r, p, s, a: (overview.intraday_overview(o, i, p, a, cal.intraday_window(END)), "order_num", 2),
    "sales_rank": lambda o, i, r, p, s, a: (sales.sales_rank(i, o, p, s, SPANS), "pay_count", 6),
    "conversion": lambda o, i, r, p, s, a: (sales.visitor_conversion(a, i, o, p, s, SPANS), "pay_user_count", 3),
    "merchant": lambda o, i, r, p, s, a: (analysis.merchant_analysis(p, s, a, o, i, r, SPANS), "pay_num", 12),
    "merchant_refund": lambda o, i, r, p, s, a: (analysis.merchant_analysis(p, s, a, o, i, r, SPANS), "refund_success_num", 6),
    "merchant_today": lambda o, i, r, p, s, a: (analysis.merchant_analysis_today(p, s, a, o, i, r, p, date(2024, 1, 30)), "refund_success_num", 2),
    "platform": lambda o, i, r, p, s, a: (analysis.platform_analysis(p, s, a, o, i, r, SPANS), "pay_num", 12),
    "platform_refund": lambda o, i, r, p, s, a: (analysis.platform_analysis(p, s, a, o, i, r, SPANS), "refund_num", 6),
    "platform_today": lambda o, i, r, p, s, a: (analysis.platform_analysis_today(p, p, s, s, a, o, i, r, cal.intraday_window(END)), "pay_num", 4),
}


@pytest.mark.parametrize("report", sorted(LATE))
def test_every_report_counts_the_last_half_second(spark, report):
    out, measure, total = LATE[report](*_one_late_order(spark))
    assert sum(r[measure] for r in out.collect()) == total
