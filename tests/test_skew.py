"""One shop or product holds 95 % of all rows, and no side is broadcast."""

import statistics
from contextlib import contextmanager
from datetime import date, datetime

import micro as m
import pytest
from pyspark.sql import functions as F

from stallmetrics.functions import calendar as cal
from stallmetrics.operators.catalog import one_name_per_shop, with_shop_names
from stallmetrics.plans import analysis, refund_ranks, sales

T = "2024-01-30 10:00:00"
DAY = date(2024, 1, 30)
WINDOWS = cal.standard_windows(datetime(2024, 1, 31, 9))
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
}


@contextmanager
def small_pieces(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def wide(spark, base, rows):
    """``rows`` copies of the one row of ``base``, with a number ``i`` and a shop ``s`` that is 1 for 95 % of them."""
    numbers = spark.range(0, rows, 1, 40).select(F.col("id").alias("i"), F.when(F.col("id") % 20 > 0, 1).otherwise(F.col("id") % 97 + 2).alias("s"))
    return base.crossJoin(numbers)


def shops(spark):
    return spark.range(1, 100).select(F.col("id").alias("shop_id"), F.concat(F.lit("shop "), "id").alias("shop_name"), F.lit(DAY).alias("dt"))


def test_names_of_a_giant_shop_are_joined_in_pieces(spark):
    rows = spark.range(0, 60_000, 1, 40).select("id", F.when(F.col("id") % 20 > 0, 1).otherwise(F.col("id") % 97 + 2).alias("shop_id"), F.sha2(F.col("id").cast("string"), 256).alias("more"))
    with small_pieces(spark):
        out = with_shop_names(rows.repartition(40, "id"), one_name_per_shop(shops(spark)))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert out.filter(F.col("shop_name") == F.concat(F.lit("shop "), "shop_id")).count() == 60_000
    assert sum(sizes) == 60_000 and max(sizes) < 3 * statistics.median(sizes) and len(sizes) > 30


def _tables(spark, rows=4000):
    dated = dict(dt="2024-01-30")
    number, item = F.concat(F.lit("n"), F.col("i").cast("string")), F.concat(F.lit("i"), F.col("i").cast("string"))
    orders = wide(spark, m.orders(spark, dict(user_id=1, create_time=T, pay_time=T, is_paid=True, actual_total=4, **dated)), rows)
    orders = orders.withColumns({"order_id": F.col("i"), "order_number": number, "shop_id": F.col("s").cast("long"), "user_id": F.col("i")}).drop("i", "s")
    items = wide(spark, m.items(spark, dict(prod_count=1, actual_total=4, rec_time=T, price=4, prod_name="p", status=1, **dated)), rows)
    items = items.withColumns({"order_item_id": item, "order_number": number, "prod_id": F.col("i"), "shop_id": F.col("s").cast("long"), "user_id": F.col("i")}).drop("i", "s")
    products = wide(spark, m.products(spark, dict(prod_name="p", price=4, pic="q", create_time=T, **dated)), rows)
    products = products.withColumns({"prod_id": F.col("i"), "shop_id": F.col("s").cast("long")}).drop("i", "s")
    refunds = wide(spark, m.refunds(spark, dict(refund_type=2, return_money_sts=5, refund_amount=1, goods_num=1, apply_time=T, refund_time=T, buyer_reason="0", **dated)), rows)
    refunds = refunds.withColumns({"refund_id": item, "order_id": F.col("i"), "order_item_id": item, "shop_id": F.col("s").cast("long"), "user_id": F.col("i")}).drop("i", "s")
    log = m.app_log(spark, dict(prod_id=3, shop_id=1, cid="a", dt="2024-01-30"))
    return orders, items, products, refunds, log


REPORTS = {
    "sales_rank": lambda o, i, p, r, a, s: sales.sales_rank(i, o, p, s, WINDOWS),
    "conversion": lambda o, i, p, r, a, s: sales.visitor_conversion(a, i, o, p, s, WINDOWS),
    "merchant": lambda o, i, p, r, a, s: analysis.merchant_analysis(p, s, a, o, i, r, WINDOWS),
    "merchant_today": lambda o, i, p, r, a, s: analysis.merchant_analysis_today(p, s, a, o, i, r, p, DAY),
    "platform": lambda o, i, p, r, a, s: analysis.platform_analysis(p, s, a, o, i, r, WINDOWS),
    "platform_today": lambda o, i, p, r, a, s: analysis.platform_analysis_today(p, p, s, s, a, o, i, r, cal.intraday_window(datetime(2024, 1, 30, 23, 59, 59))),
    "platform_today_by_status": lambda o, i, p, r, a, s: analysis.platform_analysis_today(
        p, p, s, s, a, o, i, r, cal.intraday_window(datetime(2024, 1, 30, 23, 59, 59)), 1),
}


def final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("report", sorted(REPORTS))
def test_reports_split_a_giant_shop(spark, report):
    with small_pieces(spark):
        out = REPORTS[report](*_tables(spark), shops(spark))
        assert "skew=true" in final_plan(out)
        names = {r.shop_name for r in out.collect()}
    assert "shop 1" in names and len(names) > 50


def test_one_product_meets_its_picture_after_folding(spark):
    orders, items, products, refunds, _ = _tables(spark)
    hot = F.when(F.col("prod_id") % 20 > 0, F.lit(1).cast("long")).otherwise(F.col("prod_id"))
    items, products = items.withColumn("prod_id", hot), products.withColumn("prod_id", hot).limit(100)
    out = refund_ranks.reason_rank(refunds, orders, items, products, datetime(2024, 1, 30, 12))
    got = {r.shop_id: r for r in out.collect()}
    assert got[1].refund_count == 3800 and got[1].pic == "q"
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # the aggregate by product lies below the join with the pictures
    join = plan.index("Join LeftOuter, (prod_id")
    assert "Aggregate [shop_id" in plan[join : plan.index("Join LeftOuter", join + 10)]


def test_clients_of_one_product_are_folded_before_its_card(spark):
    products = m.products(spark, dict(prod_id=7, shop_id=1, prod_name="p"), dict(prod_id=8, shop_id=2, prod_name="q"))
    log = spark.range(3000).select(
        F.when(F.col("id") % 20 > 0, 7).otherwise(8).cast("long").alias("prod_id"), F.lit(1).cast("long").alias("shop_id"), F.col("id").cast("string").alias("cid"),
        F.lit("enter").alias("action"), F.lit("1005").alias("page_id"), F.lit(None).cast("string").alias("event"), F.lit(None).cast("string").alias("label"), F.lit(DAY).alias("dt"),
    )
    out = analysis.platform_analysis(products, shops(spark), log, m.orders(spark), m.items(spark), m.refunds(spark), WINDOWS)
    got = {(r.prod_id, r.time_period): (r.expose, r.expose_person_num) for r in out.filter("status_filter = '0'").collect()}
    assert {k: v for k, v in got.items() if k[1] == "7"} == {(7, "7"): (2850, 2850), (8, "7"): (0, 0)} and len(got) == 6
