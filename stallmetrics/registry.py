"""Every report and step as a named query over a folder of retail tables."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallmetrics.functions import calendar as cal
from stallmetrics.functions.casts import MONEY
from stallmetrics.functions.labels import product_status_label, refund_reason_label
from stallmetrics.functions.rates import count_ratio, money_ratio, percent
from stallmetrics.operators import catalog, refunds as rf, shaping, trade, traffic
from stallmetrics.operators.windows import WIN, inside
from stallmetrics.plans import analysis, labels_expand, merchant, overview, refund_ranks, sales
from stallmetrics.session import remove_folder, work_folder
from stallmetrics.sinks import rules
from stallmetrics.sinks.writers import publish
from stallmetrics.sources import Marketplace, schemas
from stallmetrics.sources.raw_binding import RawRetail
from stallmetrics.sources.retail_binding import RetailTables
from stallmetrics.streaming import hourly

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 31, 9, 30)
TODAY = datetime(2024, 1, 30, 23, 59, 59)
DAY = date(2024, 1, 30)

QUERIES: dict[str, Query] = {}


def _work_dir(spark: SparkSession) -> str:
    """Fresh folder for what a run writes, below the shared folder where the cluster names one."""
    return os.path.join(work_folder(spark), f"stallmetrics-{spark.sparkContext.applicationId}-{os.urandom(6).hex()}")


def query(name: str, shared: bool = False) -> Callable[[Callable[[RetailTables], DataFrame]], Callable]:
    def add(build: Callable[[RetailTables], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, folder: build(RetailTables(spark, folder, shared))
        return build

    return add


# --- shop-level reports -------------------------------------------------------------------------------------------


@query("merchant_paid_yesterday")
def _(t):
    return merchant.paid_by_shop(t.orders, DAY)


@query("merchant_hourly_gmv")
def _(t):
    return merchant.hourly_gmv(t.orders, TODAY)


@query("merchant_daily_order_pay")
def _(t):
    return merchant.daily_order_pay(t.orders, t.refunds, TODAY)


@query("merchant_order_pay_agg")
def _(t):
    return merchant.order_pay_agg(t.orders, TODAY)


@query("merchant_refund_stats")
def _(t):
    return merchant.refund_stats(t.orders, t.refunds, TODAY)


@query("refund_product_rank")
def _(t):
    return refund_ranks.product_rank(t.refunds, t.orders, t.items_named, t.products, TODAY)


@query("refund_reason_rank")
def _(t):
    return refund_ranks.reason_rank(t.refunds, t.orders_named, t.items_named, t.products, TODAY)


PERIODS = {p: [cal.period_to_date(TODAY, p)] for p in ("day", "week", "month")}
PERIODS["all"] = [w for ws in list(PERIODS.values()) for w in ws]
SPANS = {
    "7": [cal.trailing_window(AS_OF, 7)],
    "30": [cal.trailing_window(AS_OF, 30)],
    "month": [cal.month_window(AS_OF)],
    "all": cal.standard_windows(AS_OF),
}

for _name, _windows in PERIODS.items():
    query(f"merchant_comprehensive_{_name}")(
        lambda t, w=_windows: merchant.comprehensive(t.orders, t.items, t.refunds, w)
    )

#: Overviews whose log leaves no event out.
WHOLE_LOG = ("7", "all")

for _name, _windows in SPANS.items():
    query(f"product_overview_period_{_name}")(
        lambda t, w=_windows, whole=_name in WHOLE_LOG: overview.period_overview(
            t.orders, t.items, t.products, t.whole_log if whole else t.app_log, w
        )
    )
    query(f"product_sales_rank_{_name}")(
        lambda t, w=_windows: sales.sales_rank(t.items, t.orders, t.products, t.shops, w)
    )
    query(f"product_visitor_conversion_{_name}")(
        lambda t, w=_windows: sales.visitor_conversion(t.app_log, t.items, t.orders, t.products, t.shops, w)
    )
    query(f"merchant_product_analysis_{_name}", shared=True)(
        lambda t, w=_windows: analysis.merchant_analysis(
            t.products, t.shops, t.app_log, t.orders, t.items, t.refunds, w
        )
    )
    query(f"platform_product_analysis_{_name}", shared=True)(
        lambda t, w=_windows: analysis.platform_analysis(
            t.products, t.shops, t.app_log, t.orders, t.items, t.refunds, w
        )
    )


@query("product_overview_daily")
def _(t):
    return overview.daily_overview(t.orders, t.items, t.products, t.whole_log, [DAY])


@query("product_overview_daily_intraday")
def _(t):
    return overview.intraday_overview(t.orders, t.items, t.products, t.app_log, cal.intraday_window(TODAY))


@query("product_overview_backfill")
def _(t):
    days = [date(2024, 1, d) for d in range(1, 31)]
    return overview.daily_overview(t.orders, t.items, t.products, t.whole_log, days)


@query("merchant_product_analysis_today")
def _(t):
    return analysis.merchant_analysis_today(
        t.products, t.shops, t.app_log, t.orders, t.items_named, t.refunds, t.products, DAY
    )


def _platform_today(t: RetailTables, status_filter: int | None = None) -> DataFrame:
    return analysis.platform_analysis_today(
        t.products, t.products, t.shops, t.shops, t.app_log, t.orders, t.items, t.refunds,
        cal.intraday_window(TODAY), status_filter,
    )


query("platform_product_analysis_today")(_platform_today)
query("platform_product_analysis_today_by_status")(lambda t: _platform_today(t, 1))


@query("app_log_label_expand")
def _(t):
    return labels_expand.expand_label(t.app_log, DAY, schema=schemas.LABEL)


@query("app_log_label_expand_inferred")
def _(t):
    return labels_expand.expand_label(t.app_log, DAY)


# --- steps --------------------------------------------------------------------------------------------------------

MONTH = SPANS["30"]


@query("exposure_by_product_shop")
def _(t):
    return traffic.exposure_by_product_shop(t.app_log, MONTH).drop(WIN)


@query("exposure_by_product")
def _(t):
    return traffic.exposure_by_product(t.app_log, MONTH).drop(WIN)


@query("exposure_visitors_by_shop")
def _(t):
    return traffic.visitors_by_shop(t.app_log, MONTH).drop(WIN)


@query("share_visits_by_shop")
def _(t):
    return traffic.share_visits_by_shop(t.app_log, MONTH).drop(WIN)


@query("latest_product")
def _(t):
    return catalog.latest_product(t.products)


@query("latest_product_by_product")
def _(t):
    return catalog.latest_product(t.products, ["prod_id"])


@query("one_name_per_shop")
def _(t):
    second = t.shops.withColumn(
        "shop_name",
        F.when(F.col("shop_id") % 3 == 0, F.lit("  ")).when(F.col("shop_id") % 3 == 1, F.concat(F.lit("A "), "shop_name")),
    )
    return catalog.one_name_per_shop(t.shops.unionByName(second))


@query("latest_item_snapshot")
def _(t):
    return catalog.latest_item_snapshot(t.orders, t.items_named, DAY)


@query("latest_status_today")
def _(t):
    return catalog.latest_status_today(t.products, DAY)


def _merchant_trade(t: RetailTables) -> DataFrame:
    w = MONTH[0]
    created = t.orders.filter(inside("create_time", w))
    lines = trade.distinct_order_lines(created, t.items)
    return trade.trade_metrics(lines, ["prod_id", "shop_id"], F.col("is_paid") & inside("pay_time", w))


@query("order_metrics_by_product")
def _(t):
    return _merchant_trade(t).select(
        "prod_id", "shop_id", "place_order_person", "place_order_num", "place_order_amount"
    )


@query("payment_metrics_by_product")
def _(t):
    return _merchant_trade(t).filter(F.col("pay_num") > 0).select(
        "prod_id", "shop_id", "pay_person", "pay_num", "pay_amount"
    )


@query("payment_metrics_conditional")
def _(t):
    lines = trade.order_lines(t.orders.filter(inside("create_time", MONTH[0])), t.items)
    return trade.trade_metrics(lines, ["prod_id"], F.col("is_paid"))


def _refund_sides(t: RetailTables) -> tuple[DataFrame, DataFrame]:
    asked = t.refunds.filter(inside("apply_time", MONTH[0]))
    return (
        rf.item_refunds(asked.filter(F.col("refund_type") == rf.SINGLE_ITEM), t.items),
        rf.order_refunds(
            asked.filter(F.col("refund_type") == rf.WHOLE_ORDER), t.orders.select("order_id", "order_number"), t.items
        ),
    )


@query("refund_metrics_by_product")
def _(t):
    single, whole = _refund_sides(t)
    lines = single.unionByName(whole).withColumnRenamed("item_shop_id", "shop_id")
    return rf.refund_metrics(lines, ["prod_id", "shop_id"])


@query("refund_metrics_by_row")
def _(t):
    single, whole = _refund_sides(t)
    return rf.refund_metrics(single.unionByName(whole), ["prod_id"], amount="item_total", count="rows")


def _active(t: RetailTables, exposed: bool) -> DataFrame:
    w = MONTH[0]
    orders = t.orders
    asked = t.refunds.filter(inside("apply_time", w))
    facts = [
        trade.order_lines(orders.filter(inside("create_time", w)), t.items),
        trade.order_lines(orders.filter(F.col("is_paid") & inside("pay_time", w)), t.items),
        rf.item_refunds(asked, t.items),
        rf.order_refunds(asked, orders.select("order_id", "order_number"), t.items),
    ]
    if exposed:
        facts.append(traffic.exposures(t.app_log, [w], need_shop=False))
    return rf.active_products(*facts, keys=["prod_id"])


query("active_products")(lambda t: _active(t, True))
query("active_products_without_exposure")(lambda t: _active(t, False))


@query("dedup_exact_rows")
def _(t):
    copies = t.items.unionByName(t.items.filter(F.col("prod_id") % 3 == 0))
    return trade.dedup_exact_rows(copies, ["order_item_id", "order_number", "prod_id", "shop_id", "prod_count", "actual_total"])


@query("dedup_by_sink_key")
def _(t):
    rows = t.products.select("prod_id", "shop_id", F.col("dt").alias("stat_date"), "prod_name", "supplier_price")
    return shaping.dedup_by_sink_key(rows, ["prod_id", "shop_id", "stat_date"], F.desc("supplier_price"))


@query("status_fanout")
def _(t):
    cards = catalog.latest_product(t.products, ["prod_id"])
    return shaping.status_fanout(cards).select("prod_id", "status", "status_filter")


@query("drop_all_zero")
def _(t):
    w = [cal.whole_day(DAY)]
    facts = trade.trade_metrics(
        trade.order_lines(t.orders, t.items), ["prod_id"], F.col("is_paid") & inside("pay_time", w[0]),
        inside("create_time", w[0]),
    )
    return shaping.drop_all_zero(facts, shaping.MEASURES_WITHOUT_EXPOSURE)


@query("shop_spine")
def _(t):
    day = cal.whole_day(DAY)
    sold = t.orders.filter(inside("create_time", day)).groupBy("shop_id").agg(
        F.count(F.lit(1)).alias("big_orders")
    )
    back = t.refunds.filter(inside("refund_time", day)).groupBy("shop_id").agg(F.count(F.lit(1)).alias("refunds"))
    return shaping.stack_measures(
        ["shop_id"], sold, back, traffic.share_visits_by_shop(t.app_log, [day]).drop(WIN)
    )


@query("code_labels")
def _(t):
    statuses = t.products.groupBy(
        F.lit("status").alias("kind"), F.col("status").cast("string").alias("code"),
        product_status_label("status").alias("label"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
    reasons = t.refunds.groupBy(
        F.lit("reason").alias("kind"), F.col("buyer_reason").alias("code"),
        refund_reason_label("buyer_reason").alias("label"),
    ).agg(F.count(F.lit(1)).alias("row_count"))
    return statuses.unionByName(reasons)


@query("safe_rate")
def _(t):
    day = cal.whole_day(DAY)
    totals = t.orders.groupBy("shop_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.count_if("is_paid").alias("paid"),
        F.count_if(F.col("is_paid") & inside("pay_time", day) & (F.col("user_id") % 7 == 0)).alias("few"),
        F.sum("actual_total").alias("amount"),
    )
    return totals.select(
        "shop_id",
        percent("paid", "orders").alias("paid_percent"),
        percent("orders", "few", 1).alias("orders_per_few_percent"),
        count_ratio("few", "paid", 4).alias("few_ratio"),
        money_ratio("amount", "paid", 2).alias("amount_per_paid"),
    )


# --- calendar windows ---------------------------------------------------------------------------------------------

TIMED = {
    "trailing_window": [cal.trailing_window(AS_OF, 7), cal.trailing_window(AS_OF, 30)],
    "month_window": [cal.month_window(AS_OF), cal.month_window(datetime(2024, 2, 1, 8)), cal.month_window(datetime(2024, 1, 12))],
    "period_to_date": PERIODS["all"],
    "intraday_window": [
        cal.intraday_window(datetime(2024, 1, 30, 0, 20)), cal.intraday_window(datetime(2024, 1, 30, 13, 15, 30)),
    ],
    "month_back_window": [cal.month_back_window(datetime(2024, 2, 15)), cal.month_back_window(TODAY)],
    "single_day": [cal.single_day(AS_OF)],
    "like_day": [cal.whole_day(date(2024, 1, 29))],
}
for _name, _windows in TIMED.items():
    query(_name)(lambda t, w=_windows: merchant.paid_by_window(t.orders, w))


# --- result tables ------------------------------------------------------------------------------------------------
# Old rows are the report's own history over all days of the tables, so both sides grow with them. New rows are restated: one
# more order and one more unit of money each, so that none of them equals the row it replaces. A rule runs as publishing does:
# over a partitioned table of the catalog, whose partitions go or stay by name.


def _history(t: RetailTables, back_days: int = 0) -> DataFrame:
    return merchant.paid_by_day(t.orders).withColumn("stat_date", F.date_sub("stat_date", back_days))


def _restated(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "pay_order_count": F.col("pay_order_count") + 1, "pay_actual_total": (F.col("pay_actual_total") + 1).cast(MONEY),
    })


def _today(t: RetailTables) -> DataFrame:
    return _restated(merchant.paid_by_day(t.orders.filter(inside("pay_time", cal.whole_day(DAY)))))


def _published(old: DataFrame, by: list[str], *slices: tuple[DataFrame, Column]) -> DataFrame:
    """A table of ``old`` rows, partitioned ``by``, after each slice of new rows was published into it."""
    spark = old.sparkSession
    table = f"published_{os.urandom(6).hex()}"
    old.write.partitionBy(*by).option("path", f"{_work_dir(spark)}/{table}").saveAsTable(table)
    for new, gone in slices:
        publish(new, table, gone)
    return spark.table(table)


@query("replace_stat_date")
def _(t):
    return _published(_history(t), ["stat_date"], (_today(t), rules.stat_date_slice(DAY)))


@query("keep_only_new")
def _(t):
    return _published(_history(t), ["stat_date"], (_today(t), rules.keep_only_new_slice()))


@query("rolling_month")
def _(t):
    return _published(_history(t, 20), ["stat_date"], (_today(t), rules.rolling_month_slice(DAY)))


@query("rolling_two_days")
def _(t):
    return _published(_history(t), ["stat_date"], (_today(t), rules.rolling_two_days_slice(DAY, datetime(2024, 1, 30, 1, 5))))


def _period_rows(t: RetailTables, windows) -> DataFrame:
    rows = merchant.paid_by_window(t.orders, windows)
    return rows.select(
        "shop_id", "pay_order_count", "pay_actual_total", "stat_date", F.col("period_tag").alias("date_time"),
        F.col("period_tag").alias("time_period"), "time_type",
    )


@query("replace_period")
def _(t):
    earlier = [
        cal.period_to_date(datetime(2024, 1, d), p) for d in (23, 28, 29, 30) for p in ("day", "week", "month")
    ]
    slices = []
    for p, number in (("day", 1), ("week", 2), ("month", 3)):
        w = cal.period_to_date(TODAY, p)
        slices.append((_restated(_period_rows(t, [w]).drop("time_period")), rules.period_slice(DAY, w.tag, number)))
    return _published(_period_rows(t, earlier).drop("time_period"), ["time_type", "date_time", "stat_date"], *slices)


@query("replace_time_period")
def _(t):
    rows = _period_rows(t, [w for d in (29, 30) for w in cal.standard_windows(datetime(2024, 1, d))])
    slices = [
        (_restated(_period_rows(t, [w]).drop("date_time")), rules.time_period_slice(w.stat_date, w.tag)) for w in SPANS["all"]
    ]
    return _published(rows.drop("date_time"), ["time_period", "stat_date"], *slices)


@query("replace_all_or_month")
def _(t):
    w = cal.month_window(AS_OF)
    return _published(_history(t, 20), ["stat_date"], (_today(t), rules.all_or_month_slice(w.tag)))


@query("replace_current_day")
def _(t):
    def by_day(rows):
        return rows.withColumnRenamed("stat_date", "current_day")

    return _published(by_day(_history(t)), ["current_day"], (by_day(_today(t)), rules.current_day_slice(DAY)))


@query("assert_unique_key")
def _(t):
    rows = shaping.status_fanout(
        t.products.select("prod_id", "shop_id", F.col("dt").alias("stat_date"), "status")
    )
    return rules.duplicate_keys(rows)


# --- through the raw layer ----------------------------------------------------------------------------------------
# The same reports over text tables: every cast, spelling and renaming of the raw layer lies between the data and the result.


#: Raw reports that read orders, items and refunds: a shuffle of the lines serves all three.
SHARED = {"raw_merchant_product_analysis_all", "raw_platform_product_analysis_all", "raw_refund_product_rank", "raw_refund_reason_rank"}


def raw_query(name: str, changed: bool = False) -> Callable[[Callable[[Marketplace], DataFrame]], Callable]:
    def add(build: Callable[[Marketplace], DataFrame]) -> Callable:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            raw = RawRetail(spark, folder, shared=name in SHARED)
            return build(Marketplace.from_raw(raw.changed if changed else raw.read))

        QUERIES[name] = run
        return build

    return add


@raw_query("merge_snapshot_increment", changed=True)
def _(m):
    return catalog.merged_products(m.products, m.products_inc, DAY)


@raw_query("merge_snapshot_increment_shops", changed=True)
def _(m):
    return catalog.merged_shops(m.shops, m.shops_inc, DAY)


RAW_REPORTS: dict[str, Callable[[Marketplace], DataFrame]] = {
    "merchant_paid_yesterday": lambda m: merchant.paid_by_shop(m.orders, DAY),
    "merchant_hourly_gmv": lambda m: merchant.hourly_gmv(m.orders_inc, TODAY),
    "merchant_daily_order_pay": lambda m: merchant.daily_order_pay(m.orders, m.refunds, TODAY),
    "merchant_comprehensive_all": lambda m: merchant.comprehensive(m.orders, m.items, m.refunds, PERIODS["all"]),
    "merchant_refund_stats": lambda m: merchant.refund_stats(m.orders, m.refunds, TODAY),
    "refund_product_rank": lambda m: refund_ranks.product_rank(m.refunds, m.orders, m.items, m.products, TODAY),
    "refund_reason_rank": lambda m: refund_ranks.reason_rank(m.refunds, m.orders, m.items, m.products, TODAY),
    "product_overview_period_all": lambda m: overview.period_overview(m.orders, m.items, m.products, m.app_log, SPANS["all"]),
    "product_overview_daily_intraday": lambda m: overview.intraday_overview(
        m.orders_inc, m.items_inc, m.products_inc, m.app_log, cal.intraday_window(TODAY)),
    "product_sales_rank_30": lambda m: sales.sales_rank(m.items, m.orders, m.products, m.shops, SPANS["30"]),
    "product_visitor_conversion_30": lambda m: sales.visitor_conversion(m.app_log, m.items, m.orders, m.products, m.shops, SPANS["30"]),
    "merchant_product_analysis_all": lambda m: analysis.merchant_analysis(
        m.products, m.shops, m.app_log, m.orders, m.items, m.refunds, SPANS["all"]),
    "merchant_product_analysis_today": lambda m: analysis.merchant_analysis_today(
        m.products, m.shops, m.app_log, m.orders_inc, m.items_inc, m.refunds_inc, m.products_inc, DAY),
    "platform_product_analysis_all": lambda m: analysis.platform_analysis(
        m.products, m.shops, m.app_log, m.orders, m.items, m.refunds, SPANS["all"]),
    "platform_product_analysis_today": lambda m: analysis.platform_analysis_today(
        m.products, m.products_inc, m.shops, m.shops_inc, m.app_log, m.orders_inc, m.items_inc, m.refunds_inc, cal.intraday_window(TODAY)),
    "app_log_label_expand": lambda m: labels_expand.expand_label(m.app_log, DAY, schema=schemas.LABEL),
}
for _name, _build in RAW_REPORTS.items():
    raw_query(f"raw_{_name}")(_build)


# --- streams ------------------------------------------------------------------------------------------------------


def _hourly_stream(spark: SparkSession, folder: str) -> DataFrame:
    work = _work_dir(spark)
    columns = ["order_id", "shop_id", "is_paid", "pay_time", "actual_total"]
    orders = RetailTables(spark, folder).orders.select(*columns)
    orders.write.parquet(f"{work}/orders")
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 64).parquet(f"{work}/orders")
    hourly.stream_state(hourly.hourly_stream(stream), f"{work}/state", f"{work}/progress").awaitTermination()
    remove_folder(spark, f"{work}/orders")
    remove_folder(spark, f"{work}/progress")
    return hourly.hourly_report(hourly.read_state(spark, f"{work}/state", DAY), DAY)


QUERIES["hourly_gmv_stream"] = _hourly_stream
