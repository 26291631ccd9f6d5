"""Product overviews per shop: over periods, per day, and for many days at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow, whole_day
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.traffic import exposures, shop_traffic_rows
from stallmetrics.operators.windows import Slots, inside, window_value


def _in_reach(facts: DataFrame, windows: Sequence[ReportWindow], ts: str) -> DataFrame:
    """Rows from the first start to the end of the last second, before they are marked with each window."""
    first, last = min(w.start for w in windows), max(w.end for w in windows)
    return facts.filter(inside(ts, ReportWindow(first, last, "", last.date())))


def _sales(orders: DataFrame, items: DataFrame, slots: Slots) -> DataFrame:
    """Additive products, ordered and paid pieces: one row per shop and product (NULL for orders without items)."""
    keys, paid = [*slots.keys, "shop_id"], F.coalesce(F.col("is_paid"), F.lit(False))
    lines = _in_reach(orders, slots.windows, "create_time").select("order_number", "shop_id", "is_paid", "create_time").join(
        items.select("order_number", "prod_id", "prod_count", F.lit(1).alias("_item")), "order_number", "left"
    )
    per_product = slots.mark_time(lines, "create_time").groupBy(*keys, "prod_id").agg(
        *slots.folded(),
        *slots.measures(
            order_num=lambda i: F.sum(slots.only(i, F.col("prod_count"))),
            pay_num=lambda i: F.sum(F.when(paid & slots.here(i), F.col("prod_count"))),
            _lines=lambda i: F.count(slots.only(i, F.col("_item"))),
        ),
    )
    return per_product.select(
        *keys, *slots.carried, *slots.names("order_num", "pay_num", "_lines"),
        *slots.measures(
            _ordered=lambda i: one_if(slots.here(i)),
            dynamic_sale=lambda i: one_if(F.col("prod_id").isNotNull() & slots.here(i)),
        ),
    )


def _new_products(products: DataFrame, slots: Slots, extra: Column | None = None) -> DataFrame:
    live = products.filter((F.col("status") != -1) & F.col("shop_id").isNotNull())
    if extra is not None:
        live = live.filter(extra)
    return slots.mark_time(live, "create_time").groupBy(*slots.keys, "shop_id").agg(
        *slots.folded(), *slots.measures(new_prod=lambda i: F.count(slots.only(i, F.col("prod_id"))))
    )


def period_overview(
    orders: DataFrame, items: DataFrame, products: DataFrame, app_log: DataFrame, windows: Sequence[ReportWindow]
) -> DataFrame:
    """Overview per shop and period for every shop with orders, new products or traffic; all periods in one scan."""
    slots = Slots(tuple(windows))
    stacked = slots.unfold(stack_measures(
        [*slots.keys, "shop_id"],
        _sales(orders.filter(F.col("shop_id").isNotNull()), items, slots).drop(*slots.names("_lines", "_ordered")),
        _new_products(products, slots),
        shop_traffic_rows(exposures(app_log, slots), slots).drop(*slots.names("share_visit")),
    ))
    return stacked.select(
        "shop_id", "order_num", "pay_num", "dynamic_sale", "new_prod", "visited_prod", "expose",
        F.col("expose").alias("browse"), "visitor",
        window_value(windows, lambda w: w.tag).alias("time_period"),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
    ).orderBy("time_period", "shop_id")


def _daily(sales: DataFrame, new: DataFrame, traffic: DataFrame, slots: Slots, need_items: bool) -> DataFrame:
    stacked = slots.unfold(stack_measures([*slots.keys, "shop_id"], sales, new, traffic))
    has_orders = (F.col("_lines") > 0) if need_items else (F.col("_ordered") > 0)
    only_new = (F.col("new_prod") > 0) & (F.col("_ordered") == 0)
    return stacked.filter(has_orders | only_new).select(
        "shop_id",
        window_value(slots.windows, lambda w: w.stat_date).alias("current_day"),
        "new_prod", "visited_prod", "dynamic_sale", "expose", F.col("expose").alias("browse"), "visitor",
        F.lit(0).alias("add_cart"), "order_num", "pay_num", "share_visit",
    ).orderBy("current_day", "shop_id")


def daily_overview(
    orders: DataFrame, items: DataFrame, products: DataFrame, app_log: DataFrame, days: Sequence[date]
) -> DataFrame:
    """Overview of whole days from snapshots: shops with orders, and shops with only new products.

    Any number of days is one pass; a single day and a backfill are the same query. No shop is lost to a NULL
    shop id among the orders.
    """
    slots = Slots(tuple(whole_day(d) for d in days))
    return _daily(
        _sales(orders, items, slots), _new_products(products, slots), shop_traffic_rows(exposures(app_log, slots), slots), slots,
        need_items=False,
    )


def intraday_overview(
    orders_inc: DataFrame, items_inc: DataFrame, products_inc: DataFrame, app_log: DataFrame, window: ReportWindow
) -> DataFrame:
    """As the daily overview over one day's increments. A shop whose orders have no items yet gets no row."""
    on_day, slots = F.col("dt") == F.lit(window.stat_date), Slots((window,))
    seen = exposures(app_log, Slots((whole_day(window.stat_date),)))
    return _daily(
        _sales(orders_inc.filter(on_day), items_inc.filter(on_day), slots),
        _new_products(products_inc.filter(on_day), slots, ~F.col("is_deleted")),
        shop_traffic_rows(seen, slots),
        slots,
        need_items=True,
    )
