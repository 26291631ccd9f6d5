"""Product sales ranking and visitor conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow
from stallmetrics.functions.ids import with_packed
from stallmetrics.functions.rates import count_ratio
from stallmetrics.operators.catalog import latest_product, one_name_per_shop, with_shop_names
from stallmetrics.operators.ranking import rank_in_group
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.traffic import exposure_rows, exposures
from stallmetrics.operators.windows import Slots, any_window, inside, window_value


def _cards(products: DataFrame) -> DataFrame:
    """One undeleted card per product and shop."""
    live = products.filter((F.col("status") != -1) & F.col("shop_id").isNotNull())
    return latest_product(live).select("prod_id", "shop_id", "prod_name", "pic")


def sales_rank(
    items: DataFrame, orders: DataFrame, products: DataFrame, shops: DataFrame, windows: Sequence[ReportWindow]
) -> DataFrame:
    """Paid amount and pieces per product, for each shop that carries it, with its position in the shop."""
    slots = Slots(tuple(windows))
    orders, items = orders.withColumns(with_packed("order_number")), items.withColumns(with_packed("order_number"))
    paid = orders.filter(F.col("is_paid") & any_window(windows, lambda w: inside("pay_time", w)))
    lines = items.select("order_number", "prod_id", "prod_count", "actual_total").join(
        paid.select("order_number", "pay_time"), "order_number"
    )
    sold = slots.mark_time(lines, "pay_time").groupBy(*slots.keys, "prod_id").agg(
        *slots.folded(),
        *slots.measures(
            pay_amount=lambda i: F.sum(slots.only(i, F.col("actual_total"))).cast("decimal(18,2)"),
            pay_count=lambda i: F.coalesce(F.sum(slots.only(i, F.col("prod_count"))), F.lit(0)),
        ),
    )
    carried = slots.unfold(_cards(products).join(sold, "prod_id"))
    ranked = rank_in_group(carried, [*slots.unfolded, "shop_id"], "pay_amount", "prod_id")
    return with_shop_names(ranked, one_name_per_shop(shops)).select(
        "prod_id", "shop_id", "shop_name", "pic", "prod_name", "pay_amount", "pay_count", "rank_num",
        window_value(windows, lambda w: w.tag).alias("time_period"),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
    )


def visitor_conversion(
    app_log: DataFrame,
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    shops: DataFrame,
    windows: Sequence[ReportWindow],
) -> DataFrame:
    """Visitors, ordering users (paid or not) and their ratio per product and shop, ranked by visitors in the shop."""
    slots = Slots(tuple(windows))
    keys = [*slots.keys, "prod_id", "shop_id"]
    visitors = exposure_rows(exposures(app_log, slots), keys, slots).select(
        *keys, *slots.carried, *slots.measures(visitor_num=lambda i: F.col(slots.name("expose_person_num", i)))
    )
    recorded = items.filter(any_window(windows, lambda w: inside("rec_time", w))).select(
        "order_number", "prod_id", "user_id", "rec_time"
    )
    lines = recorded.join(orders.select("order_number", "shop_id"), "order_number")
    people = slots.mark_time(lines, "rec_time").groupBy(*keys, "user_id").agg(*slots.folded(), F.count(F.lit(1)).alias("_lines"))
    buyers = people.select(
        *keys, *slots.carried, *slots.measures(pay_user_count=lambda i: one_if(F.col("user_id").isNotNull() & slots.here(i)))
    )
    named = _cards(products.filter(F.col("prod_name").isNotNull()))
    described = slots.unfold(named.join(stack_measures(keys, visitors, buyers), ["prod_id", "shop_id"]))
    active = described.filter((F.col("visitor_num") > 0) | (F.col("pay_user_count") > 0))
    ranked = rank_in_group(active, [*slots.unfolded, "shop_id"], "visitor_num", "prod_id")
    return with_shop_names(ranked, one_name_per_shop(shops)).select(
        "prod_id", "shop_id", "shop_name", "prod_name", "pic", "visitor_num",
        count_ratio("pay_user_count", "visitor_num", 4).alias("visitor_to_pay_rate"),
        "pay_user_count", "rank_num",
        window_value(windows, lambda w: w.tag).alias("time_period"),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
    )
