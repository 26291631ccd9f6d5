"""Full product analysis, per merchant and for the platform.

All variants share one assembly: facts are folded to the product's grain, stacked, joined to the catalog and fanned
out to the status filters. What differs between them (sources, pay rule, refund amount, refund count) is passed in.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow, whole_day
from stallmetrics.functions.ids import with_packed
from stallmetrics.functions.labels import PRODUCT_PREFIX, SHOP_PREFIX, product_status_label
from stallmetrics.functions.rates import percent
from stallmetrics.operators.activity import activity_lines
from stallmetrics.operators.catalog import (
    latest_item_snapshot,
    latest_product,
    latest_status_today,
    merged_products,
    merged_shops,
    one_name_per_shop,
    with_shop_names,
)
from stallmetrics.operators.refunds import (
    REFUND_FACT,
    SINGLE_ITEM,
    SUCCEEDED,
    WHOLE_ORDER,
    first_of_refund,
    item_refunds,
    order_refunds,
    refund_rows,
    refunded_lines,
)
from stallmetrics.operators.shaping import (
    MEASURES_WITHOUT_EXPOSURE,
    STATUS_FILTERS,
    admitted,
    drop_all_zero,
    stack_measures,
    status_fanout,
)
from stallmetrics.operators.tally import REFUND, SEEN, TRADE, by_part, lines_of, measured, met, what
from stallmetrics.operators.trade import distinct_order_lines, one_of_each, order_lines, shareable, trade_rows
from stallmetrics.operators.traffic import exposure_rows, exposures
from stallmetrics.operators.windows import MASK, Slots, any_window, inside, mask_of, per_window, window_value

_MERCHANT = ["prod_id", "shop_id"]


def _measures(price: Column) -> list[Column | str]:
    return [
        price.alias("price"),
        "supplier_price", "expose", "expose_person_num",
        F.lit(0).alias("add_cart_person"), F.lit(0).alias("add_cart"),
        "place_order_person", "pay_person", "place_order_num", "pay_num", "place_order_amount", "pay_amount",
        percent("pay_person", "expose_person_num").alias("single_prod_rate"),
        "refund_num", "refund_person", "refund_success_num", "refund_success_person", "refund_success_amount",
        percent("refund_success_num", "refund_num").alias("refund_success_rate"),
        "status",
        product_status_label("status").alias("prod_status"),
        "status_filter",
    ]


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumnRenamed("item_shop_id", "shop_id") if "shop_id" in keys else df


def _one_each(lines: DataFrame, columns: Sequence[str], near: Sequence[str], slots: Slots) -> DataFrame:
    """Chosen columns without repeated rows, in any of the windows that the copies lie in, dealt by some of them."""
    near = [*slots.keys, *near]
    return lines.repartition(*near).groupBy(*columns).agg(*slots.folded()) if slots.shared else one_of_each(lines, columns, near)


def _short(orders: DataFrame, items: DataFrame, refunds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts whose text ids are short keys: no report shows them."""
    return (
        orders.withColumns(with_packed("order_number")), items.withColumns(with_packed("order_number", "order_item_id")),
        refunds.withColumns(with_packed("order_item_id", "refund_id")),
    )


def merchant_analysis(
    products: DataFrame,
    shops: DataFrame,
    app_log: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    refunds: DataFrame,
    windows: Sequence[ReportWindow],
) -> DataFrame:
    """Per product, shop and status filter over whole-day windows, all windows in one pass.

    Facts may hold copies and are deduplicated. Paid means created and paid in the window. A whole-order refund
    gives its full amount to every item of the order.
    """
    slots = Slots(tuple(windows))
    keys = [*slots.keys, *_MERCHANT]
    orders, items, refunds = _short(orders, items, refunds)
    created = orders.filter(any_window(windows, lambda w: inside("create_time", w)))
    order_items = shareable(distinct_order_lines(created, items))
    lines = slots.mark_time(order_items, "create_time")
    in_both = slots.each(lambda w: F.col("is_paid") & inside("create_time", w) & inside("pay_time", w))
    placed = slots.each(lambda w: inside("create_time", w))
    trade = lines_of(lines, keys, "user_id", slots, what(TRADE, mask_of(placed), mask_of(in_both), slots), F.col("prod_count"), F.col("item_total"))

    asked = refunds.filter(any_window(windows, lambda w: inside("apply_time", w)))

    def of_type(kind: int, key: str) -> DataFrame:
        wanted = asked.filter((F.col("refund_type") == kind) & F.col(key).isNotNull())
        return slots.mark_time(one_of_each(wanted, REFUND_FACT, [key]), "apply_time")

    carry = [*slots.keys, *slots.carried]
    single = item_refunds(of_type(SINGLE_ITEM, "order_item_id"), items, carry)
    # the order lines of above again: the never-NULL key keeps them the same shuffle, read a second time
    window_of = "_created" if slots.shared else "create_time"
    if slots.shared:
        order_items = order_items.withColumn("_created", mask_of([inside("create_time", w) for w in windows]))
    whole = refunded_lines(of_type(WHOLE_ORDER, "order_id"), order_items, [*carry, window_of])
    if slots.shared:  # windows that hold both the request and the order
        whole = whole.withColumn(MASK, F.col(MASK).bitwiseAND(F.col(window_of))).filter(F.col(MASK) != 0)
    else:
        whole = whole.filter(per_window(windows, lambda w: inside("create_time", w)))
    # a refund counts once per product, however many of its items the order holds
    refund_cols = [*slots.keys, "prod_id", "item_shop_id", "refund_id", "user_id", "return_money_sts", "refund_amount", "refund_type"]
    both = single.select(*refund_cols, *slots.carried).unionByName(whole.select(*refund_cols, *slots.carried))
    attributed = _one_each(both, refund_cols, ["prod_id", "item_shop_id", "refund_id"], slots)
    in_windows, ok = F.col(MASK) if slots.shared else F.lit(1), F.coalesce(F.col("return_money_sts") == SUCCEEDED, F.lit(False))
    flagged = _keyed(attributed, keys).withColumns({"_in": in_windows, "_ok": F.when(ok, in_windows).otherwise(0)})
    back = lines_of(
        first_of_refund(flagged, keys), keys, "user_id", slots, what(REFUND, F.col("_in"), F.col("_ok"), slots),
        money=F.when(ok, F.col("refund_amount")), once=(F.col("_refund_in"), F.col("_refund_ok")),
    )
    log = exposures(app_log, slots, need_shop=False)
    seen = lines_of(log, keys, "cid", slots, what(SEEN, F.col(MASK) if slots.shared else F.lit(1), F.lit(0), slots), pieces=F.lit(1))

    folded = by_part(trade.unionByName(back), keys, slots).unionByName(by_part(seen, keys, slots))
    facts = drop_all_zero(measured(folded, keys, slots, distinct_refunds=True), slots=slots)
    described = with_shop_names(latest_product(products).join(facts, ["prod_id", "shop_id"]), one_name_per_shop(shops))
    described = drop_all_zero(slots.unfold(described)) if slots.shared else described
    return status_fanout(described).select(
        "prod_id", "shop_id", *_measures(F.col("price")),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
        F.coalesce("prod_name", F.lit("")).alias("prod_name"),
        F.coalesce("pic", F.lit("")).alias("prod_url"),
        F.coalesce("shop_name", F.lit("")).alias("shop_name"),
        window_value(windows, lambda w: w.tag).alias("time_period"),
    )


def merchant_analysis_today(
    products: DataFrame,
    shops: DataFrame,
    app_log: DataFrame,
    orders_inc: DataFrame,
    items_inc: DataFrame,
    refunds_inc: DataFrame,
    products_inc: DataFrame,
    day: date,
) -> DataFrame:
    """Per product, shop and status filter for one day's increments.

    Status, price and names fall back from the catalog to today's order items and then to a made-up text.
    """
    window = whole_day(day)
    on_day = F.col("dt") == F.lit(day)
    orders, items, refunds = orders_inc.filter(on_day), items_inc.filter(on_day), refunds_inc.filter(on_day)

    placed, paid = inside("create_time", window), F.col("is_paid") & inside("pay_time", window)
    lines = order_lines(orders.filter(placed | paid), items)
    keys = ["prod_id", "shop_id"]
    trade = trade_rows(lines, keys, paid=paid, placed=placed)

    asked = refunds.filter(inside("apply_time", window))
    single = item_refunds(asked.filter(F.col("refund_type") == SINGLE_ITEM), items)
    whole = order_refunds(
        asked.filter(F.col("refund_type") == WHOLE_ORDER),
        orders.filter(placed).select("order_id", "order_number"), items,
    )
    back = refund_rows(_keyed(single.unionByName(whole), keys), keys)
    seen = exposure_rows(exposures(app_log, [window], need_shop=False), keys)

    facts = drop_all_zero(stack_measures(keys, seen, trade, back))
    described = (
        with_shop_names(latest_product(products).join(facts, keys), one_name_per_shop(shops))
        .join(latest_item_snapshot(orders_inc, items_inc, day), keys, "left")
        .join(latest_status_today(products_inc, day), keys, "left")
        .withColumn("status", F.coalesce("today_status", "item_status", "status", F.lit(0)))
    )
    price = F.coalesce("price", "item_price", F.lit(0).cast("decimal(18,2)"))
    return status_fanout(described).select(
        "prod_id", "shop_id", *_measures(price),
        F.lit(day).alias("stat_date"),
        F.coalesce("prod_name", "item_name", F.concat(F.lit(PRODUCT_PREFIX), "prod_id")).alias("prod_name"),
        F.coalesce("pic", F.lit("")).alias("prod_url"),
        F.coalesce("shop_name", F.concat(F.lit(SHOP_PREFIX), "shop_id")).alias("shop_name"),
    ).orderBy("status_filter", F.desc("expose"))


def _created_or_paid(window: ReportWindow) -> Column:
    return inside("create_time", window) | (F.col("is_paid") & inside("pay_time", window))


def platform_analysis(
    products: DataFrame,
    shops: DataFrame,
    app_log: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    refunds: DataFrame,
    windows: Sequence[ReportWindow],
) -> DataFrame:
    """Per product and status filter, for products with any activity in the window, all windows in one pass.

    Exposures count where they happened in the shop the product's card names; a refund is worth its item's total
    and is counted per row; paid means created in the window and paid. Products paid in the window but created
    before it, or touched by any kind of refund, are listed even when all measures are 0.
    """
    slots = Slots(tuple(windows))
    keys = [*slots.keys, "prod_id"]
    orders, items, refunds = _short(orders, items, refunds)
    touched = slots.mark(orders.filter(any_window(windows, _created_or_paid)), _created_or_paid)
    placed = slots.each(lambda w: inside("create_time", w))
    # a refund counts through its own scope only; through the other it still marks the product as active
    asked = slots.mark_time(refunds, "apply_time")
    lines = activity_lines(touched, asked, orders, items, placed=placed, paid=[p & F.col("is_paid") for p in placed], slots=slots)
    activity = by_part(lines_of(lines, keys, "user_id", slots, F.col("_what"), F.col("prod_count"), F.col("item_total")), keys, slots)

    # clients are folded to one row per product and shop before the cards are met
    at_shop = [*keys, "shop_id"]
    seen = stack_measures(at_shop, exposure_rows(exposures(app_log, slots, need_shop=False), at_shop, slots))
    cards = latest_product(products, ["prod_id"])
    at_home = F.col("_at") == F.col("shop_id")
    at_own_shop = seen.withColumnRenamed("shop_id", "_at").join(cards.select("prod_id", "shop_id"), "prod_id").select(
        *keys, *slots.carried,
        *[F.when(at_home, F.col(name)).alias(name) for name in slots.names("expose", "expose_person_num")],
    )
    facts = measured(activity.unionByName(met(at_own_shop, keys, slots)), keys, slots, distinct_refunds=False)
    described = slots.unfold(with_shop_names(cards.join(facts, "prod_id"), one_name_per_shop(shops)))
    return status_fanout(described).select(
        F.lit(0).alias("id"), "prod_id", *_measures(F.col("price")),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
        "prod_name",
        F.coalesce("pic", F.lit("")).alias("prod_url"),
        F.coalesce("shop_name", F.lit("")).alias("shop_name"),
        window_value(windows, lambda w: w.tag).alias("time_period"),
    )


def platform_analysis_today(
    products: DataFrame,
    products_inc: DataFrame,
    shops: DataFrame,
    shops_inc: DataFrame,
    app_log: DataFrame,
    orders_inc: DataFrame,
    items_inc: DataFrame,
    refunds_inc: DataFrame,
    window: ReportWindow,
    status_filter: int | None = None,
) -> DataFrame:
    """Per product and status filter for an intraday window over increments; one filter only if ``status_filter``
    is given.

    Only products with orders or refunds are listed. Those are active by definition, so the set of active products
    (with or without exposures) needs no join of its own. The refund window is open at its end.
    """
    day = window.stat_date
    on_day = F.col("dt") == F.lit(day)
    items, orders = items_inc.filter(on_day), orders_inc.filter(on_day)
    lines = order_lines(orders.filter(inside("create_time", window)), items)
    trade = trade_rows(lines, ["prod_id"], paid=F.col("is_paid"))

    until = ReportWindow(window.start, window.end, window.tag, day, end_open=True)
    asked = refunds_inc.filter(on_day & inside("apply_time", until))
    single = item_refunds(asked.filter(F.col("refund_type") == SINGLE_ITEM), items)
    whole = order_refunds(
        asked.filter(F.col("refund_type") == WHOLE_ORDER), orders.select("order_id", "order_number"), items
    )
    back = refund_rows(single.unionByName(whole), ["prod_id"], amount="item_total")
    seen = exposure_rows(exposures(app_log, [whole_day(day)], need_shop=False), ["prod_id"])

    facts = stack_measures(["prod_id"], seen, trade, back).filter(
        (F.col("place_order_person") > 0) | (F.col("pay_person") > 0) | (F.col("refund_num") > 0)
    )
    filters = STATUS_FILTERS if status_filter is None else {status_filter: STATUS_FILTERS[status_filter]}
    cards = merged_products(products, products_inc, day).filter(admitted(filters=filters))
    sold = cards.join(drop_all_zero(facts, MEASURES_WITHOUT_EXPOSURE), "prod_id")
    described = with_shop_names(sold, merged_shops(shops, shops_inc, day))
    return status_fanout(described, filters=filters).select(
        "prod_id", *_measures(F.col("price")),
        F.lit(day).alias("stat_date"),
        "prod_name", F.col("pic").alias("prod_url"), "shop_name",
    ).orderBy("status_filter", F.desc("expose"))
