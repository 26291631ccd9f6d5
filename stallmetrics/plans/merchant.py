"""Shop-level sales, payment and refund reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow, intraday_window, whole_day
from stallmetrics.functions.casts import MONEY
from stallmetrics.functions.rates import money_ratio, percent
from stallmetrics.operators.refunds import SUCCEEDED, shop_refund_rows
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.trade import order_rows
from stallmetrics.operators.windows import Slots, any_window, inside, window_value

# quotients the reports leave unrounded are kept to this many places
_UNROUNDED = 6


def _with_shop(df: DataFrame) -> DataFrame:
    return df.filter(F.col("shop_id").isNotNull())


def _refund_sums(refunds: DataFrame, flags: dict) -> DataFrame:
    """Successful refund amount per shop for each flagged subset."""
    aggs = [
        F.coalesce(F.sum(F.when(flag, F.col("refund_amount"))), F.lit(0)).cast(MONEY).alias(name)
        for name, flag in flags.items()
    ]
    return refunds.groupBy("shop_id").agg(*aggs)


def _succeeded(refunds: DataFrame) -> DataFrame:
    return _with_shop(refunds).filter(F.col("return_money_sts") == SUCCEEDED)


def paid_by_shop(orders: DataFrame, day: date) -> DataFrame:
    """Paid amount, payers, orders and unit price per shop for one day's partition."""
    paid = orders.filter(F.col("is_paid") & (F.col("dt") == F.lit(day)) & inside("pay_time", whole_day(day)))
    totals = stack_measures(["shop_id"], order_rows(paid, ["shop_id"], {"pay": F.lit(True)}))
    return totals.select(
        "shop_id",
        F.col("pay_amount").alias("payActualTotal"),
        F.col("pay_users").alias("payUserCount"),
        F.col("pay_orders").alias("payOrderCount"),
        money_ratio("pay_amount", "pay_users", _UNROUNDED).alias("onePrice"),
    ).orderBy(F.desc("payActualTotal"))


def hourly_gmv(orders_inc: DataFrame, as_of: datetime) -> DataFrame:
    """Paid orders and amount per shop and hour of the intraday window."""
    window = intraday_window(as_of)
    paid = _with_shop(orders_inc).filter(
        F.col("is_paid") & inside("pay_time", window) & (F.col("dt") == F.lit(window.stat_date))
    )
    return (
        paid.groupBy(
            F.to_date("pay_time").alias("order_date"),
            F.date_format("pay_time", "HH").alias("hour_of_day"),
            "shop_id",
        )
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("actual_total").cast(MONEY).alias("pay_actual_total"),
        )
        .withColumn("stat_date", F.lit(window.stat_date))
        .orderBy("order_date", "hour_of_day", "shop_id")
    )


def daily_order_pay(orders: DataFrame, refunds: DataFrame, as_of: datetime) -> DataFrame:
    """Today beside yesterday: payments and successful refunds per shop, for shops that have any of the four."""
    today, yesterday = whole_day(as_of.date()), whole_day(as_of.date() - timedelta(days=1))
    both = [today, yesterday]
    paid = _with_shop(orders).filter(F.col("is_paid") & any_window(both, lambda w: inside("pay_time", w)))
    sales = order_rows(
        paid, ["shop_id"], {"now": inside("pay_time", today), "prev": inside("pay_time", yesterday)}
    )
    back = _refund_sums(
        _succeeded(refunds).filter(any_window(both, lambda w: inside("refund_time", w))),
        {"now_refund": inside("refund_time", today), "prev_refund": inside("refund_time", yesterday)},
    )
    return stack_measures(["shop_id"], sales, back).select(
        "shop_id",
        F.col("now_amount").alias("pay_actual_total"),
        F.col("now_users").alias("pay_user_count"),
        F.col("now_orders").alias("pay_order_count"),
        money_ratio("now_amount", "now_users", _UNROUNDED).alias("one_price"),
        F.col("now_refund").alias("refund"),
        F.col("prev_amount").alias("yesterday_pay_actual_total"),
        F.col("prev_users").alias("yesterday_pay_user_count"),
        F.col("prev_orders").alias("yesterday_pay_order_count"),
        money_ratio("prev_amount", "prev_users", _UNROUNDED).alias("yesterday_one_price"),
        F.col("prev_refund").alias("yesterday_refund"),
        F.lit(as_of.date()).alias("stat_date"),
    ).orderBy("shop_id")


def order_pay_agg(orders: DataFrame, as_of: datetime) -> DataFrame:
    """Today's paid orders per shop. ``month_amount`` equals today's amount as published reports have it;
    ``month_to_date_amount`` is the real month so far."""
    today = whole_day(as_of.date())
    month = ReportWindow(today.start.replace(day=1), today.end, today.tag, today.stat_date)
    paid = _with_shop(orders).filter(F.col("is_paid") & inside("pay_time", month))
    on_day = inside("pay_time", today)
    day_sum = F.sum(F.when(on_day, F.col("actual_total"))).cast(MONEY)
    return (
        paid.groupBy("shop_id")
        .agg(
            F.count_if(on_day).alias("pay_order_count"),
            day_sum.alias("pay_actual_total"),
            F.sum("actual_total").cast(MONEY).alias("month_to_date_amount"),
        )
        .filter(F.col("pay_order_count") > 0)
        .select(
            "shop_id", "pay_order_count", "pay_actual_total",
            F.col("pay_actual_total").alias("today_amount"),
            F.col("pay_actual_total").alias("month_amount"),
            "month_to_date_amount",
            F.lit(as_of.date()).alias("stat_date"),
        )
        .orderBy("shop_id")
    )


def refund_stats(orders: DataFrame, refunds: DataFrame, as_of: datetime) -> DataFrame:
    """Today's successful refunds against orders paid today; the rate is 100 when there are refunds but no orders."""
    today = whole_day(as_of.date())
    back = shop_refund_rows(
        _succeeded(refunds).filter(inside("refund_time", today)), ["shop_id"], "pay_actual_total", "refund_count"
    )
    sold = (
        _with_shop(orders).filter((F.col("status") >= 2) & inside("pay_time", today))
        .groupBy("shop_id").agg(F.count("order_id").alias("pay_order_count"))
    )
    only_refunds = (F.col("refund_count") > 0) & (F.col("pay_order_count") == 0)
    return stack_measures(["shop_id"], back, sold).select(
        F.lit(as_of.date()).alias("refund_date"),
        F.lit(f"{as_of:%Y-%m-%d}").alias("refund_date_to_string"),
        "shop_id", "pay_actual_total", "refund_count", "pay_order_count",
        F.when(only_refunds, F.lit(100).cast("decimal(18,4)"))
        .otherwise(percent("refund_count", "pay_order_count", 4)).alias("refund_rate"),
        F.lit(as_of.date()).alias("stat_date"),
    ).orderBy("shop_id")


def comprehensive(
    orders: DataFrame, items: DataFrame, refunds: DataFrame, windows: Sequence[ReportWindow]
) -> DataFrame:
    """Orders, payments, item counts and refunds per shop and period, all periods in one scan.

    Orders meet their items once and are folded back to one row each on the same shuffle, so order amounts are never multiplied;
    a row number keeps copies of an order apart.
    """
    slots = Slots(tuple(windows))
    placed = _with_shop(orders).filter(any_window(windows, lambda w: inside("create_time", w))).select(
        "order_number", "shop_id", "user_id", "create_time", "is_paid", "actual_total", F.monotonically_increasing_id().alias("_row")
    )
    kept = ("shop_id", "user_id", "create_time", "is_paid", "actual_total")
    per_order = placed.join(items.select("order_number", "prod_count"), "order_number", "left").groupBy("order_number", "_row").agg(
        *[F.first(c).alias(c) for c in kept], F.sum("prod_count").alias("_pieces")
    )
    marked = slots.mark_time(per_order, "create_time")
    keys = [*slots.keys, "shop_id"]
    paid = F.coalesce(F.col("is_paid"), F.lit(False))

    def total(value: str, test: Column | None = None):
        of = F.col(value) if test is None else F.when(test, F.col(value))
        return lambda i: F.sum(slots.only(i, of)).cast(MONEY if value == "actual_total" else "bigint")

    first = marked.groupBy(*keys, "user_id").agg(
        *slots.folded(),
        *slots.measures(
            order_nums=lambda i: F.count_if(slots.here(i)), order_amount=total("actual_total"), product_nums=total("_pieces"),
            pay_order_nums=lambda i: F.count_if(slots.here(i) & paid), pay_amount=total("actual_total", paid),
            pay_product_nums=total("_pieces", paid),
        ),
    )
    known = F.col("user_id").isNotNull()
    sums = ("order_nums", "order_amount", "product_nums", "pay_order_nums", "pay_amount", "pay_product_nums")
    sales = first.select(
        *keys, *slots.carried, *slots.names(*sums),
        *slots.measures(
            user_nums=lambda i: one_if(known & slots.here(i)),
            pay_user_nums=lambda i: one_if(known & (F.col(slots.name("pay_order_nums", i)) > 0)),
        ),
    )
    back = shop_refund_rows(
        slots.mark_time(_succeeded(refunds), "refund_time"), keys, "refund_amount", "refund_order_nums", slots
    )
    return slots.unfold(stack_measures(keys, sales, back)).select(
        "shop_id",
        money_ratio("pay_amount", "pay_user_nums", 2).alias("customer_unit_price"),
        F.col("pay_amount").alias("total_transaction_amount"),
        "order_amount", "user_nums", "order_nums", "product_nums",
        "pay_amount", "pay_user_nums", "pay_order_nums", "pay_product_nums",
        "refund_amount", "refund_order_nums",
        percent("pay_order_nums", "order_nums").alias("order_to_pay_rate"),
        percent("refund_order_nums", "pay_order_nums").alias("refund_rate"),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
        window_value(windows, lambda w: w.tag).alias("date_time"),
        window_value(windows, lambda w: w.time_type).alias("time_type"),
    ).orderBy("time_type", "shop_id")


def paid_by_window(orders: DataFrame, windows: Sequence[ReportWindow], ts: str = "pay_time") -> DataFrame:
    """Paid orders and amount per shop and reporting window."""
    slots = Slots(tuple(windows))
    marked = slots.mark_time(_with_shop(orders).filter("is_paid"), ts)
    totals = marked.groupBy(*slots.keys, "shop_id").agg(
        *slots.folded(),
        *slots.measures(
            pay_order_count=lambda i: F.count_if(slots.here(i)),
            pay_actual_total=lambda i: F.sum(slots.only(i, F.col("actual_total"))).cast(MONEY),
        ),
    )
    return slots.unfold(totals).select(
        "shop_id", "pay_order_count", "pay_actual_total",
        window_value(windows, lambda w: w.tag).alias("period_tag"),
        window_value(windows, lambda w: w.time_type).alias("time_type"),
        window_value(windows, lambda w: w.first_day).alias("first_day"),
        window_value(windows, lambda w: w.last_day).alias("last_day"),
        window_value(windows, lambda w: w.stat_date).alias("stat_date"),
    )


def paid_by_day(orders: DataFrame) -> DataFrame:
    """Paid orders and amount per shop and pay day over the whole table: the history a result table keeps."""
    paid = _with_shop(orders).filter(F.col("is_paid") & F.col("pay_time").isNotNull())
    return paid.groupBy("shop_id", F.to_date("pay_time").alias("stat_date")).agg(
        F.count(F.lit(1)).alias("pay_order_count"),
        F.sum("actual_total").cast(MONEY).alias("pay_actual_total"),
    )


__all__ = [
    "comprehensive", "daily_order_pay", "hourly_gmv", "order_pay_agg", "paid_by_day", "paid_by_shop",
    "paid_by_window", "refund_stats",
]
