"""App-log steps: exposures, visitors, share opens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallmetrics.functions.calendar import ReportWindow
from stallmetrics.operators.shaping import one_if, stack_measures
from stallmetrics.operators.windows import ONE, WIN, Slots, tag_by_day

# What the log calls an exposure, and a screen view.
ENTER = "enter"
PRODUCT_PAGE = "1005"
SCREEN_VIEW = "AppViewScreen"


def is_share_open() -> Column:
    """Exposure that came from a shared link."""
    return (F.col("event") == SCREEN_VIEW) & (F.get_json_object("label", "$.isShare") == "1")


def exposures(app_log: DataFrame, windows: Sequence[ReportWindow] | Slots, need_shop: bool = True) -> DataFrame:
    """Exposure events of the windows' days, marked; events without a product (or shop) are left out.

    Of a list of windows an event gets one copy each; ``Slots`` choose how windows are told apart.
    """
    known = F.col("prod_id").isNotNull()
    if need_shop:
        known = known & F.col("shop_id").isNotNull()
    seen = app_log.filter((F.col("action") == ENTER) & (F.col("page_id") == PRODUCT_PAGE) & known)
    return windows.mark_day(seen, "dt") if isinstance(windows, Slots) else tag_by_day(seen, windows, "dt")


def exposure_rows(events: DataFrame, keys: Sequence[str], slots: Slots = ONE) -> DataFrame:
    """Additive exposure measures: one row per key and client."""
    counts = slots.measures(expose=lambda i: F.count_if(slots.here(i)) if slots.shared else F.count(F.lit(1)))
    return events.groupBy(*keys, "cid").agg(*slots.folded(), *counts).select(
        *keys, *slots.carried, *slots.names("expose"),
        *slots.measures(expose_person_num=lambda i: one_if(F.col("cid").isNotNull() & slots.here(i))),
    )


def exposure_by_product_shop(app_log, windows, need_shop: bool = True) -> DataFrame:
    """Exposures and distinct clients per product and shop."""
    keys = [WIN, "prod_id", "shop_id"]
    return stack_measures(keys, exposure_rows(exposures(app_log, windows, need_shop), keys))


def exposure_by_product(app_log, windows) -> DataFrame:
    """Exposures and distinct clients per product, blank products left out."""
    keys = [WIN, "prod_id"]
    return stack_measures(keys, exposure_rows(exposures(app_log, windows, need_shop=False), keys))


def visitors_by_shop(app_log, windows) -> DataFrame:
    """Distinct clients per shop."""
    return exposures(app_log, windows).groupBy(WIN, "shop_id").agg(F.count_distinct("cid").alias("visitor"))


def share_visits_by_shop(app_log, windows) -> DataFrame:
    """Exposures per shop that are share opens."""
    return (
        exposures(app_log, windows).filter(is_share_open())
        .groupBy(WIN, "shop_id").agg(F.count(F.lit(1)).alias("share_visit"))
    )


def shop_traffic_rows(events: DataFrame, slots: Slots) -> DataFrame:
    """Additive shop-level traffic in one pass over marked exposures: one row per shop and product or client."""
    ids = F.array(
        F.struct(F.lit(True).alias("_is_prod"), F.col("prod_id").cast("string").alias("_id")),
        F.struct(F.lit(False).alias("_is_prod"), F.col("cid").alias("_id")),
    )
    keys = [*slots.keys, "shop_id"]
    is_prod, known = F.col("_is_prod"), F.col("_id").isNotNull()
    folded = events.select(*keys, *slots.carried, F.coalesce(is_share_open(), F.lit(False)).alias("_shared"), F.inline(ids)).groupBy(
        *keys, "_is_prod", "_id"
    ).agg(
        *slots.folded(),
        *slots.measures(_n=lambda i: F.count_if(slots.here(i)), _shares=lambda i: F.count_if(slots.here(i) & F.col("_shared"))),
    )
    return folded.select(
        *keys, *slots.carried,
        *slots.measures(
            expose=lambda i: F.when(is_prod, F.col(slots.name("_n", i))),
            visited_prod=lambda i: one_if(is_prod & known & slots.here(i)),
            visitor=lambda i: one_if(~is_prod & known & slots.here(i)),
            share_visit=lambda i: F.when(is_prod, F.col(slots.name("_shares", i))),
        ),
    )
