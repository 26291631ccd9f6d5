"""The logical tables a report reads, as one value."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from stallmetrics.sources import canonical
from stallmetrics.sources.pruning import on_days


@dataclass(frozen=True)
class Marketplace:
    """Typed frames. ``*_inc`` are daily increments partitioned by ``dt``, the others whole snapshots."""

    orders: DataFrame
    items: DataFrame
    refunds: DataFrame
    products: DataFrame
    shops: DataFrame
    app_log: DataFrame
    orders_inc: DataFrame
    items_inc: DataFrame
    refunds_inc: DataFrame
    products_inc: DataFrame
    shops_inc: DataFrame

    @staticmethod
    def from_raw(read: Callable[[str], DataFrame], days: tuple[date, date] | None = None) -> Marketplace:
        """Build from raw tables; ``read`` maps a logical name (``orders``, ``orders_inc``, …) to its raw frame.

        With ``days`` (first, last) the increments and the log are read for these days alone, by the names of their partitions.
        """

        def dated(name: str) -> DataFrame:
            return read(name) if days is None else on_days(read(name), *days)

        return Marketplace(
            orders=canonical.orders(read("orders")),
            items=canonical.items(read("items")),
            refunds=canonical.refunds(read("refunds")),
            products=canonical.products(read("products")),
            shops=canonical.shops(read("shops")),
            app_log=canonical.app_log(dated("app_log")),
            orders_inc=canonical.orders(dated("orders_inc")),
            items_inc=canonical.items(dated("items_inc")),
            refunds_inc=canonical.refunds(dated("refunds_inc")),
            products_inc=canonical.products(dated("products_inc")),
            shops_inc=canonical.shops(dated("shops_inc")),
        )
