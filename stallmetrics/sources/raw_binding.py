"""The retail tables as a raw warehouse holds them: text columns, other names, several spellings of the same value.

Every logical table is rendered whole. Increments hold the rows of all days, partitioned by a day without dashes; ``changed``
gives increments that differ from the snapshot: renamed rows, rows that are new, and products that were deleted and are back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallmetrics.sources.retail_binding import RetailTables

#: What is added to an id to make a new one.
NEW_PRODUCT, NEW_SHOP = 10_000_000, 1_000_000
_NAMES = {"is_paid": "is_payed", "is_deleted": "is_delete_hive"}
_LOG_NAMES = {"prod_id": "prodid", "shop_id": "shopid"}


def _spelled(field: T.StructField, dashes: bool) -> Column:
    """A column as text, in one of several ways from row to row."""
    col, way = F.col(field.name), F.pmod(F.xxhash64(field.name), F.lit(3))
    text = col.cast("string")
    if isinstance(field.dataType, T.LongType):
        return F.when(way == 0, F.concat(text, F.lit(".0"))).when(way == 1, F.concat(F.lit(" "), text)).otherwise(text)
    if isinstance(field.dataType, T.BooleanType):
        return F.when(col, F.lit("true" if field.name == "is_deleted" else "1")).otherwise("0")
    if isinstance(field.dataType, T.DateType) and not dashes:
        return F.date_format(col, "yyyyMMdd")
    if field.name == "order_item_id":
        return F.coalesce(text, F.lit(" "))
    return text


def as_raw(df: DataFrame, dashes: bool = True, names: dict[str, str] | None = None) -> DataFrame:
    """Typed rows as a raw table holds them."""
    renamed = _NAMES | (names or {})
    return df.select(*[_spelled(f, dashes).alias(renamed.get(f.name, f.name)) for f in df.schema.fields])


class RawRetail:
    """Raw frames over one folder of retail tables, for ``Marketplace.from_raw``."""

    def __init__(self, spark: SparkSession, folder: str, shared: bool = False):
        self._tables = RetailTables(spark, folder, shared)

    def read(self, name: str) -> DataFrame:
        """A logical table; its increment has the same rows."""
        t, table = self._tables, name.removesuffix("_inc")
        typed = {
            "orders": lambda: t.orders_named, "items": lambda: t.items_named, "refunds": lambda: t.refunds,
            "products": lambda: t.products, "shops": lambda: t.shops, "app_log": lambda: t.app_log,
        }[table]()
        return as_raw(typed, dashes=not name.endswith("_inc"), names=_LOG_NAMES if table == "app_log" else None)

    def changed(self, name: str) -> DataFrame:
        """As ``read``, but the increments of products and shops differ from their snapshots."""
        t = self._tables
        if name == "products_inc":
            status = F.when(F.col("status") == -1, F.lit(1)).otherwise(F.col("status"))
            renamed = t.products.withColumns({"prod_name": F.concat(F.lit("new "), "prod_name"), "status": status})
            return as_raw(renamed.unionByName(t.products.withColumn("prod_id", F.col("prod_id") + NEW_PRODUCT)), dashes=False)
        if name == "shops_inc":
            renamed = t.shops.withColumn("shop_name", F.concat(F.lit("new "), "shop_name"))
            return as_raw(renamed.unionByName(t.shops.withColumn("shop_id", F.col("shop_id") + NEW_SHOP)), dashes=False)
        return self.read(name)
