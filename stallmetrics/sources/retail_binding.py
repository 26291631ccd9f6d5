"""Maps retail star-schema tables (orders, lineitem, part, supplier, events) onto the logical tables.

A marketplace order is the part of an order one supplier sells: one row per (l_orderkey, l_suppkey). Order days
are folded into January 2024, where the event log lies. Increments are the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stallmetrics.functions.casts import MONEY
from stallmetrics.operators.shaping import read_whole


# declared, so that building a query reads no file
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_size int, p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
}


def _january(days: Column) -> Column:
    return F.date_add(F.lit("2024-01-01").cast("date"), days.cast("int"))


def _at_hour(day: Column, hour: Column) -> Column:
    return day.cast("timestamp") + F.make_dt_interval(F.lit(0), hour.cast("int"))


class RetailTables:
    """Lazily bound frames over one folder of Parquet tables.

    ``shared`` is for reports that read orders, items and refunds: order lines and headers are dealt by order once, whole, and every
    logical table reads that shuffle, instead of one shuffle for each with the columns it needs.
    """

    def __init__(self, spark: SparkSession, folder: str, shared: bool = False):
        self._spark = spark
        self._folder = folder.rstrip("/")
        self._shared = shared

    def _by_order(self, rows: DataFrame) -> DataFrame:
        if not self._shared:
            return rows
        return read_whole(rows.filter(F.col("l_orderkey").isNotNull()).repartition("l_orderkey"))

    def _read(self, name: str) -> DataFrame:
        return self._spark.read.schema(_SCHEMAS[name]).parquet(f"{self._folder}/{name}.parquet")

    @cached_property
    def _lineitem(self) -> DataFrame:
        return self._read("lineitem")

    @cached_property
    def _order_lines(self) -> DataFrame:
        return self._by_order(self._lineitem.drop("l_shipdate"))

    @cached_property
    def _headers(self) -> DataFrame:
        day = _january(F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date")) % 30)
        placed = _at_hour(day, F.col("o_orderkey") % 24)
        paid = F.col("o_orderstatus").isin("F", "P")
        return self._by_order(self._read("orders").select(
            F.col("o_orderkey").alias("l_orderkey"),
            F.col("o_custkey").alias("user_id"),
            placed.alias("create_time"),
            # up to 28 hours later, so that orders are paid on the next day and the one after
            F.when(paid, placed + F.make_dt_interval(F.lit(0), (F.col("o_orderkey") % 5 * 7).cast("int"))).alias("pay_time"),
            paid.alias("is_paid"),
            day.alias("dt"),
        ))

    @cached_property
    def _lines(self) -> DataFrame:
        return self._order_lines.join(self._headers, "l_orderkey")

    @staticmethod
    def _order_number() -> Column:
        return F.concat_ws("-", "l_orderkey", "l_suppkey")

    @staticmethod
    def _order_id() -> Column:
        return F.col("l_orderkey") * 100000 + F.col("l_suppkey")

    @staticmethod
    def _item_id() -> Column:
        return F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("int"), F.col("l_extendedprice").cast(MONEY),
        )

    @cached_property
    def _part_names(self) -> DataFrame:
        return self._read("part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_size", "p_retailprice")

    def _first_of_each(self, rows: DataFrame, columns: list[str], **totals: Column) -> DataFrame:
        """The first row of each group, with totals of the group, dealt by l_orderkey; rows without that key are left out."""
        group = Window.partitionBy(*columns)
        dealt = rows if self._shared else rows.filter(F.col("l_orderkey").isNotNull()).repartition("l_orderkey")
        numbered = dealt.withColumns({"_number": F.row_number().over(group.orderBy("l_orderkey"))} | {k: v.over(group) for k, v in totals.items()})
        return numbered.filter(F.col("_number") == 1).drop("_number")

    @cached_property
    def orders(self) -> DataFrame:
        # Both sides are dealt by l_orderkey and folded there, among their neighbours, before they meet: no table of all groups is
        # held. Lines of a header that is there n times count n times.
        prices = self._order_lines.select("l_orderkey", "l_suppkey", F.col("l_extendedprice").cast(MONEY).alias("_price"))
        sold = self._first_of_each(prices, ["l_orderkey", "l_suppkey"], _total=F.sum("_price")).drop("_price")
        headers = self._headers
        folded = self._first_of_each(headers, headers.columns, _copies=F.count(F.lit(1)))
        return sold.join(folded, "l_orderkey").withColumn("actual_total", (F.col("_total") * F.col("_copies")).cast(MONEY)).select(
            self._order_id().alias("order_id"),
            self._order_number().alias("order_number"),
            "user_id",
            F.col("l_suppkey").alias("shop_id"),
            "create_time", "pay_time", "is_paid", "actual_total",
            F.when(F.col("is_paid"), 2).otherwise(1).alias("status"),
            "dt",
        )

    def _item_columns(self) -> list[Column]:
        return [
            self._item_id().alias("order_item_id"),
            self._order_number().alias("order_number"),
            F.col("l_partkey").alias("prod_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("user_id"),
            F.col("l_quantity").cast("int").alias("prod_count"),
            F.col("l_extendedprice").cast(MONEY).alias("actual_total"),
            F.col("create_time").alias("rec_time"),
            F.col("dt"),
        ]

    @cached_property
    def items(self) -> DataFrame:
        return self._lines.select(*self._item_columns())

    @cached_property
    def items_named(self) -> DataFrame:
        """Items with the catalog columns of their product (name, price, status)."""
        return self._lines.join(self._part_names, "l_partkey").select(
            *self._item_columns(),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            F.col("p_name").alias("prod_name"),
            (F.col("p_size") % 9 - 1).alias("status"),
        )

    @cached_property
    def orders_named(self) -> DataFrame:
        """Orders with a product name where the order id is even (names are optional in this table)."""
        names = self.items_named.groupBy("order_number").agg(F.max("prod_name").alias("_name"))
        return self.orders.join(names, "order_number", "left").withColumn(
            "prod_name", F.when(F.col("order_id") % 2 == 0, F.col("_name"))
        ).drop("_name")

    @cached_property
    def refunds(self) -> DataFrame:
        single = F.col("l_linestatus") == "O"
        quantity = F.col("l_quantity").cast("int")
        applied = F.col("create_time") + F.make_dt_interval(quantity % 7)
        succeeded = F.col("l_returnflag") == "R"
        return self._lines.filter(F.col("l_returnflag").isin("R", "A")).select(
            self._item_id().alias("refund_id"),
            self._order_id().alias("order_id"),
            F.when(single, self._item_id()).alias("order_item_id"),
            "user_id",
            F.col("l_suppkey").alias("shop_id"),
            F.when(single, 2).otherwise(1).alias("refund_type"),
            F.when(succeeded, 5).otherwise(1).alias("return_money_sts"),
            F.col("l_extendedprice").cast(MONEY).alias("refund_amount"),
            applied.alias("apply_time"),
            F.when(succeeded, applied).alias("refund_time"),
            F.when(single, quantity).alias("goods_num"),
            (F.col("l_partkey") % 18).cast("string").alias("buyer_reason"),
            applied.cast("date").alias("dt"),
        )

    @cached_property
    def products(self) -> DataFrame:
        """One version per item row, dated by its ship date."""
        created = _january(F.col("l_partkey") % 30)
        return self._lineitem.join(self._part_names, "l_partkey").select(
            F.col("l_partkey").alias("prod_id"),
            F.col("l_suppkey").alias("shop_id"),
            F.col("p_name").alias("prod_name"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            F.col("l_extendedprice").cast(MONEY).alias("supplier_price"),
            (F.col("p_size") % 9 - 1).alias("status"),
            F.concat(F.lit("pic/"), F.col("l_partkey")).alias("pic"),
            created.cast("timestamp").alias("create_time"),
            F.col("l_shipdate").cast("timestamp").alias("update_time"),
            (F.col("l_partkey") % 11 == 0).alias("is_deleted"),
            created.alias("dt"),
        )

    @cached_property
    def shops(self) -> DataFrame:
        return self._read("supplier").select(
            F.col("s_suppkey").alias("shop_id"), F.col("s_name").alias("shop_name"),
            F.lit("2024-01-30").cast("date").alias("dt"),
        )

    @cached_property
    def app_log(self) -> DataFrame:
        """Events on several pages, some of them clicks."""
        return self._log(
            F.when(F.col("event_id") % 7 == 0, "1006").otherwise("1005"),
            F.when(F.col("event_id") % 5 == 0, "AppClick").otherwise("AppViewScreen"),
        )

    @cached_property
    def whole_log(self) -> DataFrame:
        """All events as screen views of the product page, so that none is left out of a report."""
        return self._log(F.lit("1005"), F.lit("AppViewScreen"))

    def _log(self, page: Column, event: Column) -> DataFrame:
        share = F.when(F.col("event_id") % 3 == 0, "1").otherwise("0")
        return self._read("events").select(
            F.get_json_object("props", "$.k").try_cast("bigint").alias("prod_id"),
            (F.col("event_id") % 10).alias("shop_id"),
            F.col("user_id").cast("string").alias("cid"),
            F.when(F.col("event_type") == "view", "enter").otherwise(F.col("event_type")).alias("action"),
            page.alias("page_id"),
            event.alias("event"),
            F.concat(F.lit('{"isShare":"'), share, F.lit('"}')).alias("label"),
            F.col("ts").cast("date").alias("dt"),
        )
