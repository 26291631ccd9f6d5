"""The raw layer: partitions pruned by their own names, and increments that differ from the snapshot."""

from datetime import date

import micro as m
import pytest
from pyspark.sql import functions as F

from stallmetrics.sources import Marketplace
from stallmetrics.sources.pruning import on_days
from stallmetrics.sources.raw_binding import NEW_PRODUCT, RawRetail, as_raw

DAYS = [date(2023, 12, 31), date(2024, 1, 1), date(2024, 1, 15), date(2024, 1, 30), date(2024, 1, 31)]
SPELLINGS = {
    "dashes": lambda d: f"{d:%Y-%m-%d}", "plain": lambda d: f"{d:%Y%m%d}", "number": lambda d: int(f"{d:%Y%m%d}"), "date": lambda d: d,
}
TYPES = {"dashes": "string", "plain": "string", "number": "int", "date": "date"}


@pytest.mark.parametrize("span", [(date(2024, 1, 1), date(2024, 1, 30)), (date(2024, 1, 30), date(2024, 1, 30))])
@pytest.mark.parametrize("spelling", sorted(SPELLINGS))
def test_days_are_pruned_by_partition_name(spark, tmp_path, spelling, span):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(i, SPELLINGS[spelling](d)) for i, d in enumerate(DAYS)], f"n int, dt {TYPES[spelling]}")
    rows.write.partitionBy("dt").parquet(path)
    raw = on_days(spark.read.schema(rows.schema).parquet(path), *span)
    assert {r.n for r in raw.collect()} == {i for i, d in enumerate(DAYS) if span[0] <= d <= span[1]}
    plan = raw._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "dt#" in filters and "cast(" not in filters and "regexp" not in filters


def test_both_spellings_in_one_table(spark):
    rows = spark.createDataFrame([(f(d),) for d in DAYS for f in (SPELLINGS["dashes"], SPELLINGS["plain"])], "dt string")
    assert on_days(rows, date(2024, 1, 1), date(2024, 1, 30)).count() == 6
    assert on_days(spark.range(3), date(2024, 1, 1), date(2024, 1, 30)).count() == 3


def test_raw_rows_keep_their_values(spark):
    typed = m.orders(spark, *[dict(order_id=i, shop_id=i + 1, user_id=None if i == 2 else 9, is_paid=i % 2 == 0, actual_total=i, create_time="2024-01-30 10:00:00.5", dt="2024-01-30") for i in range(8)])
    raw = as_raw(typed, dashes=False)
    assert {t for _, t in raw.dtypes} == {"string"} and "is_payed" in raw.columns and len({r.order_id.strip().isdigit() for r in raw.collect()}) == 2
    empty = {"items": m.items(spark), "refunds": m.refunds(spark), "products": m.products(spark), "shops": m.shops(spark), "app_log": m.app_log(spark)}
    read = lambda name: raw if name.startswith("orders") else as_raw(empty[name.removesuffix("_inc")])
    back = Marketplace.from_raw(read, days=(date(2024, 1, 30), date(2024, 1, 30)))
    assert sorted(map(str, back.orders.collect())) == sorted(map(str, typed.collect())) == sorted(map(str, back.orders_inc.collect()))
    assert Marketplace.from_raw(read, days=(date(2024, 1, 29), date(2024, 1, 29))).orders_inc.count() == 0


def test_increments_differ_from_the_snapshot(spark):
    raw = RawRetail(spark, "/root/testdata/sf0.001")
    market = Marketplace.from_raw(raw.changed)
    old = market.products_inc.filter(F.col("prod_id") < NEW_PRODUCT)
    assert old.count() == market.products.count() == market.products_inc.count() - old.count()
    assert old.filter(~F.col("prod_name").startswith("new ")).isEmpty()
    assert market.shops_inc.count() == 2 * market.shops.count()
