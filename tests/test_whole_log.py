"""Overviews that leave no event of the log out."""

import os
from datetime import datetime

import pytest

from stallmetrics.registry import QUERIES

NAMES = ("product_overview_period_7", "product_overview_period_all", "product_overview_daily", "product_overview_backfill")


@pytest.mark.parametrize("name", NAMES)
def test_every_view_counts(spark, tmp_path, name):
    at, event = datetime(2024, 1, 30), "event_id long, ts timestamp_ntz, user_id long, event_type string, props string"
    views = [(i, at, i, "view", '{"k": 3}') for i in range(70)]
    spark.createDataFrame(views, event).write.parquet(f"{tmp_path}/events.parquet")
    orders, lines = "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz", (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz")
    # 1995-01-30 is bound to the 30th
    spark.createDataFrame([(1, 1, "F", datetime(1995, 1, 30))], orders).write.parquet(f"{tmp_path}/orders.parquet")
    sold = [(1, 1, shop, 1, 1.0, 1.0, "N", "O", at) for shop in range(10)]
    spark.createDataFrame(sold, lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "p", 1, 1.0)], "p_partkey long, p_name string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    rows = QUERIES[name](spark, os.fspath(tmp_path)).collect()
    periods = {r["time_period"] for r in rows} if "period" in name else {"day"}
    assert sum(r.expose for r in rows) == 70 * len(periods) and len(periods) == (3 if name.endswith("all") else 1)
    if "period" not in name:
        assert sum(r.share_visit for r in rows) == 24
