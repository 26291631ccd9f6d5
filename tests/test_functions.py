from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stallmetrics.functions import calendar as cal
from stallmetrics.functions.labels import product_status_label, refund_reason_label
from stallmetrics.functions.rates import count_ratio, money_ratio, percent
from stallmetrics.operators.windows import WIN, inside, tag_by_day, tag_by_time, tag_windows
from stallmetrics.sources import canonical


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


@pytest.mark.parametrize(
    "num, den, places, times, expected",
    [(201, 20000, 2, 100, "1.01"), (0, 0, 2, 100, "0"), (1, 0, 2, 100, "0"), (1, 3, 4, 1, "0.3333"),
     (2, 3, 4, 1, "0.6667"), (1, 8, 2, 1, "0.13"), (5, 2, 1, 100, "250"), (None, 5, 2, 1, "0"), (5, None, 2, 1, "0")],
)
def test_count_ratio(spark, num, den, places, times, expected):
    got = one(spark, count_ratio(F.lit(num).cast("bigint"), F.lit(den).cast("bigint"), places, times))
    assert got == Decimal(expected)


def test_money_ratio_is_exact(spark):
    amount = F.lit(Decimal("100.01")).cast("decimal(18,2)")
    assert one(spark, money_ratio(amount, F.lit(3), 2)) == Decimal("33.34")
    assert one(spark, money_ratio(amount, F.lit(3), 6)) == Decimal("33.336667")
    assert one(spark, percent(F.lit(3), F.lit(2))) == Decimal("150")


def test_labels(spark):
    assert one(spark, product_status_label(F.lit(3))) == "违规下架待审核"
    assert one(spark, product_status_label(F.lit(4))) == ""
    assert one(spark, product_status_label(F.lit(None).cast("int"))) == ""
    assert one(spark, refund_reason_label(F.lit("0"))) == "拍错/多拍/不喜欢"
    assert one(spark, refund_reason_label(F.lit("9"))) == "9"
    assert one(spark, refund_reason_label(F.lit(None).cast("string"))) is None


def test_trailing_and_month_windows():
    week = cal.trailing_window(datetime(2024, 3, 1, 9), 7)
    assert (week.first_day, week.last_day, week.tag, week.stat_date) == (
        date(2024, 2, 23), date(2024, 2, 29), "7", date(2024, 3, 1))
    first = cal.month_window(datetime(2024, 3, 1, 9))
    assert (first.first_day, first.last_day, first.tag, first.stat_date) == (
        date(2024, 2, 1), date(2024, 2, 29), "202402", date(2024, 2, 29))
    new_year = cal.month_window(datetime(2024, 1, 1, 0, 5))
    assert (new_year.first_day, new_year.last_day, new_year.tag) == (date(2023, 12, 1), date(2023, 12, 31), "202312")
    mid = cal.month_window(datetime(2024, 1, 12))
    assert (mid.first_day, mid.last_day, mid.stat_date) == (date(2024, 1, 1), date(2024, 1, 11), date(2024, 1, 11))


def test_period_to_date():
    sunday = cal.period_to_date(datetime(2024, 1, 28, 12), "week")
    assert (sunday.first_day, sunday.last_day, sunday.tag) == (date(2024, 1, 22), date(2024, 1, 28), "202404")
    turn = cal.period_to_date(datetime(2024, 12, 30, 12), "week")
    assert (turn.first_day, turn.tag) == (date(2024, 12, 30), "202501")
    late = cal.period_to_date(datetime(2021, 1, 2), "week")
    assert late.tag == "202053"
    assert cal.period_to_date(datetime(2024, 2, 29), "month").tag == "202402"
    assert [cal.period_to_date(datetime(2024, 2, 29), p).time_type for p in ("day", "week", "month")] == [1, 2, 3]
    with pytest.raises(ValueError):
        cal.period_to_date(datetime(2024, 1, 1), "year")


@pytest.mark.parametrize(
    "day, expected",
    [(date(2024, 3, 31), date(2024, 2, 29)), (date(2023, 3, 31), date(2023, 2, 28)), (date(2024, 1, 15), date(2023, 12, 15)),
     (date(2024, 5, 31), date(2024, 4, 30))],
)
def test_month_back_is_clamped(day, expected):
    assert cal.month_back(day) == expected


def test_intraday_window_in_hour_zero_is_yesterday():
    night = cal.intraday_window(datetime(2024, 3, 1, 0, 59))
    assert (night.start, night.end, night.stat_date) == (
        datetime(2024, 2, 29), datetime(2024, 2, 29, 23, 59, 59), date(2024, 2, 29))
    noon = cal.intraday_window(datetime(2024, 3, 1, 12, 30, 15, 99))
    assert (noon.start, noon.end) == (datetime(2024, 3, 1), datetime(2024, 3, 1, 12, 30, 15))


def test_window_ends(spark):
    back = cal.month_back_window(datetime(2024, 3, 31, 10))
    rows = spark.createDataFrame(
        [("2024-02-29 23:59:59",), ("2024-03-01 00:00:00",), ("2024-03-31 23:59:59",), ("2024-04-01 00:00:00",), (None,)],
        "t string",
    ).select(F.col("t"), F.col("t").cast("timestamp").alias("ts"))
    assert [r.t for r in rows.filter(inside("ts", back)).collect()] == ["2024-03-01 00:00:00", "2024-03-31 23:59:59"]
    until = cal.ReportWindow(datetime(2024, 3, 1), datetime(2024, 3, 31, 23, 59, 59), "x", date(2024, 3, 31), end_open=True)
    assert [r.t for r in rows.filter(inside("ts", until)).collect()] == ["2024-03-01 00:00:00"]


def test_windows_follow_the_session_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        rows = spark.sql("SELECT explode(array('2024-01-29 23:59:59', '2024-01-30 00:00:00', '2024-01-30 23:59:59')) AS t")
        day = cal.whole_day(date(2024, 1, 30))
        assert rows.filter(inside(F.col("t").cast("timestamp"), day)).count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_single_days_are_looked_up_like_any_window(spark):
    days = [cal.whole_day(date(2024, 1, d)) for d in (3, 5, 9)]
    rows = spark.range(300).select("id", F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, id, 0, 0.5)").alias("ts"))
    rows = rows.union(spark.sql("SELECT 1000L, timestamp'2024-01-05 23:59:59.5'"))
    looked_up = tag_by_time(rows, days, "ts")
    tested = tag_windows(rows, days, lambda w: inside("ts", w))
    assert looked_up.exceptAll(tested).isEmpty() and tested.exceptAll(looked_up).isEmpty() and looked_up.count() == 73  # 23:59:59.5 is still that day
    dated = rows.select(F.to_date("ts").alias("d"))
    assert tag_by_day(dated, days, "d").groupBy(WIN).count().count() == 3


def test_many_windows_in_one_pass_equal_one_by_one(spark):
    windows = cal.standard_windows(datetime(2024, 1, 31, 9))
    rows = spark.range(2000).select("id", F.expr("timestamp'2023-12-20 00:00:00' + make_dt_interval(0, id)").alias("ts"))
    together = tag_windows(rows, windows, lambda w: inside("ts", w)).groupBy(WIN).count().collect()
    alone = [tag_windows(rows, [w], lambda v: inside("ts", v)).count() for w in windows]
    assert [r["count"] for r in sorted(together)] == alone and min(alone) > 0


def test_raw_orders_become_typed(spark):
    raw = spark.createDataFrame(
        [("1", "n1", "7", " 3 ", "2024-01-01 10:00:00", "bad", "1", "10.50"), ("2", "n2", "x", "", "", None, "true", "y"),
         ("3", "n3", "8", None, "2024-01-01", "2024-01-02 00:00:00", "0", "1"), ("4", "n4", "8", "1", None, None, "false", None),
         ("5", "n5", "8", "1", None, None, "", None)],
        "order_id string, order_number string, user_id string, shop_id string, create_time string, pay_time string,"
        " is_payed string, actual_total string",
    )
    rows = canonical.orders(raw).orderBy("order_id").collect()
    assert [r.shop_id for r in rows] == [3, None, None, 1, 1]
    assert [r.is_paid for r in rows] == [True, True, False, False, False]
    assert rows[0].create_time == datetime(2024, 1, 1, 10) and rows[0].pay_time is None
    assert (rows[1].user_id, rows[1].create_time, rows[1].actual_total) == (None, None, None)
    assert rows[0].actual_total == Decimal("10.50") and rows[0].dt is None
    numeric = spark.createDataFrame([(1, 1)], "order_id int, is_payed int")
    assert canonical.orders(numeric).first().is_paid is True


def test_filters_on_typed_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.sql("SELECT 1L AS shop_id, '1' AS is_payed, timestamp'2024-01-30 10:00:00' AS pay_time, date'2024-01-30' AS dt").write.partitionBy("dt").parquet(path)
    rows = canonical.orders(spark.read.parquet(path)).filter(
        inside("pay_time", cal.whole_day(date(2024, 1, 30))) & (F.col("dt") == F.lit(date(2024, 1, 30)))
    ).select("shop_id")
    assert rows.count() == 1
    scan = next(line for line in rows._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in line)
    assert "GreaterThanOrEqual(pay_time,2024-01-30" in scan and "(dt#" in scan.split("PartitionFilters")[1]
    assert "ReadSchema: struct<shop_id:bigint,pay_time:timestamp>" in scan


def test_raw_app_log_and_days_become_typed(spark):
    raw = spark.createDataFrame(
        [("12", "", "c", "enter", "1005", "e", "{}", "20240130"), ("ab", "4", "c", "enter", "1005", "e", None, "2024-01-30")],
        "prodid string, shopid string, cid string, action string, page_id string, event string, label string, dt string",
    )
    a, b = canonical.app_log(raw).collect()
    assert (a.prod_id, a.shop_id, a.dt) == (12, None, date(2024, 1, 30))
    assert (b.prod_id, b.shop_id, b.dt) == (None, 4, date(2024, 1, 30))


def test_ratio_below_zero_is_rounded_like_its_opposite(spark):
    assert one(spark, count_ratio(F.lit(-1).cast("bigint"), F.lit(3).cast("bigint"), 2)) == Decimal("-0.33")
    assert one(spark, count_ratio(F.lit(-1).cast("bigint"), F.lit(8).cast("bigint"), 2)) == Decimal("-0.13")
