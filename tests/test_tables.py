"""Slice and retention rules, and the writers."""

from datetime import date, datetime

import pytest

from stallmetrics.sinks import rules, writers

DAY = date(2024, 3, 31)


def table(spark, *days, col="stat_date", mark="old"):
    return spark.createDataFrame([(date.fromisoformat(d), mark) for d in days], f"{col} date, mark string")


def left(df, col="stat_date"):
    return sorted((str(r[col]), r.mark) for r in df.collect())


def test_replace_stat_date(spark):
    old, new = table(spark, "2024-03-30", "2024-03-31"), table(spark, "2024-03-31", mark="new")
    once = rules.replace_stat_date(old, new, DAY)
    assert left(once) == [("2024-03-30", "old"), ("2024-03-31", "new")]
    assert left(rules.replace_stat_date(once, new, DAY)) == left(once)
    assert rules.replace_stat_date(old, new, DAY, delete=False).count() == 3


def test_empty_slice_is_cleared_unless_told_otherwise(spark):
    old, new = table(spark, "2024-03-31"), table(spark)
    gone = old.stat_date == DAY
    assert rules.replace_where(old, new, gone).count() == 0
    assert rules.replace_where(old, new, gone, skip_empty=True).count() == 1


def test_rolling_month_is_clamped(spark):
    old = table(spark, "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-31")
    got = rules.rolling_month(old, table(spark, "2024-03-31", mark="new"), DAY)
    assert left(got) == [("2024-03-01", "old"), ("2024-03-31", "new")]


@pytest.mark.parametrize("hour, kept", [(0, 1), (1, 1), (2, 2)])
def test_rolling_two_days(spark, hour, kept):
    old = table(spark, "2024-03-29", "2024-03-30", "2024-03-31")
    got = rules.rolling_two_days(old, table(spark, "2024-03-31", mark="new"), DAY, datetime(2024, 3, 31, hour))
    assert sum(r.mark == "old" for r in got.collect()) == kept


def test_replace_period(spark):
    old = spark.createDataFrame(
        [(DAY, "20240331", 1), (date(2024, 3, 25), "202413", 2), (date(2024, 3, 25), "202403", 3), (DAY, "202403", 4)],
        "stat_date date, date_time string, time_type int",
    )
    none = old.limit(0)
    assert rules.replace_period(old, none, DAY, "20240331", 1).count() == 3
    assert rules.replace_period(old, none, DAY, "202413", 2).count() == 3
    assert rules.replace_period(old, none, DAY, "202403", 3).count() == 3
    assert rules.replace_period(old, none, DAY, "202403", 4).count() == 3
    assert rules.replace_period(old, none, DAY, "x", 4).count() == 4


def test_replace_time_period(spark):
    old = spark.createDataFrame([(DAY, "7"), (date(2024, 1, 1), "7"), (DAY, "30"), (DAY, "q1")], "stat_date date, time_period string")
    none = old.limit(0)
    assert rules.replace_time_period(old, none, DAY, "7").count() == 2
    assert rules.replace_time_period(old, none, DAY, "q1").count() == 3
    assert rules.replace_time_period(old, none, DAY, "q2").count() == 4
    assert rules.replace_time_period(old, none, DAY, "q2", match_tag=False).count() == 1


def test_replace_all_or_month(spark):
    old, new = table(spark, "2024-02-29", "2024-03-01"), table(spark, "2024-03-31", mark="new")
    assert left(rules.replace_all_or_month(old, new, "30")) == [("2024-03-31", "new")]
    assert left(rules.replace_all_or_month(old, new, "202402")) == [("2024-03-01", "old"), ("2024-03-31", "new")]
    assert rules.analysis_table("product_analysis", "202402") == "product_analysis_202402"


def test_keep_only_new_and_current_day(spark):
    assert left(rules.keep_only_new(table(spark, "2024-03-31"), table(spark, "2024-03-30", mark="new"))) == [("2024-03-30", "new")]
    old = table(spark, "2024-03-30", "2024-03-31", col="current_day")
    got = rules.replace_current_day(old, table(spark, "2024-03-31", col="current_day", mark="new"), DAY)
    assert left(got, "current_day") == [("2024-03-30", "old"), ("2024-03-31", "new")]


def test_unique_key(spark):
    df = spark.createDataFrame([(1, 2, DAY, "0"), (1, 2, DAY, "1")], "prod_id long, shop_id long, stat_date date, status_filter string")
    rules.assert_unique_key(df)
    with pytest.raises(ValueError):
        rules.assert_unique_key(df.union(df))
    with pytest.raises(ValueError):
        rules.assert_unique_key(df.union(df.limit(1)), rules.PLATFORM_KEY)


def test_overwrite_slices_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_slices(table(spark, "2024-03-30", "2024-03-31"), path, ["stat_date"])
    for _ in range(2):
        writers.overwrite_slices(table(spark, "2024-03-31", mark="new"), path, ["stat_date"])
    assert left(spark.read.parquet(path)) == [("2024-03-30", "old"), ("2024-03-31", "new")]


def test_rewrite_parquet_reads_and_replaces_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    table(spark, "2024-02-01", "2024-03-31").write.parquet(path)
    for _ in range(2):
        writers.rewrite_parquet(rules.rolling_month(spark.read.parquet(path), table(spark, "2024-03-31", mark="new"), DAY), path)
    assert left(spark.read.parquet(path)) == [("2024-03-31", "new")]


def test_publish_replaces_its_slice_alone(spark):
    spark.sql("DROP TABLE IF EXISTS published")
    old = table(spark, "2024-02-28", "2024-03-01", "2024-03-30", "2024-03-31")
    old.select("mark", "stat_date").write.partitionBy("stat_date").saveAsTable("published")

    def files():
        return {p for p in spark.table("published").inputFiles() if "stat_date=2024-03-31" not in p}

    before = {p for p in files() if "2024-02-28" not in p}
    gone, new = rules.rolling_month_slice(DAY), table(spark, "2024-03-31", mark="new")
    for _ in range(2):
        writers.publish(new, "published", gone, ["stat_date"])
        spark.catalog.refreshTable("published")
        assert left(spark.table("published")) == [("2024-03-01", "old"), ("2024-03-30", "old"), ("2024-03-31", "new")]
        assert files() == before
    with pytest.raises(ValueError, match="not unique"):
        writers.publish(new.unionByName(new), "published", gone, ["stat_date"])
    with pytest.raises(ValueError, match="outside"):
        writers.publish(table(spark, "2024-03-30"), "published", gone)
    writers.publish(new.limit(0), "published", gone, skip_empty=True)
    assert spark.table("published").count() == 3
    writers.publish(new.limit(0), "published", gone)
    assert left(spark.table("published")) == [("2024-03-01", "old"), ("2024-03-30", "old")]
    spark.sql("DROP TABLE published")
