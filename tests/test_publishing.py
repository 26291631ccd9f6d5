"""Publishing: the old slice or the new one, whatever happens between."""

import glob
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from stallmetrics.session import folders
from stallmetrics.sinks import publishing, rules

DAY = date(2024, 3, 31)


@pytest.fixture
def table(spark):
    name = f"slices_{os.urandom(4).hex()}"
    rows = [(d, "old") for d in ("2024-02-28", "2024-03-01", "2024-03-30", "2024-03-31")]
    frame(spark, *rows).select("mark", "stat_date").write.partitionBy("stat_date").saveAsTable(name)
    yield name
    spark.sql(f"DROP TABLE {name}")


def frame(spark, *rows):
    return spark.createDataFrame([(date.fromisoformat(d), m) for d, m in rows], "stat_date date, mark string")


def content(spark, name):
    return sorted((str(r.stat_date), r.mark) for r in spark.table(name).collect())


OLD = [("2024-02-28", "old"), ("2024-03-01", "old"), ("2024-03-30", "old"), ("2024-03-31", "old")]
NEXT = [("2024-03-01", "old"), ("2024-03-30", "old"), ("2024-03-31", "new")]


def test_a_run_that_stops_before_the_switch_shows_the_old_slice(spark, table):
    gone, new = rules.rolling_month_slice(DAY), frame(spark, ("2024-03-31", "new"))
    assert publishing.stage(new, table, gone)
    assert content(spark, table) == OLD
    publishing.finish(spark, table)
    assert content(spark, table) == NEXT
    publishing.finish(spark, table)
    assert content(spark, table) == NEXT


def test_a_run_that_stops_within_the_switch_is_finished_by_the_next(spark, table, monkeypatch):
    gone, new = rules.rolling_month_slice(DAY), frame(spark, ("2024-03-31", "new"))
    ran, sql = [], type(spark).sql

    def failing(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE") and "DROP" in text:
            raise RuntimeError("stopped")
        ran.append(text)
        return sql(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", failing)
    with pytest.raises(RuntimeError):
        publishing.publish(new, table, gone)
    monkeypatch.undo()
    # the day is switched as a whole, the day to be dropped is still whole
    assert content(spark, table) == [OLD[0], *NEXT]
    publishing.publish(frame(spark, ("2024-03-31", "newer")), table, gone)
    assert content(spark, table) == [*NEXT[:2], ("2024-03-31", "newer")]


def test_an_incomplete_manifest_is_thrown_away(spark, table):
    version = publishing.stage(frame(spark, ("2024-03-31", "new")), table, rules.rolling_month_slice(DAY))
    root = publishing._root(spark, table).removeprefix("file:")
    os.remove(f"{root}/_pending/{version}/_SUCCESS")
    publishing.finish(spark, table)
    assert content(spark, table) == OLD and not os.path.exists(f"{root}/_versions/{version}") and not os.listdir(f"{root}/_pending")


def test_a_reader_keeps_the_files_it_planned_with(spark, table):
    gone = rules.stat_date_slice(DAY)
    publishing.publish(frame(spark, ("2024-03-31", "one")), table, gone)
    reader = spark.table(table).filter("stat_date = '2024-03-31'")
    files = set(reader.inputFiles())
    publishing.publish(frame(spark, ("2024-03-31", "two")), table, gone)
    assert all(os.path.exists(f.removeprefix("file://")) for f in files)
    for mark in ("three", "four"):
        publishing.publish(frame(spark, ("2024-03-31", mark)), table, gone)
    # superseded versions go once nobody who read before the last switch can need them
    assert len(folders(spark, f"{publishing._root(spark, table)}/_versions")) <= 2
    assert content(spark, table)[-1] == ("2024-03-31", "four")


def test_retention_reads_no_rows(spark, table):
    root = publishing._root(spark, table).removeprefix("file:")
    for path in glob.glob(f"{root}/stat_date=*/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"no parquet")
    spark.catalog.refreshTable(table)
    publishing.publish(frame(spark, ("2024-03-31", "new")), table, rules.keep_only_new_slice())
    assert content(spark, table) == [("2024-03-31", "new")]


def test_an_empty_slice_drops_its_partitions(spark, table):
    publishing.publish(frame(spark, ("2024-03-31", "x")).limit(0), table, rules.rolling_month_slice(DAY))
    assert content(spark, table) == [("2024-03-01", "old"), ("2024-03-30", "old")]
    publishing.publish(frame(spark, ("2024-03-31", "x")).limit(0), table, F.lit(True), skip_empty=True)
    assert len(content(spark, table)) == 2


def test_odd_partition_names(spark, tmp_path):
    odd = ["a'b", "a\\b", "x/y=z", "50%", "a+b c", "größe", None]
    rows = spark.createDataFrame([(i, v, i % 2) for i, v in enumerate(odd)], "n int, tag string, kind int")
    rows.write.partitionBy("tag", "kind").option("path", str(tmp_path / "odd")).saveAsTable("odd_names")
    try:
        assert {r.tag for r in publishing.partitions(spark, "odd_names").collect()} == set(odd)
        again = rows.withColumn("n", F.col("n") + 10)
        publishing.publish(again, "odd_names", F.lit(True))
        assert {(r.n, r.tag, r.kind) for r in spark.table("odd_names").collect()} == {(i + 10, v, i % 2) for i, v in enumerate(odd)}
        publishing.publish(again.filter("kind = 1"), "odd_names", F.lit(True))
        assert {r.n for r in spark.table("odd_names").collect()} == {11, 13, 15}
    finally:
        spark.sql("DROP TABLE odd_names")
