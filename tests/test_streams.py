import json
import os
from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from stallmetrics.plans.merchant import hourly_gmv
from stallmetrics.registry import TODAY
from stallmetrics.sources import schemas
from stallmetrics.sources.retail_binding import RetailTables
from stallmetrics.streaming import change_log, hourly, into_table

FOLDER = "/root/testdata/sf0.001"


def test_bad_change_records_are_kept_apart(spark, tmp_path):
    good = [json.dumps({"id": i, "username": f"u{i}"}) for i in range(5)]
    bad = ['{"id": 1, "user', "", "[1,2", "no json"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(good + bad) + "\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    parsed = change_log.parse_changes(stream, schemas.USER)
    run = into_table.stream_to_parquet(parsed, str(tmp_path / "out"), str(tmp_path / "cp"))
    run.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == len(good) + len(bad)
    assert sorted(r.id for r in rows if r.bad_record is None) == [0, 1, 2, 3, 4]
    assert sorted(r.bad_record for r in rows if r.bad_record is not None) == sorted(bad)


def test_null_value_is_bad(spark):
    df = spark.createDataFrame([(None,)], "value string")
    assert change_log.parse_changes(df, schemas.USER).first().bad_record == ""


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = spark.range(10)
    for _ in range(2):
        into_table._write_batch(str(tmp_path / "t"), rows, 3)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 10


def test_hourly_stream_in_shuffled_batches_equals_the_batch_report(spark, tmp_path):
    tables = RetailTables(spark, FOLDER)
    orders = tables.orders.select("order_id", "shop_id", "is_paid", "pay_time", "actual_total")
    orders.orderBy(F.rand(7)).repartition(6).write.parquet(str(tmp_path / "orders"))
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "orders"))
    run = into_table.stream_to_parquet(
        hourly.hourly_stream(stream, "40 days"), str(tmp_path / "updates"), str(tmp_path / "cp"), mode="update"
    )
    run.awaitTermination()
    updates = spark.read.parquet(str(tmp_path / "updates"))
    assert updates.select(into_table.BATCH).distinct().count() == 3
    got = hourly.hourly_report(updates, date(2024, 1, 30))
    expected = hourly_gmv(tables.orders, TODAY).select(*got.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def _feed(spark, folder, name, values):
    spark.createDataFrame([(v, None if v % 5 == 0 else f"t{v}") for v in values], "id long, more string").coalesce(1).write.parquet(str(folder / name))


def _once(spark, folder, checkpoint):
    stream = spark.readStream.schema("id long, more string").option("maxFilesPerTrigger", 1).parquet(str(folder / "in" / "*"))
    into_table.stream_once_to_parquet(stream, str(folder / "table"), str(folder / checkpoint)).awaitTermination()
    return Counter(r.id for r in into_table.read_once(spark, str(folder / "table")).collect())


def test_a_lost_checkpoint_repeats_nothing(spark, tmp_path):
    _feed(spark, tmp_path / "in", "a", [1, 1, 2, 5])
    _feed(spark, tmp_path / "in", "b", [1, 3])
    want = Counter([1, 1, 2, 5, 1, 3])
    assert _once(spark, tmp_path, "cp1") == want
    assert _once(spark, tmp_path, "cp1") == want
    # the source is read again from its start, with a new row of a known content
    _feed(spark, tmp_path / "in", "c", [1, 4])
    want += Counter([1, 4])
    assert _once(spark, tmp_path, "cp2") == want
    _feed(spark, tmp_path / "in", "d", [1, 2, 2])
    assert _once(spark, tmp_path, "cp2") == want + Counter([1, 2, 2])
    assert _once(spark, tmp_path, "cp3") == want + Counter([1, 2, 2])


def test_a_batch_that_stopped_between_ledger_and_rows(spark, tmp_path):
    path, rows = str(tmp_path / "t"), spark.createDataFrame([(7,), (7,), (8,)], "id long")
    into_table.commit_batch(path, rows, 0, "first")
    into_table.digested(spark.createDataFrame([(9,)], "id long")).groupBy("row_digest").agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/delivered/run_id=first/batch_id=1")
    into_table.commit_batch(path, rows.union(spark.createDataFrame([(9,)], "id long")), 0, "second")
    assert Counter(r.id for r in into_table.read_once(spark, path).collect()) == Counter([7, 7, 8, 9])
    for _ in range(2):
        into_table.commit_batch(path, spark.createDataFrame([(7,)], "id long"), 1, "second")
    assert Counter(r.id for r in into_table.read_once(spark, path).collect()) == Counter([7, 7, 7, 8, 9])


def test_the_state_of_a_day_does_not_grow_with_batches(spark, tmp_path):
    tables = RetailTables(spark, FOLDER)
    orders = tables.orders.select("order_id", "shop_id", "is_paid", "pay_time", "actual_total")
    orders.orderBy(F.rand(7)).repartition(9).write.parquet(str(tmp_path / "orders"))
    stream = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "orders"))
    state, day = str(tmp_path / "state"), date(2024, 1, 30)
    hourly.stream_state(hourly.hourly_stream(stream), state, str(tmp_path / "cp")).awaitTermination()
    held = hourly._versions(spark, state)
    assert len(held) > 20 and all(len(v) <= 2 for v in held.values()) and held[str(day)][-1][0] == 9
    got = hourly.hourly_report(hourly.read_state(spark, state, day), day)
    expected = hourly_gmv(tables.orders, TODAY).select(*got.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()
    assert all(f"order_day={day}" in f for f in hourly.read_state(spark, state, day).inputFiles())
    # the same rows through a fresh checkpoint
    hourly.stream_state(hourly.hourly_stream(stream), state, str(tmp_path / "cp2")).awaitTermination()
    again = hourly.hourly_report(hourly.read_state(spark, state, day), day)
    assert again.exceptAll(expected).isEmpty() and expected.exceptAll(again).isEmpty()
    assert hourly.read_state(spark, state, date(2020, 1, 1)).count() == 0


def test_an_unfinished_version_is_not_read(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-30 10:00:00", 1, 2, 3)], "t string, shop_id long, order_count long, a int").select(
        F.col("t").cast("timestamp").alias("hour_start"), "shop_id", "order_count", F.col("a").cast("decimal(18,2)").alias("pay_actual_total"))
    path, day = str(tmp_path / "s"), date(2024, 1, 30)
    hourly.fold_batch(path, rows, 0)
    hourly.fold_batch(path, rows.withColumn("order_count", F.lit(9).cast("long")), 1)
    os.remove(f"{path}/version=2/_SUCCESS")
    assert hourly.read_state(spark, path, day).first().order_count == 2
    hourly.fold_batch(path, rows.withColumn("order_count", F.lit(9).cast("long")), 1)
    assert hourly.read_state(spark, path, day).first().order_count == 9
    hourly.fold_batch(path, rows.limit(0), 2)
    assert hourly.read_state(spark, path, day).first().order_count == 9
