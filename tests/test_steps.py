import os

from pyspark.sql import Window
from pyspark.sql import functions as F

from stallmetrics.operators import shaping
from stallmetrics.operators.catalog import first_per_key
from stallmetrics.operators.ranking import rank_in_group
from stallmetrics.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_rank_in_group_equals_row_number(spark):
    """One group holds most rows; values mix heavy ties, zeros, cents and large numbers."""
    ids = spark.range(60000).withColumn("g", F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 11))
    value = (
        F.when(F.col("id") % 5 == 0, F.lit(0)).when(F.col("id") % 5 == 1, F.lit(19.99))
        .when(F.col("id") % 5 == 2, F.pow(F.lit(1.0007), F.col("id") % 20000)).otherwise(F.hash("id") % 1000 + 1000)
    )
    # keys beyond what a double can hold exactly
    df = ids.select("g", (F.col("id") * 7919 % 1000003 + 2**60).alias("k"), value.cast("decimal(18,2)").alias("v"))
    expected = df.withColumn("r", F.row_number().over(Window.partitionBy("g").orderBy(F.desc("v"), "k")))
    got = rank_in_group(df, ["g"], "v", "k", "r")
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_rank_shuffles_its_input_once(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("k"), (F.col("id") % 13).alias("v"))
    ranked = rank_in_group(df, ["g"], "v", "k")
    ranked.collect()
    assert "ReusedExchange" in ranked._jdf.queryExecution().executedPlan().toString()


def test_order_lines_are_shuffled_once_in_the_full_analysis(spark):
    df = QUERIES["merchant_product_analysis_30"](spark, FOLDER)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan.split("== Initial Plan ==")[0]


def test_first_per_key_keeps_one_row_per_task_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = first_per_key(df, ["k"], F.desc("id"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_stack_measures_fills_and_sums(spark):
    a = spark.createDataFrame([(1, 2), (1, 3), (2, None)], "k int, a int")
    b = spark.createDataFrame([(3, 7)], "k int, b int")
    assert {tuple(r) for r in shaping.stack_measures(["k"], a, b).collect()} == {(1, 5, 0), (2, 0, 0), (3, 0, 7)}


def test_status_fanout(spark):
    df = spark.createDataFrame([(i,) for i in (-2, -1, 0, 1, 2, 3, 4)] + [(None,)], "status int")
    got = {(r.status, r.status_filter) for r in shaping.status_fanout(df).collect()}
    assert got == {(0, "0"), (0, "2"), (1, "0"), (1, "1"), (2, "0"), (3, "0"), (3, "3"), (4, "0")}


def test_drop_all_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 2)], "expose int, pay_num int")
    assert shaping.drop_all_zero(df).count() == 2
    assert shaping.drop_all_zero(df, shaping.MEASURES_WITHOUT_EXPOSURE).count() == 1


def test_invariants_of_the_analysis(spark):
    if not os.path.isdir(FOLDER):
        return
    df = QUERIES["merchant_product_analysis_30"](spark, FOLDER).cache()
    key = ["prod_id", "shop_id"]
    everything = df.filter("status_filter = '0'").select(*key)
    assert df.filter("status_filter <> '0'").select(*key).exceptAll(
        df.filter("status_filter <> '0'").join(everything, key, "left_semi").select(*key)
    ).isEmpty()
    assert df.filter("pay_num > place_order_num OR pay_person > place_order_person OR refund_success_num > refund_num").isEmpty()
    assert df.groupBy(*key, "status_filter").count().filter("count > 1").isEmpty()
    df.unpersist()


def test_reason_shares_add_up(spark):
    df = QUERIES["refund_reason_rank"](spark, FOLDER).groupBy("shop_id").agg(F.sum("percent_amount").alias("s"))
    assert df.filter((F.col("s") < 99) | (F.col("s") > 101)).isEmpty()
