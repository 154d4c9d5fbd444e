"""Plan shapes that matter at scale."""

from pyspark.sql import functions as F

from tabspark.operators import metrics, profile, project, split
from tabspark.operators.outliers import outlier_mask
from tabspark.sources import fixtures as fx, io

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hash_split_needs_no_shuffle(spark):
    plan = physical(split.hash_split(fx.events_value(spark, SF)).filter("split = 'train'"))
    assert "Exchange" not in plan


def test_feature_union_is_one_projection(spark):
    df = io.read_table(spark, SF, "orders")
    plan = physical(project.feature_union(df, {"a": {"x": F.col("o_totalprice")}, "b": {"x": F.col("o_custkey")}}, ["o_orderkey"]))
    assert "Join" not in plan and "Exchange" not in plan


def test_outlier_flags_are_narrow(spark):
    df = fx.events_value(spark, SF)
    plan = physical(df.select("row_id", outlier_mask(df, "value").alias("flag")))
    assert "Exchange" not in plan and "Join" not in plan
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_profiles_read_only_their_columns(spark):
    plan = physical(profile.variance_table(fx.line_num(spark, SF), ["l_tax"]))
    assert "ReadSchema: struct<l_tax:double>" in plan and plan.count("Exchange SinglePartition") == 1


def test_metrics_combine_before_the_shuffle(spark):
    df = fx.scored(spark, SF).withColumn("yhat", F.lit(1))
    plan = physical(metrics.confusion_matrix(df, "y", "yhat"))
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 1


def test_filters_reach_the_scan(spark):
    plan = physical(project.keep_rows(io.read_table(spark, SF, "events"), F.col("value") > 100).select("event_id"))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,100" in plan
