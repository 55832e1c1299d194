"""The plans of the heavy operators have the shape they need at scale."""

import re

import pytest
from parity import SMALLEST
from pyspark.sql import functions as F

from liftwise.operators import evaluate as ev
from liftwise.operators import features as feat
from liftwise.operators import rank, split
from liftwise.sources import star_schema as star


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def feature_plan(spark):
    lines = star.purchases(spark, SMALLEST)
    cutoff = feat.cutoff_value(lines)
    return plan(feat.client_features(star.clients(spark, SMALLEST), lines, cutoff))


def test_features_never_shuffle_lines_by_client_alone(feature_plan):
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", feature_plan)
    columns = [[c.strip().split("#")[0] for c in k.split(",")] for k in keys]
    assert ["client_id", "transaction_id"] in columns
    assert ["client_id", "product_id"] in columns
    assert any({"client_id", "month", "store"} <= set(keys) for keys in columns)


def test_features_hash_and_stay_in_the_jvm(feature_plan):
    assert "SortAggregate" not in feature_plan
    assert "ObjectHashAggregate" not in feature_plan
    assert "Python" not in feature_plan
    assert "SinglePartition" not in feature_plan


def test_history_filter_and_columns_reach_the_scan(feature_plan):
    orders = [s for s in feature_plan.split("FileScan") if "orders.parquet" in s]
    assert orders
    assert all("LessThan(o_orderdate" in s for s in orders)
    lines = [s for s in feature_plan.split("FileScan") if "lineitem.parquet" in s]
    assert all("l_shipdate" not in s.split("ReadSchema")[1] for s in lines)
    assert any(
        "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in s for s in lines
    )


def test_ranks_add_no_exchange_for_the_join(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).cast("double").alias("score"))
    shape = plan(rank.running_totals(df, "score", "id"))
    # Rows by slice, totals by slice, and the few totals in one place.
    assert shape.count("Exchange hashpartitioning") <= 3
    assert "BroadcastNestedLoop" not in shape


def test_split_does_not_shuffle_the_rows(spark):
    df = star.labels(spark, SMALLEST).select("client_id", F.col("target").alias("y"))
    wide = df.withColumn("wide", F.lit("x" * 100)).cache()
    shape = plan(split.stratified_split(wide, "client_id", ["y"]))
    assert "BroadcastHashJoin" in shape
    assert "Exchange hashpartitioning" not in shape.split("InMemoryRelation")[0]
    wide.unpersist()


def test_metrics_aggregate_ranks_once(spark):
    rows = [("m", i, float(i), i % 2, i % 3 % 2) for i in range(50)]
    scores = spark.createDataFrame(
        rows, "learner string, client_id int, score double, treatment int, y int"
    )
    shape = plan(ev.uplift_metrics(scores, "client_id"))
    assert shape.count("Window [row_number()") == 1


def test_ranks_stay_spread_and_are_never_broadcast(spark, many_slices):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 32)
    try:
        df = spark.range(400_000).select("id", F.xxhash64("id").cast("double").alias("score"))
        out = rank.running_totals(df, "score", "id", ["score"])
        parts = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        shape = plan(out)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(parts) == 32 and max(r["count"] for r in parts) < 1.5 * 400_000 / 32
    assert "BroadcastHashJoin" in shape and "BuildRight" in shape and "BuildLeft" not in shape


def test_tasks_of_large_shuffles_stay_small(spark):
    """Partitions grow in number with the rows, not in size; few rows are merged to few tasks."""
    from liftwise.plans.registry import QUERIES, query
    from liftwise.session import PARTITIONS

    kept = {key: spark.conf.get(key, None) for key in PARTITIONS}
    for key in PARTITIONS:
        spark.conf.unset(key)
    seen = {}

    def pairs(spark, folder):
        seen.update({key: spark.conf.get(key, None) for key in PARTITIONS})
        return spark.range(200_000).groupBy((F.col("id") % 100_000).alias("k")).agg(F.max("id").alias("v"))

    try:
        query("_pairs")(pairs)
        shape = plan(QUERIES["_pairs"](spark, SMALLEST))
        few = QUERIES["_pairs"](spark, SMALLEST).where("k < 10").rdd.getNumPartitions()
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m")
        QUERIES["_pairs"](spark, SMALLEST)
    finally:
        del QUERIES["_pairs"]
        for key, value in kept.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\)", shape) == ["1000"] and few <= 8
    assert seen["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "8m"  # the session's own value holds
