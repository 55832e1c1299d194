"""Feature table checks and request validation."""

import pytest
from pyspark.sql import functions as F

from liftwise.functions.exprs import is_pinned
from liftwise.operators import quality
from liftwise.operators import requests as rq

GOOD = [("a", 0, 1, 45, 10.5), ("b", 1, 0, None, None), ("c", 1, 1, 30, 3.0)]
SCHEMA = "client_id string, treatment int, y int, age int, spend double"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(GOOD, SCHEMA)


def test_sound_table(table):
    assert quality.require_feature_table(table) == ["age", "spend"]
    assert quality.check_feature_table(table).count() == 0


BAD = [
    (lambda d: d.drop("y"), "missing_column", "y"),
    (lambda d: d.withColumn("treatment", F.col("treatment") * 2), "not_binary", "treatment"),
    (lambda d: d.withColumn("y", F.when(F.col("client_id") != "b", F.col("y"))), "not_binary", "y"),
    (lambda d: d.withColumn("gender", F.lit("F")), "non_numeric", "gender"),
    (lambda d: d.withColumn("client_id", F.lit("a")), "duplicate_key", "a"),
    (lambda d: d.drop("age", "spend"), "no_features", ""),
]


@pytest.mark.parametrize(("change", "check", "subject"), BAD)
def test_bad_tables(table, change, check, subject):
    bad = change(table)
    with pytest.raises(ValueError, match=f"{check} x 1, first '{subject}'"):
        quality.require_feature_table(bad)
    rows = quality.check_feature_table(bad).collect()
    assert [(r["check"], r["subject"]) for r in rows] == [(check, subject)]


def test_all_faults_are_told_at_once(table):
    bad = table.unionByName(table).withColumn("y", F.lit(7)).withColumn("note", F.lit("x"))
    with pytest.raises(ValueError) as told:
        quality.require_feature_table(bad)
    parts = str(told.value).split("; ")
    assert len(parts) == 3 and "duplicate_key x 3, first 'a' (2)" in parts[0]


def test_missing_shards(spark):
    df = spark.createDataFrame([(0,), (2,), (2,)], "shard int")
    assert sorted(r["shard"] for r in quality.missing_shards(df, 4).collect()) == [1, 3]


def test_shard_domain():
    with pytest.raises(ValueError, match=r"shard must be in \[0, 4\), got 4"):
        quality.require_shard(4, 4)


URIS = {
    "models:/lift/3": True,
    "models:/lift/3/": True,
    "models:/lift/latest": False,
    "models:/lift@champion": False,
    "models:/lift/v3": False,
    "runs:/abc/model": True,
    "s3://bucket/model": True,
    "/opt/model": True,
}


def test_pinned(spark):
    df = spark.createDataFrame([(u,) for u in URIS], "uri string")
    got = {r["uri"]: r["p"] for r in df.select("uri", is_pinned(F.col("uri")).alias("p")).collect()}
    assert got == URIS
    for uri, pinned in URIS.items():
        if pinned:
            quality.assert_pinned(uri)
        else:
            with pytest.raises(RuntimeError, match="floating alias"):
                quality.assert_pinned(uri)


def checked(spark, records, **kwargs):
    df = spark.createDataFrame([(records,)], "records array<map<string,double>>")
    row = rq.validate_requests(df, ["x"], **kwargs).first()
    return row["reason"], row["detail"]


def test_request_reasons(spark):
    assert checked(spark, [{"x": 1.0}, {"x": 2.0}]) == (None, None)
    assert checked(spark, [])[0] == "batch_size"
    assert checked(spark, [{"x": 1.0}] * 1001)[0] == "batch_size"
    assert checked(spark, [{"x": 1.0}] * 1000)[0] is None
    assert checked(spark, [{}]) == (
        "feature_mismatch",
        "features do not match the model: ['missing x']",
    )
    assert checked(spark, [{"x": 1.0}, {"x": None}]) == (
        "all_null",
        "records with all features null: [1]",
    )


def test_unknown_features_are_listed_ten_at_most(spark):
    record = {"x": 1.0} | {f"k{i:02}": 1.0 for i in range(20)}
    shown = ", ".join(f"'unknown k{i:02}'" for i in range(10))
    assert checked(spark, [record])[1] == f"features do not match the model: [{shown}]"


def test_mismatch_comes_before_all_null(spark):
    assert checked(spark, [{"x": None}, {"y": 1.0}])[1] == (
        "features do not match the model: ['missing x', 'unknown y']"
    )


def test_positions_of_empty_records_are_listed_ten_at_most(spark):
    assert checked(spark, [{"x": None}] * 12)[1] == (
        "records with all features null: [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]"
    )
