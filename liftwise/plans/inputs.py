"""Tables several queries start from.

The labeled feature table and the tables derived from it are written once per
session to the shared folder, as the jobs that follow a feature build read it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.functions.exprs import bounded_label
from liftwise.functions.hashing import uniform
from liftwise.operators import features as feat
from liftwise.operators.evaluate import long_scores
from liftwise.operators.monitor import PATHS
from liftwise.operators.perturb import make_scenario
from liftwise.operators.split import stratified_split
from liftwise.schemas import KEY, OUTCOME, TREATMENT
from liftwise.session import scratch
from liftwise.sources import star_schema as star

_stored: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, folder: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """A table written on first use in this application, then read back."""
    at = (spark.sparkContext.applicationId, folder, name)
    if at not in _stored:
        path = scratch(spark, name)
        build().write.parquet(path)
        _stored[at] = path
    return spark.read.parquet(_stored[at])


def features(spark: SparkSession, folder: str) -> DataFrame:
    cutoff = star.last_purchase(spark, folder)
    return feat.client_features(star.clients(spark, folder), star.purchases(spark, folder), cutoff)


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    """The labeled feature table with its split mark."""

    def build() -> DataFrame:
        table = feat.labeled_features(features(spark, folder), star.labels(spark, folder))
        return stratified_split(feat.training_frame(table), KEY, [TREATMENT, OUTCOME])

    return stored(spark, folder, "labeled", build)


def held_out(spark: SparkSession, folder: str) -> DataFrame:
    return labeled(spark, folder).where("split = 'test'").drop("split")


def training(spark: SparkSession, folder: str) -> DataFrame:
    return labeled(spark, folder).where("split = 'train'").drop("split")


SCENARIO_SEED = 11


def scenario(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """As many held-out rows as there are, drawn with replacement, and one thing broken."""

    def build() -> DataFrame:
        rows = held_out(spark, folder)
        return make_scenario(rows, KEY, name, rows.count(), SCENARIO_SEED)

    return stored(spark, folder, f"scenario_{name}", build)


# Deterministic scores with an SQL twin, for everything that ranks.
SCORES = {"hashed": "score_hashed", "tied": "score_tied", "balance": "score_balance"}


def wide_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Three scores per labeled client; `tied` takes eleven values only."""
    key = F.col(KEY)
    balances = star.table(spark, folder, "customer").select(
        F.col("c_custkey").alias(KEY), F.col("c_acctbal").alias("score_balance")
    )
    return (
        star.labels(spark, folder)
        .select(
            KEY,
            F.col("treatment_flg").cast("int").alias(TREATMENT),
            F.col("target").cast("int").alias(OUTCOME),
            uniform(key, 7).alias("score_hashed"),
            F.round(uniform(key, 8), 1).alias("score_tied"),
        )
        .join(balances, KEY)
    )


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return long_scores(wide_scores(spark, folder), SCORES, KEY)


def as_requests(events: DataFrame) -> DataFrame:
    """Events as requests: time, caller, latency, records, status, path and reason."""
    kind = F.col("event_type")
    path = F.when(kind == "view", "/health").when(kind == "click", "/wp-login.php")
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.col("user_id").alias("caller"),
        (F.col("value") / 1000.0).alias("seconds"),
        (1 + F.get_json_object("props", "$.k").cast("int")).alias("records"),
        F.when(kind == "error", 500).when(kind == "signup", 422).otherwise(200).alias("status"),
        bounded_label(path.otherwise("/predict"), PATHS).alias("path"),
        F.when(kind == "signup", "feature_mismatch")
        .when(kind == "error", "model_error")
        .alias("reason"),
    )


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per request."""
    return as_requests(star.table(spark, folder, "events"))


def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """One row per prediction: time and predicted uplift, on both sides of zero."""
    events = star.table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        ((F.col("value") - 50.0) / 1000.0).alias("uplift"),
    )


REQUEST_FEATURES = ["age", "balance", "nation"]


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring requests built from customers: blocks of 40 records, and of every 4,000
    customers one oversized block of 1,200. Some records lack a feature, carry an
    unknown one or have no value at all."""
    c = F.col("c_custkey")
    block = F.when(
        c % 4000 < 1200, F.concat(F.lit("big-"), F.floor(c / 4000).cast("string"))
    ).otherwise(F.concat(F.lit("r-"), F.floor(c / 40).cast("string")))
    request = F.floor(c / 40)
    no_value = request % 3 == 1
    empty = no_value & (c % 9 == 0)

    def entry(name: str, value: Column) -> Column:
        shown = F.when(~empty, value.cast("double"))
        return F.struct(F.lit(name).alias("key"), shown.alias("value"))

    age = F.when(~((request % 3 == 2) & (c % 13 == 0)), entry("age", 10 + c % 95))
    extra = F.when(
        (request % 6 == 5) & (c % 7 == 0),
        F.struct(
            F.concat(F.lit("k"), (c % 17).cast("string")).alias("key"),
            F.lit(1.0).alias("value"),
        ),
    )
    fields = F.filter(
        F.array(age, entry("balance", F.col("c_acctbal")), entry("nation", F.col("c_nationkey")), extra),
        lambda e: e.isNotNull(),
    )
    customers = star.table(spark, folder, "customer")
    record = F.struct(c.alias("at"), fields.alias("fields"))
    # A block never has more than 1,200 records, whatever the table size.
    blocks = customers.groupBy(block.alias("request")).agg(
        F.array_sort(F.collect_list(record)).alias("r")
    )
    maps = F.transform("r.fields", F.map_from_entries)
    return blocks.select("request", maps.alias("records"))
