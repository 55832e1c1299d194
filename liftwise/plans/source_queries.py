"""Queries over sources, sinks and layout: tables are written, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise import jobs
from liftwise.functions.hashing import bucket
from liftwise.operators.drift import drift_report, profile
from liftwise.operators.evaluate import qini_curve, wide_curve
from liftwise.operators.features import history_cutoff
from liftwise.plans import inputs
from liftwise.plans.registry import query
from liftwise.plans.sql import bucket as sql_bucket
from liftwise.plans.sql import long_values, profile_of, psi_of, with_
from liftwise.schemas import CLIENTS, FEATURES, KEY
from liftwise.session import scratch
from liftwise.sources import star_schema as star
from liftwise.sources import store, tables

SHARDS = 8
_NTZ = "yyyy-MM-dd HH:mm:ss"


def _raw(df: DataFrame, path: str) -> None:
    df.write.option("timestampNTZFormat", _NTZ).csv(path, header=True, compression="gzip")


_written: dict[tuple[str, str], str] = {}


def _partitioned(spark: SparkSession, folder: str) -> str:
    """The purchases by shard and month, written once per application."""
    at = (spark.sparkContext.applicationId, folder)
    if at not in _written:
        path = scratch(spark, "purchases")
        tables.write_partitioned(star.purchases(spark, folder), path, SHARDS)
        _written[at] = path
    return _written[at]


@query(
    "a1_read_typed_csv",
    with_("clients", "SELECT * REPLACE (CAST(client_id AS VARCHAR) AS client_id) FROM clients"),
)
def a1(spark, folder):
    path = scratch(spark, "a1")
    _raw(star.clients(spark, folder), path)
    return tables.read_typed_csv(spark, path, CLIENTS)


@query(
    "a2_convert_tables",
    with_(
        "lines",
        """
SELECT 'uplift_train' AS "table", count(*) AS "rows" FROM customer
UNION ALL SELECT 'clients', count(*) FROM customer
UNION ALL SELECT 'purchases', count(*) FROM lines
""",
    ),
)
def a2(spark, folder):
    raw, out = scratch(spark, "a2-raw"), scratch(spark, "a2")
    header = tables.RAW_TABLES["purchases"]
    names = [field.split()[0] for field in header.split(", ")]
    _raw(star.labels(spark, folder), f"{raw}/uplift_train.csv.gz")
    _raw(star.clients(spark, folder), f"{raw}/clients.csv.gz")
    _raw(star.purchases(spark, folder).select(*names), f"{raw}/purchases.csv.gz")
    counts = tables.convert_tables(spark, raw, out, SHARDS)
    return spark.createDataFrame(list(counts.items()), "table string, rows bigint")


@query(
    "a3_write_partitioned",
    with_(
        "lines",
        f"""
SELECT {sql_bucket("client_id", SHARDS)} AS shard,
  strftime(transaction_datetime, '%Y-%m') AS month, count(*) AS lines
FROM lines GROUP BY 1, 2
""",
    ),
)
def a3(spark, folder):
    written = spark.read.parquet(_partitioned(spark, folder))
    return written.groupBy("shard", "month").agg(F.count(F.lit(1)).alias("lines"))


@query("a4_history_cutoff", with_("cut", "SELECT cutoff FROM cut"))
def a4(spark, folder):
    return history_cutoff(star.purchases(spark, folder))


@query("a5_layout", with_("cut", f"SELECT CAST({SHARDS} AS BIGINT) AS num_shards, cutoff FROM cut"))
def a5(spark, folder):
    layout = tables.read_layout(spark, _partitioned(spark, folder), SHARDS)
    row = [(layout["num_shards"], layout["cutoff"])]
    return spark.createDataFrame(row, "num_shards bigint, cutoff timestamp_ntz")


@query(
    "a6_read_shard",
    with_(
        "lines",
        f"""
SELECT client_id, transaction_id, count(*) AS lines FROM lines
WHERE {sql_bucket("client_id", SHARDS)} = 3 GROUP BY 1, 2
""",
    ),
)
def a6(spark, folder):
    shard = tables.read_shard(spark, _partitioned(spark, folder), 3, SHARDS)
    return shard.groupBy(KEY, "transaction_id").agg(F.count(F.lit(1)).alias("lines"))


@query("a7_read_parts", with_("clients", "SELECT client_id, age, gender FROM clients"))
def a7(spark, folder):
    path = scratch(spark, "a7")
    placed = star.clients(spark, folder).withColumn("shard", bucket(F.col(KEY), 4))
    placed.write.partitionBy("shard").parquet(path)
    parts = [f"{path}/shard={k}" for k in range(4)]
    return tables.read_parts(spark, parts).select(KEY, "age", "gender")


@query(
    "a8_write_atomic",
    with_("clients", f"SELECT {sql_bucket('client_id', 4)} AS shard, count(*) AS clients "
                     "FROM clients GROUP BY 1"),
)
def a8(spark, folder):
    path = scratch(spark, "a8")
    placed = star.clients(spark, folder).withColumn("shard", bucket(F.col(KEY), 4))
    tables.write_atomic(placed, path, ["shard"])
    # Run one shard again: it replaces itself and leaves the others alone.
    tables.write_atomic(placed.where("shard = 1"), path, ["shard"])
    return spark.read.parquet(path).groupBy("shard").agg(F.count(F.lit(1)).alias("clients"))


@query("a14_rebuild_shard", with_("labeled", "SELECT * FROM labeled"))
def a14(spark, folder):
    """Features built shard by shard, one of them a second time, equal the full build."""
    at = scratch(spark, "a14")
    tables.write_partitioned(star.purchases(spark, folder), f"{at}/purchases", 3)
    star.clients(spark, folder).write.parquet(f"{at}/clients")
    star.labels(spark, folder).write.parquet(f"{at}/uplift_train")
    for shard in [*range(3), 1]:
        jobs.build_shard(spark, at, f"{at}/parts", shard, 3)
    jobs.merge_shards(spark, at, f"{at}/parts", f"{at}/features", 3)
    return spark.read.parquet(f"{at}/features")


@query("a9_projected_read", "SELECT o_orderkey, o_totalprice FROM orders")
def a9(spark, folder):
    return star.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")


@query(
    "a10_export_csv",
    with_(
        "wide_scores",
        "SELECT printf('%.5f', score_hashed) AS score_hashed, CAST(treatment AS VARCHAR) AS "
        "treatment, CAST(y AS VARCHAR) AS y FROM wide_scores",
    ),
)
def a10(spark, folder):
    path = scratch(spark, "a10")
    columns = ["score_hashed", "treatment", "y"]
    tables.export_csv(inputs.wide_scores(spark, folder), path, "score_hashed", KEY, columns)
    return spark.read.csv(path, header=True)


PROFILED = FEATURES
long_values("training_some", "training", PROFILED)
profile_of("training_some_profile", "training_some")


@query(
    "a11_profile_json",
    with_(
        "training_some_profile",
        'SELECT "column", CAST(bin AS INTEGER) AS bin, round(share, 9) AS share '
        "FROM training_some_profile",
    ),
)
def a11(spark, folder):
    path = scratch(spark, "a11")
    store.save_profile(profile(inputs.training(spark, folder), PROFILED), path)
    loaded = store.load_profile(spark, path)
    return loaded.select("column", F.posexplode("shares").alias("bin", "share")).select(
        "column", "bin", F.round("share", 9).alias("share")
    )


long_values("held_out_some", "held_out", PROFILED)
psi_of("psi_first", "training_some_profile", "training_some")
psi_of("psi_second", "training_some_profile", "held_out_some")


@query(
    "a12_publish_metrics",
    with_(
        "held_out training psi_first psi_second",
        """
SELECT 'first' AS "window", 'rows' AS metric, NULL AS feature, count(*)::DOUBLE AS value FROM training
UNION ALL SELECT 'second', 'rows', NULL, count(*)::DOUBLE FROM held_out
UNION ALL SELECT 'first', 'feature_psi', "column", round(psi, 9) FROM psi_first
UNION ALL SELECT 'second', 'feature_psi', "column", round(psi, 9) FROM psi_second
""",
    ),
)
def a12(spark, folder):
    path = scratch(spark, "a12")
    train, test = inputs.training(spark, folder), inputs.held_out(spark, folder)
    reference = profile(train, PROFILED)
    for window, batch in (("first", test), ("second", test), ("first", train)):
        # The last push replaces the first window and leaves the second alone.
        store.publish_metrics(drift_report(reference, batch, PROFILED, KEY, window), path, window)
    published = spark.read.parquet(path)
    return published.select("window", "metric", "feature", F.round("value", 9).alias("value"))


@query(
    "a13_curve_csv",
    with_(
        "curves",
        """
SELECT i, round(i::DOUBLE / n, 6) AS fraction,
  round(max(qini / abs(qini_last)) FILTER (WHERE learner = 'hashed'), 6) AS hashed,
  round(max(qini / abs(qini_last)) FILTER (WHERE learner = 'tied'), 6) AS tied,
  round(max(sign(qini_last) * i / n) FILTER (WHERE learner = 'hashed'), 6) AS random
FROM (SELECT learner, i, n, qini, qini_last FROM curves
  UNION ALL SELECT DISTINCT learner, 0, n, 0, qini_last FROM curves)
WHERE learner IN ('hashed', 'tied') AND i IN (SELECT CAST(round_even(k * (n / 100.0::DOUBLE), 0)
  AS BIGINT) FROM range(0, 101) AS r(k))
GROUP BY i, n
""".replace("SELECT i, round", "SELECT round"),
    ),
)
def a13(spark, folder):
    path = scratch(spark, "a13")
    learners = ["hashed", "tied"]
    scores = inputs.scores(spark, folder).where(F.col("learner").isin(*learners))
    curve = wide_curve(qini_curve(scores, KEY), learners).orderBy("fraction")
    curve.write.csv(path, header=True)
    back = spark.read.schema("fraction double, hashed double, tied double, random double").csv(
        path, header=True
    )
    return back.select(*[F.round(c, 6).alias(c) for c in back.columns])
