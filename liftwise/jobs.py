"""The jobs of a campaign, in order, each reading what the one before stored.

    python -m liftwise.jobs ingest   --raw RAW --out STORE --num-shards 8
    python -m liftwise.jobs features --store STORE --out FEATURES --num-shards 8
    python -m liftwise.jobs shard 3  --store STORE --out PARTS --num-shards 8
    python -m liftwise.jobs merge    --store STORE --parts PARTS --out FEATURES --num-shards 8
    python -m liftwise.jobs train    --features FEATURES --models MODELS --runs RUNS
    python -m liftwise.jobs score    --features FEATURES --models MODELS --version 1 --out SCORES
    python -m liftwise.jobs sample   SCORES --out TEXT
    python -m liftwise.jobs scenario missing --features FEATURES --out BATCH
    python -m liftwise.jobs drift    REFERENCE BATCH --window missing --publish METRICS
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.functions.hashing import bucket
from liftwise.operators import drift as dr
from liftwise.operators import features as feat
from liftwise.operators import learners as ln
from liftwise.operators.evaluate import best_learner, curve_of, wide_curve
from liftwise.operators.perturb import SCENARIOS, make_scenario
from liftwise.operators.quality import require_feature_table, require_merge, require_shards
from liftwise.operators.score import score_clients
from liftwise.operators.split import (
    DRAW,
    SPLIT_SEED,
    stratified_sample,
    stratified_split,
)
from liftwise.schemas import KEY, OUTCOME, TREATMENT
from liftwise.session import small_partitions, tune
from liftwise.sources import store, tables

PROFILE = "reference_profile"


def ingest(spark: SparkSession, raw: str, out: str, num_shards: int) -> dict[str, int]:
    """Raw files to Parquet, unless the store has the same layout already."""
    counts: dict[str, int] = {}
    tables.run_if_stale(
        spark,
        f"{out}/purchases",
        num_shards,
        lambda: counts.update(tables.convert_tables(spark, raw, out, num_shards)),
    )
    return counts


def build_features(spark: SparkSession, store_dir: str, out: str, num_shards: int) -> None:
    """The labeled feature table; refuses to write one that lost or doubled clients, and to
    start from purchases that lost a shard or lines since they were written."""
    layout = tables.read_layout(spark, f"{store_dir}/purchases", num_shards)
    if layout["lines"] is not None:
        require_shards(tables.shard_lines(spark, f"{store_dir}/purchases"), layout["lines"])
    lines = spark.read.parquet(f"{store_dir}/purchases")
    clients = spark.read.parquet(f"{store_dir}/clients")
    labels = spark.read.parquet(f"{store_dir}/uplift_train")
    built = feat.client_features(clients, lines, layout["cutoff"])
    staged = tables.stage(feat.labeled_features(built, labels), out)
    require_merge(spark.read.parquet(staged), labels)
    tables.publish(spark, staged, out)


def build_shard(
    spark: SparkSession, store_dir: str, parts: str, shard: int, num_shards: int
) -> None:
    """The labeled features of one client shard. They replace that shard's partition of
    `parts` and no other; files of other shards' purchases are not opened."""
    purchases = f"{store_dir}/purchases"
    lines = tables.read_shard(spark, purchases, shard, num_shards)
    layout = tables.read_layout(spark, purchases, num_shards)
    if layout["lines"] is not None:
        require_shards({shard: lines.count()}, {shard: layout["lines"].get(shard, 0)})
    clients, labels = (
        spark.read.parquet(f"{store_dir}/{name}").where(bucket(F.col(KEY), num_shards) == shard)
        for name in ("clients", "uplift_train")
    )
    built = feat.labeled_features(feat.client_features(clients, lines, layout["cutoff"]), labels)
    tables.write_atomic(built.withColumn("shard", F.lit(shard)), parts, ["shard"])


def merge_shards(
    spark: SparkSession, store_dir: str, parts: str, out: str, num_shards: int
) -> None:
    """The shards' features as one table; an error names shards whose clients are not there."""
    labels = spark.read.parquet(f"{store_dir}/uplift_train")
    built = spark.read.parquet(parts)
    wanted = labels.select(bucket(F.col(KEY), num_shards).alias("shard")).distinct()
    there = built.select(F.col("shard").cast("int")).distinct()
    gone = sorted(r["shard"] for r in wanted.join(there, "shard", "left_anti").collect())
    if gone:
        raise ValueError(f"no features of shards {gone}; build them first")
    require_merge(built, labels)
    tables.write_atomic(built.drop("shard"), out)


def load_features(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A checked feature table with doubles, and its feature names."""
    table = spark.read.parquet(path)
    features = require_feature_table(table)
    return feat.training_frame(table.select(KEY, TREATMENT, OUTCOME, *features)), features


def train(
    spark: SparkSession,
    features_path: str,
    models: str,
    runs: str,
    kinds: Sequence[str] = ln.KINDS,
    seed: int = SPLIT_SEED,
    **settings,
) -> tuple[dict[str, float], int]:
    """Compare learners on one split, store the best by Qini; its metrics and version.

    Logs one parent run and one run per learner. The reference profile and the Qini
    curves are stored next to the version.
    """
    rows, features = load_features(spark, features_path)
    stamp = tables.fingerprint(rows, rows.columns).first()
    judged = ln.compare_learners(rows, features, kinds, seed, **settings)
    by_kind = {r["learner"]: r.asDict() for r in judged.metrics.collect()}  # one row per learner
    best = best_learner(judged.metrics, list(kinds)).first()["learner"]
    version = store.save_version(spark, judged.models[best], models)
    at = f"{models}/version={version}"

    curve = wide_curve(curve_of(judged.arms), list(kinds)).orderBy("fraction")
    curve.write.csv(f"{at}/qini_curves", header=True)
    split = stratified_split(rows, KEY, [TREATMENT, OUTCOME], seed=seed)
    best_scores = judged.scores.where(F.col("learner") == best)
    held_out = best_scores.select(F.col("score").alias(dr.SCORE))
    reference = dr.reference_profile(split.where("split = 'train'"), features, held_out)
    store.save_profile(reference, f"{at}/{PROFILE}")

    run = uuid.uuid4().hex
    dataset = {
        "features_path": features_path,
        "features_checksum": f"{stamp['rows']}-{stamp['sum_a']}-{stamp['sum_b']}",
        "n_rows": stamp["rows"],
        "n_features": len(features),
        "seed": seed,
    }
    store.log_run(
        spark,
        runs,
        run,
        params={
            **dataset,
            "learners": ",".join(kinds),
            "best_learner": best,
            "registered_version": version,
        },
        metrics={f"{k}_{m}": by_kind[k][m] for k in kinds for m in ("qini", "auuc")},
    )
    for kind in kinds:
        measured = {m: v for m, v in by_kind[kind].items() if m != "learner"}
        store.log_run(spark, runs, f"{run}-{kind}", kind, run, {**dataset, "learner": kind}, measured)
    wanted = ("qini", "auuc", "ate", "mean_uplift")
    return {m: by_kind[best][m] for m in wanted}, version


def score(
    spark: SparkSession,
    features_path: str,
    models: str,
    version: int | str,
    out: str,
    seed: int = SPLIT_SEED,
) -> None:
    """Score every client with a stored version, best first, held-out clients marked."""
    model = store.load_version(spark, models, version)
    rows, _ = load_features(spark, features_path)
    split = stratified_split(rows, KEY, [TREATMENT, OUTCOME], seed=seed)
    tables.write_atomic(score_clients(split, model), out)


def sample(spark: SparkSession, scores: str, out: str, n: int = 20_000, seed: int = 42) -> None:
    """About n held-out scores with the mix of arms and outcomes kept, as sorted text."""
    rows = spark.read.parquet(scores)
    if "split" in rows.columns:
        rows = rows.where("split = 'test'")
    shown = [dr.SCORE, TREATMENT, OUTCOME]
    picked = stratified_sample(rows.select(KEY, *shown), KEY, [TREATMENT, OUTCOME], n, seed)
    tables.export_csv(picked, out, dr.SCORE, KEY, shown)


def scenario(
    spark: SparkSession,
    name: str,
    features_path: str,
    out: str,
    n: int = 20_000,
    seed: int = 0,
    strength: float = 1.0,
    model: ln.UpliftModel | None = None,
) -> None:
    """A drifted batch drawn from the clients training held out, scored if a model is given."""
    rows, _ = load_features(spark, features_path)
    split = stratified_split(rows, KEY, [TREATMENT, OUTCOME])
    held_out = split.where("split = 'test'").drop("split")
    batch = make_scenario(held_out, KEY, name, n, seed, strength)
    tables.write_atomic(model.transform(batch) if model else batch, out)


def load_reference(
    spark: SparkSession, reference: str, scores: str | None = None
) -> tuple[DataFrame, list[str]]:
    """A stored profile, or the profile of a feature table's training rows; with a score
    table, the held-out uplift is profiled too."""
    if reference.rstrip("/").endswith(PROFILE):
        profile = store.load_profile(spark, reference)
    else:
        rows, features = load_features(spark, reference)
        split = stratified_split(rows, KEY, [TREATMENT, OUTCOME])
        profile = dr.profile(split.where("split = 'train'"), features)
    if scores:
        held_out = spark.read.parquet(scores).where("split = 'test'").select(dr.SCORE)
        others = profile.where(F.col("column") != dr.SCORE)
        profile = others.unionByName(dr.profile(held_out, [dr.SCORE]))
    return profile, [r["column"] for r in profile.select("column").collect()]


def drift(
    spark: SparkSession,
    reference: str,
    batch: str,
    window: str = "batch",
    scores: str | None = None,
    publish: str | None = None,
    key: str = DRAW,
) -> DataFrame:
    """The drift report of a stored batch, published under its window if asked."""
    profile, columns = load_reference(spark, reference, scores)
    report = dr.drift_report(profile, spark.read.parquet(batch), columns, key, window)
    if publish:
        store.publish_metrics(report, publish, window)
        return spark.read.parquet(publish).where(F.col("window") == window)
    return report


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    sub = parser.add_subparsers(dest="job", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--raw", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--num-shards", type=int, required=True)
    p = sub.add_parser("features")
    p.add_argument("--store", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--num-shards", type=int, required=True)
    p = sub.add_parser("shard")
    p.add_argument("shard", type=int)
    p.add_argument("--store", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--num-shards", type=int, required=True)
    p = sub.add_parser("merge")
    p.add_argument("--store", required=True)
    p.add_argument("--parts", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--num-shards", type=int, required=True)
    p = sub.add_parser("train")
    p.add_argument("--features", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--runs", required=True)
    p.add_argument("--learners", default=",".join(ln.KINDS))
    p.add_argument("--trees", type=int, default=ln.TREES)
    p = sub.add_parser("score")
    p.add_argument("--features", required=True)
    p.add_argument("--models", required=True)
    p.add_argument("--version", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("sample")
    p.add_argument("scores")
    p.add_argument("--out", required=True)
    p.add_argument("--rows", type=int, default=20_000)
    p.add_argument("--seed", type=int, default=42)
    p = sub.add_parser("scenario")
    p.add_argument("scenario", choices=SCENARIOS)
    p.add_argument("--features", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--n", type=int, default=20_000)
    p.add_argument("--seed", type=int, default=0)
    p.add_argument("--strength", type=float, default=1.0)
    p.add_argument("--models", help="score the batch with a version from here")
    p.add_argument("--version")
    p = sub.add_parser("drift")
    p.add_argument("reference", help=f"a stored {PROFILE} or a feature table")
    p.add_argument("batch")
    p.add_argument("--scores", help="score table whose held-out uplift is profiled")
    p.add_argument("--publish", metavar="TABLE")
    p.add_argument("--window", default="batch")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"liftwise-{args.job}").getOrCreate()
    small_partitions(tune(spark))
    if args.job == "ingest":
        for name, rows in ingest(spark, args.raw, args.out, args.num_shards).items():
            print(f"{name}: {rows:,} rows")
    elif args.job == "features":
        build_features(spark, args.store, args.out, args.num_shards)
    elif args.job == "shard":
        build_shard(spark, args.store, args.out, args.shard, args.num_shards)
    elif args.job == "merge":
        merge_shards(spark, args.store, args.parts, args.out, args.num_shards)
    elif args.job == "train":
        kinds = [k.strip() for k in args.learners.split(",")]
        print(train(spark, args.features, args.models, args.runs, kinds, trees=args.trees))
    elif args.job == "score":
        score(spark, args.features, args.models, args.version, args.out)
    elif args.job == "sample":
        sample(spark, args.scores, args.out, args.rows, args.seed)
    elif args.job == "scenario":
        model = store.load_version(spark, args.models, args.version) if args.models else None
        scenario(
            spark, args.scenario, args.features, args.out, args.n, args.seed, args.strength, model
        )
    else:
        report = drift(spark, args.reference, args.batch, args.window, args.scores, args.publish)
        report.orderBy(F.col("value").desc()).show(100, truncate=False)


if __name__ == "__main__":
    main()
