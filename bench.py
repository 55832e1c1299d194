"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR is the folder of tables, BENCH_CPUS the local cores. Each query runs
once to warm the JVM up and then BENCH_RUNS times; the best run counts. Tables that
a job stores for the next one (the labeled feature table, fitted models) are timed
where they are built: d16_labeled_features and learners_fit.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from liftwise.plans import catalog, inputs, learner_queries  # noqa: E402
from liftwise.session import local_session  # noqa: E402

HEADLINE = [
    "d1_transaction_rollup",
    "d15_client_features",
    "d16_labeled_features",
    "f7_running_totals",
    "g1_stratified_split",
    "g6_permute_column",
    "i9_batch_score",
    "j9_uplift_metrics",
    "k1_decile_edges",
    "k5_drift_report",
    "l2_bucket_quantiles",
    "m3_tumbling_metrics",
]


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session("bench", cores)
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").count()

    def drain(name: str) -> None:
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    inputs.labeled(spark, folder)  # stores the feature table
    took = {"learners_fit": timed(lambda: learner_queries.compare(spark, folder))}
    for name in HEADLINE:
        drain(name)
        took[name] = min(timed(lambda n=name: drain(n)) for _ in range(runs))
    took = {name: round(seconds, 3) for name, seconds in took.items()}
    features = took["d16_labeled_features"]
    print(
        json.dumps(
            {
                "metric": "uplift_headline_total",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": Path(folder).name.removeprefix("sf"),
                "cores": cores,
                "lineitem_rows": lines,
                "feature_rows_per_sec": round(lines / features),
            }
        )
    )


if __name__ == "__main__":
    main()
