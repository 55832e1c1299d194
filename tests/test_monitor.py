"""Histograms, quantiles, alerts and streams."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from liftwise.operators import drift as dr
from liftwise.operators import monitor as mon
from liftwise.streaming import jobs

START = datetime(2024, 1, 1)
LOG = "request_id bigint, ts timestamp_ntz, caller string, seconds double, status int"


def log(spark, rows):
    return spark.createDataFrame(
        [(i, START + timedelta(seconds=s), c, d, st) for i, (s, c, d, st) in enumerate(rows)], LOG
    )


def quantile(spark, counts, q):
    rows = [(float(le), n) for le, n in counts]
    histogram = spark.createDataFrame(rows, "le double, count bigint")
    row = mon.bucket_quantile(histogram, q).first()
    return row and row["quantile"]


INF = float("inf")


@pytest.mark.parametrize(
    ("counts", "q", "want"),
    [
        ([(0.1, 10), (0.2, 20), (INF, 20)], 0.5, 0.1),
        ([(0.1, 10), (0.2, 20), (INF, 20)], 0.75, 0.15),
        ([(0.1, 0), (0.2, 20), (INF, 20)], 0.25, 0.125),
        ([(0.1, 10), (0.2, 20), (INF, 40)], 0.9, 0.2),  # open bucket: highest finite bound
        ([(-0.1, 10), (0.0, 20), (INF, 20)], 0.25, -0.1),  # lowest bucket not positive
        ([(0.1, 0), (INF, 0)], 0.5, None),
    ],
)
def test_bucket_quantile(spark, counts, q, want):
    got = quantile(spark, counts, q)
    assert got == (want if want is None else pytest.approx(want))


def test_buckets_are_cumulative_with_inclusive_bounds(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.5,), (9.0,)], "v double")
    got = {r["le"]: r["count"] for r in mon.bucket_counts(df, "v", (1, 2, 3)).collect()}
    assert got == {1.0: 1, 2.0: 2, 3.0: 3, INF: 4}


def test_alerts(spark):
    rows = [(s, "a", 3.0 if s < 300 else 0.01, 500 if s % 60 == 0 else 200) for s in range(0, 900, 10)]
    df = log(spark, rows)
    slow = {r["window_start"].minute: r["firing"] for r in mon.latency_alert(df).collect()}
    assert slow == {0: True, 5: False, 10: False}
    mixed = log(spark, [*rows, *[(s, "b", 0.01, 204) for s in range(0, 300, 1) for _ in range(20)]])
    pooled = mon.latency_alert(mixed).where("firing").count()
    by_series = mon.latency_alert(mixed, by=["status"]).where("firing").count()
    assert (pooled, by_series) == (0, 1)
    failed = {r["window_start"].minute: (r["errors"], r["firing"]) for r in mon.error_alert(df).collect()}
    assert failed == {0: (5, False), 5: (5, False), 10: (5, False)}
    assert mon.error_alert(df, limit=4).where("firing").count() == 3


def write_in_order(spark, parts, folder):
    """One file per part, in arrival order."""
    for rows in parts:
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_are_dropped_and_open_windows_wait(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    first = [(1, at(10), "a", 1.0, 200), (2, at(400), "a", 3.0, 500), (3, at(2000), "a", 1.0, 200)]
    between = [(6, at(2100), "a", 1.0, 200)]
    # Row 4 is behind the watermark (2000 - 600 s) and its window is out: dropped.
    late = [(4, at(20), "a", 9.0, 200), (5, at(1600), "a", 5.0, 200)]
    write_in_order(spark, [first, between, late], f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    stream = jobs.file_stream(spark, f"{tmp_path}/in", schema, files_per_trigger=1)
    closed = jobs.request_metrics(stream, "5 minutes", ["caller"], "10 minutes")
    jobs.append_table(closed, f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    rows = spark.read.parquet(f"{tmp_path}/out").orderBy("window_start").collect()
    got = [(r["window_start"].minute, r["requests"], r["mean_seconds"], r["errors"]) for r in rows]
    assert got == [(0, 1, 1.0, 0), (5, 1, 3.0, 1)]
    batch = jobs.request_metrics(spark.read.parquet(f"{tmp_path}/in"), "5 minutes", [], "0 seconds")
    assert batch.agg(F.sum("requests")).first()[0] == 6


def test_batch_written_twice_counts_once(spark, tmp_path):
    df = spark.range(5)
    for _ in range(2):
        jobs.replace_batch(df, f"{tmp_path}/t", 3)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5


def test_metrics_match_between_tumbling_and_sliding(spark):
    df = log(spark, [(s, "a", 1.0, 200) for s in range(0, 600, 30)])
    slid = jobs.request_metrics(df, "5 minutes", [], "0 seconds", "1 minute")
    assert slid.agg(F.sum("requests")).first()[0] == 5 * 20
