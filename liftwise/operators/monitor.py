"""Service monitoring over request and prediction logs: histograms, rates, alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bucket bounds, known paths and alert limits.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10)
RECORD_BOUNDS = (1, 10, 50, 100, 250, 500, 1000)
UPLIFT_BOUNDS = (-0.1, -0.05, -0.02, -0.01, 0, 0.01, 0.02, 0.05, 0.1, 0.2)
PATHS = ("/predict", "/ready", "/health", "/metrics")
P99_LIMIT_SECONDS = 1.0
SERVER_ERRORS_LIMIT = 5
ALERT_WINDOW = "5 minutes"

INFINITY = float("inf")


def _bound_at_or_above(value: Column, bounds: Sequence[float]) -> Column:
    """The lowest bound that is not below the value; infinity beyond the last."""
    out = F.lit(INFINITY)
    for bound in reversed(bounds):
        out = F.when(value <= F.lit(float(bound)), F.lit(float(bound))).otherwise(out)
    return out


def bucket_counts(
    df: DataFrame, column: str, bounds: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Cumulative histogram: (by, le, count) with every bound and infinity present.

    Rows are counted once, in their own bucket; running sums over the handful of
    buckets of each label set make them cumulative.
    """
    by = list(by)
    own = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, _bound_at_or_above(F.col(column), bounds).alias("le"))
        .agg(F.count(F.lit(1)).alias("own"))
    )
    ladder = F.array(*[F.lit(float(b)) for b in bounds], F.lit(INFINITY))
    empty = own.select(*by).distinct() if by else own.agg(F.count(F.lit(1)))
    every = empty.select(*by, F.explode(ladder).alias("le"), F.lit(0).cast("bigint").alias("own"))
    dense = own.unionByName(every).groupBy(*by, "le").agg(F.sum("own").alias("own"))
    so_far = Window.partitionBy(*by).orderBy("le")
    return dense.select(*by, "le", F.sum("own").over(so_far).alias("count"))


def bucket_quantile(histogram: DataFrame, q: float, by: Sequence[str] = ()) -> DataFrame:
    """(by, quantile): linear inside the bucket that reaches q of the count.

    The lowest bucket starts at 0, or is its own bound when that is not positive; in
    the open top bucket the answer is the highest finite bound.
    """
    by = list(by)
    ordered = Window.partitionBy(*by).orderBy("le")
    group = Window.partitionBy(*by)
    steps = histogram.select(
        *by,
        "le",
        "count",
        F.lag("le").over(ordered).alias("_low"),
        F.coalesce(F.lag("count").over(ordered), F.lit(0)).alias("_before"),
        (F.max("count").over(group) * F.lit(float(q))).alias("_target"),
    )
    reached = steps.where((F.col("count") >= F.col("_target")) & (F.col("_target") > 0))
    first = reached.groupBy(*by).agg(
        F.min_by(F.struct("le", "count", "_low", "_before", "_target"), "le").alias("b")
    )
    c = F.col
    low = F.coalesce(c("b._low"), F.lit(0.0))
    inside = (c("b._target") - c("b._before")) / (c("b.count") - c("b._before"))
    value = (
        F.when(c("b.le") == F.lit(INFINITY), c("b._low"))
        .when(c("b._low").isNull() & (c("b.le") <= 0), c("b.le"))
        .otherwise(low + (c("b.le") - low) * inside)
    )
    return first.select(*by, value.alias("quantile"))


def _seconds(interval: str) -> int:
    """Length of '<n> seconds|minutes|hours|days'."""
    number, unit = interval.split()
    lengths = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(number) * lengths[unit.rstrip("s")]


def windowed(df: DataFrame, length: str, slide: str | None = None, ts: str = "ts") -> DataFrame:
    """Add `window_start` and `window_end`; a row is in several windows when they slide."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return df.withColumn("_window", w).select(
        *df.columns,
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
    )


def rate(
    df: DataFrame,
    length: str,
    by: Sequence[str] = (),
    slide: str | None = None,
    weight: Column | None = None,
) -> DataFrame:
    """(window_start, by, count, per_second) of rows, or of a summed weight."""
    amount = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return (
        windowed(df, length, slide)
        .groupBy("window_start", *by)
        .agg(amount.cast("bigint").alias("count"))
        .withColumn("per_second", F.col("count") / F.lit(float(_seconds(length))))
    )


def mean_per_window(df: DataFrame, column: str, length: str) -> DataFrame:
    """(window_start, count, mean) of a value."""
    return (
        windowed(df, length)
        .groupBy("window_start")
        .agg(F.count(column).alias("count"), F.avg(column).alias("mean"))
    )


def negative_share(df: DataFrame, column: str, length: str) -> DataFrame:
    """(window_start, share) of values at or below zero, the bucket bounded by 0."""
    return (
        windowed(df, length)
        .groupBy("window_start")
        .agg(F.avg((F.col(column) <= 0).cast("int")).alias("share"))
    )


def models_served(df: DataFrame) -> DataFrame:
    """(uri, served): 1 for each model URI some instance reports."""
    return df.groupBy("uri").agg(F.max("info").alias("served"))


def latency_alert(
    df: DataFrame,
    column: str = "seconds",
    length: str = ALERT_WINDOW,
    limit: float = P99_LIMIT_SECONDS,
    bounds: Sequence[float] = LATENCY_BOUNDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """(window_start, p99, firing) from per-window histograms, whose size does not
    depend on the traffic. With `by`, each series has its own p99 and the worst counts,
    so a slow series cannot hide behind fast ones."""
    keys = ["window_start", *by]
    histogram = bucket_counts(windowed(df, length), column, bounds, keys)
    worst = bucket_quantile(histogram, 0.99, keys).groupBy("window_start").agg(
        F.max("quantile").alias("p99")
    )
    return worst.withColumn("firing", F.col("p99") > limit)


def error_alert(
    df: DataFrame, length: str = ALERT_WINDOW, limit: int = SERVER_ERRORS_LIMIT
) -> DataFrame:
    """(window_start, errors, firing): windows with 5xx answers."""
    failed = df.where(F.col("status").between(500, 599))
    return (
        windowed(failed, length)
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("errors"))
        .withColumn("firing", F.col("errors") > limit)
    )


def dashboard_rows(published: DataFrame, windows: Sequence[str]) -> DataFrame:
    """Published drift metrics of the chosen windows, highest value first."""
    return published.where(F.col("window").isin(*windows)).orderBy(
        F.col("value").desc(), "window", "metric", "feature"
    )
