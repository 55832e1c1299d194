"""Distribution drift of client columns against a stored reference profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwise.functions.exprs import DRIFT_THRESHOLD
from liftwise.operators.evaluate import TOP_SHARE, top_lift
from liftwise.operators.rank import ranked
from liftwise.schemas import OUTCOME, TREATMENT
from liftwise.session import materialize

BINS = 10
MIN_SHARE = 1e-4
SCORE = "uplift"
# Rank error of the quantile sketch is 1/ACCURACY of the rows; MARGIN exceeds it.
ACCURACY = 1000
MARGIN = 0.003

# Status bands, each the first value of the next color.
PSI_BANDS = (0.1, 0.2)
LIFT_BANDS = (0.05, 0.1)


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column, value) of the listed columns in one pass; NaN counts as null."""
    doubles = [
        F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c)
        for c in columns
    ]
    return df.select(*by, *doubles).unpivot(list(by), list(columns), "column", "value")


def brackets(values: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, lows, highs): a narrow range of values around each quantile, from a
    mergeable sketch whose rank error is below the margin left on both sides."""
    lows = [max(p - MARGIN, 0.0) for p in probs]
    highs = [min(p + MARGIN, 1.0) for p in probs]
    n = len(probs)
    sketched = values.groupBy("column").agg(
        F.percentile_approx("value", lows + highs, ACCURACY).alias("q")
    )
    return sketched.select(
        "column", F.slice("q", 1, n).alias("lows"), F.slice("q", n + 1, n).alias("highs")
    )


def _bracketed_counts(present: DataFrame, ranges: DataFrame, n_ranges: int) -> DataFrame:
    """(column, value, outside, c): counts in value order from one pass.

    A value inside a range is counted as itself. All values between two ranges
    collapse into one count, placed right after the lower range.
    """
    value, spots = F.col("value"), range(n_ranges)
    low = [F.get("lows", F.lit(k)) for k in spots]
    high = [F.get("highs", F.lit(k)) for k in spots]
    inside = F.lit(False)
    below = F.lit(float("-inf"))
    for k in spots:
        inside = inside | value.between(low[k], high[k])
        below = F.when(value > high[k], high[k]).otherwise(below)
    # One row per column.
    placed = present.join(F.broadcast(ranges), "column").select(
        "column",
        F.when(inside, value).otherwise(below).alias("value"),
        (~inside).alias("outside"),
    )
    return placed.groupBy("column", "value", "outside").agg(F.count(F.lit(1)).alias("c"))


def _ranked_quantiles(counts: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, p, quantile, found) from counts per value, ranked globally."""
    order = [F.col("value").asc(), F.col("outside").asc()]
    spans = ranked(counts, order, by=["column"], sums=["c"]).select(
        "column",
        "value",
        "outside",
        (F.col("cum_c") - F.col("c")).alias("first"),
        F.col("cum_c").alias("after"),
        F.col("total_c").alias("n"),
    )
    grid = F.array(*[F.lit(float(p)) for p in probs])

    def covers(position: Column) -> Column:
        return (position >= F.col("first")) & (position < F.col("after"))

    def position(p: Column) -> Column:
        return (F.col("n") - 1) * p

    touched = F.filter(
        grid,
        lambda p: covers(F.floor(position(p))) | covers(F.ceil(position(p))),
    )
    hits = spans.where(F.size(touched) > 0).select("*", F.explode(touched).alias("p"))
    at = position(F.col("p"))
    low = F.max(F.when(covers(F.floor(at)), F.col("value")))
    high = F.max(F.when(covers(F.ceil(at)), F.col("value")))
    weight = F.max(at - F.floor(at))
    return hits.groupBy("column", "p").agg(
        (low + (high - low) * weight).alias("quantile"), (~F.bool_or("outside")).alias("found")
    )


def exact_quantiles(values: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(column, p, quantile) by linear interpolation between neighbors, exact at any size.

    A sketch narrows each quantile down to a small range of values; only values in a
    range are shuffled, combined and ranked, the others are just counted. Equal
    values combine first, so a value holding a large share of the rows is one row.
    Should a range miss its quantile, all values are ranked.
    """
    present = values.where(F.col("value").isNotNull())
    narrow = _bracketed_counts(present, brackets(present, probs), len(probs))
    out = materialize(_ranked_quantiles(narrow, probs))
    if out.where(~F.col("found")).limit(1).count():
        whole = present.groupBy("column", "value").agg(F.count(F.lit(1)).alias("c"))
        out = _ranked_quantiles(whole.withColumn("outside", F.lit(False)), probs)
    return out.select("column", "p", "quantile")


def edges(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(column, edges): the distinct inner quantiles, empty for an all-null column."""
    probs = [i * (1.0 / bins) for i in range(1, bins)]
    found = (
        exact_quantiles(long_values(df, columns), probs)
        .groupBy("column")
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))
    )
    spark = df.sparkSession
    named = spark.createDataFrame([(c,) for c in columns], "column string")
    none = F.array().cast("array<double>")
    return named.join(found, "column", "left").select(
        "column", F.coalesce("edges", none).alias("edges")
    )


def bin_of(value: Column, cuts: Column, at_most: int = BINS - 1) -> Column:
    """Number of edges at or below the value; null has the bin after the last."""
    passed = [
        F.coalesce((F.get(cuts, F.lit(k)) <= value).cast("int"), F.lit(0))
        for k in range(at_most)
    ]
    total = passed[0]
    for p in passed[1:]:
        total = total + p
    return F.when(value.isNull(), F.size(cuts) + 1).otherwise(total)


def bin_counts(
    df: DataFrame,
    cuts: DataFrame,
    columns: Sequence[str],
    bins: int = BINS,
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, column, bin, count) of the bins that occur, from one scan. Counts of several
    batches add up."""
    # One row per profiled column.
    values = long_values(df, columns, by)
    binned = values.join(F.broadcast(cuts.select("column", "edges")), "column")
    return binned.groupBy(
        *by, "column", bin_of(F.col("value"), F.col("edges"), bins - 1).alias("bin")
    ).agg(F.count(F.lit(1)).alias("count"))


def bin_shares(
    df: DataFrame, cuts: DataFrame, columns: Sequence[str], bins: int = BINS
) -> DataFrame:
    """(column, bin, share) of every bin, empty ones and the null bin included."""
    every = cuts.where(F.col("column").isin(*columns)).select(
        "column", F.explode(F.sequence(F.lit(0), F.size("edges") + 1)).alias("bin")
    )
    counts = every.join(bin_counts(df, cuts, columns, bins), ["column", "bin"], "left").select(
        "column", "bin", F.coalesce("count", F.lit(0)).alias("count")
    )
    # At most bins + 2 rows per column from here on.
    rows = F.sum("count").over(Window.partitionBy("column"))
    share = F.col("count") / F.greatest(rows, F.lit(1))
    return counts.select("column", "bin", share.alias("share"))


def profile(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """(column, edges, shares): bin edges and shares, the last share that of null."""
    cuts = edges(df, columns, bins)
    shares = (
        bin_shares(df, cuts, columns, bins)
        .groupBy("column")
        .agg(F.array_sort(F.collect_list(F.struct("bin", "share"))).alias("s"))
    )
    return cuts.join(shares, "column").select("column", "edges", F.col("s.share").alias("shares"))


def reference_profile(
    train: DataFrame, features: Sequence[str], held_out_scores: DataFrame | None = None
) -> DataFrame:
    """Profile of the training rows' features and of the held-out rows' uplift."""
    out = profile(train, features)
    if held_out_scores is not None:
        out = out.unionByName(profile(held_out_scores, [SCORE]))
    return out


def psi(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], eps: float = MIN_SHARE
) -> DataFrame:
    """(column, psi) of the current rows; shares below eps count as eps."""
    expected = reference.select("column", F.posexplode("shares").alias("bin", "expected"))
    actual = bin_shares(current, reference, columns)
    a = F.greatest(F.col("share"), F.lit(eps))
    e = F.greatest(F.col("expected"), F.lit(eps))
    return (
        actual.join(expected, ["column", "bin"])
        .groupBy("column")
        .agg(F.sum((a - e) * F.log(a / e)).alias("psi"))
    )


def psi_of_counts(
    reference: DataFrame, counts: DataFrame, by: Sequence[str] = (), eps: float = MIN_SHARE
) -> DataFrame:
    """(by, column, psi) from `bin_counts`, those of any number of batches together."""
    of = [*by, "column"]
    actual = counts.groupBy(*of, "bin").agg(F.sum("count").alias("count"))
    rows = actual.groupBy(*of).agg(F.sum("count").alias("rows"))
    # One row per profiled column and bin.
    expected = reference.select("column", F.posexplode("shares").alias("bin", "expected"))
    every = rows.join(F.broadcast(expected), "column").join(actual, [*of, "bin"], "left")
    a = F.greatest(F.coalesce("count", F.lit(0)) / F.col("rows"), F.lit(eps))
    e = F.greatest(F.col("expected"), F.lit(eps))
    return every.groupBy(*of).agg(F.sum((a - e) * F.log(a / e)).alias("psi"))


def null_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, null_share) in one pass."""
    return (
        long_values(df, columns)
        .groupBy("column")
        .agg(F.avg(F.col("value").isNull().cast("int")).alias("null_share"))
    )


def _psi_metric() -> list[Column]:
    """(metric, feature, value) of (column, psi): the score reports apart from features."""
    score = F.col("column") == SCORE
    return [
        F.when(score, F.lit("uplift_psi")).otherwise(F.lit("feature_psi")).alias("metric"),
        F.when(~score, F.col("column")).alias("feature"),
        F.col("psi").alias("value"),
    ]


def windows_report(reference: DataFrame, counts: DataFrame, window: str) -> DataFrame:
    """(window, metric, feature, value) of many windows from their summed `bin_counts`, in
    which the count without a column is that of the rows."""
    rows = counts.where(F.col("column").isNull()).groupBy(window).agg(F.sum("count").alias("n"))
    sizes = rows.select(
        F.col(window).alias("window"),
        F.lit("rows").alias("metric"),
        F.lit(None).cast("string").alias("feature"),
        F.col("n").cast("double").alias("value"),
    )
    moved = psi_of_counts(reference, counts.where(F.col("column").isNotNull()), [window])
    return sizes.unionByName(moved.select(F.col(window).alias("window"), *_psi_metric()))


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    key: str,
    window: str = "batch",
) -> DataFrame:
    """(window, metric, feature, value) of one batch.

    `columns` are the profiled ones; those missing from the batch are skipped. The
    uplift score reports apart from the features, and the top lift is there when
    the batch carries treatment, outcome and uplift.
    """
    shared = [c for c in columns if c in current.columns]
    parts = [
        current.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rows").alias("metric"), F.lit(None).cast("string").alias("feature"), "value"
        )
    ]
    if shared:
        parts.append(
            psi(reference, current, shared).select(*_psi_metric())
        )
    if {TREATMENT, OUTCOME, SCORE} <= set(current.columns):
        scores = current.select(
            F.lit(SCORE).alias("learner"), key, F.col(SCORE).alias("score"), TREATMENT, OUTCOME
        )
        parts.append(
            top_lift(scores, key, TOP_SHARE, by=()).select(
                F.lit("top20_lift").alias("metric"),
                F.lit(None).cast("string").alias("feature"),
                F.col("top_lift").alias("value"),
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(F.lit(window).alias("window"), "metric", "feature", "value")


def psi_status(value: Column) -> Column:
    return (
        F.when(value < PSI_BANDS[0], "green").when(value < PSI_BANDS[1], "yellow").otherwise("red")
    )


def lift_status(value: Column) -> Column:
    return (
        F.when(value < LIFT_BANDS[0], "red").when(value < LIFT_BANDS[1], "yellow").otherwise("green")
    )


def drifted(report: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """Features above the threshold, worst first."""
    return report.where((F.col("metric") == "feature_psi") & (F.col("value") > threshold)).orderBy(
        F.col("value").desc(), "feature"
    )
