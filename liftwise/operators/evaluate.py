"""Incrementality of a ranking: lift, gain, Qini, targeting tables.

Scores come in long form: one row per (learner, client) with `score`, `treatment`
and `y`. Ranks run from 1, best score first; the point before the first row is 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.functions.exprs import ratio
from liftwise.operators.rank import running_totals, top_fraction
from liftwise.schemas import OUTCOME, TREATMENT

TOP_SHARE = 0.2
POINTS = 101


def long_scores(df: DataFrame, scores: Mapping[str, str] | Sequence[str], key: str) -> DataFrame:
    """Unpivot score columns; a mapping renames columns to learner names."""
    names = scores if isinstance(scores, Mapping) else {s: s for s in scores}
    wide = df.select(
        key,
        TREATMENT,
        OUTCOME,
        *[F.col(column).cast("double").alias(learner) for learner, column in names.items()],
    )
    return wide.unpivot([key, TREATMENT, OUTCOME], list(names), "learner", "score")


def running_arms(scores: DataFrame, key: str) -> DataFrame:
    """Per learner and rank i: clients and outcomes so far of each arm.

    ct, cc count treated and control clients; yt, yc sum their outcomes; n is the
    learner's number of rows; all_* are the totals.
    """
    treated = (F.col(TREATMENT) == 1).cast("bigint")
    outcome = F.col(OUTCOME).cast("bigint")
    sums = {"ct": treated, "yt": treated * outcome, "y": outcome}
    narrow = scores.select("learner", key, "score", TREATMENT, OUTCOME)
    out = running_totals(narrow, "score", key, sums, by=["learner"])
    c = F.col
    # The control arm is what the treated arm leaves.
    return out.select(
        *narrow.columns,
        c("rank").alias("i"),
        c("group_size").alias("n"),
        c("cum_ct").alias("ct"),
        (c("rank") - c("cum_ct")).alias("cc"),
        c("cum_yt").alias("yt"),
        (c("cum_y") - c("cum_yt")).alias("yc"),
        c("total_ct").alias("all_ct"),
        (c("group_size") - c("total_ct")).alias("all_cc"),
        c("total_yt").alias("all_yt"),
        (c("total_y") - c("total_yt")).alias("all_yc"),
    )


def lift_at(ct: str = "ct", cc: str = "cc", yt: str = "yt", yc: str = "yc") -> Column:
    """Treated minus control outcome rate; null while an arm is empty."""
    return ratio(F.col(yt), F.col(ct)) - ratio(F.col(yc), F.col(cc))


def qini_at(ct: str = "ct", cc: str = "cc", yt: str = "yt", yc: str = "yc") -> Column:
    """Treated outcomes minus control outcomes scaled to the treated; null without control."""
    return F.col(yt) - ratio(F.col(yc).cast("double") * F.col(ct), F.col(cc))


def _at_end(point) -> Column:
    return point("all_ct", "all_cc", "all_yt", "all_yc")


def first_defined(arms: DataFrame) -> DataFrame:
    """Where each learner's lift and Qini begin, and their values there."""
    known = {"lift": lift_at(), "qini": qini_at()}
    aggregates = []
    for name, value in known.items():
        rank = F.when(value.isNotNull(), F.col("i"))
        aggregates += [
            F.min(rank).alias(f"{name}_from"),
            F.min_by(value, rank).alias(f"{name}_first"),
        ]
    return arms.groupBy("learner").agg(*aggregates)


def _filled(arms: DataFrame, name: str, value: Column) -> DataFrame:
    """A curve value per row; the undefined head runs straight from 0 to the first value."""
    # One row per learner the caller named.
    start = F.broadcast(first_defined(arms).select("learner", f"{name}_from", f"{name}_first"))
    head = F.col(f"{name}_first") * F.col("i") / F.col(f"{name}_from")
    return (
        arms.join(start, "learner")
        .withColumn(name, F.coalesce(value, head))
        .drop(f"{name}_from", f"{name}_first")
    )


def cumulative_lift(arms: DataFrame) -> DataFrame:
    """Lift among the best i clients, for every i."""
    return _filled(arms, "lift", lift_at()).select("learner", "i", "lift")


def cumulative_gain(arms: DataFrame) -> DataFrame:
    """Lift times clients, over the size of the gain on everybody (null if that is 0)."""
    end = F.abs(_at_end(lift_at) * F.col("n"))
    return _filled(arms, "lift", lift_at()).select(
        "learner", "i", ratio(F.col("lift") * F.col("i"), end).alias("gain")
    )


def _on_grid(points: int) -> Column:
    """Whether rank i is one of round(k*n/(points-1)), k = 0..points-1, halves to even."""
    step = F.col("n") / F.lit(float(points - 1))
    nearest = F.floor(F.col("i") / step)
    hits = [
        (k >= 0) & (k <= points - 1) & (F.bround(k * step, 0) == F.col("i"))
        for k in (nearest - 1, nearest, nearest + 1)
    ]
    return hits[0] | hits[1] | hits[2]


def curve_grid(arms: DataFrame, points: int = POINTS) -> DataFrame:
    """The rows of evenly spaced ranks, each rank once."""
    return arms.where(_on_grid(points))


def qini_curve(scores: DataFrame, key: str, points: int = POINTS) -> DataFrame:
    """Normalized Qini curve of each learner with the random line, from fraction 0 to 1."""
    return curve_of(running_arms(scores, key), points)


def curve_of(arms: DataFrame, points: int = POINTS) -> DataFrame:
    """`qini_curve` from ranks already computed."""
    filled = _filled(arms, "qini", qini_at()).where(_on_grid(points))
    end = _at_end(qini_at)
    curve = filled.select(
        "learner",
        "i",
        (F.col("i") / F.col("n")).alias("fraction"),
        ratio(F.col("qini"), F.abs(end)).alias("qini"),
        ratio(end * F.col("i") / F.col("n"), F.abs(end)).alias("random"),
    )
    zero = F.lit(0.0)
    start = curve.where("fraction = 1.0").select(
        "learner",
        F.lit(0).cast("bigint").alias("i"),
        zero.alias("fraction"),
        zero.alias("qini"),
        zero.alias("random"),
    )
    return start.unionByName(curve)


def random_line(arms: DataFrame) -> DataFrame:
    """Expected Qini of targeting at random: straight to the value on everybody."""
    end = _at_end(qini_at)
    return arms.select("learner", "i", (end * F.col("i") / F.col("n")).alias("random"))


def wide_curve(curve: DataFrame, learners: Sequence[str]) -> DataFrame:
    """One column per learner plus one random line, as a curve file has it."""
    one_line = curve.groupBy("i", "fraction").agg(
        *[F.max(F.when(F.col("learner") == m, F.col("qini"))).alias(m) for m in learners],
        F.max(F.when(F.col("learner") == learners[0], F.col("random"))).alias("random"),
    )
    return one_line.select("fraction", *learners, "random")


def uplift_metrics(scores: DataFrame, key: str) -> DataFrame:
    """qini, auuc, ate and mean_uplift per learner, in one pass over the ranks.

    Areas are means over the points 0..n, the undefined head included in closed form.
    Where the total effect is 0 the normalized areas are null.
    """
    return metrics_of(running_arms(scores, key))


def metrics_of(arms: DataFrame) -> DataFrame:
    """`uplift_metrics` from ranks already computed."""
    lift, qini, i = lift_at(), qini_at(), F.col("i")
    lift_rank, qini_rank = (F.when(v.isNotNull(), i) for v in (lift, qini))
    sums = arms.groupBy("learner").agg(
        F.max("n").alias("n"),
        F.sum(lift * i).alias("gain_sum"),
        F.min(lift_rank).alias("lift_from"),
        F.min_by(lift, lift_rank).alias("lift_first"),
        F.sum(qini).alias("qini_sum"),
        F.min(qini_rank).alias("qini_from"),
        F.min_by(qini, qini_rank).alias("qini_first"),
        *[F.max(f"all_{c}").alias(f"all_{c}") for c in ("ct", "cc", "yt", "yc")],
        F.avg("score").alias("mean_uplift"),
    )
    c = F.col
    ate, q_end = _at_end(lift_at), _at_end(qini_at)
    before = c("lift_from") - 1.0
    gain_head = c("lift_first") * before * (2.0 * c("lift_from") - 1.0) / 6.0
    qini_head = c("qini_first") * (c("qini_from") - 1.0) / 2.0
    points = c("n") + 1.0
    return sums.select(
        "learner",
        (
            ratio((c("qini_sum") + qini_head) / points, F.abs(q_end)) - F.signum(q_end) / 2.0
        ).alias("qini"),
        ratio((c("gain_sum") + gain_head) / points, F.abs(ate * c("n"))).alias("auuc"),
        ate.alias("ate"),
        "mean_uplift",
    )


def average_effect(df: DataFrame) -> DataFrame:
    """Observed effect: mean outcome of the treated minus that of the control."""
    return df.agg(
        (
            F.avg(F.when(F.col(TREATMENT) == 1, F.col(OUTCOME)))
            - F.avg(F.when(F.col(TREATMENT) == 0, F.col(OUTCOME)))
        ).alias("ate")
    )


def calibration(scores: DataFrame) -> DataFrame:
    """Mean predicted uplift per learner and its gap to the observed effect."""
    rate = {a: F.avg(F.when(F.col(TREATMENT) == a, F.col(OUTCOME))) for a in (0, 1)}
    mean = F.avg("score")
    return scores.groupBy("learner").agg(
        mean.alias("mean_uplift"), (mean - (rate[1] - rate[0])).alias("gap")
    )


def incremental_curve(scores: DataFrame, key: str) -> DataFrame:
    """Extra outcomes when targeting the best i clients; 0 while an arm is empty."""
    extra = F.coalesce(lift_at() * F.col("i"), F.lit(0.0))
    last = F.coalesce(_at_end(lift_at) * F.col("n"), F.lit(0.0))
    return running_arms(scores, key).select(
        "learner", "i", "n", extra.alias("incremental"), last.alias("incremental_all")
    )


def targeting_table(curve: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Extra outcomes of targeting k percent, by model and at random."""
    sizes = curve.groupBy("learner").agg(F.max("n").alias("size"))
    count = F.floor(F.col("size") * F.col("k") / F.lit(100.0) + 0.5)
    wanted = sizes.select(
        "learner", "size", F.explode(F.array(*[F.lit(int(k)) for k in ks])).alias("k")
    ).select("learner", "k", F.greatest(F.lit(1), count).cast("bigint").alias("i"))
    # One row per learner and k, both named by the caller.
    return curve.join(F.broadcast(wanted), ["learner", "i"]).select(
        "learner",
        "k",
        F.col("i").alias("clients"),
        F.col("incremental").alias("model"),
        (F.col("incremental_all") * F.col("i") / F.col("n")).alias("random"),
    )


def top_lift(
    scores: DataFrame, key: str, k: float = TOP_SHARE, by: Sequence[str] = ("learner",)
) -> DataFrame:
    """Treated minus control outcome rate among the best share k; null if an arm is empty.
    Scores of a single learner need no `by`."""
    top = top_fraction(scores, "score", key, k, by=by)
    rate = {a: F.avg(F.when(F.col(TREATMENT) == a, F.col(OUTCOME))) for a in (0, 1)}
    return top.groupBy("learner").agg((rate[1] - rate[0]).alias("top_lift"))


def best_learner(metrics: DataFrame, order: Sequence[str]) -> DataFrame:
    """The learner with the highest Qini; of equals, the one listed first."""
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("learner"))
    return metrics.agg(
        F.max_by("learner", F.struct(F.col("qini"), -place)).alias("learner"),
        F.max("qini").alias("qini"),
    )
