"""Deterministic splits, samples, resamples and permutations by keyed hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwise.functions.hashing import bijection, uniform
from liftwise.operators import rank
from liftwise.operators.rank import hash_cut, hash_thresholds, row_index, up_to
from liftwise.session import materialize

TEST_SHARE = 0.3
SPLIT_SEED = 42
DRAW = "draw"


def strata_counts(df: DataFrame, strata: Sequence[str]) -> DataFrame:
    return df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n"))


def largest_remainder(counts: DataFrame, strata: Sequence[str], share: float) -> DataFrame:
    """Seats per stratum in proportion to its size, ceil(share * total) in all.

    Equal remainders go by the strata's values. Many strata are ranked without a window over
    all of them.
    """
    counts = materialize(counts)
    groups, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not total:
        return counts.select(*strata, "n", F.lit(0).cast("bigint").alias("quota"))
    wanted = F.ceil(F.lit(total) * F.lit(float(share)))
    ideal = F.col("n") * wanted / F.lit(total)
    seats = counts.withColumn("ideal", ideal).withColumn("seats", F.floor("ideal"))
    left = seats.agg(F.max(wanted) - F.sum("seats")).first()[0]
    order = [(F.col("ideal") - F.col("seats")).desc(), *[F.col(c).asc() for c in strata]]
    if groups <= rank.BROADCAST_ROWS:
        place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
        placed = seats.withColumn("rank", place)
    else:
        placed = rank.ranked(seats, order)
    extra = (F.col("rank") <= F.lit(left)).cast("int")
    return placed.select(*strata, "n", (F.col("seats") + extra).alias("quota"))


def _choose(df: DataFrame, key: str, strata: Sequence[str], quotas: DataFrame, seed: int):
    """(rows with the cut of their stratum, whether each is chosen)"""
    cuts = hash_thresholds(df, key, seed, quotas, strata)
    picked = up_to(key, seed, F.col("cut_u"), F.col("cut_key"))
    return df.join(cuts, list(strata), "left"), picked


def stratified_split(
    df: DataFrame,
    key: str,
    strata: Sequence[str],
    test: float = TEST_SHARE,
    seed: int = SPLIT_SEED,
) -> DataFrame:
    """Add `split`: 'test' for exactly ceil(test * n) rows, each stratum keeping its share.

    Needs no shuffle of the rows: each is compared with the cut of its stratum.
    """
    quotas = largest_remainder(strata_counts(df, strata), strata, test)
    rows, is_test = _choose(df, key, strata, quotas, seed)
    return rows.select(
        *df.columns, F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split")
    )


def stratified_sample(
    df: DataFrame, key: str, strata: Sequence[str], n: int, seed: int
) -> DataFrame:
    """About n rows with the mix of strata kept; every row if there are no more than n."""
    total = df.count()
    if total <= n:
        return df
    quotas = strata_counts(df, strata).withColumn(
        "quota", F.bround(F.col("n") * F.lit(n / total), 0).cast("bigint")
    )
    rows, picked = _choose(df, key, strata, quotas, seed)
    return rows.where(picked).select(*df.columns)


def choose(df: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows without replacement: those with the smallest hash."""
    n = df.count()
    if k >= n:
        return df
    if k <= 0:
        return df.limit(0)
    cut = hash_cut(df, key, seed, n, k)
    return df.where(up_to(key, seed, F.lit(cut["_u"]), F.lit(cut["_key"])))


def bernoulli(key: str, p: float, seed: int) -> Column:
    """True with probability p, the same for the same key."""
    return uniform(F.col(key), seed) < F.lit(float(p))


def resample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly n rows with replacement, numbered by `draw` from 0."""
    keys = row_index(df.select(key), key)
    size = df.count()
    spark = df.sparkSession
    draws = spark.range(n).select(
        F.col("id").alias(DRAW),
        F.floor(uniform(F.col("id"), seed) * F.lit(size)).alias("idx"),
    )
    picks = draws.join(keys, "idx").select(DRAW, key)
    return picks.join(df, key).select(DRAW, *df.columns)


def permute(
    df: DataFrame, key: str, column: str, k: int, seed: int, size: int | None = None
) -> DataFrame:
    """Shuffle `column` among k rows (all if there are fewer); everything else stays in place.

    Keyed bijections of the row numbers choose the rows and say where each value goes, so the
    multiset of values is kept and one join by number moves them. Rows are numbered in the
    order of the unique `key`; give `size` if the key itself numbers them from 0 to
    size - 1, and nothing is ranked.
    """
    if k <= 0:
        return df
    if size is not None:
        return _moved(df, F.col(key), column, k, seed, size).select(*df.columns)
    numbered = row_index(df.select(key, column), key)
    moved = _moved(numbered, F.col("idx"), column, k, seed, numbered.count())
    # The rows themselves travel once, for this join.
    fresh = moved.where(F.col("_slot") >= 0).select(key, F.struct(column).alias("_fresh"))
    value = F.when(F.col("_fresh").isNull(), F.col(column)).otherwise(F.col(f"_fresh.{column}"))
    return df.join(fresh, key, "left").select(
        *[value.alias(column) if c == column else F.col(c) for c in df.columns]
    )


def _moved(df: DataFrame, idx: Column, column: str, k: int, seed: int, size: int) -> DataFrame:
    """Rows with the value they get and their `_slot` among the k chosen, below 0 for others."""
    if not size:
        return df.withColumn("_slot", F.lit(-1))
    k = min(k, size)
    place = idx.cast("bigint") if k == size else bijection(idx, size, seed)
    # Rows not chosen keep numbers of their own: nulls would meet in one task.
    slots = df.withColumn("_place", place).withColumn(
        "_slot", F.when(F.col("_place") < k, F.col("_place")).otherwise(-1 - F.col("_place"))
    )
    giving = slots.where(F.col("_slot") >= 0).select(
        bijection(F.col("_slot"), k, seed + 1).alias("_slot"), F.struct(column).alias("_given")
    )
    value = F.when(F.col("_slot") < 0, F.col(column)).otherwise(F.col(f"_given.{column}"))
    return slots.join(giving, "_slot", "left").withColumn(column, value)
