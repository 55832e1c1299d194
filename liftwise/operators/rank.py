"""Global ranks and running totals without ever sorting a whole table in one task.

Rows are range-partitioned into ordered slices and fixed with a checkpoint, since
range bounds come from a sample and may differ between runs. Ranks take one exchange:
slices are sorted before they are fixed, so a row's place in its slice is its rank but
for where its group begins and what earlier slices hold. Running totals need a window
per slice, and with it a second exchange. Slices are shifted by the totals of those
before them: one row per slice and group, which is counted before it is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from liftwise.functions.hashing import uniform
from liftwise.session import materialize

SLICE = "_slice"
BROADCAST_ROWS = 10_000


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | Sequence[str] = (),
) -> DataFrame:
    """Add the 1-based `rank` in `order` within each group of `by`, the group's
    `group_size`, and for every entry of `sums` (columns, or expressions by name) its
    running total `cum_<name>` up to and including the row and its group total
    `total_<name>`.

    `order` must be a total order and `by` free of nulls. Groups may be of any size.
    Pass only the columns needed: rows are shuffled once, with sums twice, evenly each time.
    """
    by = list(by)
    columns = df.columns
    sums = dict(sums) if isinstance(sums, Mapping) else {c: F.col(c) for c in sums}
    if not sums:
        return _numbered(df, order, by)
    slices = materialize(
        df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(
            SLICE, F.spark_partition_id()
        )
    )
    within = Window.partitionBy(*by, SLICE).orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One partition per slice: the window takes this partitioning as it is, and a hash of
    # the slice number would lose the balance of the ranges.
    placed = slices.repartitionById(max(1, slices.rdd.getNumPartitions()), F.col(SLICE))
    local = placed.select(
        *columns,
        SLICE,
        F.row_number().over(within).alias("_rank"),
        *[F.sum(x).over(running).alias(f"_sum_{name}") for name, x in sums.items()],
    )
    totals = slices.groupBy(*by, SLICE).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.sum(x).alias(f"_all_{name}") for name, x in sums.items()],
    )
    group = Window.partitionBy(*by)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    earlier = {name: F.sum(f"_all_{name}").over(before) for name in sums}
    offsets = totals.select(
        *by,
        SLICE,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(group).alias("group_size"),
        *[F.coalesce(x, F.lit(0)).alias(f"_before_{name}") for name, x in earlier.items()],
        *[F.sum(f"_all_{name}").over(group).alias(f"total_{name}") for name in sums],
    )
    offsets = materialize(offsets)
    # The few offsets may be broadcast, the ranked rows never.
    few = offsets.count() <= BROADCAST_ROWS
    shifts = F.broadcast(offsets) if few else offsets.hint("merge")
    return local.join(shifts, [*by, SLICE]).select(
        *columns,
        (F.col("_rank") + F.col("_rows_before")).alias("rank"),
        "group_size",
        *[(F.col(f"_sum_{name}") + F.col(f"_before_{name}")).alias(f"cum_{name}") for name in sums],
        *[f"total_{name}" for name in sums],
    )


# monotonically_increasing_id(): the partition above, the row's place in it below (fixed value).
PLACE_BITS = 33


def _numbered(df: DataFrame, order: Sequence[Column], by: list[str]) -> DataFrame:
    """`ranked` without sums: places in sorted partitions, shifted."""
    columns = df.columns
    keys = [*[F.col(c) for c in by], *order]
    slices = materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys))
    at = F.monotonically_increasing_id()
    placed = slices.select(*columns, at.alias("_at")).select(
        *columns,
        F.shiftright("_at", PLACE_BITS).alias(SLICE),
        F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("_place"),
    )
    totals = placed.groupBy(*by, SLICE).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_start")
    )
    group = Window.partitionBy(*by)
    before = group.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(
        totals.select(
            *by,
            SLICE,
            (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
            F.sum("_rows").over(group).alias("group_size"),
        )
    )
    # The few offsets may be broadcast, the ranked rows never.
    few = offsets.count() <= BROADCAST_ROWS
    shifts = F.broadcast(offsets) if few else offsets.hint("merge")
    return placed.join(shifts, [*by, SLICE]).select(
        *columns, (F.col("_place") + F.col("_shift")).alias("rank"), "group_size"
    )


def best_first(score: str, key: str) -> list[Column]:
    """Highest score first; the key settles ties."""
    return [F.col(score).desc_nulls_last(), F.col(key).asc()]


def running_totals(
    df: DataFrame,
    score: str,
    key: str,
    sums: Mapping[str, Column] | Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """`ranked` by score, best first."""
    return ranked(df, best_first(score, key), by, sums)


def row_index(df: DataFrame, key: str) -> DataFrame:
    """Add a dense 0-based `idx` in key order."""
    out = ranked(df, [F.col(key).asc()])
    return out.withColumn("idx", F.col("rank") - 1).drop("rank", "group_size")


# Groups of so many rows altogether are simply ranked; a cut is searched in larger ones.
RANK_ALL = 100_000
# Part of a group on either side of the cut that is ranked to find it.
MARGIN = 0.005


def top_fraction(
    df: DataFrame, score: str, key: str, k: float, by: Sequence[str] = ()
) -> DataFrame:
    """The best max(floor(n*k), 1) rows of each group."""
    if by:
        cuts = _cuts(df.select(*by, score, key), score, key, k, [*by])
        up_to_cut = _best(F.col(score), F.col(key), F.col("_cut"), F.col("_cut_key"))
        return df.join(cuts, [*by]).where(up_to_cut).select(*df.columns)
    last = _cut(df.select(score, key), score, key, k)
    if last is None:
        return df
    cut, cut_key = (F.lit(last[c]).cast(df.schema[c].dataType) for c in (score, key))
    return df.where(_best(F.col(score), F.col(key), cut, cut_key))


def _best(score: Column, key: Column, cut: Column, cut_key: Column) -> Column:
    """Whether a row is not after the last chosen one; rows without score come last."""
    among_nulls = score.isNotNull() | (key <= cut_key)
    scored = (score > cut) | ((score == cut) & (key <= cut_key))
    return F.when(cut.isNull(), among_nulls).otherwise(F.coalesce(scored, F.lit(False)))


def _around(score: str, k: float) -> Column:
    """Two scores, by a sketch, that the cut should lie between."""
    share = F.array(F.lit(max(0.0, 1 - k - MARGIN)), F.lit(min(1.0, 1 - k + MARGIN)))
    return F.percentile_approx(score, share, F.lit(10_000))


def _cut(rows: DataFrame, score: str, key: str, k: float) -> Row | None:
    """`_cuts` of one group, as a row for the driver to compare with; None without rows."""
    n, around = rows.agg(F.count(F.lit(1)), _around(score, k)).first()
    if not n:
        return None
    wanted, order = max(math.floor(n * float(k)), 1), best_first(score, key)
    if n > RANK_ALL and around:
        low, high = around
        skipped = rows.where(F.col(score) > high).count()
        band = ranked(rows.where(F.col(score).between(low, high)), order)
        found = band.where(F.col("rank") == wanted - skipped).first()
        if found:
            return found
    return ranked(rows, order).where(F.col("rank") == wanted).first()


def _cuts(rows: DataFrame, score: str, key: str, k: float, by: list[str]) -> DataFrame:
    """The last chosen row of each group (`_cut`, `_cut_key`), ready to join.

    A sketch of each group gives two scores around its cut. Rows above both are counted, rows
    between them ranked; a group whose cut is not between them (nulls, or few rows) is ranked
    whole. So the cut is exact whatever the sketch says, with any number of equal scores.
    """
    wanted = F.greatest(F.floor(F.count(F.lit(1)) * F.lit(float(k))), F.lit(1))
    n = F.count(F.lit(1)).alias("_n")
    bands = materialize(rows.groupBy(*by).agg(n, wanted.alias("_wanted"), _around(score, k).alias("_q")))
    groups, total = bands.agg(F.count(F.lit(1)), F.sum("_n")).first()

    def last_of(part: DataFrame, skipped: Column) -> DataFrame:
        return part.where(F.col("rank") + skipped == F.col("_wanted")).select(
            *by, F.col(score).alias("_cut"), F.col(key).alias("_cut_key")
        )

    def whole(of: DataFrame) -> DataFrame:
        part = rows.join(small(of.select(*by, "_wanted"), groups), by)
        return last_of(ranked(part, best_first(score, key), by), F.lit(0))

    if (total or 0) <= RANK_ALL:
        return small(materialize(whole(bands)), groups)
    near = rows.join(small(bands, groups), by)
    low, high = F.col("_q")[0], F.col("_q")[1]
    above = near.groupBy(*by).agg(F.count_if(F.col(score) > high).alias("_above"))
    band = near.where(F.col(score).between(low, high)).select(*by, score, key, "_wanted")
    inside = ranked(band, best_first(score, key), by).join(small(above, groups), by)
    cuts = materialize(last_of(inside, F.col("_above")))
    if cuts.count() < groups:
        cuts = materialize(cuts.union(whole(bands.join(cuts, by, "left_anti"))))
    return small(cuts, groups)


def sorted_by_score(df: DataFrame, score: str, key: str) -> DataFrame:
    """All rows, best first: a range sort, one sorted output part per task."""
    return df.orderBy(*best_first(score, key))


def small(df: DataFrame, rows: int) -> DataFrame:
    """A table to broadcast if it has few rows; a large one joins by shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def hash_thresholds(
    df: DataFrame, key: str, seed: int, quotas: DataFrame, by: Sequence[str]
) -> DataFrame:
    """Where to cut each group so that exactly `quota` rows have the smallest keyed hash.

    `quotas` holds `by`, `n` and `quota`, one row per group; the result has `by` and
    the last chosen row (`cut_u`, `cut_key`), ready to join. Hashes are uniform, so the
    cut lies close to quota/n: only the rows of that narrow band are ranked, and the
    rows below it are just counted. Should a band miss its cut, all rows are ranked.
    """
    by = list(by)
    quotas = materialize(quotas.where("quota > 0"))
    groups = quotas.count()
    hashed = df.select(*by, F.col(key).alias("_key"), uniform(F.col(key), seed).alias("_u"))
    share = F.col("quota") / F.col("n")
    margin = 6.0 / F.sqrt(F.col("n").cast("double"))

    def cuts(low: Column, high: Column) -> DataFrame:
        bands = quotas.withColumns({"_low": low, "_high": high})
        near = hashed.join(small(bands, groups), by)
        below = near.groupBy(*by).agg(F.count_if(F.col("_u") < F.col("_low")).alias("_below"))
        band = near.where((F.col("_u") >= F.col("_low")) & (F.col("_u") < F.col("_high")))
        order = [F.col("_u").asc(), F.col("_key").asc()]
        in_band = ranked(band.select(*by, "quota", "_u", "_key"), order, by)
        return materialize(
            in_band.join(small(below, groups), by)
            .where(F.col("rank") + F.col("_below") == F.col("quota"))
            .select(*by, F.col("_u").alias("cut_u"), F.col("_key").alias("cut_key"))
        )

    found = cuts(share - margin, share + margin)
    if found.count() < groups:
        found = cuts(F.lit(0.0), F.lit(1.0))
    return small(found, groups)


def hash_cut(df: DataFrame, key: str, seed: int, n: int, k: int) -> Row:
    """`hash_thresholds` of one group of n rows: the k-th smallest (`_u`, `_key`)."""
    hashed = df.select(F.col(key).alias("_key"), uniform(F.col(key), seed).alias("_u"))
    order = [F.col("_u").asc(), F.col("_key").asc()]
    margin = 6.0 / math.sqrt(n)
    low, high = k / n - margin, k / n + margin
    below = hashed.where(F.col("_u") < low).count()
    band = hashed.where((F.col("_u") >= low) & (F.col("_u") < high))
    found = ranked(band, order).where(F.col("rank") == k - below).first()
    return found or ranked(hashed, order).where(F.col("rank") == k).first()


def up_to(key: str, seed: int, cut_u: Column, cut_key: Column) -> Column:
    """Whether a row's hash lies at or before a cut; false without a cut."""
    u = uniform(F.col(key), seed)
    return F.coalesce((u < cut_u) | ((u == cut_u) & (F.col(key) <= cut_key)), F.lit(False))
