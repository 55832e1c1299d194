"""Column expressions: cleaning, time differences, exact sums, labels, JSON."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400.0
UNITS = 10_000
DRIFT_THRESHOLD = 0.2
# Registry URIs and the version number that pins one.
REGISTRY = "models:"
VERSIONED = "/[0-9]+/*$"


def within(value: Column, low, high) -> Column:
    """The value where it lies in [low, high], else null."""
    return F.when(value.between(low, high), value)


def flag(condition: Column) -> Column:
    """A condition as 0/1; unknown stays null."""
    return condition.cast("int")


def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 with the microseconds kept, for either timestamp type."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1000000.0)


def days_between(later: Column, earlier: Column) -> Column:
    """Fractional days from `earlier` to `later`."""
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(SECONDS_PER_DAY)


def known_by(event: Column, cutoff: Column) -> Column:
    """1 when the event had happened by the cutoff, else 0; never null."""
    return flag(F.coalesce(event <= cutoff, F.lit(False)))


def censored_days(start: Column, event: Column, cutoff: Column) -> Column:
    """Days from start to event; null if the event is after the cutoff or before start."""
    return F.when((event <= cutoff) & (event >= start), days_between(event, start))


def month_key(ts: Column) -> Column:
    """The calendar month as 'YYYY-MM'."""
    return F.date_format(ts, "yyyy-MM")


def month_number(ts: Column) -> Column:
    """The calendar month as a number, months since year 0."""
    return F.year(ts) * 12 + F.month(ts) - 1


def days_before(ts: Column, days: int) -> Column:
    """The moment `days` days before `ts`."""
    return ts - F.make_dt_interval(F.lit(days))


def negated(value: Column) -> Column:
    """Sign flip that yields 0.0 rather than -0.0 for zero."""
    return F.lit(0.0) - value


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is null, not an error, when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def units(value: Column) -> Column:
    """A number as whole ten-thousandths, halves rounded away from zero.

    Doubles below 2**51 units round in plain arithmetic, which keeps the hot loop in
    generated code; larger ones take the decimal route, which also raises beyond the
    18 digits the fixed-point type holds.
    """
    scaled = value * F.lit(float(UNITS))
    size = F.abs(scaled)
    return (
        F.when(size < F.lit(float(2**51)), F.floor(size + 0.5) * F.signum(scaled).cast("int"))
        .otherwise(scaled.cast("decimal(18,0)").cast("bigint"))
        .cast("bigint")
    )


def from_units(total: Column) -> Column:
    """Whole ten-thousandths back to a double, correctly rounded at any size."""
    exact = total.cast("decimal(19,0)") / F.lit(UNITS).cast("decimal(5,0)")
    return F.when(F.abs(total) < F.lit(2**53), total / F.lit(float(UNITS))).otherwise(
        exact.cast("double")
    )


def exact_sum(value: Column) -> Column:
    """Order-independent sum with four decimals, as a double.

    Integer sums have one result whatever the partitioning; ANSI mode raises if a
    group ever exceeds 64 bits.
    """
    return from_units(F.sum(units(value)))


def exact_mean(value: Column) -> Column:
    """Exact sum over the count of present values (avg(decimal) would truncate)."""
    return ratio(exact_sum(value), F.count(value))


def share_where(condition: Column) -> Column:
    """Share of rows meeting the condition; rows where it is unknown do not count."""
    return F.avg(flag(condition))


def bounded_label(value: Column, allowed: Iterable[str], other: str = "other") -> Column:
    """Keep listed labels and fold all others into one."""
    return F.when(value.isin(*allowed), value).otherwise(F.lit(other))


def drift_flag(value: Column, threshold: float = DRIFT_THRESHOLD) -> Column:
    return F.when(value > threshold, F.lit("DRIFT")).otherwise(F.lit(""))


def as_features(columns: Sequence[str]) -> list[Column]:
    """Feature columns as doubles, the one numeric type learners read."""
    return [F.col(c).cast("double").alias(c) for c in columns]


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def record_json(columns: Sequence[str]) -> Column:
    """One JSON object per row with null (never NaN) for a missing value."""
    return F.to_json(
        F.struct(*[null_if_nan(F.col(c).cast("double")).alias(c) for c in columns]),
        {"ignoreNullFields": "false"},
    )


def parse_record(text: Column) -> Column:
    """A JSON object of numbers as a map."""
    return F.from_json(text, "map<string,double>")


def is_pinned(uri: Column) -> Column:
    """True when a model URI cannot be repointed: not a registry URI, or one whose
    last path part is a version number."""
    return ~uri.startswith(REGISTRY) | uri.rlike(VERSIONED)
