"""Validation of scoring requests: one row per request, `records` an array of maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of one request and of the listed faults.
MAX_RECORDS = 1000
LISTED = 10


def missing_features(records: Column, features: Sequence[str]) -> Column:
    """Features some record lacks, sorted."""
    wanted = F.array(*[F.lit(f) for f in features])
    lacking = F.transform(records, lambda r: F.array_except(wanted, F.map_keys(r)))
    return F.array_sort(F.array_distinct(F.flatten(lacking)))


def unknown_features(records: Column, features: Sequence[str]) -> Column:
    """Names some record has that are no features, sorted."""
    wanted = F.array(*[F.lit(f) for f in features])
    extra = F.transform(records, lambda r: F.array_except(F.map_keys(r), wanted))
    return F.array_sort(F.array_distinct(F.flatten(extra)))


def mismatches(records: Column, features: Sequence[str]) -> Column:
    """The first faults by name: what is missing, then what is unknown."""
    missing = F.transform(
        missing_features(records, features), lambda k: F.concat(F.lit("missing "), k)
    )
    unknown = F.transform(
        unknown_features(records, features), lambda k: F.concat(F.lit("unknown "), k)
    )
    return F.slice(F.concat(missing, unknown), 1, LISTED)


def all_null(record: Column) -> Column:
    return F.forall(F.map_values(record), lambda v: v.isNull())


def empty_records(records: Column) -> Column:
    """0-based positions of the records without any value."""
    marked = F.transform(records, lambda r, i: F.when(all_null(r), i))
    return F.filter(marked, lambda i: i.isNotNull())


def size_ok(records: Column, max_records: int = MAX_RECORDS) -> Column:
    return F.size(records).between(1, max_records)


def _listed(values: Column, quote: str) -> Column:
    text = F.transform(values, lambda v: F.concat(F.lit(quote), v.cast("string"), F.lit(quote)))
    return F.concat(F.lit("["), F.array_join(text, ", "), F.lit("]"))


def validate_requests(
    df: DataFrame, features: Sequence[str], max_records: int = MAX_RECORDS
) -> DataFrame:
    """Add `reason` (null for a sound request) and `detail`; the first fault counts:
    batch size, then feature names, then records without any value."""
    records = F.col("records")
    faults = mismatches(records, features)
    empty = empty_records(records)
    checked = df.withColumns(
        {
            "_size": F.coalesce(size_ok(records, max_records), F.lit(False)),
            "_faults": faults,
            "_empty": empty,
        }
    )
    c = F.col
    reason = (
        F.when(~c("_size"), "batch_size")
        .when(F.size("_faults") > 0, "feature_mismatch")
        .when(F.size("_empty") > 0, "all_null")
    )
    detail = (
        F.when(~c("_size"), F.concat(F.lit("records: "), F.size("records").cast("string")))
        .when(
            F.size("_faults") > 0,
            F.concat(F.lit("features do not match the model: "), _listed(c("_faults"), "'")),
        )
        .when(
            F.size("_empty") > 0,
            F.concat(
                F.lit("records with all features null: "),
                _listed(F.slice(c("_empty"), 1, LISTED), ""),
            ),
        )
    )
    return checked.withColumns({"reason": reason, "detail": detail}).drop(
        "_size", "_faults", "_empty"
    )
