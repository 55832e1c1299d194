"""Structured Streaming jobs: scoring, validation, request metrics, drift.

Every job takes a streaming DataFrame and starts a query that drains what is
available (`availableNow`), so a scheduler can rerun it; drop the trigger for a
continuous one. Sinks are tables keyed by batch or window, so a batch that runs
again after a failure replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from liftwise.operators.drift import SCORE, bin_counts, windows_report
from liftwise.operators.evaluate import TOP_SHARE, top_lift
from liftwise.operators.learners import UpliftModel
from liftwise.operators.requests import MAX_RECORDS, validate_requests
from liftwise.schemas import OUTCOME, TREATMENT
from liftwise.sources.store import publish_windows


def file_stream(
    spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_trigger: int = 100
) -> DataFrame:
    """Parquet files of a folder as a stream, a bounded number per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def append_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a Parquet table, each exactly once."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def each_batch(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def replace_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write one batch's rows; the same batch written again replaces itself."""
    df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch").parquet(path)


def score_stream(
    stream: DataFrame, model: UpliftModel, keep: Sequence[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Score arriving client rows: `keep` columns and `uplift`."""
    return append_table(model.transform(stream).select(*keep, "uplift"), path, checkpoint)


def validate_stream(
    stream: DataFrame,
    features: Sequence[str],
    accepted: str,
    rejected: str,
    checkpoint: str,
    max_records: int = MAX_RECORDS,
) -> StreamingQuery:
    """Sound requests to one table, the others with their reason to another."""

    def handle(batch: DataFrame, number: int) -> None:
        checked = validate_requests(batch, features, max_records).persist()
        try:
            sound = checked.where(F.col("reason").isNull()).drop("reason", "detail")
            replace_batch(sound, accepted, number)
            replace_batch(checked.where(F.col("reason").isNotNull()).drop("records"), rejected, number)
        finally:
            checked.unpersist()

    return each_batch(stream, handle, checkpoint)


def request_metrics(
    stream: DataFrame,
    length: str,
    by: Sequence[str],
    delay: str,
    slide: str | None = None,
) -> DataFrame:
    """(window_start, by, requests, mean_seconds, errors) per tumbling or sliding window.

    On a stream, rows up to `delay` behind the newest count and a window comes out once
    the watermark has passed its end; rows later than that are dropped from the batch
    after on. On a batch all windows come out.
    """
    rows = stream.withColumn("ts", F.col("ts").cast("timestamp"))
    if stream.isStreaming:
        rows = rows.withWatermark("ts", delay)
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    return (
        rows.groupBy(w.alias("window"), *by)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.avg("seconds").alias("mean_seconds"),
            F.count_if(F.col("status") >= 500).alias("errors"),
        )
        .select(F.col("window.start").alias("window_start"), *by, "requests", "mean_seconds", "errors")
    )


def drift_stream(
    stream: DataFrame,
    reference: DataFrame,
    columns: Sequence[str],
    key: str,
    rows: str,
    path: str,
    checkpoint: str,
    window: str = "window",
) -> StreamingQuery:
    """Drift of each window, named by a column, against a fixed profile.

    Every row is read once: a micro-batch leaves its bin counts per window under `rows` (a
    batch that runs again replaces its own), and the windows it touched are published anew
    from the sums of their counts, however many rows they hold and however many files a
    micro-batch takes. Rows without a window are in none. Rows with treatment, outcome and
    uplift also keep these and the key, for `close_drift_windows`.
    """
    lifts = {TREATMENT, OUTCOME, SCORE} <= set(stream.columns)

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        named = batch.where(F.col(window).isNotNull()).withColumn(window, F.col(window).cast("string"))
        shared = [c for c in columns if c in batch.columns]
        named = named.select(*dict.fromkeys([window, key, *shared, *([TREATMENT, OUTCOME] if lifts else [])]))
        named.persist()
        try:
            counts = named.groupBy(window).agg(F.count(F.lit(1)).alias("count")).select(
                window, F.lit(None).cast("string").alias("column"), F.lit(-1).alias("bin"), "count"
            )
            if shared:
                counts = counts.unionByName(bin_counts(named, reference, shared, by=[window]))
            counts.coalesce(1).withColumn("_batch", F.lit(number)).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(window, "_batch").parquet(f"{rows}/counts")
            if lifts:
                scores = named.select(window, key, SCORE, TREATMENT, OUTCOME)
                replace_batch(scores, f"{rows}/scores", number)
            # Their names only; a micro-batch touches few windows.
            touched = [name for (name,) in named.select(window).distinct().collect()]
        finally:
            named.unpersist()
        if touched:
            stored = _window_counts(spark, rows, window).where(F.col(window).isin(touched))
            publish_windows(windows_report(reference, stored, window), path)

    return each_batch(stream, handle, checkpoint)


def _window_counts(spark: SparkSession, rows: str, window: str) -> DataFrame:
    """Bin counts of all micro-batches; they are partitioned by window."""
    fields = f"column string, bin int, count bigint, `{window}` string, _batch int"
    return spark.read.schema(fields).parquet(f"{rows}/counts")


def close_drift_windows(
    spark: SparkSession,
    reference: DataFrame,
    key: str,
    rows: str,
    path: str,
    names: Sequence[str] | None = None,
    window: str = "window",
) -> None:
    """Publish finished windows (all, unless named) once more, with their top lift, which needs
    all of a window's scores at once. A row that arrives later publishes its window without
    it again."""
    counts = _window_counts(spark, rows, window)
    scores = spark.read.parquet(f"{rows}/scores")
    if names is not None:
        counts = counts.where(F.col(window).isin(*names))
        scores = scores.where(F.col(window).isin(*names))
    scores = scores.select(
        F.col(window).alias("learner"), key, F.col(SCORE).alias("score"), TREATMENT, OUTCOME
    )
    lift = top_lift(scores, key, TOP_SHARE).select(
        F.col("learner").alias("window"),
        F.lit("top20_lift").alias("metric"),
        F.lit(None).cast("string").alias("feature"),
        F.col("top_lift").alias("value"),
    )
    publish_windows(windows_report(reference, counts, window).unionByName(lift), path)
