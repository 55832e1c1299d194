"""Queries over request and prediction logs, in batch and as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwise.operators import monitor as mon
from liftwise.operators.drift import drift_report
from liftwise.operators.perturb import SCENARIOS
from liftwise.plans import inputs
from liftwise.plans.lift_queries import _reference, _scenario
from liftwise.plans.rank_queries import REASONS_SQL
from liftwise.plans.registry import query
from liftwise.plans.sql import cte, histogram, quantile, with_
from liftwise.schemas import FEATURES
from liftwise.session import scratch
from liftwise.sources import star_schema as star
from liftwise.sources.store import publish_metrics
from liftwise.streaming import jobs
from liftwise.streaming.throttle import decisions, open_decisions, throttle_stream

c = F.col


def _predicts(spark, folder):
    return inputs.request_log(spark, folder).where("path = '/predict'")


def _finite(df):
    """Bucket bounds as text, so that the open bucket has a plain name."""
    le = F.when(c("le") == mon.INFINITY, "+Inf").otherwise(F.format_string("%.3f", c("le")))
    return df.withColumn("le", le)


_LE = "CASE WHEN le = 'inf'::DOUBLE THEN '+Inf' ELSE printf('%.3f', le) END AS le"

histogram("latency_hist", "request_log", "seconds", mon.LATENCY_BOUNDS, "path, status")


@query(
    "l1_bucket_histogram",
    with_("latency_hist", f"SELECT path, status, {_LE}, count FROM latency_hist"),
)
def l1(spark, folder):
    log = inputs.request_log(spark, folder)
    return _finite(mon.bucket_counts(log, "seconds", mon.LATENCY_BOUNDS, ["path", "status"]))


cte(
    "predict_days",
    "SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS window_start FROM request_log "
    "WHERE path = '/predict'",
    "request_log",
)
histogram("daily_hist", "predict_days", "seconds", mon.LATENCY_BOUNDS, "window_start")
_QS = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
for _name, _q in _QS.items():
    quantile(f"daily_{_name}", "daily_hist", _q, "window_start")


@query(
    "l2_bucket_quantiles",
    with_(
        "daily_p50 daily_p95 daily_p99",
        "SELECT window_start, round(a.quantile, 9) AS p50, round(b.quantile, 9) AS p95, "
        "round(d.quantile, 9) AS p99 FROM daily_p50 a JOIN daily_p95 b USING (window_start) "
        "JOIN daily_p99 d USING (window_start)",
    ),
)
def l2(spark, folder):
    by = ["window_start"]
    days = mon.windowed(_predicts(spark, folder), "1 day")
    found = mon.bucket_counts(days, "seconds", mon.LATENCY_BOUNDS, by)
    out = None
    for name, q in _QS.items():
        part = mon.bucket_quantile(found, q, by).withColumnRenamed("quantile", name)
        out = part if out is None else out.join(part, by)
    return out.select(*by, *[F.round(name, 9).alias(name) for name in _QS])


def _rate_sql(by: str, table: str, minutes: int, where: str = "true") -> str:
    keys = f", {by}" if by else ""
    return f"""
SELECT time_bucket(INTERVAL {minutes} MINUTE, ts) AS window_start{keys}, count(*) AS count,
  round(count(*) / {minutes * 60}.0::DOUBLE, 9) AS per_second
FROM {table} WHERE {where} GROUP BY 1{", 2" if by else ""}
"""


def _rate(df, *args, **kwargs):
    return mon.rate(df, *args, **kwargs).withColumn("per_second", F.round("per_second", 9))


@query(
    "l3_request_rate",
    with_("request_log", _rate_sql("status", "request_log", 60, "path = '/predict'")),
)
def l3(spark, folder):
    return _rate(_predicts(spark, folder), "60 minutes", ["status"])


@query(
    "l4_rejection_rate",
    with_("request_log", _rate_sql("reason", "request_log", 60, "reason IS NOT NULL")),
)
def l4(spark, folder):
    rejected = inputs.request_log(spark, folder).where(c("reason").isNotNull())
    return _rate(rejected, "60 minutes", ["reason"])


@query(
    "l5_prediction_rate",
    with_(
        "request_log",
        """
SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS window_start, CAST(sum(records) AS BIGINT) AS count,
  round(CAST(sum(records) AS BIGINT) / 3600.0::DOUBLE, 9) AS per_second
FROM request_log WHERE path = '/predict' AND status = 200 GROUP BY 1
""",
    ),
)
def l5(spark, folder):
    served = _predicts(spark, folder).where("status = 200")
    return _rate(served, "60 minutes", weight=c("records"))


histogram("record_hist", "predict_days", "records", mon.RECORD_BOUNDS, "window_start")
quantile("record_p95", "record_hist", 0.95, "window_start")


@query(
    "l6_records_p95",
    with_("record_p95", "SELECT window_start, round(quantile, 9) AS p95 FROM record_p95"),
)
def l6(spark, folder):
    by = ["window_start"]
    days = mon.windowed(_predicts(spark, folder), "1 day")
    found = mon.bucket_quantile(mon.bucket_counts(days, "records", mon.RECORD_BOUNDS, by), 0.95, by)
    return found.select("window_start", F.round("quantile", 9).alias("p95"))


@query(
    "l7_model_served",
    "SELECT 'models:/lift/' || (user_id % 3 + 1) AS uri, "
    "max(CAST(event_type <> 'error' AS INTEGER)) AS served FROM events GROUP BY 1",
)
def l7(spark, folder):
    version = F.concat(F.lit("models:/lift/"), (c("user_id") % 3 + 1).cast("string"))
    reports = star.table(spark, folder, "events").select(
        version.alias("uri"), (c("event_type") != "error").cast("int").alias("info")
    )
    return mon.models_served(reports)


_HOUR = "time_bucket(INTERVAL 1 HOUR, ts) AS window_start"


@query(
    "l8_mean_uplift",
    with_(
        "prediction_log",
        f"SELECT {_HOUR}, count(*) AS count, round(avg(uplift), 12) AS mean "
        "FROM prediction_log GROUP BY 1",
    ),
)
def l8(spark, folder):
    means = mon.mean_per_window(inputs.prediction_log(spark, folder), "uplift", "1 hour")
    return means.withColumn("mean", F.round("mean", 12))


@query(
    "l9_negative_share",
    with_(
        "prediction_log",
        f"SELECT {_HOUR}, round(avg(CAST(uplift <= 0 AS INTEGER)), 9) AS share "
        "FROM prediction_log GROUP BY 1",
    ),
)
def l9(spark, folder):
    shares = mon.negative_share(inputs.prediction_log(spark, folder), "uplift", "1 hour")
    return shares.withColumn("share", F.round("share", 9))


histogram("uplift_hist", "prediction_log", "uplift", mon.UPLIFT_BOUNDS)


@query("l10_uplift_buckets", with_("uplift_hist", f"SELECT {_LE}, count FROM uplift_hist"))
def l10(spark, folder):
    log = inputs.prediction_log(spark, folder)
    return _finite(mon.bucket_counts(log, "uplift", mon.UPLIFT_BOUNDS))


@query(
    "l11_drift_panel",
    with_(
        "matrix",
        'SELECT "window", metric, feature, round(value, 9) AS value FROM matrix '
        "WHERE \"window\" IN ('missing', 'concept')",
    ),
)
def l11(spark, folder):
    path = scratch(spark, "l11")
    reference = _reference(spark, folder)
    for name in SCENARIOS:
        current = _scenario(spark, folder, name)
        report = drift_report(reference, current, [*FEATURES, "uplift"], "draw", name)
        publish_metrics(report, path, name)
    shown = mon.dashboard_rows(spark.read.parquet(path), ["missing", "concept"])
    return shown.select("window", "metric", "feature", F.round("value", 9).alias("value"))


cte(
    "alert_windows",
    "SELECT *, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start FROM request_log",
    "request_log",
)
histogram("alert_hist", "alert_windows", "seconds", mon.LATENCY_BOUNDS, "window_start, path, status")
quantile("alert_p99", "alert_hist", 0.99, "window_start, path, status")


@query(
    "l12_latency_alert",
    with_(
        "alert_p99",
        "SELECT window_start, round(max(quantile), 9) AS p99, max(quantile) > 1 AS firing "
        "FROM alert_p99 GROUP BY 1",
    ),
)
def l12(spark, folder):
    alert = mon.latency_alert(inputs.request_log(spark, folder), by=["path", "status"])
    return alert.withColumn("p99", F.round("p99", 9))


@query(
    "l13_error_alert",
    with_(
        "alert_windows",
        "SELECT window_start, count(*) AS errors, count(*) > 5 AS firing FROM alert_windows "
        "WHERE status BETWEEN 500 AND 599 GROUP BY 1",
    ),
)
def l13(spark, folder):
    return mon.error_alert(inputs.request_log(spark, folder))


@query(
    "l14_latency_by_label",
    with_(
        "request_log",
        "SELECT path, status, count(*) AS requests, round(avg(seconds), 12) AS mean_seconds "
        "FROM request_log GROUP BY 1, 2",
    ),
)
def l14(spark, folder):
    log = inputs.request_log(spark, folder)
    return log.groupBy("path", "status").agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.avg("seconds"), 12).alias("mean_seconds")
    )


def _event_stream(spark, folder):
    """The event table as a file stream."""
    schema = star.table(spark, folder, "events").schema
    return jobs.file_stream(spark, folder, schema, "events.parquet")


def _drain(query) -> None:
    query.awaitTermination()


@query("m2_stream_validation", with_("sizes faults empties", REASONS_SQL))
def m2(spark, folder):
    at = scratch(spark, "m2")
    inputs.requests(spark, folder).write.parquet(f"{at}/in")
    arriving = jobs.file_stream(spark, f"{at}/in", spark.read.parquet(f"{at}/in").schema)
    _drain(
        jobs.validate_stream(
            arriving, inputs.REQUEST_FEATURES, f"{at}/ok", f"{at}/rejected", f"{at}/checkpoint"
        )
    )
    # With the schema given, a side that got no request reads as empty.
    answer = spark.read.schema("request string, reason string, detail string, batch int")
    return answer.parquet(f"{at}/ok").unionByName(answer.parquet(f"{at}/rejected")).drop("batch")


def _metrics(spark, folder, name, length, delay, slide=None):
    at = scratch(spark, name)
    log = inputs.as_requests(_event_stream(spark, folder))
    closed = jobs.request_metrics(log, length, ["status"], delay, slide)
    _drain(jobs.append_table(closed, f"{at}/out", f"{at}/checkpoint"))
    return spark.read.parquet(f"{at}/out").select(
        c("window_start").cast("timestamp_ntz").alias("window_start"),
        "status",
        "requests",
        F.round("mean_seconds", 12).alias("mean_seconds"),
        "errors",
    )


def _metrics_sql(start: str, length: str, delay: str, more: str = "") -> str:
    return f"""
SELECT window_start, status, count(*) AS requests, round(avg(seconds), 12) AS mean_seconds,
  count(*) FILTER (WHERE status >= 500) AS errors
FROM (SELECT *, {start} AS window_start FROM request_log{more})
WHERE window_start + INTERVAL {length} <= (SELECT max(ts) FROM request_log) - INTERVAL {delay}
GROUP BY 1, 2
"""


@query(
    "m3_tumbling_metrics",
    with_("request_log", _metrics_sql("time_bucket(INTERVAL 1 HOUR, ts)", "1 HOUR", "30 MINUTE")),
)
def m3(spark, folder):
    return _metrics(spark, folder, "m3", "1 hour", "30 minutes")


@query(
    "m4_sliding_rates",
    with_(
        "request_log",
        _metrics_sql(
            "time_bucket(INTERVAL 1 MINUTE, ts) - to_minutes(k)",
            "5 MINUTE",
            "30 MINUTE",
            ", range(0, 5) AS r(k)",
        ),
    ),
)
def m4(spark, folder):
    return _metrics(spark, folder, "m4", "5 minutes", "30 minutes", "1 minute")


@query(
    "m5_drift_per_window",
    with_(
        " ".join(f"report_{name}" for name in SCENARIOS),
        " UNION ALL ".join(
            f'SELECT "window", metric, feature, round(value, 9) AS value FROM report_{name}'
            for name in SCENARIOS
        ),
    ),
)
def m5(spark, folder):
    """Four campaigns of several files arrive, three files at a time, and each is compared
    with one profile; a column names the campaign."""
    at = scratch(spark, "m5")
    for scenario in SCENARIOS:
        rows = _scenario(spark, folder, scenario).withColumn("window", F.lit(scenario))
        rows.repartition(2, "draw").write.mode("append").parquet(f"{at}/in")
    schema = spark.read.parquet(f"{at}/in").schema
    arriving = jobs.file_stream(spark, f"{at}/in", schema, files_per_trigger=3)
    columns = [*FEATURES, "uplift"]
    kept = (f"{at}/rows", f"{at}/out")
    reference = _reference(spark, folder)
    _drain(jobs.drift_stream(arriving, reference, columns, "draw", *kept, f"{at}/checkpoint"))
    jobs.close_drift_windows(spark, reference, "draw", *kept)
    return spark.read.parquet(f"{at}/out").select(
        "window", "metric", "feature", F.round("value", 9).alias("value")
    )


RATE, PER = 2.0, 86400.0


@query(
    "m6_token_bucket",
    f"""
WITH RECURSIVE asked AS (
  SELECT user_id AS caller, event_id AS request_id, ts, epoch(ts) AS s,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events WHERE CAST(json_extract(props, '$.k') AS INTEGER) % 10 <> 0),
step AS (
  SELECT caller, request_id, ts, s, rn, {RATE}::DOUBLE AS before FROM asked WHERE rn = 1
  UNION ALL
  SELECT a.caller, a.request_id, a.ts, a.s, a.rn, least({RATE}::DOUBLE,
    (CASE WHEN p.before >= 1 THEN p.before - 1 ELSE p.before END)
      + CASE WHEN a.s - p.s >= {PER} THEN {RATE} ELSE (a.s - p.s) * ({RATE}::DOUBLE / {PER}::DOUBLE) END)
  FROM step p JOIN asked a ON a.caller = p.caller AND a.rn = p.rn + 1)
SELECT CAST(caller AS VARCHAR) AS caller, request_id, before >= 1 AS accepted FROM step
""",
)
def m6(spark, folder):
    """Two requests per caller and day; refused callers spend nothing, nor do unauthorized ones."""
    at = scratch(spark, "m6")
    authorized = _event_stream(spark, folder).where(
        F.get_json_object("props", "$.k").cast("int") % 10 != 0
    )
    asked = authorized.select(
        c("user_id").alias("caller"), c("event_id").alias("request_id"), "ts"
    )
    _drain(
        throttle_stream(asked, RATE, f"{at}/out", f"{at}/state", f"{at}/checkpoint", PER, delay=PER)
    )
    still_open = open_decisions(spark, f"{at}/state", RATE, PER)
    return decisions(spark, f"{at}/out").unionByName(still_open).drop("ts")
