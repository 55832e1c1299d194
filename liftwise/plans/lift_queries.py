"""Queries over incrementality metrics and drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwise.functions import exprs as X
from liftwise.functions.hashing import uniform
from liftwise.operators import drift as dr
from liftwise.operators import evaluate as ev
from liftwise.operators.perturb import SCENARIOS
from liftwise.plans import inputs
from liftwise.plans.registry import query
from liftwise.plans.sql import cte, long_values, profile_of, psi_of, u, with_
from liftwise.schemas import FEATURES, KEY, OUTCOME, TREATMENT

c = F.col


def _rounded(df, *columns, digits=9):
    return df.withColumns({name: F.round(name, digits) for name in columns})


def _arms(spark, folder):
    return ev.running_arms(inputs.scores(spark, folder), KEY)


@query(
    "j1_cumulative_lift", with_("curves", "SELECT learner, i, round(lift, 9) AS lift FROM curves")
)
def j1(spark, folder):
    return _rounded(ev.cumulative_lift(_arms(spark, folder)), "lift")


@query(
    "j2_cumulative_gain",
    with_(
        "curves",
        "SELECT learner, i, round(lift * i / abs(lift_last * n), 9) AS gain FROM curves",
    ),
)
def j2(spark, folder):
    return _rounded(ev.cumulative_gain(_arms(spark, folder)), "gain")


_GRID = """(SELECT CAST(round_even(k * (n / 100.0::DOUBLE), 0) AS BIGINT)
  FROM range(0, 101) AS r(k))"""
cte(
    "qini_points",
    f"""
SELECT learner, i, i::DOUBLE / n AS fraction, qini / abs(qini_last) AS qini,
  sign(qini_last) * i / n AS random
FROM (SELECT learner, i, n, qini, qini_last FROM curves
  UNION ALL SELECT DISTINCT learner, 0, n, 0, qini_last FROM curves)
WHERE i IN {_GRID}
""",
    "curves",
)


@query(
    "j3_qini_curve",
    with_(
        "qini_points",
        "SELECT learner, i, fraction, round(qini, 9) AS qini, round(random, 9) AS random "
        "FROM qini_points",
    ),
)
def j3(spark, folder):
    return _rounded(ev.qini_curve(inputs.scores(spark, folder), KEY), "qini", "random")


@query(
    "j4_qini_score", with_("metrics", "SELECT learner, round(qini, 9) AS qini FROM metrics")
)
def j4(spark, folder):
    metrics = ev.uplift_metrics(inputs.scores(spark, folder), KEY)
    return _rounded(metrics.select("learner", "qini"), "qini")


@query(
    "j5_random_line",
    with_("curves", "SELECT learner, i, round(qini_last * i / n, 9) AS random FROM curves"),
)
def j5(spark, folder):
    return _rounded(ev.random_line(_arms(spark, folder)), "random")


@query(
    "j6_curve_table",
    with_(
        "qini_points",
        "SELECT fraction, "
        + ", ".join(
            f"round(max(qini) FILTER (WHERE learner = '{m}'), 9) AS {m}" for m in inputs.SCORES
        )
        + ", round(max(random) FILTER (WHERE learner = 'hashed'), 9) AS random "
        "FROM qini_points GROUP BY i, fraction",
    ),
)
def j6(spark, folder):
    learners = list(inputs.SCORES)
    table = ev.wide_curve(ev.qini_curve(inputs.scores(spark, folder), KEY), learners)
    return _rounded(table, *learners, "random")


@query(
    "j7_average_effect",
    with_(
        "labels_in",
        "SELECT round(avg(y) FILTER (WHERE treatment = 1) "
        "- avg(y) FILTER (WHERE treatment = 0), 9) AS ate FROM labels_in",
    ),
)
def j7(spark, folder):
    return _rounded(ev.average_effect(inputs.labeled(spark, folder)), "ate")


@query(
    "j8_calibration",
    with_(
        "metrics",
        "SELECT learner, round(mean_uplift, 6) AS mean_uplift, "
        "round(mean_uplift - ate, 6) AS gap FROM metrics",
    ),
)
def j8(spark, folder):
    return ev.calibration(inputs.scores(spark, folder)).select(
        "learner", F.round("mean_uplift", 6).alias("mean_uplift"), F.round("gap", 6).alias("gap")
    )


@query(
    "j9_uplift_metrics",
    with_(
        "metrics",
        "SELECT learner, round(qini, 9) AS qini, round(auuc, 9) AS auuc, round(ate, 9) AS ate, "
        "round(mean_uplift, 6) AS mean_uplift FROM metrics",
    ),
)
def j9(spark, folder):
    metrics = ev.uplift_metrics(inputs.scores(spark, folder), KEY)
    return _rounded(_rounded(metrics, "qini", "auuc", "ate"), "mean_uplift", digits=6)


@query(
    "j10_incremental_curve",
    with_(
        "points",
        "SELECT learner, i, n, round(coalesce(lift0 * i, 0), 6) AS incremental FROM points",
    ),
)
def j10(spark, folder):
    curve = ev.incremental_curve(inputs.scores(spark, folder), KEY).drop("incremental_all")
    return _rounded(curve, "incremental", digits=6)


_KS = [1, 5, 10, 20, 30, 50, 75, 100]


@query(
    "j11_targeting_table",
    with_(
        "points heads",
        f"""
SELECT p.learner, k, i AS clients, round(coalesce(lift0 * i, 0), 6) AS model,
  round(lift_last * n * i / n, 6) AS random
FROM points p JOIN heads h ON h.learner = p.learner, unnest({_KS}) AS s(k)
WHERE i = greatest(1, CAST(floor(n * k / 100.0::DOUBLE + 0.5) AS BIGINT))
""",
    ),
)
def j11(spark, folder):
    curve = ev.incremental_curve(inputs.scores(spark, folder), KEY)
    return _rounded(ev.targeting_table(curve, _KS), "model", "random", digits=6)


def _top_sql(arms: str) -> str:
    return f"""
SELECT learner, round(avg(y) FILTER (WHERE treatment = 1)
  - avg(y) FILTER (WHERE treatment = 0), 9) AS top_lift
FROM {arms} WHERE i <= greatest(CAST(floor(n * 0.2::DOUBLE) AS BIGINT), 1) GROUP BY 1
"""


@query("j12_top_lift", with_("arms", _top_sql("arms")))
def j12(spark, folder):
    return _rounded(ev.top_lift(inputs.scores(spark, folder), KEY), "top_lift")


# A stand-in uplift that reacts to spending, so the scenarios move it.
def _uplift():
    return 0.05 * uniform(c(KEY), 9) + F.coalesce(c("total_spend"), F.lit(0.0)) / 1e8


UPLIFT_SQL = f"(0.05::DOUBLE * {u('client_id', 9)} + coalesce(total_spend, 0) / 1e8::DOUBLE)"


def _scenario(spark, folder, name):
    return inputs.scenario(spark, folder, name).withColumn("uplift", _uplift())


long_values("training_long", "training", FEATURES)
profile_of("training_profile", "training_long")
cte(
    "held_out_uplift",
    f"SELECT 'uplift' AS \"column\", {UPLIFT_SQL} AS value FROM held_out",
    "held_out",
)
profile_of("uplift_profile", "held_out_uplift")
cte(
    "reference",
    "SELECT * FROM training_profile UNION ALL SELECT * FROM uplift_profile",
    "training_profile",
    "uplift_profile",
)
cte(
    "reference_edges",
    "SELECT * FROM training_profile_edges UNION ALL SELECT * FROM uplift_profile_edges",
    "training_profile_edges",
    "uplift_profile_edges",
)
for _s in SCENARIOS:
    _t = f"scenario_{_s}"
    cte(f"scored_{_s}", f"SELECT *, {UPLIFT_SQL} AS uplift FROM {_t}", _t)
    long_values(f"{_s}_long", f"scored_{_s}", [*FEATURES, "uplift"])
    psi_of(f"psi_{_s}", "reference", f"{_s}_long")
    cte(
        f"top_{_s}",
        f"""
SELECT avg(y) FILTER (WHERE treatment = 1) - avg(y) FILTER (WHERE treatment = 0) AS top_lift
FROM (SELECT *, row_number() OVER (ORDER BY uplift DESC, draw) AS i, count(*) OVER () AS n
  FROM scored_{_s})
WHERE i <= greatest(CAST(floor(n * 0.2::DOUBLE) AS BIGINT), 1)
""",
        f"scored_{_s}",
    )
    cte(
        f"report_{_s}",
        f"""
SELECT '{_s}' AS "window", 'feature_psi' AS metric, "column" AS feature, psi AS value
FROM psi_{_s} WHERE "column" <> 'uplift'
UNION ALL SELECT '{_s}', 'uplift_psi', NULL, psi FROM psi_{_s} WHERE "column" = 'uplift'
UNION ALL SELECT '{_s}', 'rows', NULL, count(*)::DOUBLE FROM scored_{_s}
UNION ALL SELECT '{_s}', 'top20_lift', NULL, top_lift FROM top_{_s}
""",
        f"psi_{_s}",
        f"top_{_s}",
    )
_REPORTS = " ".join(f"report_{s}" for s in SCENARIOS)
cte("matrix", " UNION ALL ".join(f"SELECT * FROM report_{s}" for s in SCENARIOS), *_REPORTS.split())


def _reference(spark, folder):
    def build():
        scored = inputs.held_out(spark, folder).select(_uplift().alias("uplift"))
        return dr.reference_profile(inputs.training(spark, folder), FEATURES, scored)

    return inputs.stored(spark, folder, "reference_profile", build)


def _report(spark, folder, scenario):
    current = _scenario(spark, folder, scenario)
    return dr.drift_report(
        _reference(spark, folder), current, [*FEATURES, "uplift"], "draw", scenario
    )


def _matrix(spark, folder):
    out = None
    for scenario in SCENARIOS:
        part = _report(spark, folder, scenario)
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "f5_sorted_report",
    with_(
        "report_missing",
        "SELECT feature, round(value, 9) AS value, CASE WHEN value > 0.2 THEN 'DRIFT' ELSE '' END "
        "AS flag FROM report_missing WHERE metric = 'feature_psi'",
    ),
)
def f5(spark, folder):
    report = _report(spark, folder, "missing").where("metric = 'feature_psi'")
    shown = report.select(
        "feature", F.round("value", 9).alias("value"), X.drift_flag(c("value")).alias("flag")
    )
    return shown.orderBy(c("value").desc(), "feature")


@query(
    "j13_lift_by_scenario",
    with_(
        "matrix",
        'SELECT "window" AS scenario, round(value, 9) AS top_lift FROM matrix '
        "WHERE metric = 'top20_lift'",
    ),
)
def j13(spark, folder):
    parts = None
    for scenario in SCENARIOS:
        rows = _scenario(spark, folder, scenario).select(
            F.lit(scenario).alias("learner"), "draw", c("uplift").alias("score"), TREATMENT, OUTCOME
        )
        parts = rows if parts is None else parts.unionByName(rows)
    lift = ev.top_lift(parts, "draw")
    return lift.select(c("learner").alias("scenario"), F.round("top_lift", 9).alias("top_lift"))


@query(
    "k1_decile_edges",
    with_(
        "training_profile_edges",
        'SELECT "column", CAST(k AS INTEGER) AS k, round(edges[k], 6) AS edge '
        "FROM training_profile_edges, unnest(range(1, len(edges) + 1)) AS r(k)",
    ),
)
def k1(spark, folder):
    cuts = dr.edges(inputs.training(spark, folder), FEATURES)
    return cuts.select("column", F.posexplode("edges").alias("k", "edge")).select(
        "column", (c("k") + 1).alias("k"), F.round("edge", 6).alias("edge")
    )


@query(
    "k2_bin_index",
    with_(
        "held_out_uplift uplift_profile_edges",
        "SELECT value, CAST(len(list_filter(edges, lambda x: x <= value)) AS INTEGER) AS bin "
        "FROM held_out_uplift, uplift_profile_edges",
    ),
)
def k2(spark, folder):
    scored = inputs.held_out(spark, folder).select(_uplift().alias("uplift"))
    cuts = F.broadcast(dr.edges(scored, ["uplift"]))
    long = dr.long_values(scored, ["uplift"]).join(cuts, "column")
    return long.select("value", dr.bin_of(c("value"), c("edges")).alias("bin"))


@query(
    "k3_bin_shares",
    with_(
        "training_profile",
        'SELECT "column", CAST(bin AS INTEGER) AS bin, round(share, 9) AS share '
        "FROM training_profile",
    ),
)
def k3(spark, folder):
    train = inputs.training(spark, folder)
    return _rounded(dr.bin_shares(train, dr.edges(train, FEATURES), FEATURES), "share")


@query(
    "k4_psi",
    with_("psi_covariate", 'SELECT "column", round(psi, 9) AS psi FROM psi_covariate'),
)
def k4(spark, folder):
    current = _scenario(spark, folder, "covariate")
    return _rounded(dr.psi(_reference(spark, folder), current, [*FEATURES, "uplift"]), "psi")


_ROUND = 'SELECT "window", metric, feature, round(value, 9) AS value FROM '


@query("k5_drift_report", with_("report_missing", _ROUND + "report_missing"))
def k5(spark, folder):
    return _rounded(_report(spark, folder, "missing"), "value")


@query(
    "k6_reference_profile",
    with_(
        "reference",
        'SELECT "column", CAST(bin AS INTEGER) AS bin, round(share, 9) AS share FROM reference',
    ),
)
def k6(spark, folder):
    shares = _reference(spark, folder).select("column", F.posexplode("shares").alias("bin", "share"))
    return _rounded(shares, "share")


@query(
    "k7_status_bands",
    with_(
        "matrix",
        """
SELECT "window", metric, feature, round(value, 9) AS value,
  CASE WHEN metric = 'top20_lift' THEN
      CASE WHEN value < 0.05 THEN 'red' WHEN value < 0.1 THEN 'yellow' ELSE 'green' END
    WHEN value < 0.1 THEN 'green' WHEN value < 0.2 THEN 'yellow' ELSE 'red' END AS status
FROM matrix WHERE metric <> 'rows'
""",
    ),
)
def k7(spark, folder):
    value = c("value")
    status = F.when(c("metric") == "top20_lift", dr.lift_status(value)).otherwise(
        dr.psi_status(value)
    )
    report = _matrix(spark, folder).where("metric <> 'rows'").withColumn("status", status)
    return _rounded(report, "value")


@query("k8_drift_matrix", with_("matrix", _ROUND + "matrix"))
def k8(spark, folder):
    return _rounded(_matrix(spark, folder), "value")


@query(
    "k9_null_shares",
    with_(
        "training_long",
        'SELECT "column", round(avg(CAST(value IS NULL AS INTEGER)), 9) AS null_share '
        "FROM training_long GROUP BY 1",
    ),
)
def k9(spark, folder):
    return _rounded(dr.null_shares(inputs.training(spark, folder), FEATURES), "null_share")
