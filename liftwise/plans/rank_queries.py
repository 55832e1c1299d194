"""Queries over checks, ranks, splits, samples and drift scenarios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.functions.exprs import is_pinned
from liftwise.functions.hashing import bucket
from liftwise.operators import evaluate as ev
from liftwise.operators import quality, rank, split
from liftwise.operators import requests as rq
from liftwise.operators.perturb import SCENARIOS, make_scenario
from liftwise.plans import inputs
from liftwise.plans.registry import query
from liftwise.plans.sql import bijection
from liftwise.plans.sql import bucket as sql_bucket
from liftwise.plans.sql import cte, u, with_
from liftwise.schemas import FEATURES, KEY, OUTCOME, TREATMENT
from liftwise.sources import star_schema as star

c = F.col


@query(
    "e1_required_columns",
    "SELECT 'missing_column' AS \"check\", 'y' AS subject, 'required' AS detail",
)
def e1(spark, folder):
    return quality.check_feature_table(inputs.labeled(spark, folder).drop(OUTCOME, "split"))


@query(
    "e2_unique_key",
    'SELECT l_orderkey, count(*) AS "count" FROM lineitem GROUP BY 1 HAVING count(*) > 1',
)
def e2(spark, folder):
    return quality.duplicate_keys(star.table(spark, folder, "lineitem"), "l_orderkey")


_FLAGS = ["treatment", "y", "gender_f", "redeemed_before_cutoff", "n_stores"]


@query(
    "e3_binary_flags",
    with_(
        "frame",
        " UNION ALL ".join(
            f"SELECT '{f}' AS \"column\", count(*) FILTER (WHERE {f} IS NULL) AS nulls, "
            f"count(*) FILTER (WHERE {f} NOT IN (0, 1)) AS outside FROM frame"
            for f in _FLAGS
        ),
    ),
)
def e3(spark, folder):
    return quality.flag_violations(inputs.labeled(spark, folder), _FLAGS)


@query(
    "e4_some_feature",
    "SELECT 'no_features' AS \"check\", '' AS subject, 'no feature columns' AS detail",
)
def e4(spark, folder):
    return quality.check_feature_table(inputs.labeled(spark, folder).drop(*FEATURES, "split"))


@query(
    "e5_numeric_features",
    "SELECT 'non_numeric' AS \"check\", 'split' AS subject, 'string' AS detail",
)
def e5(spark, folder):
    return quality.check_feature_table(inputs.labeled(spark, folder))


@query(
    "e6_merge_complete",
    """
SELECT merge, CAST(sum(copies) AS BIGINT) AS "rows", count(*) FILTER (WHERE copies > 0) AS keys,
  count(*) AS labeled, sum(copies) = count(*) AND max(copies) = 1 AS complete
FROM (SELECT 'whole' AS merge, 1 AS copies FROM customer
  UNION ALL SELECT 'lost', CAST(c_custkey % 7 <> 0 AS INTEGER) FROM customer
  UNION ALL SELECT 'repeated', 1 + CAST(c_custkey % 10 = 0 AS INTEGER) FROM customer
  UNION ALL SELECT 'swapped', CASE c_custkey % 10 WHEN 0 THEN 2 WHEN 1 THEN 0 ELSE 1 END FROM customer)
GROUP BY 1
""",
)
def e6(spark, folder):
    """A sound merge, one that lost clients, one that repeats some, and one that does both."""
    whole, labels = inputs.labeled(spark, folder), star.labels(spark, folder)
    tenth = whole.where(c(KEY) % 10 == 0)
    merges = {
        "whole": whole,
        "lost": whole.where(c(KEY) % 7 != 0),
        "repeated": whole.unionByName(tenth),
        "swapped": whole.where(c(KEY) % 10 != 1).unionByName(tenth),
    }
    return reduce(
        DataFrame.unionByName,
        [
            quality.check_merge(merged, labels).withColumn("merge", F.lit(name))
            for name, merged in merges.items()
        ],
    )


@query(
    "e7_all_shards_present",
    f"""
SELECT CAST(k AS INTEGER) AS shard FROM range(0, 4096) AS r(k)
WHERE k NOT IN (SELECT {sql_bucket("c_custkey", 4096)} FROM customer)
""",
)
def e7(spark, folder):
    placed = inputs.labeled(spark, folder).select(bucket(c(KEY), 4096).alias("shard"))
    return quality.missing_shards(placed, 4096)


@query(
    "e8_parameter_domain",
    """
SELECT k AS shard, k >= 0 AND k < 64 AS valid, count(*) AS requests
FROM (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY 1, 2
""",
)
def e8(spark, folder):
    asked = star.table(spark, folder, "events").select(
        F.get_json_object("props", "$.k").cast("int").alias("shard")
    )
    valid = quality.in_range(c("shard"), 64)
    return asked.groupBy("shard", valid.alias("valid")).agg(F.count(F.lit(1)).alias("requests"))


# Scoring requests, one row per record, with what each record has.
cte(
    "records_in",
    """
SELECT c_custkey AS c,
  CASE WHEN c_custkey % 4000 < 1200 THEN 'big-' || c_custkey // 4000
    ELSE 'r-' || c_custkey // 40 END AS request,
  (c_custkey // 40) % 3 = 1 AND c_custkey % 9 = 0 AS empty,
  NOT ((c_custkey // 40) % 3 = 2 AND c_custkey % 13 = 0) AS has_age,
  (c_custkey // 40) % 6 = 5 AND c_custkey % 7 = 0 AS has_extra,
  'k' || c_custkey % 17 AS extra
FROM customer
""",
)
cte(
    "faults",
    """
SELECT request, o, t, row_number() OVER (PARTITION BY request ORDER BY o, t) AS rn
FROM (SELECT DISTINCT request, 0 AS o, 'missing age' AS t FROM records_in WHERE NOT has_age
  UNION ALL SELECT DISTINCT request, 1, 'unknown ' || extra FROM records_in WHERE has_extra)
""",
    "records_in",
)
cte(
    "empties",
    """
SELECT request, position, row_number() OVER (PARTITION BY request ORDER BY position) AS rn
FROM (SELECT request, empty,
    CAST(row_number() OVER (PARTITION BY request ORDER BY c) - 1 AS INTEGER) AS position
  FROM records_in)
WHERE empty
""",
    "records_in",
)
cte("sizes", "SELECT request, count(*) AS n FROM records_in GROUP BY 1", "records_in")


@query(
    "e9_feature_set",
    with_(
        "sizes faults",
        "SELECT request, coalesce(string_agg(t, ', ' ORDER BY o, t) FILTER (WHERE rn <= 10), '') "
        "AS faults FROM sizes LEFT JOIN faults USING (request) GROUP BY 1",
    ),
)
def e9(spark, folder):
    found = rq.mismatches(c("records"), inputs.REQUEST_FEATURES)
    return inputs.requests(spark, folder).select(
        "request", F.array_join(found, ", ").alias("faults")
    )


@query("e10_all_null_records", with_("empties", "SELECT request, position FROM empties"))
def e10(spark, folder):
    return inputs.requests(spark, folder).select(
        "request", F.explode(rq.empty_records(c("records"))).alias("position")
    )


@query(
    "e11_batch_size",
    with_(
        "sizes",
        "SELECT request, CAST(n AS INTEGER) AS records, n BETWEEN 1 AND 1000 AS ok FROM sizes",
    ),
)
def e11(spark, folder):
    return inputs.requests(spark, folder).select(
        "request", F.size("records").alias("records"), rq.size_ok(c("records")).alias("ok")
    )


@query(
    "e12_pinned_uri",
    """
SELECT page_id, uri, NOT starts_with(uri, 'models:') OR regexp_matches(uri, '/[0-9]+/*$') AS pinned
FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN 'models:/lift/' || page_id
  WHEN 2 THEN 'models:/lift@best' WHEN 3 THEN 'models:/lift/v' || page_id
  ELSE 'models:/lift/' || page_id || '/' END AS uri FROM pages)
""",
)
def e12(spark, folder):
    kind = c("page_id") % 5
    page = c("page_id").cast("string")
    uri = (
        F.when(kind == 0, c("url"))
        .when(kind == 1, F.concat(F.lit("models:/lift/"), page))
        .when(kind == 2, F.lit("models:/lift@best"))
        .when(kind == 3, F.concat(F.lit("models:/lift/v"), page))
        .otherwise(F.concat(F.lit("models:/lift/"), page, F.lit("/")))
    )
    named = star.table(spark, folder, "pages").select("page_id", uri.alias("uri"))
    return named.withColumn("pinned", is_pinned(c("uri")))


REASONS_SQL = """
SELECT request,
  CASE WHEN n NOT BETWEEN 1 AND 1000 THEN 'batch_size' WHEN f IS NOT NULL THEN 'feature_mismatch'
    WHEN e IS NOT NULL THEN 'all_null' END AS reason,
  CASE WHEN n NOT BETWEEN 1 AND 1000 THEN 'records: ' || n
    WHEN f IS NOT NULL THEN 'features do not match the model: [' || f || ']'
    WHEN e IS NOT NULL THEN 'records with all features null: [' || e || ']' END AS detail
FROM sizes
LEFT JOIN (SELECT request, string_agg('''' || t || '''', ', ' ORDER BY o, t) AS f
  FROM faults WHERE rn <= 10 GROUP BY 1) USING (request)
LEFT JOIN (SELECT request, string_agg(CAST(position AS VARCHAR), ', ' ORDER BY position) AS e
  FROM empties WHERE rn <= 10 GROUP BY 1) USING (request)
"""


@query("e13_reject_reason", with_("sizes faults empties", REASONS_SQL))
def e13(spark, folder):
    checked = rq.validate_requests(inputs.requests(spark, folder), inputs.REQUEST_FEATURES)
    return checked.select("request", "reason", "detail")


@query("f1_order_by_key", with_("frame", "SELECT client_id, age, total_spend FROM frame"))
def f1(spark, folder):
    return inputs.labeled(spark, folder).select(KEY, "age", "total_spend").orderBy(KEY)


@query(
    "f2_order_by_score",
    with_("wide_scores", "SELECT client_id, score_tied, treatment, y FROM wide_scores"),
)
def f2(spark, folder):
    rows = inputs.wide_scores(spark, folder).select(KEY, "score_tied", TREATMENT, OUTCOME)
    return rank.sorted_by_score(rows, "score_tied", KEY)


@query(
    "f3_top_fraction",
    with_(
        "arms",
        "SELECT learner, client_id, score FROM arms "
        "WHERE i <= greatest(CAST(floor(n * 0.2::DOUBLE) AS BIGINT), 1)",
    ),
)
def f3(spark, folder):
    scores = inputs.scores(spark, folder).select("learner", KEY, "score")
    return rank.top_fraction(scores, "score", KEY, 0.2, by=["learner"])


@query(
    "f4_first_rows",
    with_("frame", "SELECT client_id, treatment, y FROM frame ORDER BY client_id LIMIT 5"),
)
def f4(spark, folder):
    rows = inputs.labeled(spark, folder).select(KEY, TREATMENT, OUTCOME)
    return rows.orderBy(KEY).limit(5)


@query(
    "f6_row_index",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders",
)
def f6(spark, folder):
    return rank.row_index(star.table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "f7_running_totals",
    with_("arms", "SELECT learner, client_id, i, n, ct, cc, yt, yc FROM arms"),
)
def f7(spark, folder):
    arms = ev.running_arms(inputs.scores(spark, folder), KEY)
    return arms.select("learner", KEY, "i", "n", "ct", "cc", "yt", "yc")


@query(
    "f8_undefined_head",
    with_(
        "heads",
        "SELECT learner, lift_from, round(lift_first, 9) AS lift_first, qini_from, "
        "round(qini_first, 9) AS qini_first FROM heads",
    ),
)
def f8(spark, folder):
    heads = ev.first_defined(ev.running_arms(inputs.scores(spark, folder), KEY))
    return heads.withColumns(
        {f: F.round(f, 9) for f in ("lift_first", "qini_first")}
    )


@query(
    "f9_even_grid",
    with_(
        "arms",
        """
SELECT learner, i FROM arms WHERE i IN (
  SELECT CAST(round_even(k * (n / 100.0::DOUBLE), 0) AS BIGINT) FROM range(0, 101) AS r(k))
""",
    ),
)
def f9(spark, folder):
    arms = ev.running_arms(inputs.scores(spark, folder), KEY)
    return ev.curve_grid(arms).select("learner", "i")


@query("g1_stratified_split", with_("split_marks", "SELECT client_id, split FROM split_marks"))
def g1(spark, folder):
    rows = star.labels(spark, folder).select(
        KEY, c("treatment_flg").alias(TREATMENT), c("target").alias(OUTCOME)
    )
    return split.stratified_split(rows, KEY, [TREATMENT, OUTCOME]).select(KEY, "split")


@query(
    "g2_stratified_sample",
    with_(
        "labels_in",
        f"""
SELECT client_id, treatment, y FROM (
  SELECT *, row_number() OVER (PARTITION BY treatment, y ORDER BY {u("client_id", 42)}, client_id)
      AS rn, count(*) OVER (PARTITION BY treatment, y) AS n, count(*) OVER () AS total
  FROM labels_in)
WHERE total <= 1000 OR rn <= round_even(n * (1000::DOUBLE / total), 0)
""",
    ),
)
def g2(spark, folder):
    rows = inputs.labeled(spark, folder).select(KEY, TREATMENT, OUTCOME)
    return split.stratified_sample(rows, KEY, [TREATMENT, OUTCOME], 1000, 42)


@query("g3_resample", with_("scenario_baseline", "SELECT draw, client_id FROM scenario_baseline"))
def g3(spark, folder):
    rows = inputs.held_out(spark, folder).select(KEY)
    return split.resample(rows, KEY, rows.count(), inputs.SCENARIO_SEED)


@query("g4_bernoulli_mask", f"SELECT o_orderkey, {u('o_orderkey', 5)} < 0.3::DOUBLE AS hit FROM orders")
def g4(spark, folder):
    return star.table(spark, folder, "orders").select(
        "o_orderkey", split.bernoulli("o_orderkey", 0.3, 5).alias("hit")
    )


@query(
    "g5_choose_rows",
    f"""
SELECT o_orderkey FROM (SELECT o_orderkey,
  row_number() OVER (ORDER BY {u("o_orderkey", 6)}, o_orderkey) AS rn FROM orders)
WHERE rn <= (SELECT count(*) // 4 FROM orders)
""",
)
def g5(spark, folder):
    keys = star.table(spark, folder, "orders").select("o_orderkey")
    return split.choose(keys, "o_orderkey", keys.count() // 4, 6)


@query(
    "g6_permute_column",
    f"""
WITH sized AS (SELECT o_orderkey, o_orderstatus, count(*) OVER () AS n, n // 2 AS k,
  row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders),
placed AS (SELECT *, {bijection("idx", "n", 20)} AS place FROM sized),
giving AS (SELECT {bijection("place", "k", 21)} AS place, o_orderstatus AS moved
  FROM placed WHERE place < k)
SELECT o_orderkey, CASE WHEN p.place < k THEN moved ELSE o_orderstatus END AS o_orderstatus
FROM placed p LEFT JOIN giving g ON g.place = p.place
""",
)
def g6(spark, folder):
    rows = star.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return split.permute(rows, "o_orderkey", "o_orderstatus", rows.count() // 2, 20)


_SHOWN = ["draw", KEY, TREATMENT, OUTCOME, *FEATURES]

for _n, _scenario in enumerate(SCENARIOS, 1):

    def _drifted(spark, folder, scenario=_scenario):
        return inputs.scenario(spark, folder, scenario).select(*_SHOWN)

    _table = f"scenario_{_scenario}"
    query(f"h{_n}_{_scenario}", with_(_table, f"SELECT {', '.join(_SHOWN)} FROM {_table}"))(_drifted)


@query(
    "h5_strength_zero",
    with_(
        "held_out",
        """
SELECT scenario, (SELECT count(*) FROM held_out) AS "rows", 0::BIGINT AS changed
FROM (VALUES ('covariate'), ('missing'), ('concept')) AS s(scenario)
""",
    ),
)
def h5(spark, folder):
    """Rows of each scenario at strength 0 that differ from the plain resample."""
    rows = inputs.held_out(spark, folder).select(KEY, TREATMENT, OUTCOME, "age", "total_spend")
    n = rows.count()
    base = make_scenario(rows, KEY, "baseline", n, inputs.SCENARIO_SEED)
    base = base.select("draw", F.xxhash64(*base.columns).alias("before"))
    out = None
    for scenario in SCENARIOS[1:]:
        same = make_scenario(rows, KEY, scenario, n, inputs.SCENARIO_SEED, strength=0.0)
        after = same.select("draw", F.xxhash64(*same.columns).alias("after"))
        part = base.join(after, "draw", "left").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~c("before").eqNullSafe(c("after"))).alias("changed"),
        )
        part = part.select(F.lit(scenario).alias("scenario"), "rows", "changed")
        out = part if out is None else out.unionByName(part)
    return out
