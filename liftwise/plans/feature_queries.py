"""Queries over expressions, joins and aggregates of the client feature build."""

from __future__ import annotations

from pyspark.sql import functions as F

from liftwise.functions import exprs as X
from liftwise.functions.hashing import bucket, uniform
from liftwise.operators import features as feat
from liftwise.operators import quality
from liftwise.operators.evaluate import best_learner, uplift_metrics
from liftwise.operators.score import mark_held_out
from liftwise.operators.split import strata_counts
from liftwise.plans import inputs
from liftwise.plans.registry import query
from liftwise.plans.sql import bucket as sql_bucket
from liftwise.plans.sql import days, dsum, with_
from liftwise.schemas import FEATURES, KEY, OUTCOME, TREATMENT
from liftwise.sources import star_schema as star
from liftwise.sources.tables import fingerprint

c = F.col


def _cutoff(spark, folder):
    return feat.as_cutoff(star.purchases(spark, folder), None)


@query("b1_age_range", with_("person", "SELECT client_id, age FROM person"))
def b1(spark, folder):
    clients = star.clients(spark, folder)
    return clients.select(KEY, X.within(c("age"), *feat.AGE_RANGE).alias("age"))


@query(
    "b2_gender_flags",
    with_("person", "SELECT client_id, gender_f, gender_m, gender_u FROM person"),
)
def b2(spark, folder):
    clients = star.clients(spark, folder)
    flags = [X.flag(c("gender") == g).alias(f"gender_{g.lower()}") for g in feat.GENDERS]
    return clients.select(KEY, *flags)


@query("b3_days_between", with_("person", "SELECT client_id, tenure_days FROM person"))
def b3(spark, folder):
    tenure = X.days_between(_cutoff(spark, folder), c("first_issue_date"))
    return star.clients(spark, folder).select(KEY, tenure.alias("tenure_days"))


@query(
    "b4_censored_flag",
    with_("person", "SELECT client_id, redeemed_before_cutoff FROM person"),
)
def b4(spark, folder):
    known = X.known_by(c("first_redeem_date"), _cutoff(spark, folder))
    return star.clients(spark, folder).select(KEY, known.alias("redeemed_before_cutoff"))


@query(
    "b5_censored_interval",
    with_("person", "SELECT client_id, days_issue_to_redeem FROM person"),
)
def b5(spark, folder):
    cutoff = _cutoff(spark, folder)
    waited = X.censored_days(c("first_issue_date"), c("first_redeem_date"), cutoff)
    return star.clients(spark, folder).select(KEY, waited.alias("days_issue_to_redeem"))


@query("b6_month_key", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def b6(spark, folder):
    return star.table(spark, folder, "orders").select(
        "o_orderkey", X.month_key(c("o_orderdate")).alias("month")
    )


@query("b7_hash_bucket", f"SELECT c_custkey, {sql_bucket('c_custkey', 8)} AS shard FROM customer")
def b7(spark, folder):
    return star.table(spark, folder, "customer").select(
        "c_custkey", bucket(c("c_custkey"), 8).alias("shard")
    )


@query(
    "b8_recent_interval",
    with_(
        "receipts cut",
        "SELECT client_id, transaction_id, bought_at FROM receipts "
        "WHERE bought_at > (SELECT cutoff FROM cut) - INTERVAL 30 DAY",
    ),
)
def b8(spark, folder):
    lines = star.purchases(spark, folder)
    recent = c("bought_at") > X.days_before(_cutoff(spark, folder), feat.RECENT_DAYS)
    return feat.transaction_rollup(lines).where(recent).select(KEY, "transaction_id", "bought_at")


@query(
    "b9_sign_flip",
    with_("receipts", "SELECT client_id, transaction_id, regular_used, express_used FROM receipts"),
)
def b9(spark, folder):
    rolled = feat.transaction_rollup(star.purchases(spark, folder))
    return rolled.select(KEY, "transaction_id", "regular_used", "express_used")


@query(
    "b10_safe_ratio",
    with_(
        "receipts",
        "SELECT client_id, transaction_id, redeemed_units / nullif(regular_used, 0) AS per_point "
        "FROM receipts",
    ),
)
def b10(spark, folder):
    rolled = feat.transaction_rollup(star.purchases(spark, folder))
    per_point = X.ratio(c("redeemed_units"), c("regular_used"))
    return rolled.select(KEY, "transaction_id", per_point.alias("per_point"))


@query(
    "b11_null_to_zero",
    with_(
        "lines",
        f"""
SELECT client_id, {dsum("coalesce(trn_sum_from_red, 0)")} AS redeemed,
  count(*) - count(trn_sum_from_red) AS filled FROM lines GROUP BY 1
""",
    ),
)
def b11(spark, folder):
    red = c("trn_sum_from_red")
    return (
        star.purchases(spark, folder)
        .groupBy(KEY)
        .agg(
            X.exact_sum(X.or_zero(red)).alias("redeemed"),
            F.count_if(red.isNull()).alias("filled"),
        )
    )


@query("b12_casts", with_("frame", "SELECT * FROM frame"))
def b12(spark, folder):
    table = feat.labeled_features(inputs.features(spark, folder), star.labels(spark, folder))
    return feat.training_frame(table)


@query(
    "b13_exclude_rename",
    with_(
        "labeled",
        "SELECT client_id AS id, y AS outcome, treatment AS arm, "
        "age, tenure_days FROM labeled",
    ),
)
def b13(spark, folder):
    table = feat.labeled_features(inputs.features(spark, folder), star.labels(spark, folder))
    dropped = [f for f in FEATURES if f not in ("age", "tenure_days")]
    renamed = table.drop(*dropped).withColumnsRenamed(
        {KEY: "id", TREATMENT: "arm", OUTCOME: "outcome"}
    )
    return renamed.select("id", "outcome", "arm", "age", "tenure_days")


@query(
    "b14_bounded_label",
    with_("request_log", "SELECT path, count(*) AS requests FROM request_log GROUP BY 1"),
)
def b14(spark, folder):
    log = inputs.request_log(spark, folder)
    return log.groupBy("path").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "b15_drift_flag",
    "SELECT event_id, CASE WHEN value / 250 > 0.2::DOUBLE THEN 'DRIFT' ELSE '' END AS flag "
    "FROM events",
)
def b15(spark, folder):
    return star.table(spark, folder, "events").select(
        "event_id", X.drift_flag(c("value") / 250).alias("flag")
    )


@query(
    "b16_formatting",
    """
SELECT printf('c%08d', o_custkey) AS client, printf('t%010d', o_orderkey) AS txn,
  o_orderdate + to_seconds(o_orderkey % 86400) AS shifted,
  CAST(o_orderdate + to_days(CAST(o_orderkey % 500 AS INTEGER)) AS TIMESTAMP) AS later,
  round(o_totalprice / 3, 2) AS third
FROM orders
""",
)
def b16(spark, folder):
    key = c("o_orderkey")
    seconds = F.make_dt_interval(secs=(key % 86400).cast("decimal(18,6)"))
    spread = F.make_dt_interval(days=(key % 500).cast("int"))
    return star.table(spark, folder, "orders").select(
        F.format_string("c%08d", "o_custkey").alias("client"),
        F.format_string("t%010d", "o_orderkey").alias("txn"),
        (c("o_orderdate") + seconds).alias("shifted"),
        (c("o_orderdate") + spread).alias("later"),
        F.round(c("o_totalprice") / 3, 2).alias("third"),
    )


_JSON = ["age", "total_spend", "mean_days_between_txn", "n_products"]


@query("b17_json_records", with_("frame", f"SELECT client_id, {', '.join(_JSON)} FROM frame"))
def b17(spark, folder):
    text = inputs.labeled(spark, folder).select(KEY, X.record_json(_JSON).alias("record"))
    parsed = text.select(KEY, X.parse_record(c("record")).alias("r"))
    return parsed.select(KEY, *[c("r").getItem(f).alias(f) for f in _JSON])


@query(
    "c1_left_joins",
    with_(
        "clients activity assortment",
        "SELECT client_id, n_transactions, n_products FROM clients "
        "LEFT JOIN activity USING (client_id) LEFT JOIN assortment USING (client_id)",
    ),
)
def c1(spark, folder):
    lines = star.purchases(spark, folder)
    rolled = feat.transaction_rollup(lines)
    spending = rolled.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_transactions"))
    return (
        star.clients(spark, folder)
        .select(KEY)
        .join(spending, KEY, "left")
        .join(feat.client_products(lines), KEY, "left")
    )


@query(
    "c2_inner_join_labels",
    with_(
        "person labels_in",
        "SELECT client_id, age, treatment, y FROM person JOIN labels_in USING (client_id)",
    ),
)
def c2(spark, folder):
    part = feat.client_profile(star.clients(spark, folder), _cutoff(spark, folder))
    return feat.labeled_features(part.select(KEY, "age"), star.labels(spark, folder))


@query(
    "c3_scalar_into_rows",
    with_(
        "cut",
        f"SELECT o_orderkey, cutoff, {days('cutoff', 'o_orderdate')} AS days_before "
        "FROM orders, cut",
    ),
)
def c3(spark, folder):
    cutoff = _cutoff(spark, folder)
    return star.table(spark, folder, "orders").select(
        "o_orderkey",
        cutoff.alias("cutoff"),
        X.days_between(cutoff, c("o_orderdate")).alias("days_before"),
    )


@query(
    "c4_align_by_key",
    with_(
        "wide_scores frame",
        "SELECT client_id, age, score_hashed FROM wide_scores JOIN frame USING (client_id)",
    ),
)
def c4(spark, folder):
    """The key travels with the score, so predictions need no row positions."""
    rows = inputs.labeled(spark, folder)
    return rows.select(KEY, "age", uniform(c(KEY), 7).alias("score_hashed"))


@query("c5_mark_held_out", with_("split_marks", "SELECT client_id, split FROM split_marks"))
def c5(spark, folder):
    clients = star.labels(spark, folder).select(KEY)
    return mark_held_out(clients, inputs.held_out(spark, folder).select(KEY))


@query(
    "c6_pair_arms",
    with_(
        "labels_in",
        """
SELECT gender, round(avg(y) FILTER (WHERE treatment = 1) - avg(y) FILTER (WHERE treatment = 0), 9)
  AS difference
FROM labels_in JOIN clients USING (client_id) GROUP BY 1
""",
    ).replace("WITH ", "WITH clients AS (SELECT c_custkey AS client_id, c_mktsegment AS gender "
                       "FROM customer),\n", 1),
)
def c6(spark, folder):
    segments = star.table(spark, folder, "customer").select(
        c("c_custkey").alias(KEY), c("c_mktsegment").alias("gender")
    )
    rows = star.labels(spark, folder).join(segments, KEY)
    rate = {a: F.avg(F.when(c("treatment_flg") == a, c("target"))) for a in (0, 1)}
    return rows.groupBy("gender").agg(F.round(rate[1] - rate[0], 9).alias("difference"))


@query(
    "c7_sequence_product",
    "SELECT o_orderkey, l AS line, CAST(1 + l % 3 AS DOUBLE) AS quantity "
    "FROM orders, range(3) AS r(l)",
)
def c7(spark, folder):
    """Every order with line numbers 0..2: the short sequence explodes, nothing shuffles."""
    lines = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint")))
    return (
        star.table(spark, folder, "orders")
        .select("o_orderkey", lines.alias("line"))
        .withColumn("quantity", (1 + c("line") % 3).cast("double"))
    )


@query(
    "c8_missing_parts",
    f"""
SELECT CAST(k AS INTEGER) AS shard FROM range(0, 200) AS r(k)
WHERE k NOT IN (SELECT {sql_bucket("user_id", 200)} FROM events)
""",
)
def c8(spark, folder):
    placed = star.table(spark, folder, "events").select(bucket(c("user_id"), 200).alias("shard"))
    return quality.missing_shards(placed, 200)


@query("d1_transaction_rollup", with_("receipts", "SELECT * FROM receipts"))
def d1(spark, folder):
    return feat.transaction_rollup(star.purchases(spark, folder))


@query("d2_client_aggregate", with_("purchase_part", "SELECT * FROM purchase_part"))
def d2(spark, folder):
    lines = star.purchases(spark, folder)
    rolled = feat.transaction_rollup(lines)
    return feat.client_aggregate(rolled, _cutoff(spark, folder))


@query("d3_client_products", with_("assortment", "SELECT client_id, n_products FROM assortment"))
def d3(spark, folder):
    return feat.client_products(star.purchases(spark, folder))


@query(
    "d4_exact_sum",
    f"SELECT l_suppkey, {dsum('l_extendedprice * l_discount')} AS total FROM lineitem GROUP BY 1",
)
def d4(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    total = X.exact_sum(c("l_extendedprice") * c("l_discount"))
    return lines.groupBy("l_suppkey").agg(total.alias("total"))


@query(
    "d5_exact_mean",
    f"SELECT l_suppkey, {dsum('l_extendedprice')} / count(l_extendedprice) AS mean "
    "FROM lineitem GROUP BY 1",
)
def d5(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return lines.groupBy("l_suppkey").agg(X.exact_mean(c("l_extendedprice")).alias("mean"))


@query(
    "d6_filtered_aggregates",
    with_("recent", "SELECT client_id, n_transactions_30d, spend_30d FROM recent"),
)
def d6(spark, folder):
    recent = c("bought_at") > X.days_before(_cutoff(spark, folder), feat.RECENT_DAYS)
    rolled = feat.transaction_rollup(star.purchases(spark, folder))
    spent = F.when(recent, c("spend")).otherwise(0.0)
    return rolled.groupBy(KEY).agg(
        F.count_if(recent).alias("n_transactions_30d"), X.exact_sum(spent).alias("spend_30d")
    )


@query(
    "d7_count_distinct",
    with_(
        "receipts",
        "SELECT client_id, count(DISTINCT store) AS n_stores, "
        "count(DISTINCT strftime(bought_at, '%Y-%m')) AS active_months FROM receipts GROUP BY 1",
    ),
)
def d7(spark, folder):
    rolled = feat.transaction_rollup(star.purchases(spark, folder))
    rolled = rolled.withColumn("month", X.month_number(c("bought_at")))
    return rolled.groupBy(KEY).agg(
        F.count_distinct("store").alias("n_stores"),
        F.count_distinct("month").alias("active_months"),
    )


@query(
    "d8_share_where",
    with_(
        "lines",
        "SELECT product_id, avg(CAST(trn_sum_from_red > 1000 AS INTEGER)) AS share "
        "FROM lines GROUP BY 1",
    ),
)
def d8(spark, folder):
    lines = star.purchases(spark, folder)
    share = X.share_where(c("trn_sum_from_red") > 1000)
    return lines.groupBy("product_id").agg(share.alias("share"))


@query("d9_arm_means", with_("labels_in", "SELECT treatment, avg(y) AS rate FROM labels_in GROUP BY 1"))
def d9(spark, folder):
    rows = star.labels(spark, folder).select(
        c("treatment_flg").cast("int").alias(TREATMENT), c("target").alias(OUTCOME)
    )
    return rows.groupBy(TREATMENT).agg(F.avg(OUTCOME).alias("rate"))


@query(
    "d10_key_counts",
    'SELECT count(*) AS "rows", count(DISTINCT l_orderkey) AS keys FROM lineitem',
)
def d10(spark, folder):
    return quality.key_counts(star.table(spark, folder, "lineitem"), "l_orderkey")


# Engines print doubles differently: features go into the digest as ten-thousandths.
_PRINTED = ["client_id", "treatment", "y", *FEATURES]
_EXACT = ["client_id", "treatment", "y", *[
    f"CAST(round(CAST({f} AS DOUBLE) * 10000) AS BIGINT) AS {f}" for f in FEATURES
]]
_DIGEST = "md5(" + " || '|' || ".join(
    f"coalesce(length(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), 'null')"
    for f in _PRINTED
) + ")"


@query(
    "d11_fingerprint",
    with_(
        "labeled",
        f"""
SELECT count(*) AS "rows",
  CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR) AS sum_a,
  CAST(sum(CAST('0x' || substr(d, 16, 15) AS BIGINT)) AS VARCHAR) AS sum_b
FROM (SELECT {_DIGEST} AS d FROM (SELECT {", ".join(_EXACT)} FROM labeled))
""",
    ),
)
def d11(spark, folder):
    table = feat.labeled_features(inputs.features(spark, folder), star.labels(spark, folder))
    return fingerprint(table.selectExpr(*_EXACT), _PRINTED)


@query(
    "d12_best_learner",
    with_("metrics", "SELECT arg_max(learner, qini) AS learner, round(max(qini), 9) AS qini "
                     "FROM metrics"),
)
def d12(spark, folder):
    metrics = uplift_metrics(inputs.scores(spark, folder), KEY)
    best = best_learner(metrics, list(inputs.SCORES))
    return best.select("learner", F.round("qini", 9).alias("qini"))


@query(
    "d13_stratum_counts",
    with_("labels_in", "SELECT treatment, y, count(*) AS n FROM labels_in GROUP BY 1, 2"),
)
def d13(spark, folder):
    return strata_counts(inputs.labeled(spark, folder), [TREATMENT, OUTCOME])


@query(
    "d14_score_range",
    "SELECT min(c_acctbal) AS low, max(c_acctbal) AS high, round(avg(c_acctbal), 6) AS mean "
    "FROM customer",
)
def d14(spark, folder):
    score = "score_balance"
    return inputs.wide_scores(spark, folder).agg(
        F.min(score).alias("low"),
        F.max(score).alias("high"),
        F.round(F.avg(score), 6).alias("mean"),
    )


@query("d15_client_features", with_("features", "SELECT * FROM features"))
def d15(spark, folder):
    return inputs.features(spark, folder)


@query("d16_labeled_features", with_("labeled", "SELECT * FROM labeled"))
def d16(spark, folder):
    return feat.labeled_features(inputs.features(spark, folder), star.labels(spark, folder))
