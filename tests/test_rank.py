"""Global ranks, splits, samples and scenarios against brute force."""

import math
import random
from collections import Counter
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from liftwise.functions.hashing import bijection
from liftwise.operators import rank, split
from liftwise.operators.perturb import SCENARIOS, make_scenario


@pytest.fixture(scope="module")
def scored(spark):
    """Two groups, a third of all rows sharing one score."""
    rng = random.Random(1)
    rows = [
        ("a" if i % 4 else "b", i, 0.5 if i % 3 == 0 else round(rng.random(), 2), i % 5)
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "g string, id bigint, score double, v bigint"), rows


def test_running_totals_over_many_slices(spark, scored, many_slices):
    df, rows = scored
    out = rank.running_totals(df.repartition(7), "score", "id", ["v"], by=["g"])
    got = {(r["g"], r["id"]): r for r in out.collect()}
    for g in "ab":
        total = 0
        part = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        whole = sum(r[3] for r in part)
        for i, r in enumerate(part, 1):
            total += r[3]
            row = got[g, r[1]]
            assert (row["rank"], row["group_size"]) == (i, len(part))
            assert (row["cum_v"], row["total_v"]) == (total, whole)


def test_slices_are_spread(spark, scored, many_slices):
    """The tied third is split as well: no slice holds it whole."""
    df, _ = scored
    sizes = (
        df.repartitionByRange(F.col("score").desc(), F.col("id"))
        .groupBy(F.spark_partition_id())
        .count()
        .collect()
    )
    assert max(r["count"] for r in sizes) < 1000


def test_row_index_is_dense(scored, many_slices):
    df, rows = scored
    got = {r["id"]: r["idx"] for r in rank.row_index(df.select("id"), "id").collect()}
    assert got == {r[1]: i for i, r in enumerate(sorted(rows, key=lambda r: r[1]))}


def test_top_fraction_keeps_at_least_one(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.3), (3, 0.2)], "id int, score double")
    assert [r["id"] for r in rank.top_fraction(df, "score", "id", 0.2).collect()] == [2]


def test_split_is_stratified_exact_and_stable(spark, many_slices):
    df = spark.range(1000).select(
        F.col("id").alias("client_id"),
        (F.col("id") % 2).alias("treatment"),
        (F.col("id") % 10 == 0).cast("int").alias("y"),
    )
    strata = ["treatment", "y"]
    marks = split.stratified_split(df, "client_id", strata)
    test = marks.where("split = 'test'")
    assert test.count() == 300
    shares = {
        (r["treatment"], r["y"]): r["s"]
        for r in marks.groupBy(*strata)
        .agg(F.avg((F.col("split") == "test").cast("int")).alias("s"))
        .collect()
    }
    assert all(s == pytest.approx(0.3, abs=0.01) for s in shares.values())
    again = split.stratified_split(df.repartition(5), "client_id", strata)
    assert {r["client_id"] for r in test.collect()} == {
        r["client_id"] for r in again.where("split = 'test'").collect()
    }


def test_narrow_band_gives_the_same_cut_as_ranking_all(spark, many_slices):
    df = spark.range(20_000).withColumnRenamed("id", "k")
    from liftwise.functions.hashing import uniform

    want = {
        r["k"]
        for r in df.orderBy(uniform(F.col("k"), 4), "k").limit(1234).collect()
    }
    assert {r["k"] for r in split.choose(df, "k", 1234, 4).collect()} == want


def test_choose_more_than_there_are(spark):
    assert split.choose(spark.range(10).withColumnRenamed("id", "k"), "k", 50, 1).count() == 10


def test_stratified_sample(spark):
    df = spark.range(500).select(
        F.col("id").alias("k"), (F.col("id") % 2).alias("treatment"), F.lit(0).alias("y")
    )
    sample = split.stratified_sample(df, "k", ["treatment", "y"], 100, 1)
    assert {r["treatment"]: r["count"] for r in sample.groupBy("treatment").count().collect()} == {
        0: 50,
        1: 50,
    }
    assert split.stratified_sample(df, "k", ["treatment", "y"], 500, 1).count() == 500


def test_resample_has_exactly_n_rows(spark, many_slices):
    df = spark.range(50).withColumnRenamed("id", "k")
    out = split.resample(df, "k", 170, 3)
    assert out.count() == out.select("draw").distinct().count() == 170


def test_permute_keeps_the_values(spark, many_slices):
    df = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 4).alias("v"))
    out = split.permute(df, "k", "v", 200, 9)
    moved = out.join(df.withColumnRenamed("v", "w"), "k").where("v <> w").count()
    assert 100 < moved <= 200
    assert sorted(r["v"] for r in out.collect()) == sorted(r["v"] for r in df.collect())


def test_seats_of_many_strata_need_no_single_task(spark, monkeypatch):
    i = F.col("id")
    counts = spark.range(3000).select(
        F.when(i > 0, i % 50).alias("a"), i.alias("b"), (1 + i * 7 % 13).alias("n")
    )
    few = split.largest_remainder(counts, ["a", "b"], 0.3)
    monkeypatch.setattr(rank, "BROADCAST_ROWS", 20)
    many = split.largest_remainder(counts, ["a", "b"], 0.3)
    assert "SinglePartition" not in many._jdf.queryExecution().toString()
    got = {r["b"]: r["quota"] for r in many.collect()}
    assert got == {r["b"]: r["quota"] for r in few.collect()}
    rows = [(1 + k * 7 % 13, k, k % 50 if k else -1) for k in range(3000)]
    total = sum(n for n, _, _ in rows)
    wanted = math.ceil(total * 0.3)
    ideal = {k: n * wanted / total for n, k, _ in rows}
    left = wanted - sum(map(math.floor, ideal.values()))
    best = sorted(rows, key=lambda r: (math.floor(ideal[r[1]]) - ideal[r[1]], r[2], r[1]))[:left]
    more = {k for _, k, _ in best}
    assert got == {k: math.floor(x) + (k in more) for k, x in ideal.items()}
    assert split.largest_remainder(counts.limit(0), ["a"], 0.3).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 100, 1009])
def test_bijection_is_one_to_one(spark, n):
    ids = spark.range(n)
    for seed in (1, 2):
        got = [r[0] for r in ids.select(bijection(F.col("id"), n, seed)).collect()]
        assert sorted(got) == list(range(n))
    many = 2**40 + 7
    far = spark.range(many - 500, many).select(bijection(F.col("id"), many, 3).alias("to"))
    assert far.where(F.col("to").between(0, many - 1)).distinct().count() == 500


def swapped(x: int, n: int, seed: int) -> int:
    """The bijection of one number in plain Python."""
    prime = 2**31 - 1
    for r in range(1, 33):
        digits = md5(f"{seed}:{r}".encode()).hexdigest()
        shift, factor, plus = int(digits[:13], 16), int(digits[13:21], 16), int(digits[21:29], 16)
        other = (shift - x) % n
        if (max(x, other) % prime * (factor % prime) + plus) % prime < 2**30:
            x = other
    return x


def test_bijections_are_spread_evenly(spark):
    for n, seed in ((4, 5), (1009, 6), (2**40 + 7, 7)):
        ids = spark.range(max(0, n - 300), n)
        got = dict(ids.select("id", bijection(F.col("id"), n, seed)).collect())
        assert got == {x: swapped(x, n, seed) for x in got}
    seen = Counter(tuple(swapped(i, 4, seed) for i in range(4)) for seed in range(2400))
    # All 24 orders, 100 of each expected; 49.7 is the 0.1 % point of chi-squared.
    assert len(seen) == 24
    assert sum((c - 100) ** 2 / 100 for c in seen.values()) < 49.7


def test_permute_with_numbered_rows_ranks_nothing(spark):
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 5).alias("v"))
    dense = split.permute(df, "k", "v", 120, 9, size=300)
    assert sorted(dense.collect()) == sorted(split.permute(df, "k", "v", 120, 9).collect())
    assert "rangepartitioning" not in dense._jdf.queryExecution().toString()
    kept = dense.join(df.withColumnRenamed("v", "w"), "k").where("v = w").count()
    assert 180 <= kept < 230
    nulls = df.withColumn("v", F.when(F.col("v") > 1, F.col("v")))
    moved = split.permute(nulls, "k", "v", 300, 9)
    assert moved.where("v is null").count() == nulls.where("v is null").count() == 120
    assert split.permute(df.limit(0), "k", "v", 5, 9).count() == 0
    assert split.permute(df, "k", "v", 1000, 9).groupBy("v").count().count() == 5


@pytest.fixture(scope="module")
def people(spark):
    i = F.col("id")
    return spark.range(4000).select(
        i.alias("client_id"),
        (18 + i % 62).cast("double").alias("age"),
        (100.0 + (i * 37) % 5000).alias("total_spend"),
        (i % 20).cast("double").alias("n_transactions"),
        F.pmod(F.xxhash64(i), F.lit(2)).cast("int").alias("treatment"),
        ((F.pmod(F.xxhash64(i), F.lit(2)) == 1) & (18 + i % 62 > 50)).cast("int").alias("y"),
    )


def _mean(df, c):
    return df.agg(F.avg(c)).first()[0]


def test_covariate_moves_inputs_only(people):
    base = make_scenario(people, "client_id", "baseline", 3000, 2)
    out = make_scenario(people, "client_id", "covariate", 3000, 2)
    assert _mean(out, "total_spend") == pytest.approx(1.5 * _mean(base, "total_spend"))
    assert _mean(out, "age") == pytest.approx(_mean(base, "age") + 10)
    assert base.select("draw", "y").exceptAll(out.select("draw", "y")).count() == 0


def test_missing_loses_about_30_percent(people):
    out = make_scenario(people, "client_id", "missing", 3000, 3)
    assert 0.25 < _mean(out, F.col("age").isNull().cast("int")) < 0.35
    assert out.where("treatment is null").count() == 0


def test_concept_removes_the_effect_only(people):
    base = make_scenario(people, "client_id", "baseline", 3000, 4)
    out = make_scenario(people, "client_id", "concept", 3000, 4)
    same = ["draw", "age", "y"]
    assert base.select(*same).exceptAll(out.select(*same)).count() == 0
    assert out.agg(F.sum("treatment")).first() == base.agg(F.sum("treatment")).first()
    rates = {
        r["treatment"]: r["r"]
        for r in out.where("age > 50").groupBy("treatment").agg(F.avg("y").alias("r")).collect()
    }
    assert abs(rates[1] - rates[0]) < 0.2


@pytest.mark.parametrize("name", SCENARIOS)
def test_strength_zero_is_the_baseline(people, name):
    base = make_scenario(people, "client_id", "baseline", 300, 5)
    assert make_scenario(people, "client_id", name, 300, 5, 0.0).exceptAll(base).count() == 0


def test_unknown_scenario(people):
    with pytest.raises(ValueError, match="no scenario"):
        make_scenario(people, "client_id", "nope", 10)


def brute_top(rows, k):
    """(group, key) of the best max(floor(n*k), 1) of each group; no score comes last."""
    chosen = set()
    for g in {r[0] for r in rows}:
        inside = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2] is None, -(r[2] or 0), r[1]))
        chosen |= {(g, r[1]) for r in inside[: max(int(len(inside) * k), 1)]}
    return chosen


@pytest.mark.parametrize("k", [0.0, 0.2, 0.5, 0.97, 1.0])
@pytest.mark.parametrize("all_rows", [0, 10**6])
def test_top_fraction_with_ties_and_nulls(spark, k, all_rows, many_slices, monkeypatch):
    monkeypatch.setattr(rank, "RANK_ALL", all_rows)
    rng = random.Random(11)
    rows = [("even", i, rng.random()) for i in range(900)]
    rows += [("tied", i, float(rng.randrange(3))) for i in range(700)] + [("one", 1, 5.0)]
    rows += [("nulls", i, None if i % 3 else 1.0) for i in range(60)] + [("none", i, None) for i in range(7)]
    df = spark.createDataFrame(rows, "g string, id int, s double").repartition(5)
    got = rank.top_fraction(df.withColumn("more", F.lit(1)), "s", "id", k, by=["g"])
    assert got.columns == ["g", "id", "s", "more"]
    assert {(r["g"], r["id"]) for r in got.collect()} == brute_top(rows, k)
    for g in ("tied", "nulls", "none", "absent"):
        alone = rank.top_fraction(df.where(F.col("g") == g), "s", "id", k)
        assert {(g, r["id"]) for r in alone.collect()} == brute_top([r for r in rows if r[0] == g], k)


@pytest.mark.parametrize("few", [0, 10_000])
def test_ranks_of_groups_take_no_exchange_after_the_sort(spark, few, many_slices, monkeypatch):
    monkeypatch.setattr(rank, "BROADCAST_ROWS", few)
    rng = random.Random(2)
    rows = [(rng.choice("aabbbbbbc"), rng.randrange(9), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, s int, id int").repartition(7)
    out = rank.ranked(df, [F.col("s").desc(), F.col("id").asc()], ["g"])
    places = {}
    for g in "abc":
        inside = sorted((-s, i) for h, s, i in rows if h == g)
        places |= {i: (n, len(inside)) for n, (_, i) in enumerate(inside, 1)}
    assert {r["id"]: (r["rank"], r["group_size"]) for r in out.collect()} == places
    if few:
        shape = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in shape and "Exchange range" not in shape
