"""Qini, AUUC and targeting against plain formulas."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from liftwise.operators import evaluate as ev

SCHEMA = "learner string, client_id bigint, score double, treatment int, y int"


def trial(n, seed, score=lambda tau: tau):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tau, w = rng.random() * 0.5, rng.randrange(2)
        rows.append(("m", i, score(tau), w, int(rng.random() < 0.2 + tau * w)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def plain(rows):
    """Curves by pandas, as the published definitions have them."""
    df = pd.DataFrame(rows, columns=["learner", "id", "score", "w", "y"])
    df = df.sort_values(["score", "id"], ascending=[False, True]).reset_index(drop=True)
    df.index += 1
    ct, cc = df.w.cumsum(), (1 - df.w).cumsum()
    yt, yc = (df.y * df.w).cumsum(), (df.y * (1 - df.w)).cumsum()
    lift = yt / ct.replace(0, np.nan) - yc / cc.replace(0, np.nan)
    qini = yt - yc * ct / cc.replace(0, np.nan)
    zero = pd.Series({0: 0.0})
    lift = pd.concat([zero, lift]).sort_index().interpolate()
    qini = pd.concat([zero, qini]).sort_index().interpolate()
    gain = lift * lift.index
    gain, qini = gain / abs(gain.iloc[-1]), qini / abs(qini.iloc[-1])
    line = np.linspace(0, qini.iloc[-1], len(qini))
    return {
        "lift": lift,
        "gain": gain,
        "curve": qini,
        "auuc": gain.mean(),
        "qini": (qini - line).mean(),
    }


def test_true_ranking_beats_reversed(spark):
    good = ev.uplift_metrics(frame(spark, trial(4000, 0)), "client_id").first()
    bad = ev.uplift_metrics(frame(spark, trial(4000, 0, lambda t: -t)), "client_id").first()
    assert good["qini"] > bad["qini"]
    assert good["auuc"] > bad["auuc"]


@pytest.mark.parametrize("score", [lambda t: t, lambda t: round(t, 1), lambda t: 0.0])
def test_metrics_equal_the_plain_formulas(spark, score, many_slices):
    rows = trial(500, 1, score)
    want, got = plain(rows), ev.uplift_metrics(frame(spark, rows), "client_id").first()
    assert got["qini"] == pytest.approx(want["qini"], abs=1e-12)
    assert got["auuc"] == pytest.approx(want["auuc"], abs=1e-12)


def test_undefined_head_runs_straight_from_zero(spark, many_slices):
    """The best six clients are all treated, so no rate of the control arm is known yet."""
    rows = [("m", i, 1.0 - i / 100, int(i < 6 or i % 2), int(i < 4 or i % 3 == 0)) for i in range(60)]
    want = plain(rows)
    arms = ev.running_arms(frame(spark, rows), "client_id")
    lift = {r["i"]: r["lift"] for r in ev.cumulative_lift(arms).collect()}
    assert lift == pytest.approx({i: v for i, v in want["lift"].items() if i})
    metrics = ev.uplift_metrics(frame(spark, rows), "client_id").first()
    assert metrics["auuc"] == pytest.approx(want["auuc"])
    assert metrics["qini"] == pytest.approx(want["qini"])


def test_curve_area_is_the_score(spark):
    rows = trial(500, 2)
    curve = ev.qini_curve(frame(spark, rows), "client_id", points=501).orderBy("i").collect()
    assert [curve[0]["fraction"], curve[-1]["fraction"]] == [0.0, 1.0]
    area = sum(r["qini"] - r["random"] for r in curve) / len(curve)
    assert area == pytest.approx(ev.uplift_metrics(frame(spark, rows), "client_id").first()["qini"])
    assert [r["qini"] for r in curve] == pytest.approx(list(plain(rows)["curve"]))


@pytest.mark.parametrize("n", [4, 99, 100, 101, 257, 1000])
def test_curve_points_are_even_and_distinct(spark, n):
    rows = [("m", i, float(-i), (i // 2) % 2, i % 2) for i in range(n)]
    curve = ev.qini_curve(frame(spark, rows), "client_id").orderBy("i").collect()
    want = np.unique(np.linspace(0, n, 101).round().astype(int)).tolist()
    assert [r["i"] for r in curve] == want


def test_four_rows(spark):
    rows = [("m", 0, 0.4, 1, 1), ("m", 1, 0.3, 1, 0), ("m", 2, 0.2, 0, 1), ("m", 3, 0.1, 0, 0)]
    curve = ev.qini_curve(frame(spark, rows), "client_id").orderBy("i").collect()
    assert [r["fraction"] for r in curve] == [0.0, 0.25, 0.5, 0.75, 1.0]


def test_observed_effect_does_not_depend_on_the_model(spark):
    rows = [("m", i, 0.0, int(i < 2), int(i < 2)) for i in range(4)]
    metrics = ev.uplift_metrics(frame(spark, rows), "client_id").first()
    assert metrics["ate"] == 1.0
    assert metrics["mean_uplift"] == 0.0


def test_no_total_effect_gives_null_not_infinity(spark):
    rows = [("m", i, float(i), i % 2, (i // 2) % 2) for i in range(8)]
    metrics = ev.uplift_metrics(frame(spark, rows), "client_id").first()
    assert metrics["ate"] == 0.0
    assert metrics["qini"] is None and metrics["auuc"] is None


def test_targeting(spark):
    """Treated buy only among the best fifth."""
    n = 1000
    rows = [("m", i, 1 - i / n, i % 2, int(i % 2 == 1 and i < n // 5)) for i in range(n)]
    scores = frame(spark, rows)
    assert ev.top_lift(scores, "client_id").first()["top_lift"] == pytest.approx(1.0)
    table = ev.targeting_table(ev.incremental_curve(scores, "client_id"), [0, 20, 100])
    got = {r["k"]: r for r in table.collect()}
    assert (got[0]["clients"], got[0]["model"]) == (1, 0.0)
    assert got[20]["model"] == pytest.approx(200.0)
    assert got[20]["random"] == pytest.approx(0.2 * got[100]["model"])


def test_top_lift_of_one_arm_is_null(spark):
    rows = [("m", i, float(-i), int(i < 5), 1) for i in range(20)]
    assert ev.top_lift(frame(spark, rows), "client_id").first()["top_lift"] is None


def test_best_learner_prefers_the_first_of_equals(spark):
    metrics = spark.createDataFrame(
        [("x", 0.2), ("t", 0.2), ("s", 0.1)], "learner string, qini double"
    )
    assert ev.best_learner(metrics, ["t", "x", "s"]).first()["learner"] == "t"


def test_several_learners_share_one_random_line(spark):
    rows = trial(300, 3) + [("r", i, -s, w, y) for _, i, s, w, y in trial(300, 3)]
    table = ev.wide_curve(ev.qini_curve(frame(spark, rows), "client_id"), ["m", "r"])
    assert table.columns == ["fraction", "m", "r", "random"]
    last = table.where(F.col("fraction") == 1.0).first()
    assert last["m"] == pytest.approx(last["r"])
    assert last["random"] == pytest.approx(last["m"])
