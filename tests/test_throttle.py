"""Token buckets: the same answers as one caller after another, in batch and as a stream."""

import random
from datetime import datetime, timedelta

import pytest

from liftwise.streaming import throttle as th
from liftwise.streaming.jobs import file_stream

START = datetime(2024, 3, 1)
LOG = "request_id bigint, ts timestamp, caller string"
BIG = 2**60


def line_by_line(rows, rate, per):
    """Every caller's requests in order, one bucket each."""
    out, buckets = {}, {}
    for request, ts, caller in sorted(rows, key=lambda r: (r[1], r[0])):
        now = (ts - START).total_seconds()
        tokens, last = buckets.get(caller, (rate, now))
        tokens = rate if now - last >= per else min(rate, tokens + (now - last) * rate / per)
        out[request] = tokens >= 1
        buckets[caller] = (tokens - (tokens >= 1), now)
    return out


def requests(n, span, seed, callers=(None, "b", "c")):
    """Half of all requests are one caller's; quarters of seconds, so that times tie."""
    rng = random.Random(seed)
    return [
        (BIG + i, START + timedelta(seconds=rng.randrange(4 * span) / 4),
         "hot" if rng.random() < 0.5 else rng.choice(callers))
        for i in range(n)
    ]


def answered(df):
    return {r["request_id"]: r["accepted"] for r in df.collect()}


def test_a_bucket():
    accepted, tokens, last = th.take_tokens([0.0, 0.0, 0.0], 2.0, 1.0, 2.0, None)
    assert accepted == [True, True, False]
    accepted, tokens, _ = th.take_tokens([0.4, 0.6, 5.0], 2.0, 1.0, tokens, last)
    assert accepted == [False, True, True] and tokens == 1.0


def test_the_clock_never_runs_back():
    accepted, tokens, last = th.take_tokens([100.0] * 3, 2, 86400.0, 2.0, 200_000.0)
    assert accepted == [True, True, False]
    assert (tokens, last) == (0.0, 200_000.0)


@pytest.mark.parametrize(("rate", "per", "span"), [(1.0, 1.0, 300), (2.0, 4.0, 900), (4.0, 64.0, 90)])
def test_whole_tables_equal_line_by_line(spark, many_slices, rate, per, span):
    rows = requests(700, span, seed=int(per))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = answered(th.throttle(spark.createDataFrame(rows, LOG).repartition(5), rate, per))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == line_by_line(rows, rate, per)
    assert len(set(got.values())) == 2


def test_a_busy_caller_is_cut_at_pauses(spark):
    rows = spark.createDataFrame(requests(700, 900, seed=3), LOG)
    cut = th.pieces(th.as_rows(rows), 1.0).where("caller = 'hot'")
    sizes = [r["count"] for r in cut.groupBy("piece").count().collect()]
    assert len(sizes) > 50 and max(sizes) < sum(sizes) / 10


def test_odd_rows(spark):
    """No time: refused. No caller: one bucket. Repeated rows: a token each. No rows: none."""
    rows = [(1, None, "a"), (2, START, None), (3, START, None), (4, START, "b"), (4, START, "b")]
    df = spark.createDataFrame(rows, LOG)
    got = sorted((r["request_id"], r["accepted"]) for r in th.throttle(df, 1.0).collect())
    assert got == [(1, False), (2, True), (3, False), (4, False), (4, True)]
    assert th.throttle(df.where("false"), 1.0).count() == 0


def stream(spark, tmp_path, parts, rate, per, delay):
    """One file per part, in arrival order, a file per micro-batch."""
    at = {name: f"{tmp_path}/{name}" for name in ("in", "out", "state", "checkpoint")}
    for part in parts:
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(at["in"])
    source = file_stream(spark, at["in"], LOG, files_per_trigger=1)
    query = th.throttle_stream(source, rate, at["out"], at["state"], at["checkpoint"], per, delay)
    query.awaitTermination()
    return th.decisions(spark, at["out"]), th.open_decisions(spark, at["state"], rate, per), at


def test_files_in_any_order_equal_line_by_line(spark, tmp_path):
    """Times are up to a minute out of order between files, and in any order inside them."""
    rng = random.Random(4)
    rows = sorted(requests(400, 300, seed=9), key=lambda r: r[1] + timedelta(seconds=rng.randrange(60)))
    parts = [rng.sample(rows[i : i + 100], 100) for i in range(0, 400, 100)]
    done, still_open, _ = stream(spark, tmp_path, parts, 2.0, 4.0, delay=60)
    assert done.count() > 200 and still_open.count() > 0
    got = done.unionByName(still_open)
    assert got.count() == 400 and answered(got) == line_by_line(rows, 2.0, 4.0)


def test_buckets_outlive_a_batch_and_idle_callers_leave_nothing(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    many = [(100 + i, at(0), f"x{i}") for i in range(50)]
    parts = [
        [(1, at(0), "a"), (3, at(0.2), "a"), (2, at(0.1), "a"), (9, at(0), "b"), *many],
        [(4, at(0.3), "a"), (8, None, "a")],
        [(5, at(3), "a"), (6, at(1), "a")],
    ]
    done, still_open, where = stream(spark, tmp_path, parts, 2.0, 1.0, delay=0)
    got = answered(done.where("request_id < 100"))
    # 6 comes behind the clock (0.3) no more than the others: both lie ahead of it.
    assert got == {1: True, 2: True, 3: False, 4: False, 5: True, 6: True, 8: False, 9: True}
    assert done.where("request_id >= 100 and accepted").count() == 50
    assert still_open.count() == 0
    kept = spark.read.schema(th.ROWS).parquet(f"{where['state']}/version=2").collect()
    assert [(r["caller"], r["held"]) for r in kept] == [("a", 1.0)]
    assert not (tmp_path / "state" / "version=0").exists()


def test_late_requests_count_at_the_clock(spark, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    parts = [[(1, at(10), "a"), (2, at(10), "a")], [(3, at(2), "a"), (4, at(10.5), "a")]]
    done, _, _ = stream(spark, tmp_path, parts, 2.0, 1.0, delay=0)
    assert answered(done) == {1: True, 2: True, 3: False, 4: True}


def test_the_plan_has_no_task_per_caller(spark):
    df = spark.createDataFrame(requests(50, 50, seed=1), LOG)
    plan = th.throttle(df, 1.0)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Exchange hashpartitioning(caller#" in plan
    sorts = [line for line in plan.splitlines() if "Sort [caller" in line]
    assert any("piece" in line for line in sorts)
