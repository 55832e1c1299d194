"""Token buckets per caller: which requests pass a rate limit, decided in event time.

A caller's decisions depend on each other only until its bucket is full again, and a gap of
`per` seconds fills any bucket. A caller's line of requests is therefore cut at such gaps and
the pieces are decided in parallel, each by one task that streams over its sorted rows and
keeps two numbers. A caller who never pauses that long is one piece.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from liftwise.sources.store import version_numbers
from liftwise.sources.tables import exists, remove
from liftwise.streaming.jobs import each_batch, replace_batch

MICROS = 1_000_000
# Requests (`held` is null) and buckets (`held` tokens at `at`), in microseconds.
ROWS = "caller string, request_id bigint, ts timestamp, at bigint, held double"
DECIDED = f"{ROWS}, piece bigint, step bigint, accepted boolean, remaining double"

ANSWERS = "caller string, request_id bigint, ts timestamp, accepted boolean, batch int"


def take_tokens(
    seconds: Sequence[float], rate: float, per: float, tokens: float, last: float | None
) -> tuple[list[bool], float, float | None]:
    """Spend one token per request in time order; refused requests spend nothing.

    `rate` tokens return per `per` seconds, up to `rate`. The clock never runs back: a
    request older than one already decided spends a token and earns none.
    """
    accepted = []
    for now in seconds:
        if last is not None:
            waited = max(0.0, now - last)
            tokens = rate if waited >= per else min(rate, tokens + waited * (rate / per))
        last = now if last is None else max(last, now)
        ok = tokens >= 1
        tokens -= ok
        accepted.append(bool(ok))
    return accepted, tokens, last


def as_rows(requests: DataFrame, caller: str = "caller", clock: int | None = None) -> DataFrame:
    """Requests in the form the buckets read. Those without a time are not among them; those
    behind `clock` (microseconds) count as asked at that moment."""
    ts = F.col("ts").cast("timestamp")
    at = F.unix_micros(ts)
    return requests.select(
        F.col(caller).cast("string").alias("caller"),
        F.col("request_id").cast("bigint").alias("request_id"),
        ts.alias("ts"),
        (at if clock is None else F.greatest(at, F.lit(clock))).alias("at"),
        F.lit(None).cast("double").alias("held"),
    ).where("at is not null")


def pieces(rows: DataFrame, per: float) -> DataFrame:
    """Rows with `piece`, the start of the part of the caller's line they belong to.

    Rows combine per (caller, cell of `per` seconds) first: inside a cell no gap can be that
    long, and between cells its first and last moment show the exact gap.
    """
    length = F.lit(round(per * MICROS))
    celled = rows.withColumn("cell", F.col("at") - F.pmod("at", length))
    cells = celled.groupBy("caller", "cell").agg(F.min("at").alias("first"), F.max("at").alias("last"))
    line = Window.partitionBy("caller").orderBy("cell")
    gap = F.col("first") - F.lag("last").over(line)
    starts = cells.withColumn("start", F.when(gap.isNull() | (gap >= length), F.col("first")))
    named = starts.select(
        F.col("caller").alias("_caller"), F.col("cell").alias("_cell"), F.max("start").over(line).alias("piece")
    )
    same = F.col("caller").eqNullSafe(F.col("_caller")) & (F.col("cell") == F.col("_cell"))
    return celled.join(named, same).drop("_caller", "_cell", "cell")


def _spend(
    rate: float, per: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Decide sorted rows, piece by piece; only the piece at hand is kept between batches."""

    def spend(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tokens, last, step = None, rate, None, 0
        for part in parts:
            size = part.num_rows
            if not size:
                continue
            callers, starts, at, held = (
                part.column(name).to_numpy(zero_copy_only=False)
                for name in ("caller", "piece", "at", "held")
            )
            seconds = at / MICROS
            fresh = (callers[1:] != callers[:-1]) | (starts[1:] != starts[:-1])
            bounds = [0, *(np.flatnonzero(fresh) + 1), size]
            accepted, steps = np.zeros(size, bool), np.zeros(size, np.int64)
            remaining = np.full(size, np.nan)
            for low, high in pairwise(bounds):
                key = (callers[low], starts[low])
                if key != current:
                    current, tokens, last, step = key, rate, None, 0
                steps[low:high] = np.arange(step, step + high - low)
                step += high - low
                asked = low
                if not np.isnan(held[low]):
                    tokens, last, asked = held[low], seconds[low], low + 1
                accepted[asked:high], tokens, last = take_tokens(
                    seconds[asked:high].tolist(), rate, per, tokens, last
                )
                remaining[high - 1] = tokens
            new = [pa.array(steps), pa.array(accepted), pa.array(remaining, from_pandas=True)]
            names = [*part.schema.names, "step", "accepted", "remaining"]
            yield pa.RecordBatch.from_arrays([*part.columns, *new], names=names)

    return spend


def decide(rows: DataFrame, rate: float, per: float) -> DataFrame:
    """Rows with their decision, and the tokens `remaining` where a task leaves a piece."""
    order: list[str | Column] = ["caller", "piece", "at", F.col("held").isNull(), "ts", "request_id"]
    placed = pieces(rows, per).repartition("caller", "piece").sortWithinPartitions(*order)
    columns = [field.split()[0] for field in DECIDED.split(", ")]
    return placed.select(*columns[:6]).mapInArrow(_spend(rate, per), DECIDED)


def answers(decided: DataFrame) -> DataFrame:
    """(caller, request_id, ts, accepted) of the requests among decided rows."""
    return decided.where("held is null").select("caller", "request_id", "ts", "accepted")


def refused(requests: DataFrame, caller: str = "caller") -> DataFrame:
    """The answers to requests without a time."""
    return requests.select(
        F.col(caller).cast("string").alias("caller"),
        F.col("request_id").cast("bigint").alias("request_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(False).alias("accepted"),
    ).where("ts is null")


def throttle(requests: DataFrame, rate: float, per: float = 1.0, caller: str = "caller") -> DataFrame:
    """(caller, request_id, ts, accepted) of a whole table of requests.

    Requests without a time are refused and spend nothing; those without a caller share one
    bucket. Ties in time are settled by the id.
    """
    decided = decide(as_rows(requests, caller), rate, per)
    return answers(decided).unionByName(refused(requests, caller))


def buckets(decided: DataFrame, rate: float, per: float, clock: int) -> DataFrame:
    """What the callers' buckets hold, without those that are full again at `clock`."""
    last = F.struct("piece", "step")
    return (
        decided.groupBy("caller")
        .agg(F.max_by("remaining", last).alias("held"), F.max("at").alias("at"))
        .where((F.col("at") > clock - round(per * MICROS)) & (F.col("held") < rate))
        .select(
            "caller",
            F.lit(None).cast("bigint").alias("request_id"),
            F.lit(None).cast("timestamp").alias("ts"),
            "at",
            "held",
        )
    )


def _clock(spark: SparkSession, state: str, number: int) -> int | None:
    return spark.read.schema("clock bigint").parquet(f"{state}/clock/version={number}").first()[0]


def throttle_stream(
    stream: DataFrame,
    rate: float,
    path: str,
    state: str,
    checkpoint: str,
    per: float = 1.0,
    delay: float = 0.0,
    caller: str = "caller",
) -> StreamingQuery:
    """Decide a stream of requests into a table (caller, request_id, ts, accepted, batch).

    Requests may arrive in any order within `delay` seconds of the newest one: a request is
    decided once the clock, the newest time seen less `delay`, has reached it. One that comes
    later still counts as asked at the clock's moment; one without a time is refused.

    `state` holds, per micro-batch, the clock, the undecided requests and the buckets that are
    not full again: idle callers leave nothing behind. A micro-batch reads what the one before
    it left and replaces its own, so it may run again after a failure.
    """

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{state}/version={number - 1}"
        clock = _clock(spark, state, number - 1) if number else None
        rows = as_rows(batch, caller, clock)
        newest = batch.agg(F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()[0]
        seen = [t for t in (clock, None if newest is None else newest - round(delay * MICROS)) if t is not None]
        now = max(seen, default=None)
        if number:
            rows = rows.unionByName(spark.read.schema(ROWS).parquet(before))
        due = F.lit(False) if now is None else F.col("held").isNotNull() | (F.col("at") <= now)
        decided = decide(rows.where(due), rate, per).persist()
        try:
            replace_batch(answers(decided).unionByName(refused(batch, caller)), path, number)
            spark.createDataFrame([(now,)], "clock bigint").coalesce(1).write.mode("overwrite").parquet(
                f"{state}/clock/version={number}"
            )
            left = rows.where(~due)
            if now is not None:
                left = left.unionByName(buckets(decided, rate, per, now))
            left.write.mode("overwrite").parquet(f"{state}/version={number}")
        finally:
            decided.unpersist()
        for old in (f"{state}/version={number - 2}", f"{state}/clock/version={number - 2}"):
            remove(spark, old)

    return each_batch(stream, handle, checkpoint)


def decisions(spark: SparkSession, path: str) -> DataFrame:
    """The answers a stream has written; it may have written none so far."""
    return spark.read.schema(ANSWERS).parquet(path).drop("batch")


def open_decisions(spark: SparkSession, state: str, rate: float, per: float = 1.0) -> DataFrame:
    """The answers to requests the clock has not reached, if no others came before them."""
    done = [n for n in version_numbers(spark, state) if exists(spark, f"{state}/version={n}/_SUCCESS")]
    if not done:
        raise FileNotFoundError(f"{state} holds no finished micro-batch")
    rows = spark.read.schema(ROWS).parquet(f"{state}/version={max(done)}")
    return answers(decide(rows, rate, per))
