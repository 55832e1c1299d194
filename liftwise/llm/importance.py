"""Importance resampling towards a target: documents drawn in proportion to how much more their
words and word pairs are those of the target texts.

Features are all runs of one and two words; a feature's bucket is its crc32 modulo BUCKETS.
Arrow batches become arrays: words are numbered, each distinct word is hashed once, and the
hash of a pair comes from its words' hashes by the checksum's linear shift. A task adds up one
array of counts; buckets are summed by a shuffle, so BUCKETS rows reach the driver whatever the
input. The gains go back to all tasks as one array, and a second pass scores every document.

The draw takes the k highest scores (weight plus Gumbel noise of the keyed hash) without
sorting all rows: a quantile sketch gives a bracket around the cut, one exact count of the rows
above and inside validates it, and a bracket that misses the cut is widened. Only the bracket's
rows are sorted to find the cut; afterwards the drawn rows, and no others, are ranked.

Null text has no words, no features and weight 0. Equal scores go to the smaller doc_id, null
ids last; rows that repeat a doc_id are drawn one by one. An empty table has no rows; an empty
target is one without features. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import small_batches, stored
from liftwise.operators.rank import ranked

BUCKETS = 10_000
PERCENT = 25
MIN_WORDS = 20
SEED = "7"
# Bytes of text that are split into words at a time.
PIECE = 1 << 20
# Words of up to so many bytes are joined to pairs by table; longer ones one by one.
SHIFTS = 64
# Part of all rows on either side of the sketch's cut that the first bracket takes in.
MARGIN = 0.005

# A-Z become a-z; 0-9, a-z and all bytes of other letters stay; the rest is space.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
SCORED = "doc_id long, n_words long, n_features long, weight long, score long"

# crc32 in SQL: eight steps of the polynomial per byte, over the bytes' list (fixed polynomial).
_STEP = "CASE WHEN {c} & 1 = 1 THEN xor({c} >> 1, 3988292384) ELSE {c} >> 1 END"
ORACLE = f"""
WITH RECURSIVE steps(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) t(b)
  UNION ALL SELECT b, {_STEP.format(c="c")}, k + 1 FROM steps WHERE k < 8
), crcs AS (SELECT list(c ORDER BY b) AS crc_of FROM steps WHERE k = 8
), texts AS (
  SELECT 'd' AS side, row_number() OVER () AS i, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark
), listed AS (
  SELECT side, i, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts
), features AS (
  SELECT side, i, unnest(list_concat(w, list_transform(range(1, len(w)),
    lambda k: w[k::INTEGER] || ' ' || w[(k + 1)::INTEGER]))) AS f FROM listed
), hashed AS (
  SELECT f, (xor(list_reduce(
      list_prepend(4294967295, list_transform(range(octet_length(encode(f))),
        lambda k: ('0x' || substr(hex(encode(f)), (2 * k + 1)::INTEGER, 2))::BIGINT)),
      lambda a, b: xor(a >> 8, crc_of[(xor(a, b) & 255) + 1])), 4294967295)) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM features), crcs
), bucketed AS (SELECT side, i, bucket FROM features JOIN hashed USING (f)
), totals AS (
  SELECT count(*) FILTER (WHERE side = 'd')::DOUBLE AS all_d, count(*) FILTER (WHERE side = 't')::DOUBLE AS all_t
  FROM bucketed
), gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (all_d + 10000)) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain
  FROM (SELECT bucket, count(*) FILTER (WHERE side = 'd')::DOUBLE AS s,
          count(*) FILTER (WHERE side = 't')::DOUBLE AS t FROM bucketed GROUP BY bucket), totals
), weights AS (
  SELECT i, count(*) AS n, sum(gain)::BIGINT AS g FROM bucketed JOIN gains USING (bucket)
  WHERE side = 'd' GROUP BY i
), scored AS (
  SELECT i, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features,
    CASE WHEN n > 0 THEN (g - ((g % n) + n) % n) // n ELSE 0 END AS weight,
    ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM listed LEFT JOIN weights USING (i) WHERE side = 'd'
), noisy AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored
), drawn AS (
  SELECT i, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, i) AS rank,
    count(*) OVER () AS n FROM noisy WHERE n_words >= 20
)
SELECT doc_id, n_features::BIGINT AS n_features, weight::BIGINT AS weight, score::BIGINT AS score,
  CASE WHEN rank <= 25 * n // 100 THEN rank END AS rank
FROM noisy LEFT JOIN drawn USING (i)
"""


@cache
def shift_tables() -> np.ndarray:
    """[n, k, b]: what byte k of value b of a crc32 adds once n more bytes follow."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    out = np.empty((SHIFTS + 1, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(SHIFTS):
        out[n + 1] = (out[n] >> 8) ^ c[out[n] & 255]
    return out


def pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, PIECE bytes at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(WORDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _buckets(words: list[bytes], doc: np.ndarray, carried: bool) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of all features of some texts' words. The first word counts as a
    neighbour only if it was `carried` over from the piece before."""
    unique = list(dict.fromkeys(words))
    place = dict(zip(unique, range(len(unique)), strict=True))
    at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
    alone = np.fromiter(map(zlib.crc32, unique), np.uint32, len(unique))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in unique), np.uint32, len(unique))
    size = np.fromiter(map(len, unique), np.int64, len(unique)) + 1
    pair = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    left, right = alone[at[pair - 1]], at[pair]
    n = size[right]
    tables, near = shift_tables(), np.minimum(n, SHIFTS)
    both = spaced[right].copy()
    for k in range(4):
        both ^= tables[near, k, (left >> np.uint32(8 * k)) & np.uint32(255)]
    for j in np.flatnonzero(n > SHIFTS):
        both[j] = zlib.crc32(b" " + words[pair[j]], int(left[j]))
    own = slice(1, None) if carried else slice(None)
    docs = np.concatenate([doc[own], doc[pair]])
    return docs, np.concatenate([alone[at[own]], both]) % np.uint32(BUCKETS)


def buckets(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) arrays of all features of a batch, some PIECE bytes at a time."""
    words, docs, sizes, held, carried = [], [], [], 0, False
    for i, text in enumerate(texts):
        for piece in pieces(text):
            words += piece
            docs.append(i)
            sizes.append(len(piece))
            held += sum(map(len, piece))
            if held >= PIECE:
                yield _buckets(words, np.repeat(docs, sizes), carried)
                words, docs, sizes, held, carried = words[-1:], [i], [1], 0, True
    if len(words) > carried:
        yield _buckets(words, np.repeat(docs, sizes), carried)


def bucket_counts(texts: DataFrame, column: str = "text") -> DataFrame:
    """(bucket, n): the features of all texts."""

    def count(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, found in buckets(batch.column(0).to_pylist()):
                total += np.bincount(found, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS)), pa.array(total)], names=["bucket", "n"]
        )

    small_batches(texts.sparkSession)
    per_task = texts.select(F.col(column).cast("string")).mapInArrow(count, "bucket long, n long")
    return per_task.where("n > 0").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """Thousandths of log odds of each bucket in the target against all documents."""
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for counts, df in ((s, docs), (t, target)):
        for row in bucket_counts(df).collect():
            counts[row["bucket"]] = row["n"]
    of_docs, of_target = float(s.sum()) + BUCKETS, float(t.sum()) + BUCKETS
    return np.array(
        [math.floor(1000 * math.log((b + 1) * of_docs / ((a + 1) * of_target))) for a, b in zip(s, t, strict=True)],
        np.int64,
    )


def noise(doc_id: int | None, seed: str = SEED) -> int:
    name = "" if doc_id is None else doc_id
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every document."""

    def score(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            total = np.zeros(len(ids))
            n = np.zeros(len(ids), np.int64)
            for doc, found in buckets(texts):
                total += np.bincount(doc, gains[found], len(ids))
                n += np.bincount(doc, minlength=len(ids))
            weight = total.astype(np.int64) // np.maximum(n, 1)
            extra = np.fromiter((noise(i, seed) for i in ids), np.int64, len(ids))
            columns = [pa.array(ids, pa.int64()), *map(pa.array, ((n + 1) // 2, n, weight, weight + extra))]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCORED.split(", ")])

    small_batches(docs.sparkSession)
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(score, SCORED)


def _place(score, doc_id, row) -> Column:
    """Smaller for rows that are drawn earlier."""
    return F.struct((-score).alias("s"), doc_id.isNull().alias("u"), doc_id.alias("d"), row.alias("r"))


def cut_row(rows: DataFrame, k: int, n: int, margin: float = MARGIN):
    """The k-th row of n in order of the draw: (score, doc_id, row)."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    while True:
        share = [max(0.0, 1 - k / n - margin), min(1.0, 1 - k / n + margin)]
        low, high = rows.select(F.percentile_approx("score", share, 10_000)).first()[0]
        if margin >= 1:
            low, high = rows.agg(F.min("score"), F.max("score")).first()
        inside = F.col("score").between(low, high)
        above, within = rows.agg(F.count_if(F.col("score") > high), F.count_if(inside)).first()
        if above < k <= above + within:
            bracket = rows.where(inside).select("score", "doc_id", "row")
            return ranked(bracket, order).where(F.col("rank") == k - above).first()
        margin = max(8 * margin, MARGIN)


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Scored rows with `rank`: 1, 2, 3 ... in order of the draw, null for those left out."""
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scored")
    able = rows.where(F.col("n_words") >= min_words)
    n = able.count()
    k = n * percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    names = [c for c in rows.columns if c != "row"]
    if k == 0:
        return rows.select(*names, unranked)
    cut = cut_row(able, k, n)
    last = _place(F.lit(cut["score"]), F.lit(cut["doc_id"]).cast("long"), F.lit(cut["row"]))
    taken = (F.col("n_words") >= min_words) & (_place(F.col("score"), F.col("doc_id"), F.col("row")) <= last)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    chosen = ranked(rows.where(taken), order).select(*names, F.col("rank").cast("long"))
    return chosen.union(rows.where(~taken).select(*names, unranked))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Every document with its features, weight, score and place in the draw."""
    return drawn(scored(docs, bucket_gains(docs, target)), percent)
