"""Quality rules: base statistics, then a calibrated classifier on hashed n-grams.

Features are relative counts of hashed word uni- and bigrams and of character trigrams over
the whole text (a word that repeats the word before it is a bigram of its own). A logistic
regression is fitted on a bounded sample of labelled rows (TRAIN_ROWS, those with the
smallest hash of their id), its scores are turned into probabilities on rows held out from
the fit (Platt's method), and rows are kept from THRESHOLD on. Documents are scored in Arrow
batches; the weights are the only thing broadcast, of fixed size.

Null or empty text has no words and fails the base rules. With no labelled rows, or labels
of one class only, no model can be fitted: then only the base rules decide. Null labels and
repeated label rows are fine: nulls are left out, a document counts as good only if all its
labels say so. Other columns stay; result columns replace input columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import SPACES, Cache, mix, rolled, small_batches, words

TRAIN_ROWS = 2400
THRESHOLD = 0.5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WORD_BUCKETS = 1 << 13
CHAR_BUCKETS = 1 << 12
BUCKETS = WORD_BUCKETS + CHAR_BUCKETS
SYMBOLS = b"#*$%&|<>"
STEPS, RATE, RIDGE, SCALE = 160, 0.05, 1e-4, 30.0

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_hash = Cache(xxhash.xxh64_intdigest)


def base_counts(text: str | None, found: list[bytes]) -> tuple[int, int, int, int, int]:
    """The values of BASE for a text and its words."""
    if not found:
        symbols = len(text.encode("utf-8", "surrogatepass")) if text else 0
        return 0, 0, 0 if not symbols else _symbols(text), 0, 0
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(found),
        chars,
        _symbols(text),
        len(lines) - len(set(lines)),
        repeat_words(found),
    )


def _symbols(text: str) -> int:
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw) - len(raw.translate(None, SYMBOLS))


def repeat_words(found: list[bytes]) -> int:
    """Words inside five-word windows that occur twice or more, the first one included."""
    windows = list(zip(found, found[1:], found[2:], found[3:], found[4:], strict=False))
    seen, twice = set(), set()
    if len(set(windows)) == len(windows):
        return 0
    for w in windows:
        if w in seen:
            twice.add(w)
        seen.add(w)
    starts = np.fromiter((w in twice for w in windows), bool, len(windows))
    covered = np.zeros(len(found) + 1, np.int64)
    covered[: len(windows)] += starts
    covered[5 : 5 + len(windows)] -= starts[: len(covered) - 5]
    return int((np.cumsum(covered)[: len(found)] > 0).sum())


def failed(n_words: int, n_repeat: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED_PERCENT * n_words


def buckets(text: str, found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word n-grams and character trigrams of a text, as bucket numbers."""
    one = np.fromiter(map(_hash.__getitem__, found), np.uint64, len(found))
    two = rolled(one, 2)
    if len(two):
        two[one[1:] == one[:-1]] = 0
    grams = mix(np.concatenate([one, two])) >> np.uint64(64 - 13)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    tri = (raw[:-2] * np.uint32(0x9E3779B1)) ^ (raw[1:-1] * np.uint32(0x85EBCA77))
    tri = (tri ^ (raw[2:] * np.uint32(0xC2B2AE3D))) * np.uint32(0x27D4EB2F)
    return grams.astype(np.int64), (tri >> np.uint32(32 - 12)).astype(np.int64)


def features(text: str, found: list[bytes]) -> np.ndarray:
    """The dense feature row of a training text."""
    out = np.zeros(BUCKETS, np.float32)
    word, char = buckets(text, found)
    if len(word):
        out[:WORD_BUCKETS] = np.bincount(word, minlength=WORD_BUCKETS) / len(word)
    if len(char):
        out[WORD_BUCKETS:] = np.bincount(char, minlength=CHAR_BUCKETS) / len(char)
    return out * SCALE


@dataclass
class QualityModel:
    """p = sigmoid(slope * (x . weights + bias) + shift), the probability of good."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, text: str, found: list[bytes]) -> float:
        word, char = buckets(text, found)
        score = self.bias
        if len(word):
            score += SCALE * float(self.weights[word].mean())
        if len(char):
            score += SCALE * float(self.weights[WORD_BUCKETS + char].mean())
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -500, 500))))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, good, features) of the sample; `rows` bounds what is broadcast and collected."""
    spark = docs.sparkSession
    small_batches(spark)
    picked = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_good"))
        .where("_id IS NOT NULL AND _good IS NOT NULL")
        .groupBy("_id")
        .agg(F.min("_good").alias("_good"))
        .orderBy(F.xxhash64(F.lit("quality"), "_id"), "_id")
        .limit(rows)
    )

    @F.pandas_udf("binary")
    def row(texts: pd.Series) -> pd.Series:
        return pd.Series([_packed(features(t or "", words(t))) for t in texts])

    return (
        docs.select(F.col("doc_id").alias("_id"), F.col("text").cast("string").alias("_text"))
        .join(F.broadcast(picked), "_id")
        .select("_id", "_good", F.substring(F.sha2("_text", 256), 1, 16).alias("_key"),
                row("_text").alias("_row"))
    )


def _packed(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row)
    return at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    n = len(packed) // 6
    out = np.zeros(BUCKETS, np.float32)
    out[np.frombuffer(packed, "<u2", n)] = np.frombuffer(packed, "<f4", n, 2 * n)
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> QualityModel | None:
    """The model, or None when the sample holds fewer than two classes."""
    found = sorted(training_rows(docs, labels, rows).collect(), key=lambda r: (r[2] or "", r[0]))
    found = found[:rows]  # an id that occurs in several rows of docs
    good = np.array([r["_good"] > 0 for r in found], np.float64)
    if len(found) < 8 or good.min() == good.max():
        return None
    x = np.stack([_unpacked(r["_row"]) for r in found])
    held = np.arange(len(found)) % 4 == 3
    if good[~held].min() == good[~held].max():
        held[:] = False
    weights, bias = _logistic(x[~held], good[~held])
    score = x @ weights + bias
    check = held if held.any() and good[held].min() < good[held].max() else ~held
    slope, shift = _platt(score[check], good[check])
    return QualityModel(weights, bias, slope, shift)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by full-batch Adam; both classes weigh the same."""
    w, b = np.zeros(x.shape[1] + 1), 0.0
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1].astype(np.float32) + w[-1], -60, 60)))
        gap = ((p - y) * share).astype(np.float32)
        g = np.append(gap @ x + RIDGE * w[:-1], gap.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    b = float(w[-1])
    return w[:-1].astype(np.float32), b


def _platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by damped Newton steps, on targets smoothed as Platt proposed."""
    up, down = y.sum(), len(y) - y.sum()
    goal = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    a, c = 1.0, 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * score + c, -60, 60)))
        s = np.maximum(p * (1 - p), 1e-9)
        gap = p - goal
        h = np.array([[(s * score * score).sum() + 1e-3, (s * score).sum()],
                      [(s * score).sum(), s.sum() + 1e-3]])
        move = np.linalg.solve(h, [(gap * score).sum(), gap.sum()])
        a, c = a - float(np.clip(move[0], -1, 1)), c - float(np.clip(move[1], -2, 2))
    return max(a, 1e-3), c


VERDICT = "".join(f"{n} long, " for n in BASE) + "base_failed boolean, quality double, kept boolean"


def judge(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs with the base counts, base_failed, quality (the probability of good; null
    without a model or after failing the base rules) and kept."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(VERDICT)
    def verdict(texts: pd.Series) -> pd.DataFrame:
        rows, model = [], shared.value
        for t in texts:
            found = words(t)
            counts = base_counts(t, found)
            bad = failed(counts[0], counts[4])
            p = None if bad or model is None else model.probability(t, found)
            rows.append((*counts, bad, p, not bad and (p is None or p >= threshold)))
        out = pd.DataFrame(rows, columns=[*BASE, "base_failed", "quality", "kept"])
        return out.astype({"quality": "float64"})

    names = [*BASE, "base_failed", "quality", "kept"]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(*rest, verdict(F.col("text").cast("string")).alias("_verdict_"))
    return out.select(*rest, *[F.col(f"_verdict_.{n}").alias(n) for n in names])
