"""Language-model scores from a probabilistic suffix tree over words.

Training documents are counted in Spark, level by level: words, then the next words of each
context seen MIN_COUNT times, for contexts of one to DEPTH words. A context is kept when its
next-word distribution diverges from that of its suffix (Kullback-Leibler divergence). A kept
context has discounted probabilities for its next words seen MIN_COUNT times and leaves the
freed mass to the next shorter suffix, down to add-one word probabilities, so that each
state's distribution sums to one. A text's score adds up log10 probabilities from the longest
kept suffix at each token.

Both floors are counts, so the model grows with the corpus. It is a stored table of n-grams
under 64-bit keys. An n-gram's weight is what its last word gains in it over the shorter
suffix, and what backing off from it costs the word after it; a text's score is the sum of
its words' base scores and its n-grams' weights. Levels are built and texts are scored by
shuffle joins on keys. N-grams travel in packed rows: those that a task has counted or met for
one of the buckets into which keys are dealt, about BUCKET_TOKENS tokens' worth in each, and a
bucket is counted, or joined with its weights, at once. Broadcast are caches of bounded size,
which change no result: the most frequent 1 / HEAD_SHARE words, the most frequent 2 / PAIR_SHARE
weights, and bitmaps of BITS to MOST_BITS bits that only let through too much. What the caches
lack is looked up by shuffles, in so many rounds over parts of the texts that one round looks up
about ROUND_SHARE keys a token. Shuffle files of a step are removed when its rows are stored, so
the disk holds those of one level or round at a time. Contexts and suffixes of at least
CONTEXT_SHARE of all tokens, so the hot ones, are looked up in a broadcast too.

Tokens are words between ASCII white space with A-Z in lower case, then one end. Rows whose
id's crc32 mod 7 is 2 are held out of training. Null or empty text is one end. A row without
doc_id is not held out. With nothing to train on, all counts are 0. Rows that repeat a doc_id
are rows of their own. Only doc_id and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from liftwise.llm import batches as common
from liftwise.llm.batches import as_bytes, batch_words, mix, small_batches

DEPTH = 3
HEAD_SHARE = 2.0**-21
CONTEXT_SHARE = 2e-5
PAIR_SHARE = 2.0**-21
MIN_COUNT = 8
DIVERGENCE = 0.01
DISCOUNT = 0.5
BITS, MOST_BITS = 1 << 25, 1 << 27
ROUND_SHARE = 0.3
SLICES = 4
END = "\n"  # no word holds it
FLUSH = 300_000
# N-grams that a worker holds before it hands them on, and n-grams that it hands on at once:
# what a task holds does not depend on how much it reads.
HELD_GRAMS = 500_000
SENT_ROWS = 50_000
# Tokens for each bucket, and buckets over which the next words of one context are spread.
BUCKET_TOKENS = 500_000
SPREAD = 64
# Texts whose sums are added up together, as a power of two.
BLOCK = 12
FOLDS, HELD = 7, 2


def _hash(word: bytes) -> int:
    """As Spark's xxhash64 has it, but unsigned."""
    return xxhash.xxh64_intdigest(word, 42)


END_HASH = np.uint64(_hash(END.encode()))


def held_out() -> Column:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    return F.coalesce(fold == HELD, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c), words and the end of all training texts; each task combines its own first."""
    schema = pa.schema([("word", pa.string()), ("c", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                schema=schema,
            )

        for batch in batches:
            distinct, places, _ = batch_words(batch.column(0), lower=True)
            times = np.bincount(places, minlength=len(distinct)).tolist()
            for word, n in zip(distinct.to_numpy(zero_copy_only=False), times, strict=True):
                if n:
                    seen[word] += n
            seen[END] += batch.num_rows
            if len(seen) > FLUSH:
                yield rows()
                seen.clear()
        yield rows()

    partial = train.select("text").mapInArrow(count, "word string, c long")
    return partial.groupBy("word").agg(F.sum("c").alias("c"))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, words), np.uint64, len(words))


def token_hashes(texts: pa.Array) -> np.ndarray:
    """Word hashes of all texts in a row, each text with its end."""
    distinct, places, sizes = batch_words(texts, lower=True)
    hashes = np.append(word_hashes(as_bytes(distinct)), END_HASH)
    return hashes[np.insert(places, np.cumsum(sizes), len(distinct))]


def joined_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Keys of n-grams from those of all their words but the last and all but the first."""
    return mix(context * np.uint64(3) + suffix)


def grams(hashes: np.ndarray, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to `longest`, the keys of the n-grams from each place on, and which of them
    lie in one text: an end is an n-gram's last word only. A word's hash is its key."""
    key, inside, ends = hashes, np.ones(len(hashes), bool), hashes == END_HASH
    out = [(key, inside)]
    for n in range(1, longest):
        size = max(len(key) - 1, 0)
        inside = inside[:size] & inside[1:] & ~ends[n - 1 : n - 1 + size]
        key = joined_keys(key[:size], key[1:])
        out.append((key, inside))
    return out


def stored(df: DataFrame, name: str) -> DataFrame:
    """As in batches; the shuffle files behind the rows are removed when they are written."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return common.stored(df, name)
    finally:
        conf.set(key, before)


def bitmap(keys: DataFrame) -> np.ndarray:
    """Which values of key mod the number of bits occur, as packed bits: BITS of them, or more up
    to MOST_BITS so that few are set."""
    bits, rows = BITS, keys.count()
    while bits < min(16 * rows, MOST_BITS):
        bits *= 2
    at = F.pmod("key", F.lit(bits)) + 1  # Spark counts places from 1
    parts = (
        keys.select(at.alias("at"))
        .groupBy(F.bitmap_bucket_number("at").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in parts.collect():
        some = np.frombuffer(bytes(r["bits"]), np.uint8)
        out[(r["bucket"] - 1) * len(some) : r["bucket"] * len(some)] = some
    return out


def _passes(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(8 * len(bits) - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def least_count(table: DataFrame, share: float) -> float:
    """A count c that at most 1 / share of the table's rows reach, and as many of them as steps of
    an eighth of a power of two allow; 0 if all rows may."""
    steps = table.groupBy(F.floor(F.log2("c") * 8).alias("step")).agg(F.count("*").alias("n"))
    rows, least = 0, float("inf")
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        rows += r["n"]
        if rows * share > 1:
            return least
        least = 2.0 ** (r["step"] / 8)
    return 0.0


def gathered(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a table (key, value) with the sums of their values, fetched in SLICES ranges
    of keys, so that the driver holds little besides them."""
    found = []
    for k in range(SLICES):
        some = table.where(bucket_column("key", SLICES) == k).toArrow()
        keys, at = np.unique(some["key"].to_numpy().view(np.uint64), return_inverse=True)
        found.append((keys, np.bincount(at, some["value"].to_numpy(), len(keys))))
    keys, sums = (np.concatenate(f) for f in zip(*found, strict=True))
    return keys, sums


class Tree:
    """What is broadcast: the cached words' sorted hashes with their base log10, the cached n-grams'
    sorted keys with their weights, and bitmaps of the other keys with a weight and of the n-grams
    of each length seen MIN_COUNT times. From `fit`, it also has the part of each weight that is the
    cost of backing off, and the cached words."""

    def __init__(self, total: int, distinct: int):
        self.total, self.distinct = total, distinct
        self.buckets = 1 + total // BUCKET_TOKENS
        self.words, self.base = np.zeros(0, np.uint64), np.zeros(0)
        self.keys, self.weights, self.backs = np.zeros(0, np.uint64), np.zeros(0), np.zeros(0)
        self.bits = np.zeros(BITS // 8, np.uint8)
        self.levels: list[np.ndarray] = []
        self.least_word = self.least_gram = 0.0
        self.head: list[str] = []

    def ids(self, words: list[str]) -> np.ndarray:
        return _find(self.words, word_hashes([w.encode() for w in words]))

    def score(self, ids: np.ndarray) -> tuple[float, float, np.ndarray]:
        """Base and model log10 sums of a text's cached words, from cached n-grams; the model sum
        also holds the cost of backing off before other words. The text may lack its end: then
        no word is read after the last one."""
        known = ids >= 0
        base = total = float(self.base[ids[known]].sum())
        hashes = np.append(self.words, np.uint64(0))[ids]
        for n, (keys, inside) in enumerate(grams(hashes, DEPTH + 1), 1):
            at = _find(self.keys, keys)
            at[~inside] = -1
            total += float(self.weights[at[at >= 0]].sum())
            if len(ids) >= n and at[len(ids) - n] >= 0:
                total -= float(self.backs[at[len(ids) - n]])
        return base, total, known

    def rounds(self, missing: int) -> int:
        """How many parts of the texts are scored one after the other, from how often all that the
        caches lack occurs in training, and from what the bitmap lets through besides."""
        if not self.total:
            return 1
        beside = DEPTH * int(np.bitwise_count(self.bits).sum()) / (8 * len(self.bits))
        return 1 + int((missing / self.total + beside) / ROUND_SHARE)


def _find(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of values in a sorted array, -1 where missing."""
    if not len(ordered):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return np.where(ordered[at] == values, at, -1)


def changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    out = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=out[1:])
    return out


NONE = np.zeros(0, np.uint64)


def homes(context: np.ndarray, suffix: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The upper half of a key by which n-grams are dealt to be counted: those of a context lie
    together, as equal values next to each other take little room, but those of the contexts in
    `spread` lie in SPREAD places, so that a very frequent context fills no task."""
    salt = np.where(_find(spread, context) >= 0, suffix & np.uint64(SPREAD - 1), np.uint64(0))
    return mix(context + salt) & ~np.uint64((1 << 32) - 1)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """In ascending order as the keys are; `bucket_column` is the same in Spark."""
    return ((keys >> np.uint64(33)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int32)


def bucket_column(key: str, buckets: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(key, 33) * F.lit(buckets).cast("long"), 31).cast("int")


def packed(bucket: np.ndarray, *columns: np.ndarray) -> list[pa.Array]:
    """Ascending buckets, and for each its values in lists."""
    first = np.flatnonzero(changes(bucket))
    ends = pa.array(np.append(first, len(bucket)).astype(np.int32))
    return [pa.array(bucket[first]), *(pa.ListArray.from_arrays(ends, c if isinstance(c, pa.Array) else pa.array(c)) for c in columns)]


def unpacked(lists: pa.ChunkedArray) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy()


GRAMS = pa.schema([("ctx", pa.int64()), ("suf", pa.int64()), ("c", pa.int64())])


def counted_grams(
    batches: Iterator[pa.RecordBatch], n: int, bits: np.ndarray, spread: np.ndarray = NONE
) -> Iterator[pa.RecordBatch]:
    """(ctx, suf, c) of the n-grams of texts whose two sides `bits` lets through, counted among
    about HELD_GRAMS of them at a time and handed on in the order of their homes, in batches of at
    most SENT_ROWS."""
    found, held = [], 0

    def rows():
        context, suffix = (np.concatenate(f) for f in zip(*found, strict=True))
        found.clear()
        order = np.argsort(
            homes(context, suffix, spread) | joined_keys(context, suffix) & np.uint64((1 << 32) - 1)
        )
        context, suffix = context[order], suffix[order]
        first = np.flatnonzero(changes(context) | changes(suffix))
        times = np.diff(first, append=len(context))
        columns = [context[first].view(np.int64), suffix[first].view(np.int64), times]
        for at in range(0, len(times), SENT_ROWS):
            some = [pa.array(c[at : at + SENT_ROWS], pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(some, schema=GRAMS)

    for batch in batches:
        *_, (keys, _), (_, inside) = grams(token_hashes(batch.column(0)), n)
        often = _passes(bits, keys)
        good = np.flatnonzero(inside & often[:-1] & often[1:])
        found.append((keys[good], keys[good + 1]))
        held += len(good)
        if held > HELD_GRAMS:
            yield from rows()
            held = 0
    if held:
        yield from rows()


def gram_counts(train: DataFrame, n: int, shorter: DataFrame, tree: Tree, hot: float) -> DataFrame:
    """(ctx, suf, c, key) of the n-grams seen MIN_COUNT times: keys of all words but the last
    and of all but the first. Both are among `shorter`, the (n-1)-grams seen so often."""
    buckets = tree.buckets
    # At most 1 / (10 * CONTEXT_SHARE) contexts; the others fit into a few buckets' room each.
    frequent = shorter.where(F.col("c") >= 10 * hot).select("key").toPandas()["key"]
    frequent = np.sort(frequent.to_numpy(np.int64).view(np.uint64))
    shared = train.sparkSession.sparkContext.broadcast((tree.levels[n - 2], frequent))
    names = ["bucket", "ctx", "suf", "c"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, spread = shared.value
        for some in counted_grams(batches, n, bits, spread):
            ctx, suf, c = (some.column(k).to_numpy() for k in range(3))
            bucket = bucket_of(homes(ctx.view(np.uint64), suf.view(np.uint64), spread), buckets)
            yield pa.RecordBatch.from_arrays(packed(bucket, ctx, suf, c.astype(np.int32)), names)

    def merge(bucket: pa.Table) -> pa.Table:
        ctx, suf = (unpacked(bucket[k]).view(np.uint64) for k in ("ctx", "suf"))
        key = joined_keys(ctx, suf)
        order = np.argsort(key)
        ctx, suf, key = ctx[order], suf[order], key[order]
        first = np.flatnonzero(changes(key) | changes(ctx) | changes(suf))
        times = np.add.reduceat(unpacked(bucket["c"])[order].astype(np.int64), first)
        first, times = first[times >= MIN_COUNT], times[times >= MIN_COUNT]
        out = [*(k[first].view(np.int64) for k in (ctx, suf)), times, key[first].view(np.int64)]
        return pa.table(out, names=["ctx", "suf", "c", "key"])

    partial = train.select("text").mapInArrow(
        count, "bucket int, ctx array<long>, suf array<long>, c array<int>"
    )
    often = partial.groupBy("bucket").applyInArrow(merge, "ctx long, suf long, c long, key long")
    return stored(often, "grams")


def looked_up(rows: DataFrame, on: str, table: DataFrame, hot: float, how: str = "inner") -> DataFrame:
    """rows joined with the table (on, c, ...) by `on`, c left out. The table's rows of at least
    `hot` tokens, at most 1 / CONTEXT_SHARE, are broadcast, so that no key fills a task."""
    many, few = table.where(F.col("c") >= hot).drop("c"), table.where(F.col("c") < hot).drop("c")
    cold = rows.join(F.broadcast(many.select(on)), on, "left_anti").join(few, on, how)
    return rows.join(F.broadcast(many), on).unionByName(cold)


def fit_level(found: DataFrame, below: DataFrame, hot: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From the n-grams of a level and the (n-1)-grams (key, c, lp: log10 of the last word's
    probability after the others): the same of the n-grams, the contexts kept with the cost of
    backing off, and the weights of the kept contexts' n-grams. Contexts that do not diverge
    from their suffix keep no next words: they read on in the suffix."""
    near = looked_up(found, "suf", below.select(F.col("key").alias("suf"), "c", F.col("lp").alias("short")), hot)
    near = looked_up(near.drop("suf"), "ctx",
                     below.select(F.col("key").alias("ctx"), "c", F.col("c").alias("whole")), hot)
    near = stored(near.withColumn("share", (F.col("c") - DISCOUNT) / F.col("whole")), "near")
    short = F.pow(F.lit(10.0), "short")
    left = F.greatest(1 - F.col("kept"), F.lit(1e-12)) / (1 - F.least("under", F.lit(1 - 1e-9)))
    contexts = stored(
        near.groupBy("ctx").agg(
            F.max("whole").alias("c"),
            F.sum("share").alias("kept"),
            F.sum(short).alias("under"),
            F.sum(F.col("share") * F.log(F.col("share") / short)).alias("gain"),
        )
        .where(F.col("gain") + (1 - F.col("kept")) * F.log(left) >= DIVERGENCE)
        .select("ctx", "c", F.log10(left).alias("back")),
        "contexts",
    )
    judged = looked_up(near.drop("whole"), "ctx", contexts, hot, "left")
    delta = F.log10("share") - F.col("back") - F.col("short")
    judged = stored(
        judged.select("key", "c", "short", F.coalesce(delta, F.lit(0.0)).alias("delta"),
                      F.coalesce(F.log10("share") + F.lit(0.0) * F.col("back"), "short").alias("lp")),
        "level",
    )
    own = judged.where("delta <> 0").select("key", "c", "delta", F.lit(0.0).alias("back"))
    backs = contexts.select(F.col("ctx").alias("key"), "c", F.lit(0.0).alias("delta"), "back")
    return judged.select("key", "c", "lp"), backs, own


def fit_tables(train: DataFrame, counts: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree from training texts and their stored word counts, and all n-grams' weights
    (key, c, delta, back); a key may have two rows, whose weights add up."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("word")).first()
    tree = Tree(total, distinct)
    tree.least_word = least_count(counts, HEAD_SHARE)
    words = counts.where(F.col("c") >= tree.least_word)
    tree.words, times = gathered(words.select(F.xxhash64("word").alias("key"), F.col("c").alias("value")))
    tree.base = np.log10((times + 1) / (total + distinct + 1))

    log = F.log10((F.col("c") + 1) / F.lit(float(total + distinct + 1)))
    below = stored(
        counts.where(F.col("c") >= MIN_COUNT).select(F.xxhash64("word").alias("key"), "c", log.alias("lp")), "words"
    )
    hot, parts = max(1.0, CONTEXT_SHARE * total), []
    for n in range(2, DEPTH + 2):
        tree.levels.append(bitmap(below))
        below, *weights = fit_level(gram_counts(train, n, below, tree, hot), below, hot)
        parts += weights
    tree.levels.append(bitmap(below))
    weights = stored(reduce(DataFrame.unionByName, parts), "weights")
    tree.least_gram = least_count(weights, PAIR_SHARE / 2)
    cached = weights.where(F.col("c") >= tree.least_gram)
    tree.keys, tree.weights = gathered(cached.select("key", (F.col("delta") + F.col("back")).alias("value")))
    tree.bits = bitmap(weights.where(F.col("c") < tree.least_gram))
    return tree, weights


def fit(train: DataFrame, counts: DataFrame) -> Tree:
    """The tree with all that it takes to score texts on the driver."""
    tree, weights = fit_tables(train, counts)
    tree.head = [r["word"] for r in counts.where(F.col("c") >= tree.least_word).collect()]
    cached = weights.where(F.col("c") >= tree.least_gram)
    tree.backs = gathered(cached.select("key", F.col("back").alias("value")))[1]
    return tree


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    train = docs.where(~held_out())
    counts = stored(word_counts(train), "word-counts")
    tree, weights = fit_tables(train, counts)
    shared = spark.sparkContext.broadcast(
        (tree.words, tree.base, tree.keys, tree.weights, tree.bits, tree.levels)
    )
    buckets = tree.buckets
    floor = float(np.log10(1 / (tree.total + tree.distinct + 1)))

    kind = docs.schema["doc_id"].dataType
    numbers = StructType.fromDDL("row long, n_tokens long, n_known long, base double, weight double")
    sums = pa.schema([("doc_id", to_arrow_type(kind)), ("row", pa.int64()), ("n_tokens", pa.int64()),
                      ("n_known", pa.int64()), ("base", pa.float64()), ("weight", pa.float64())])
    lists = [pa.field(k, pa.list_(pa.int64())) for k in ("rows", "keys")]
    rows = pa.schema([pa.field("bucket", pa.int32()), *sums, *lists])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each text its own row, with the sums over its cached words and n-grams and other
        words as if none was known; and the keys still to be looked up, with their rows."""
        known_words, word_base, cached, weights, bits, levels = shared.value
        word_base, held, size = np.append(word_base, floor), [], 0

        def looked_for():
            of, keys = (np.concatenate(h) for h in zip(*held, strict=True))
            held.clear()
            bucket = bucket_of(keys, buckets)
            order = np.argsort(bucket, kind="stable")
            for at in range(0, len(order), SENT_ROWS):
                some = order[at : at + SENT_ROWS]
                dealt, *found = packed(bucket[some], of[some], keys[some].view(np.int64))
                none = [pa.nulls(len(dealt), f.type) for f in sums]
                yield pa.RecordBatch.from_arrays([dealt, *none, *found], schema=rows)

        for batch in batches:
            distinct, places, sizes = batch_words(batch.column(2), lower=True)
            hashes = np.append(word_hashes(as_bytes(distinct)), END_HASH)
            order, ids = np.argsort(hashes), np.empty(len(hashes), np.int64)
            ids[order] = _find(known_words, hashes[order])  # in order, as it stays in the processor's cache
            places = np.insert(places, np.cumsum(sizes), len(distinct))
            sizes += 1
            hashes, ids = hashes[places], ids[places]
            at_row = np.repeat(np.arange(len(sizes)), sizes)
            known = ids >= 0
            count = np.bincount(at_row, known, len(sizes)).astype(np.int64)
            base = np.bincount(at_row, word_base[ids], len(sizes))
            weight = np.zeros(len(sizes))
            row = batch.column(1).to_numpy()
            often = np.ones(len(hashes) + 1, bool)
            for n, (keys, inside) in enumerate(grams(hashes, DEPTH + 1), 1):
                # What is seen so often has parts seen so often.
                often = often[:-1] & often[1:] & inside & _passes(levels[n - 1], keys)
                at = np.flatnonzero(often)
                some, where = np.unique(keys[at], return_inverse=True)
                place = _find(cached, some)[where]
                here = place >= 0
                weight += np.bincount(at_row[at[here]], weights[place[here]], len(sizes))
                left = at[~here]
                left = left[_passes(bits, keys[left])]
                if n == 1:
                    left = np.union1d(left, np.flatnonzero(~known))  # other words
                held.append((row[at_row[left]], keys[left]))
                size += len(left)
            own = [pa.array((row % buckets).astype(np.int32)), batch.column(0), batch.column(1),
                   *map(pa.array, (sizes, count, base, weight)),
                   *(pa.nulls(len(sizes), f.type) for f in lists)]
            yield pa.RecordBatch.from_arrays(own, schema=rows)
            if size > HELD_GRAMS:
                yield from looked_for()
                size = 0
        if held:
            yield from looked_for()

    def add(found: pa.Table, known: pa.Table) -> pa.Table:
        """The rows of texts as they are, and what their keys in this bucket add to them."""
        own = found.filter(pc.is_valid(found["n_tokens"])).select(sums.names)
        met = found.filter(pc.is_valid(found["keys"]))
        of, keys = unpacked(met["rows"]), unpacked(met["keys"])
        ordered, where = np.unique(known["key"].to_numpy(), return_inverse=True)
        at = _find(ordered, keys)
        some, to = np.unique(of[at >= 0], return_inverse=True)

        def added(name: str) -> np.ndarray:
            values = np.bincount(where, known[name].to_numpy(), len(ordered))
            return np.bincount(to, values[at[at >= 0]], len(some))

        more = [pa.nulls(len(some), sums.field("doc_id").type), some, np.zeros(len(some), np.int64),
                added("n_known").astype(np.int64), added("base"), added("weight")]
        both = pa.concat_tables([own.cast(sums), pa.table(more, schema=sums)])
        both = both.take(np.argsort(both["row"].to_numpy(), kind="stable")).combine_chunks()
        block = both["row"].to_numpy() >> BLOCK
        return pa.table(packed(block, *(c.combine_chunks() for c in both.columns)), names=["block", *sums.names])

    def total(block: pa.Table) -> pa.Table:
        """One row for each text of a block."""
        columns = {k: block[k].combine_chunks().flatten() for k in sums.names}
        own = pc.greater(columns["n_tokens"], 0)  # a text has an end at least
        row, where = np.unique(columns["row"].to_numpy(), return_inverse=True)
        ids = columns["doc_id"].filter(own).take(np.argsort(columns["row"].filter(own).to_numpy()))
        added = [np.bincount(where, columns[k].to_numpy(), len(row)) for k in sums.names[2:]]
        return pa.table([ids, row, *(a.astype(np.int64) for a in added[:2]), *added[2:]], schema=sums)

    names = StructType([StructField("doc_id", kind), *numbers])
    packs = StructType.fromDDL("rows array<long>, keys array<long>")
    few = counts.where(F.col("c") < tree.least_word)
    others = weights.where(F.col("c") < tree.least_gram)
    words = few.select(F.xxhash64("word").alias("key"), F.lit(1).alias("n_known"),
                       F.log10(F.col("c") + 1.0).alias("base"), F.lit(0.0).alias("weight"))
    known = others.select("key", F.lit(0).alias("n_known"), F.lit(0.0).alias("base"),
                          (F.col("delta") + F.col("back")).alias("weight")).unionByName(words)
    known = known.withColumn("bucket", bucket_column("key", buckets))
    lists_of = [StructField(f.name, ArrayType(f.dataType)) for f in names]

    def scored(some: DataFrame) -> DataFrame:
        found = some.select("doc_id", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
            read, StructType([StructField("bucket", IntegerType()), *names, *packs])
        )
        parts = found.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
            add, StructType([StructField("block", LongType()), *lists_of])
        )
        return stored(parts.groupBy("block").applyInArrow(total, names), "scores")

    missing = few.select("c").unionByName(others.select("c")).agg(F.coalesce(F.sum("c"), F.lit(0)))
    rounds = tree.rounds(missing.first()[0])
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds))
    scores = [scored(docs.where(part == k) if rounds > 1 else docs) for k in range(rounds)]
    return reduce(DataFrame.unionByName, scores).select(
        "doc_id",
        held_out().alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(tree.total)).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"),
        (F.col("base") + F.col("weight")).alias("score"),
    )
