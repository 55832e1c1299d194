"""N-gram Jaccard join by grouped prefixes, down to connected components.

1. Each document becomes its set of word shingles, as 64-bit hashes. Hashes order the
   shingles, except that those in more than a bounded number of prefixes go last (a common
   passage then costs nothing). A set's prefix is so long that two sets linked at the
   threshold share a prefix shingle.
2. Equal sets form a class, its smallest doc_id stands for it. Classes of equal prefix and
   size form a group, which its smallest class stands for.
3. Group pairs that share a prefix shingle are filtered by size, by the shingle's positions
   and by parity bits (each differing shingle flips one of 256 bits, so more differing bits
   than the threshold allows rule the pair out). Groups are expanded to their members.
4. Pairs that are left are verified on the whole word sequences.

Components need no more links than join them, so pairs come in two steps. First every
shingle's groups, and every group's members, meet in random blocks of about BLOCK rows: a
bucket costs in proportion to its rows, however many copies it holds. Rows left outside a
large bucket's main component meet one more random block of it. Then whatever the blocks did
not bring together is closed exactly: all pairs that share a prefix shingle and do not yet
lie in one component are filtered and verified, rows of a bucket's main component against
rows outside it. New links only join components, as links between their labels.

Two sets link when 100 * intersection >= percent * union. Documents with fewer words than
`width` have the whole sequence as their only shingle. Null or wordless text has an empty
set and links with nothing; a row without doc_id links with nothing and has no component.
Rows that repeat a doc_id count as one document with all their texts. Only doc_id and text
are read.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import Cache, lower_words, mix, rolled, small_batches, stored
from liftwise.llm.components import components, merged

WIDTH, PERCENT = 3, 90
BLOCK = 12
# A shingle in more prefixes than this goes last; raised until at most COMMON_ROWS do.
COMMON_FROM, COMMON_ROWS = 256, 1_000_000
# Rows of a broadcast filter on hashed ids, whatever their number.
PLACES = 1 << 20
PARITY = ["p0", "p1", "p2", "p3"]

_hash = Cache(xxhash.xxh64_intdigest)


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    return np.unique(rolled(h, min(width, len(h))) + np.uint64(min(width, len(h)) % width))


def word_set(text: str, width: int) -> set:
    w = lower_words(text)
    return set(zip(*(w[k:] for k in range(min(width, len(w)))))) if w else set()


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


SIGNATURE = "n long, digest binary, bits binary, prefix array<long>, " + ", ".join(
    f"{p} long" for p in PARITY
)


def parity_bits(found: np.ndarray) -> np.ndarray:
    """At least one bit per shingle: how many differ is close to how many shingles differ."""
    size = max(256, 1 << (len(found) - 1).bit_length())
    places = (found & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=size) & 1).astype(np.uint8))


def least_difference(x: bytes, y: bytes) -> int:
    """At least so many shingles differ; the longer bits are folded to the shorter ones."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def signatures(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, n, digest, prefix, parity bits) of every row."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(common)

    @F.pandas_udf(SIGNATURE)
    def sign(texts: pd.Series) -> pd.DataFrame:
        rows, common = [], shared.value
        for t in texts:
            found = shingles(lower_words(t), width)
            n = len(found)
            if not n:
                rows.append((0, None, None, None, 0, 0, 0, 0))
                continue
            ordered = found
            if len(common):
                at = np.minimum(np.searchsorted(common, found), len(common) - 1)
                last = common[at] == found
                ordered = np.concatenate([found[~last], found[last]])
            bits = parity = parity_bits(found)
            while len(parity) > 32:
                parity = parity[: len(parity) // 2] ^ parity[len(parity) // 2 :]
            prefix = ordered[: prefix_length(n, percent)].view(np.int64)
            digest = blake2b(found.tobytes(), digest_size=16).digest()
            rows.append((n, digest, bits.tobytes(), prefix, *parity.view(np.int64).tolist()))
        return pd.DataFrame(rows, columns=["n", "digest", "bits", "prefix", *PARITY])

    return docs.select("doc_id", sign(F.col("text").cast("string")).alias("s")).select(
        "doc_id", "s.*"
    )


def common_shingles(signed: DataFrame) -> np.ndarray:
    """Shingles in many prefixes, at most COMMON_ROWS of them, sorted."""
    counts = signed.select(F.explode("prefix").alias("token")).groupBy("token").count()
    many = stored(counts.where(F.col("count") > COMMON_FROM), "common-shingles")
    least = COMMON_FROM
    while (rows := many.where(F.col("count") > least).count()) > COMMON_ROWS:
        least *= 2
    if not rows:
        return np.zeros(0, np.uint64)
    found = many.where(F.col("count") > least).select("token").toPandas()["token"]
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("place"), column), F.lit(PLACES))


def _places(ids: DataFrame) -> DataFrame:
    """Hashed places of the column `id`, at most PLACES rows: a filter that lets every id
    pass, and few others as long as ids are few."""
    found = stored(ids.select(_place("id").alias("place")).distinct(), "places")
    return F.broadcast(found.coalesce(1))


def all_signatures(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Signatures whose prefixes put common shingles last. Only rows that a common shingle
    touches are signed a second time."""
    plain = stored(signatures(docs, width, percent, np.zeros(0, np.uint64)), "signatures")
    common = common_shingles(plain)
    if not len(common):
        return plain
    shared = docs.sparkSession.sparkContext.broadcast(common)

    @F.pandas_udf("boolean")
    def touched(prefixes: pd.Series) -> pd.Series:
        common, out = shared.value, []
        for p in prefixes:
            found = np.asarray([] if p is None else p, np.int64).view(np.uint64)
            at = np.minimum(np.searchsorted(common, found), len(common) - 1)
            out.append(bool((common[at] == found).any()))
        return pd.Series(out, dtype=bool)

    hit = plain.where("n > 0 AND doc_id IS NOT NULL").where(touched("prefix"))
    again = _places(hit.select(F.col("doc_id").alias("id")))
    redone = docs.join(again, _place("doc_id") == F.col("place"), "left_semi")
    untouched = plain.join(again, _place("doc_id") == F.col("place"), "left_anti")
    return stored(untouched.unionByName(signatures(redone, width, percent, common)), "signatures")


def _near(x: str, y: str, percent: int) -> Column:
    """Can rows x and y link? Sizes, and the least number of differing shingles."""
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    differ = sum(
        (F.bit_count(F.col(f"{x}.{p}").bitwiseXOR(F.col(f"{y}.{p}"))) for p in PARITY), F.lit(0)
    )
    fits = (F.col(f"{x}.n") * 100 >= F.col(f"{y}.n") * percent) & (
        F.col(f"{y}.n") * 100 >= F.col(f"{x}.n") * percent
    )
    return fits & (differ * (100 + percent) <= total * (100 - percent))


def _placed(x: str, y: str, percent: int) -> Column:
    """Shingles before the first common one differ; they must not be too many."""
    total = F.col(f"{x}.n") + F.col(f"{y}.n")
    before = F.col(f"{x}.pos") + F.col(f"{y}.pos")
    return before * (100 + percent) <= total * (100 - percent)


def _blocks(rows: DataFrame, key: str, count: str) -> DataFrame:
    """Rows with the random block of their bucket: about BLOCK rows each, and its key."""
    spread = F.pmod(F.xxhash64("cls", key), F.ceil(F.col(count) / F.lit(BLOCK)))
    return rows.withColumn("block", spread)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")
    ).distinct()


def verified(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs (a, b) whose texts link. Texts travel only for pairs that the full parity
    bits let pass."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("boolean")
    def close(n: pd.Series, x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(
            [least_difference(a, b) * (100 + percent) <= total * (100 - percent)
             for total, a, b in zip(n, x, y, strict=True)], dtype=bool)

    sides = [
        classes.select(F.col("cls").alias(f"id{k}"), F.col("n").alias(f"n{k}"),
                       F.col("bits").alias(f"bits{k}")) for k in (1, 2)
    ]
    with_bits = pairs.join(sides[0], pairs["a"] == F.col("id1")).join(
        sides[1], F.col("b") == F.col("id2")
    )
    pairs = stored(
        with_bits.where(close(F.col("n1") + F.col("n2"), "bits1", "bits2")).select("a", "b"), "near"
    )
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    texts = docs.join(_places(ids), _place("doc_id") == F.col("place"), "left_semi").select(
        F.col("doc_id").alias("id"), "text"
    )
    a = pairs.join(texts, pairs["a"] == texts["id"]).select(
        "a", "b", F.col("text").alias("left_text")
    )
    both = a.join(texts, a["b"] == texts["id"]).select(
        "a", "b", "left_text", F.col("text").alias("right_text")
    )

    @F.pandas_udf("boolean")
    def links(left: pd.Series, right: pd.Series) -> pd.Series:
        out, known = [], Cache(lambda t: word_set(t, width), 64)
        for x, y in zip(left, right, strict=True):
            x, y = known[x], known[y]
            shared = len(x & y)
            out.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
        return pd.Series(out, dtype=bool)

    return both.where(links("left_text", "right_text")).select("a", "b").distinct()


def _open_pairs(
    grouped: DataFrame, leads: DataFrame, labels: DataFrame, percent: int, block: int | None
) -> DataFrame:
    """Pairs of a bucket's members that lie in different components: all of them, or, given
    a block size, those that a row outside the main component forms with one random block
    of it, in buckets whose main component has more rows than that."""
    least = block or 1
    named = grouped.join(labels, grouped["cls"] == labels["node"], "left").select(
        "cls", "grp", "n", "in_group", *PARITY, F.coalesce("label", "cls").alias("label")
    )
    # A group's lead stands for all its members, so a bucket may hold more rows than leads.
    spots = leads.where(F.col("in_rows") > least).select(F.col("cls").alias("lead"), "token", "pos")
    rows = named.join(spots, named["grp"] == spots["lead"]).drop("lead", "grp", "in_group")
    alone = named.where(F.col("in_group") > least).select(
        "cls", "n", *PARITY, "label", F.xxhash64(F.lit("group"), "grp").alias("token"),
        F.lit(0).alias("pos"),
    )
    rows = stored(rows.unionByName(alone), "rows")
    per_label = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("many"))
    mixed = (
        per_label.groupBy("token")
        .agg(F.max(F.struct("many", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
        .where("labels > 1")
        .select("token", F.col("main.label").alias("main"), F.col("main.many").alias("many"))
    )
    if block:
        mixed = mixed.where(F.col("many") > block)
    open_rows = stored(rows.join(stored(mixed, "mixed"), "token"), "open")
    if block:
        spread = F.pmod(F.xxhash64(F.lit("open"), "cls", "token"), F.ceil(F.col("many") / F.lit(block)))
        open_rows = open_rows.withColumn("block", spread)
    x, y = open_rows.where("label <> main").alias("x"), open_rows.alias("y")
    main = F.col("y.label") == F.col("y.main")
    if block:
        y = open_rows.where("label = main").alias("y")
        which = F.col("x.block") == F.col("y.block")
    else:
        which = (F.col("x.label") != F.col("y.label")) & (main | (F.col("x.cls") < F.col("y.cls")))
    return x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & which
        & _near("x", "y", percent) & _placed("x", "y", percent),
    )


def jaccard_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    signed = all_signatures(docs, width, percent)
    sets = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(
        sets.groupBy("digest", "n").agg(
            F.min("doc_id").alias("cls"),
            F.count(F.lit(1)).alias("rows"),
            F.min("prefix").alias("prefix"),
            F.min("bits").alias("bits"),
            *[F.min(p).alias(p) for p in PARITY],
        ),
        "classes",
    )
    # Groups: equal size and prefix.
    key = [F.xxhash64("n", "prefix").alias("k1"), F.xxhash64(F.lit(1), "prefix").alias("k2")]
    members = classes.select("cls", "n", "prefix", *PARITY, *key)
    groups = stored(
        members.groupBy("k1", "k2").agg(
            F.min("cls").alias("grp"), F.count(F.lit(1)).alias("in_group")
        ),
        "groups",
    )
    grouped = stored(members.join(groups, ["k1", "k2"]).drop("k1", "k2"), "members")
    # Prefix shingles of groups, only those that several groups share.
    leads = grouped.where("cls = grp").select(
        "cls", "n", "in_group", *PARITY, F.posexplode("prefix").alias("pos", "token")
    )
    counts = (
        leads.groupBy("token")
        .agg(F.count(F.lit(1)).alias("in_bucket"), F.sum("in_group").alias("in_rows"))
        .where("in_bucket > 1")
    )
    leads = stored(leads.join(stored(counts, "buckets"), "token"), "leads")

    blocks = _blocks(leads.drop("in_group", "in_rows"), "token", "in_bucket")
    x, y = blocks.alias("x"), blocks.alias("y")
    across = x.join(
        y,
        (F.col("x.token") == F.col("y.token")) & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.cls") < F.col("y.cls")) & _near("x", "y", percent) & _placed("x", "y", percent),
    )
    inside = _blocks(grouped.where("in_group > 1"), "grp", "in_group")
    x, y = inside.alias("x"), inside.alias("y")
    within = x.join(
        y,
        (F.col("x.grp") == F.col("y.grp")) & (F.col("x.block") == F.col("y.block"))
        & (F.col("x.cls") < F.col("y.cls")) & _near("x", "y", percent),
    )
    first = stored(_ordered(across).union(_ordered(within)).distinct(), "pairs")
    links = stored(verified(first, classes, docs, width, percent), "links")
    labels = components(links)

    # Rows of a large bucket that lie outside its main component meet one more random block
    # of it; then whatever is still open is closed exactly.
    for block in (BLOCK, None):
        rest = _open_pairs(grouped, leads, labels, percent, block)
        fresh = stored(_ordered(rest).join(first, ["a", "b"], "left_anti"), "pairs")
        labels = merged(labels, stored(verified(fresh, classes, docs, width, percent), "links"))
        first = first.union(fresh)

    copies = classes.where("rows > 1").select(F.col("digest").alias("same"), "cls")
    placed = signed.join(copies, signed["digest"] == copies["same"], "left").select(
        "doc_id", "n", F.coalesce("cls", "doc_id").alias("cls")
    )
    return placed.join(labels, placed["cls"] == labels["node"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "cls")).alias("component_id"),
    )
