"""Benchmark decontamination by template canonicalisation.

Words become template tokens: stripped and in lower case, with numbers, units after a number
and names (capitalised inside a sentence) replaced by typed placeholders. Windows of WINDOW
template tokens are hashed, on whole texts of both sides, and hash-joined. (Windows in which
placeholders outnumber words are hashed with their values instead: alone they say nothing.)
Windows with slots are hashed by their words in lower case as well, so that a copy that tells
names by no capital meets its item.

Windows of one document and item on one diagonal form an alignment. Windows of equal values
always count. Of windows with other values those count whose values are consistent: one
value of the item stands for one value of the document and the other way round. A changed
value that conflicts with an equal one (one of two 2019 became 2020) drops its windows only;
when changed values conflict with each other, no window with other values counts.

An item is found in a document when alignments without conflict cover at least COVER percent
of its tokens, when all windows that count cover more than that, or when RUN tokens in a row
are equal: `verbatim` when all slot values of an alignment agree, else a re-parameterised
question.

Before the join, documents' windows pass a bitmap of the benchmark's (BITS bits, whatever
the size of either table); it only lets through too much, never too little.

Null or empty texts have no windows. Rows without doc_id or item_id are not compared; rows
that repeat an id count as one. An item of fewer than WINDOW tokens is one window. Other
columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import Cache, rolled, small_batches, stored

WINDOW, COVER, RUN = 6, 50, 13
BITS = 1 << 23

ENDS, NAME, UNIT, NUMBER = 1, 2, 4, 8
NUMBERS = set(
    "zero two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
    "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
    "hundred thousand million billion dozen half twice".split()
)
UNITS = set(
    "% $ € £ km m cm mm mi ft yd inch inches foot feet mile miles meter meters metre metres "
    "kilometer kilometers kilometre kilometres centimeter centimeters kg g mg lb lbs oz gram "
    "grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres "
    "gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years mph kph km/h m/s dollar dollars cent cents euro euros percent "
    "degrees degree".split()
)
FIGURE = re.compile(r"[+\-−$€£]?\d[\d.,:/]*(%|[a-z]{1,3})?")
BREAK = b"\x01"


def _constant(name: str) -> int:
    return xxhash.xxh64_intdigest(name.encode()) >> 4 or 1


SLOTS = {NAME: _constant("<name>"), UNIT: _constant("<unit>"), NUMBER: _constant("<number>")}


def bare(word: str) -> str:
    """A word without the punctuation around it; signs that are units stay."""
    start, end = 0, len(word)
    while start < end and not (word[start].isalnum() or word[start] in "%$€£"):
        start += 1
    while end > start and not (word[end - 1].isalnum() or word[end - 1] in "%$€£"):
        end -= 1
    return word[start:end]


def _pack(raw: bytes) -> int:
    """Hash of the bare lower-case word << 4, and what it may be; 0 << 4 if nothing is left."""
    if raw == BREAK:
        return ENDS
    word = raw.decode("utf-8", "replace")
    core = bare(word)
    flags = ENDS if word.rstrip("\"')]»”’")[-1:] in tuple(".!?:;") else 0
    if not core:
        return flags
    low = core.lower()
    if low in NUMBERS or FIGURE.fullmatch(low):
        flags |= NUMBER
    elif low in UNITS:
        flags |= UNIT
    elif core[0].isupper() and core != core.upper():
        flags |= NAME
    return (xxhash.xxh64_intdigest(low.encode()) >> 4 or 1) << 4 | flags


_packed = Cache(_pack)


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Template hashes, word hashes, which tokens are slots, and the raw words."""
    raw = (text or "").encode("utf-8", "surrogatepass").replace(b"\n", b" \x01 ").split()
    packed = np.fromiter(map(_packed.__getitem__, raw), np.uint64, len(raw))
    flags = (packed & np.uint64(15)).astype(np.uint8)
    word = packed >> np.uint64(4)
    starts = np.ones(len(raw), bool)
    starts[1:] = (flags[:-1] & ENDS) > 0
    kept = np.flatnonzero(word)
    word, flags, starts = word[kept], flags[kept], starts[kept]
    slot = flags & NUMBER
    slot |= np.where(starts, 0, flags & NAME).astype(np.uint8)
    after = np.zeros(len(kept), bool)
    after[1:] = slot[:-1] == NUMBER
    slot |= np.where(after, flags & UNIT, 0).astype(np.uint8)
    shape = word.copy()
    for kind, value in SLOTS.items():
        shape[slot == kind] = value
    return shape, word, slot > 0, [raw[i] for i in kept] if slot.any() else []


def windows(shape, word, slot, width: int) -> tuple[np.ndarray, np.ndarray]:
    """One hash per start of a window of `width` tokens, then the starts of windows whose
    hash by words alone is another one, and these hashes after the first ones."""
    hashes, words = rolled(shape, width), rolled(word, width)
    slots = np.concatenate([[0], np.cumsum(slot)])
    many = 2 * (slots[width:] - slots[:-width]) > width if len(hashes) else slots[:0] > 0
    if many.any():
        hashes = np.where(many, words, hashes)
    other = np.flatnonzero(hashes != words)
    return (
        np.concatenate([hashes, words[other]]),
        np.concatenate([np.arange(len(hashes)), other]),
    )


def _slots(slot: np.ndarray, raw: list[bytes], at: int, width: int) -> list[str]:
    return [
        bare(raw[i].decode("utf-8", "replace")).lower()
        for i in range(at, at + width)
        if slot[i]
    ]


HIT = "array<struct<pos: int, hash: long, slots: array<string>>>"


def item_windows(benchmark: DataFrame, text: str = "text") -> DataFrame:
    """(item_id, size, width, ipos, hash, islots): every window of every item."""
    small_batches(benchmark.sparkSession)

    @F.pandas_udf(f"size int, hits {HIT}")
    def cut(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            shape, word, slot, raw = template(t)
            width = min(WINDOW, len(shape))
            found, starts = windows(shape, word, slot, width) if width else ([], [])
            rows.append((len(shape), [
                {"pos": int(i), "hash": int(h.view(np.int64)),
                 "slots": _slots(slot, raw, i, width) if k <= len(shape) - width else []}
                for k, (h, i) in enumerate(zip(found, starts, strict=True))]))
        return pd.DataFrame(rows, columns=["size", "hits"])

    return (
        benchmark.where("item_id IS NOT NULL")
        .select("item_id", cut(F.col(text).cast("string")).alias("c"))
        .select("item_id", F.col("c.size").alias("size"), F.explode("c.hits").alias("h"))
        .select("item_id", "size", F.least(F.lit(WINDOW), "size").alias("width"),
                F.col("h.pos").alias("ipos"), "h.hash", F.col("h.slots").alias("islots"))
    )


def _bitmap(items: DataFrame) -> np.ndarray:
    """Which values of hash mod BITS occur; at most BITS numbers reach the driver."""
    places = items.select(F.pmod("hash", F.lit(BITS)).cast("int").alias("at")).distinct()
    bits = np.zeros(BITS, bool)
    bits[places.toPandas()["at"].to_numpy(np.int64)] = True
    return np.packbits(bits)


def document_windows(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, width, pos, hash, slots) of documents' windows that pass the bitmap."""
    spark = docs.sparkSession
    small_batches(spark)
    widths = [r[0] for r in items.select("width").distinct().collect()]
    shared = spark.sparkContext.broadcast(_bitmap(items))
    made: dict[str, np.ndarray] = {}

    @F.pandas_udf(f"array<struct<width: int, pos: int, hash: long, slots: array<string>>>")
    def cut(texts: pd.Series) -> pd.Series:
        if "bits" not in made:
            made["bits"] = np.unpackbits(shared.value).astype(bool)
        bits, out = made["bits"], []
        for t in texts:
            shape, word, slot, raw = template(t)
            hits = []
            for width in widths:
                found, starts = windows(shape, word, slot, width)
                for k in np.flatnonzero(bits[(found & np.uint64(BITS - 1)).astype(np.int64)]):
                    i = starts[k]
                    hits.append({"width": width, "pos": int(i),
                                 "hash": int(found[k].view(np.int64)),
                                 "slots": _slots(slot, raw, i, width)
                                 if k <= len(shape) - width else []})
            out.append(hits)
        return pd.Series(out)

    return (
        docs.where("doc_id IS NOT NULL")
        .select("doc_id", F.explode(cut(F.col(text).cast("string"))).alias("h"))
        .select("doc_id", "h.width", "h.pos", "h.hash", "h.slots")
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, cover: int = COVER) -> DataFrame:
    """(doc_id, item_id, n_covered, n_tokens, n_slots, verbatim) of each item found."""
    items = stored(item_windows(benchmark), "items")
    hits = stored(document_windows(docs, items), "windows")
    joined = hits.join(items, ["hash", "width"])
    aligned = joined.groupBy("doc_id", "item_id", "size", (F.col("pos") - F.col("ipos")).alias("d"))
    # Windows hashed by words on one side at least are equal: their values need no pairs.
    pairs = F.when(
        F.size("islots") == F.size("slots"),
        F.transform(
            F.arrays_zip("islots", "slots"),
            lambda s: F.struct(s["islots"].alias("of_item"), s["slots"].alias("of_doc")),
        ),
    ).otherwise(F.expr("array()").cast("array<struct<of_item: string, of_doc: string>>"))
    window = F.struct(F.col("ipos").alias("at"), pairs.alias("slots"))
    changed = lambda s: s["of_item"] != s["of_doc"]
    meets = lambda s, t: (s["of_item"] == t["of_item"]) != (s["of_doc"] == t["of_doc"])
    alignments = (
        aligned.agg(F.collect_set(window).alias("all"), F.max("width").alias("width"))
        .withColumn("slots", F.array_distinct(F.flatten(F.transform("all", lambda w: w["slots"]))))
        .withColumn("other", F.filter("slots", changed))
        .withColumn("out", F.filter("other", lambda s: F.exists("slots", lambda t: meets(s, t))))
        .withColumn(
            "renamed", ~F.exists("other", lambda s: F.exists("other", lambda t: meets(s, t)))
        )
        .withColumn("equal", F.filter("all", lambda w: ~F.exists(w["slots"], changed)))
        .withColumn(
            "counted",
            F.when(
                F.col("renamed"),
                F.filter("all", lambda w: F.size(F.array_intersect(w["slots"], F.col("out"))) == 0),
            ).otherwise(F.col("equal")),
        )
    )

    def covered(ws: str) -> Column:
        return F.array_distinct(
            F.flatten(
                F.transform(ws, lambda w: F.sequence(w["at"], w["at"] + F.col("width") - F.lit(1)))
            )
        )

    # A row of equal tokens starts where the token before is not equal.
    run = F.size(
        F.filter(
            "same",
            lambda p: F.size(
                F.array_intersect("same", F.sequence(p, p + F.lit(RUN - 1)))
            ) == RUN,
        )
    ) > 0
    found = (
        alignments.where(F.size("counted") > 0)
        .select(
            "doc_id", "item_id", "size", "slots", covered("counted").alias("tokens"),
            covered("equal").alias("same"), (F.size("out") == 0).alias("whole"),
        )
        .withColumn("run", (F.size("same") >= RUN) & run)
        .groupBy("doc_id", "item_id", "size")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("tokens")))).cast("long").alias(
                "n_covered"
            ),
            F.size(
                F.array_distinct(F.flatten(F.collect_list(F.when(F.col("whole"), F.col("tokens")))))
            ).alias("n_whole"),
            F.max("run").alias("run"),
            F.max(F.size("slots")).cast("long").alias("n_slots"),
            F.max(F.forall("slots", lambda s: s["of_item"] == s["of_doc"])).alias("verbatim"),
        )
    )
    least = F.col("size") * cover
    found = found.where(
        (F.col("n_whole") * 100 >= least) | (F.col("n_covered") * 100 > least) | F.col("run")
    )
    return found.select(
        "doc_id", "item_id", "n_covered", F.col("size").cast("long").alias("n_tokens"), "n_slots",
        "verbatim",
    )
