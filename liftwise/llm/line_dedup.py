"""Line dedup, DataFrame functions only.

Lines are exploded, their keys hashed (128 bits), and each key keeps its smallest and largest
doc_id: a key is shared when they differ. That table is stored and joined back to the lines,
so that one line in a third of all documents is split like any skewed join. What a document
loses becomes one array of flags, and the text is put together again by position.

A key is the line without white space (space, tab to carriage return) at both ends, A-Z in
lower case. Keys of at least MIN_CHARS code points found in at least two documents lose all
their lines except in the smallest doc_id that holds them.

Null or empty text is one empty line and stays as it is. Rows without doc_id are compared
with nothing and lose nothing. Rows that repeat a doc_id count as one document; each row
keeps or loses its own lines. Other columns stay; result columns replace input columns of
the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import stored

MIN_CHARS = 10
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), lines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line FROM split
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), shared AS (
  SELECT k, min(doc_id) AS first_id FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> first_id, false) AS gone
  FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id
"""


def line_key(line: Column) -> Column:
    """Stripped, A-Z lowered. Only where other letters occur is translate() needed."""
    bare = F.btrim(line, F.lit(SPACES))
    plain = F.length(bare) == F.octet_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def keyed_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, row, pos, k1, k2) of the lines whose key is long enough to compare."""
    lines = docs.where("doc_id IS NOT NULL").select(
        "doc_id",
        F.xxhash64("text").alias("row"),
        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("pos", "line"),
    )
    keyed = lines.select("doc_id", "row", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= MIN_CHARS).select(
        "doc_id", "row", "pos",
        F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2"),
    )


def dropped_flags(docs: DataFrame) -> DataFrame:
    """(doc_id, row, n_dropped, flags): true where a line goes, up to the last that does."""
    lines = keyed_lines(docs)
    shared = (
        lines.groupBy("k1", "k2")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
        .where("first_id <> last_id")
        .drop("last_id")
    )
    gone = lines.join(stored(shared, "shared-lines"), ["k1", "k2"]).where("doc_id <> first_id")
    per_row = gone.groupBy("doc_id", "row").agg(F.collect_set("pos").alias("at"))
    rest = F.array_except(F.sequence(F.lit(0), F.array_max("at")), "at")
    flags = F.sort_array(
        F.concat(
            F.transform("at", lambda p: F.struct(p.alias("pos"), F.lit(True).alias("gone"))),
            F.transform(rest, lambda p: F.struct(p.alias("pos"), F.lit(False).alias("gone"))),
        )
    )
    return per_row.select(
        F.col("doc_id").alias("_id"),
        F.col("row").alias("_row"),
        F.size("at").cast("long").alias("_dropped"),
        F.transform(flags, lambda f: f["gone"]).alias("_flags"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with n_lines, n_dropped and kept (the text that stays; null text stays null)."""
    text = docs["text"]
    flags = dropped_flags(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    joined = docs.join(
        flags,
        (docs["doc_id"] == F.col("_id")) & (F.xxhash64(text.cast("string")) == F.col("_row")),
        "left",
    )
    lines = F.split(text.cast("string"), "\n", -1)
    left = F.zip_with(lines, F.col("_flags"), lambda l, f: F.when(~F.coalesce(f, F.lit(False)), l))
    names = ("n_lines", "n_dropped", "kept")
    rest = [docs[c] for c in docs.columns if c not in names]
    return joined.select(
        *rest,
        F.coalesce(F.size(lines), F.lit(1)).cast("long").alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("_flags").isNull(), text.cast("string"))
        .otherwise(F.array_join(left, "\n"))
        .alias("kept"),
    )


def line_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256."""
    return dedup_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
