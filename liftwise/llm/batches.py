"""Small helpers of all operators: batch size, bounded caches, words, table reading."""

from __future__ import annotations

import io
import re
import tempfile
import weakref
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwise.session import scratch

# Rows of an Arrow batch: long texts, so far fewer than Spark's default of 10,000.
BATCH_ROWS = 256
BATCH_BYTES = 32 << 20
# Entries a worker keeps of any cache; a full cache is emptied, results never change. Keys
# longer than KEY_LENGTH (a text without white space is one word) are not kept.
CACHE_ENTRIES = 400_000
KEY_LENGTH = 64

SPACES = " \t\n\x0b\x0c\r"
# White space as Unicode's White_Space property has it (fixed values).
WHITE = "\t-\r \x85\xa0  -     　"


_shipped: set[str] = set()


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once, whatever the length of the texts, and see
    to it that workers can import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_package())
        _shipped.add(context.applicationId)


def _package() -> str:
    """The package as a file that Spark hands to executors, as --py-files would."""
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for p in sorted(root.rglob("*.py")):
            out.write(p, p.relative_to(root.parent))
    path = Path(tempfile.mkdtemp(prefix="package-")).resolve() / f"{root.name}.zip"
    path.write_bytes(packed.getvalue())
    return str(path)


_caches: list[weakref.ref] = []


def release(*keep: Cache) -> None:
    """Empty all caches of this worker but these: workers outlive a query, and what an operator
    before has left here would only take memory from the next."""
    for cache in [ref() for ref in _caches]:
        if cache and not any(cache is k for k in keep):
            cache.clear()


class Cache(dict):
    """key -> make(key), emptied when full."""

    def __init__(self, make, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries
        _caches[:] = [ref for ref in _caches if ref() is not None] + [weakref.ref(self)]

    def __missing__(self, key):
        value = self.make(key)
        if isinstance(key, int) or len(key) <= KEY_LENGTH:
            if len(self) >= self.entries:
                self.clear()
            self[key] = value
        return value

    def __reduce__(self):  # a copy on another machine starts empty
        return (Cache, (self.make, self.entries))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, as UTF-8. bytes.split() knows just these six."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """words() with A-Z in lower case; bytes.lower() leaves all other letters alone."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def batch_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """words() or lower_words() of all texts of a batch: the distinct ones, the place of each word
    among them, and how many words each text has. Among the distinct ones may be the empty word,
    which has no place."""
    texts = pc.fill_null(texts, "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    coded = lists.flatten().dictionary_encode()
    distinct, places = coded.dictionary, coded.indices.to_numpy()
    sizes = np.diff(lists.offsets.to_numpy())
    empty = pc.index(distinct, "").as_py()
    if empty >= 0:  # beside white space at an end of a text
        real = places != empty
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[real], minlength=len(sizes))
        places = places[real]
    return distinct, places, sizes


def as_bytes(words: pa.Array) -> list[bytes]:
    return words.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
RAGGED = re.compile(f"[{WHITE}] ")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: all bits of the input reach all bits of the output."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` neighbours; a shorter sequence has none."""
    n = len(hashes) - width + 1
    if n <= 0:
        return hashes[:0]
    out = mix(hashes[:n] + np.uint64(0x9E3779B97F4A7C15))
    for k in range(1, width):
        out = mix(out * np.uint64(3) + hashes[k : k + n])
    return out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: rows fixed even when executors
    are lost, and no partitioning left over that would keep a skewed join in one piece."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table whose row count has just been checked, else leave it to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
