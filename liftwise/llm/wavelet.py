"""Token ids in shard files: a wavelet matrix per shard.

Documents are range-partitioned and sorted by doc_id, encoded, and cut into shards of about
SHARD_TOKENS tokens. A shard's ids become one bit plane per bit, the most significant first;
each plane sorts the sequence by its bit before the next plane is cut. With rank samples a
plane answers rank and select, so one shard file gives any token, counts of a token up to a
place, and the places where it occurs, without the ids themselves. Planes are compressed one
by one; the header holds the documents' ids and lengths.

Shard files are rows of a Parquet table (part, shard, n_tokens, body) in a folder all
executors share: Spark's committer keeps half-written shards of lost executors out, in any
store that Spark can write. `part` and `shard` put the files in ascending doc_id order.

Null text counts as empty; each document ends with END. Rows without doc_id come first; rows
that repeat a doc_id stay separate documents. An empty table makes no shard. Only doc_id and
text are read.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liftwise.llm.batches import as_bytes, batch_words, bounded, small_batches, words
from liftwise.llm.bpe import byte_letters
from liftwise.session import scratch

END = 1
SHARD_TOKENS = 1 << 20
MAGIC = b"WVM1"
SAMPLE = 64  # words of 64 bits between two rank samples
# Words of a generation that a worker keeps, and the longest one kept, in bytes.
KEPT_WORDS = 500_000
KEPT_LENGTH = 64
# Marks that the tokenizer keeps together as one piece, whatever run of them follows a word.
MARKS = b".,!?;:#$%&*"
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Plane:
    """A bit plane with rank and select."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        ones = np.bitwise_count(words[: -(-len(words) // SAMPLE) * SAMPLE])
        pad = -len(ones) % SAMPLE
        per = np.pad(ones, (0, pad)).reshape(-1, SAMPLE).sum(1, dtype=np.int64)
        self.samples = np.concatenate([[0], np.cumsum(per)])

    @classmethod
    def of(cls, bits: np.ndarray) -> Plane:
        packed = np.packbits(bits, bitorder="little")
        return cls(np.pad(packed, (0, -len(packed) % 8)).view("<u8"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), bitorder="little")[: self.size].view(bool)

    def get(self, i: int) -> int:
        return int(self.words[i >> 6] >> np.uint64(i & 63)) & 1

    def rank(self, bit: int, i: int) -> int:
        """How many of the first i bits are `bit`."""
        word = i >> 6
        block = word // SAMPLE
        ones = int(self.samples[block])
        ones += int(np.bitwise_count(self.words[block * SAMPLE : word]).sum(dtype=np.int64))
        if i & 63:
            mask = np.uint64((1 << (i & 63)) - 1)
            ones += int(np.bitwise_count(self.words[word] & mask))
        return ones if bit else i - ones

    def select(self, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit that is `bit`."""
        low, high = 0, self.size
        while low < high:
            middle = (low + high) // 2
            if self.rank(bit, middle + 1) > k:
                high = middle
            else:
                low = middle + 1
        return low


class WaveletMatrix:
    def __init__(self, planes: list[Plane], zeros: list[int], size: int):
        self.planes, self.zeros, self.size = planes, zeros, size

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        depth = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros, rest = [], [], ids
        for level in range(depth - 1, -1, -1):
            bits = (rest >> level) & 1 > 0
            planes.append(Plane.of(bits))
            low = rest.compress(~bits)
            zeros.append(len(low))
            rest = np.concatenate([low, rest.compress(bits)])
        return cls(planes, zeros, len(ids))

    def tokens(self) -> np.ndarray:
        """All ids, undoing the planes from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for level, (plane, zeros) in enumerate(
            zip(reversed(self.planes), reversed(self.zeros), strict=True)
        ):
            back = np.empty_like(out)
            bits = plane.bits()
            # Places take less time than masks here.
            back[np.flatnonzero(~bits)] = out[:zeros]
            back[np.flatnonzero(bits)] = out[zeros:] | kind(1 << level)
            out = back
        return out

    def access(self, i: int) -> int:
        value = 0
        for plane, zeros in zip(self.planes, self.zeros, strict=True):
            bit = plane.get(i)
            value = value << 1 | bit
            i = plane.rank(bit, i) + (zeros if bit else 0)
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        start = 0
        if token >> len(self.planes):
            return 0, 0
        for level, (plane, zeros) in enumerate(zip(self.planes, self.zeros, strict=True)):
            bit = token >> (len(self.planes) - 1 - level) & 1
            shift = zeros if bit else 0
            start, end = plane.rank(bit, start) + shift, plane.rank(bit, end) + shift
        return start, end

    def count(self, token: int, end: int | None = None) -> int:
        """How often `token` occurs among the first `end` tokens."""
        low, high = self._range(token, self.size if end is None else end)
        return high - low

    def places(self, token: int) -> list[int]:
        """Where `token` occurs, in order."""
        low, high = self._range(token, self.size)
        out = []
        for i in range(low, high):
            for level in range(len(self.planes) - 1, -1, -1):
                bit = token >> (len(self.planes) - 1 - level) & 1
                i = self.planes[level].select(bit, i - (self.zeros[level] if bit else 0))
            out.append(i)
        return out


def shard_bytes(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The file of one shard."""
    matrix = WaveletMatrix.of(ids)
    pack = zstandard.ZstdCompressor(level=1).compress
    head = np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    head += np.array([d is not None for d in doc_ids], "u1").tobytes()
    head += np.array(lengths, "<u8").tobytes()
    blocks = [pack(head), *(pack(p.words.astype("<u8").tobytes()) for p in matrix.planes)]
    out = [MAGIC, struct.pack("<QQI", matrix.size, len(doc_ids), len(matrix.planes))]
    out.append(np.array(matrix.zeros, "<u8").tobytes())
    out.append(np.array([len(b) for b in blocks], "<u8").tobytes())
    return b"".join(out + blocks)


def read_shard(body: bytes) -> tuple[WaveletMatrix, list[int | None], np.ndarray]:
    """(matrix, doc ids, lengths) of a shard file."""
    if body[:4] != MAGIC:
        raise ValueError("not a shard file")
    size, docs, depth = struct.unpack_from("<QQI", body, 4)
    zeros = np.frombuffer(body, "<u8", depth, 24)
    sizes = np.frombuffer(body, "<u8", depth + 1, 24 + 8 * depth)
    ends = 24 + 8 * (2 * depth + 1) + np.cumsum(np.concatenate([[0], sizes.astype(np.int64)]))
    unpack = zstandard.ZstdDecompressor().decompress
    blocks = [unpack(body[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    ids = np.frombuffer(blocks[0], "<i8", docs)
    has = np.frombuffer(blocks[0], "u1", docs, 8 * docs)
    lengths = np.frombuffer(blocks[0], "<u8", docs, 9 * docs).astype(np.int64)
    planes = [Plane(np.frombuffer(b, "<u8"), size) for b in blocks[1:]]
    doc_ids = [int(i) if h else None for i, h in zip(ids, has, strict=True)]
    return WaveletMatrix(planes, [int(z) for z in zeros], size), doc_ids, lengths


class WordCodec:
    """The library's encoding, kept per word. No rule of a tokenizer that drops white space
    reaches across it, so a text's ids are its words' ids in a row.

    Words are kept in two generations: when the young one is full it becomes the old one, and
    what of the old one is still in use has moved on by then. So frequent words stay, rare ones
    go, and no batch starts from nothing."""

    def __init__(self, spec: str, entries: int = KEPT_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.spec = spec
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.entries = entries
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.passing: list[bytes] = []  # long words of the batch, not kept

    def __reduce__(self):
        return (WordCodec, (self.spec, self.entries))

    def _merged(self, piece: bytes) -> bytes:
        """Ids of a run of lower-case Latin-1 letters, or of marks. Nothing of the normalizer
        or the splitting rules changes it, so the merges alone are asked."""
        letters = piece.decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """The same, kept like a word."""
        code = self.young.get(piece)
        if code is None:
            code = self.old.get(piece)
            if code is None:
                code = self._merged(piece)
            if len(piece) <= KEPT_LENGTH:
                self.young[piece] = code
        return code

    def _turn(self) -> None:
        for w in self.passing:
            self.young.pop(w, None)
        self.passing = []
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}

    def pieces(self, found: list[bytes]) -> list[bytes]:
        """The ids of runs of lower-case letters and of marks."""
        self._turn()
        get, piece = self.young.get, self._piece
        return [get(p) or piece(p) for p in found]

    def codes(self, found: list[list[bytes]]) -> dict[bytes, bytes]:
        """The ids of all words of a batch, until the next one is asked. Words met before are
        looked up whole. Of a new one, letters of Latin-1 and a run of marks after them are pieces
        that the tokenizer splits a word into anyway, in lower case; any other word is encoded
        as it is, in one call for the batch."""
        self._turn()
        young, old, piece, merged = self.young, self.old, self._piece, self._merged
        odd: list[bytes] = []
        for w in set().union(*found).difference(young):
            code = old.get(w)
            if code is None:
                head = w.rstrip(MARKS)
                mark = w[len(head) :]
                if not head.isalpha():
                    text = head.decode("utf-8")
                    if not text.isalpha() or max(text) > "\xff":
                        odd.append(w)
                        continue
                    low = text.lower().encode()
                else:
                    low = head.lower()
                if mark:
                    code = piece(low) + piece(mark)
                else:  # a word in lower case is its own piece, and was not met before
                    code = piece(low) if low != w else merged(w)
                if len(w) > KEPT_LENGTH:
                    self.passing.append(w)
            young[w] = code
        if odd:
            encoded = self.tokenizer.encode_batch_fast(
                [w.decode("utf-8") for w in odd], add_special_tokens=False
            )
            for w, c in zip(odd, encoded, strict=True):
                young[w] = array("I", c.ids).tobytes()
            self.passing += [w for w in odd if len(w) > KEPT_LENGTH]
        return young

    def encode(self, text: str | None) -> np.ndarray:
        found = words(text)
        return ids_of(found, self.codes([found]))


def ids_of(found: list[bytes], codes: dict[bytes, bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(codes.__getitem__, found)), "<u4")


def picked(flat: np.ndarray, sizes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs at `places` of the runs that lie in `flat` one after the other, and their sizes."""
    many = sizes[places]
    upto = np.cumsum(many)
    at = (np.cumsum(sizes) - sizes)[places] - upto + many
    return flat[np.repeat(at, many) + np.arange(len(at) and upto[-1])], many


def batch_ids(texts: pa.Array, codec: WordCodec) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts in a row, each text with its END, and how many ids each has. Words
    of ASCII letters and marks after them are split into these pieces here, and the codec is
    asked once for each distinct piece of the batch, and for each distinct word of any other kind."""
    distinct, places, sizes = batch_words(texts)
    heads = pc.ascii_rtrim(distinct, MARKS.decode())
    plain = pc.ascii_is_alpha(heads)
    lower, marks = pc.ascii_lower(heads.filter(plain)), pc.ascii_ltrim(distinct.filter(plain), LETTERS)
    pieces = pa.concat_arrays([lower, marks]).dictionary_encode()
    parts = codec.pieces(as_bytes(pieces.dictionary))
    odd = as_bytes(distinct.filter(pc.invert(plain)))
    codes = codec.codes([odd])
    # A word is two runs: its head and its marks, or its ids and none, as END is.
    none = len(parts)
    parts += [b"", *map(codes.__getitem__, odd), array("I", [END]).tobytes()]
    halves = np.full((len(distinct) + 1, 2), none)
    is_plain = np.append(plain.to_numpy(zero_copy_only=False), False)
    halves[is_plain] = pieces.indices.to_numpy().reshape(2, -1).T
    halves[~is_plain, 0] = np.arange(none + 1, len(parts))
    flat = np.frombuffer(b"".join(parts), "<u4")
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    flat, lengths = picked(flat, lengths, halves.ravel())
    ends = np.cumsum(sizes)
    ids, many = picked(flat, lengths.reshape(-1, 2).sum(1), np.insert(places, ends, len(distinct)))
    ends += np.arange(len(sizes))
    return ids, np.diff(np.cumsum(many)[ends], prepend=0)


SHARDS = "part int, shard int, n_tokens long, n_docs long, body binary"


def write_shards(docs: DataFrame, tokenizer: str, path: str, tokens: int = SHARD_TOKENS) -> None:
    """Encode and write all documents as shard files, in ascending doc_id order."""
    spark = docs.sparkSession
    small_batches(spark)
    codec = spark.sparkContext.broadcast(WordCodec(Path(tokenizer).read_text(encoding="utf-8")))
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_tokens", pa.int64()),
                        ("n_docs", pa.int64()), ("body", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        ids, names, lengths, held = [], [], [], 0

        def row():
            whole = np.concatenate(ids)
            small = whole.astype(np.uint16) if whole.max() < 1 << 16 else whole
            body = shard_bytes(small, names, lengths)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "shard": shard, "n_tokens": len(whole),
                  "n_docs": len(names), "body": body}], schema)

        for batch in batches:
            flat, sizes = batch_ids(batch.column(1), codec.value)
            at = end = 0
            for name, size in zip(batch.column(0).to_pylist(), sizes.tolist(), strict=True):
                names.append(name)
                lengths.append(size)
                held += size
                end += size
                if held >= tokens:
                    ids.append(flat[at:end])
                    yield row()
                    ids, names, lengths, held, shard, at = [], [], [], 0, shard + 1, end
            ids.append(flat[at:])
        if names:
            yield row()

    # Range bounds come from a sample of the keys on the driver: a hash stands for the text there.
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("text")]
    ordered = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
        .withColumn("hash", F.xxhash64("text"))
        .repartitionByRange(*order[:2])
        .sortWithinPartitions(*order)
    )
    ordered.select("doc_id", "text").mapInArrow(cut, SHARDS).write.parquet(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shard files."""
    small_batches(spark)
    shards = spark.read.schema(SHARDS).parquet(path)
    schema = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()),
                        ("place", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64())])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, body in zip(*(batch.column(c) for c in range(3)), strict=True):
                matrix, names, lengths = read_shard(body.as_py())
                ids = matrix.tokens().astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * n, pa.int32()), pa.array([shard.as_py()] * n, pa.int32()),
                     pa.array(names, pa.int64()), pa.array(starts), pa.array(lengths),
                     pa.array(sums, pa.int64())], schema=schema)

    one_shard = shards.select("part", "shard", "body")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    rows = one_shard.mapInArrow(
        unpack, "part int, shard int, doc_id long, place long, n_tokens long, ids_crc32 long"
    )
    # One row per shard: a running sum over them all.
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select(
        F.col("part").alias("p"), F.col("shard").alias("s"),
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("offset"),
    )
    return rows.join(
        bounded(offsets, 100_000), (F.col("part") == F.col("p")) & (F.col("shard") == F.col("s"))
    ).select("doc_id", (F.col("offset") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the shard files of `docs` to the shared folder and read them back."""
    path = scratch(docs.sparkSession, "token-shards")
    write_shards(docs, tokenizer, path)
    return read_documents(docs.sparkSession, path)
