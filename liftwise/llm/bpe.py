"""BPE as a deterministic automaton over tokens, built merge by merge.

Start: one state in which every byte loops. The gadget of merge (u, v), the r-th:

* the state that arcs u lead to is copied without its arc v, and arcs u lead to the copy:
  u followed by v no longer is a path (`cut[u][v] = r`);
* states with an arc u get an arc uv, which leads to where v led before the merge: the
  state after uv starts as the state after v at time r (`right[uv] = v`, `born[uv] = r`).

Copies share what they have in common: a state is the token read last, its arcs are the
cuts along the token's right edge up to the time each edge piece was absorbed, and an arc y
exists if none of the pieces on y's left edge was cut while it stood for itself. Rows of
the transition table are filled on first use. The automaton accepts one token path for
each byte string, so every prefix has one last token: `path` finds it from the longest
suffix down. Decoding emits the arcs' labels.

Only what the merges derive is encoded by the automaton; texts are pre-split as the
tokenizers library does it. A piece between "no white space" and "white space" is always
split alone, so encodings are kept per such chunk.

encode_documents: one row per input row, other columns untouched. Null text counts as
empty: no tokens, hashes of the empty text. A column of the input named like a result is
replaced.
"""

from __future__ import annotations

import json
import re
from hashlib import sha256
from itertools import chain
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import CHUNK, RAGGED, WHITE, Cache, release, small_batches

NEVER = 1 << 60
# Longer pieces are read from the left, without recursion and without keeping prefixes.
LONG = 200
# What a worker keeps: arcs asked for, paths of pieces and their prefixes, words.
ARCS, PATHS, WORDS = 500_000, 400_000, 300_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


# The pre-split for chunks of Latin-1, where letters and numbers are a few ranges; all
# others are split by the library.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼½¾"
LATIN = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+"
    rf"| ?[^{WHITE}{LETTERS}{NUMBERS}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)


class MergeAutomaton:
    """Compiled merges. `vocab`: token -> id, `merges`: pairs in order of application."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.vocab = vocab
        size = max(vocab.values()) + 1
        self.born = [-1] * size
        self.left = [-1] * size
        self.right = [-1] * size
        self.cut: dict[int, dict[int, int]] = {}
        for r, (u, v) in enumerate(merges):
            a, b, new = vocab[u], vocab[v], vocab[u + v]
            if self.born[new] >= 0 or max(self.born[a], self.born[b]) >= r:
                raise ValueError(f"merge {r} makes a token twice or before its parts")
            self.cut.setdefault(a, {})[b] = r
            self.born[new], self.left[new], self.right[new] = r, a, b
        self.longest = max(map(len, vocab))
        self.size = [0] * size
        for token, i in vocab.items():
            self.size[i] = len(token)
        self._ready()

    def _ready(self) -> None:
        self.arcs = Cache(self._arc, ARCS)
        self.paths: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("arcs", "paths")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def _arc(self, pair: int) -> bool:
        """Does the state after token x have an arc y? pair = x << 32 | y."""
        x, end = pair >> 32, NEVER
        while x >= 0:
            cuts = self.cut.get(x)
            if cuts:
                y, till = pair & 0xFFFFFFFF, NEVER
                while y >= 0:
                    r = cuts.get(y, NEVER)
                    if r < end and r <= till and r < NEVER:
                        return False
                    y, till = self.left[y], self.born[y]
            x, end = self.right[x], self.born[x]
        return True

    def path(self, piece: str) -> tuple[int, ...]:
        """The token ids of one pre-split piece: the longest last token that the path of
        the rest has an arc for. Paths of prefixes are kept for the next piece."""
        known = self.paths.get(piece)
        if known is not None:
            return known
        get, n = self.vocab.get, len(piece)
        if n > LONG:
            return self._long_path(piece)
        for length in range(min(n, self.longest), 0, -1):
            y = get(piece[n - length :])
            if y is None:
                continue
            if length == n:
                return self._keep(piece, (y,))
            head = self.path(piece[: n - length])
            if self.arcs[head[-1] << 32 | y]:
                return self._keep(piece, (*head, y))
        raise ValueError("a byte without a token")

    def _keep(self, piece: str, path: tuple[int, ...]) -> tuple[int, ...]:
        if len(self.paths) >= PATHS:
            self.paths.clear()
        self.paths[piece] = path
        return path

    def _long_path(self, piece: str) -> tuple[int, ...]:
        get, ends = self.vocab.get, []
        for end in range(1, len(piece) + 1):
            for length in range(min(end, self.longest), 0, -1):
                y = get(piece[end - length : end])
                if y is not None and (
                    length == end or self.arcs[ends[end - length - 1] << 32 | y]
                ):
                    ends.append(y)
                    break
        out, n = [], len(piece)
        while n:
            out.append(ends[n - 1])
            n -= self.size[ends[n - 1]]
        return tuple(out[::-1])


class ByteCodec:
    """Texts to ids and back by the automaton of a byte-level tokenizer file."""

    def __init__(self, spec: str):
        model = json.loads(spec)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                  for m in model["model"]["merges"]]
        self.automaton = MergeAutomaton(model["model"]["vocab"], merges)
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        self.spec = spec
        self._tables()

    def __reduce__(self):  # the file travels, each worker compiles it once
        return (ByteCodec, (self.spec,))

    def _tables(self) -> None:
        from tokenizers import pre_tokenizers

        self.letters = byte_letters()
        byte = {c: b for b, c in self.letters.items()}
        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        size = max([*self.automaton.vocab.values(), *self.special.values()]) + 1
        self.labels = [b""] * size
        for token, i in self.automaton.vocab.items():
            self.labels[i] = bytes(byte[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode()
        self.names = list(map(str, range(size)))
        self.chunks = Cache(self.chunk, WORDS)
        self.spaced = Cache(self.after_space, WORDS)

    def _split(self, chunk: str) -> list[str]:
        """The pieces of a chunk, in the vocabulary's letters."""
        try:
            chunk.encode("latin-1")
        except UnicodeEncodeError:
            return [p for p, _ in self.split.pre_tokenize_str(chunk)]
        return [p.encode().decode("latin-1").translate(self.letters) for p in LATIN.findall(chunk)]

    def chunk(self, chunk: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.automaton.path, self._split(chunk))))

    def after_space(self, word: str) -> tuple[int, ...]:
        """The chunk of a space and a word; the usual shapes need no pattern."""
        if word.isascii():
            if word.isalpha():
                return self.automaton.path("\u0120" + word)
            if word[-1:] in ".,!?;:" and word[:-1].isalpha():
                return self.automaton.path("\u0120" + word[:-1]) + self.automaton.path(word[-1])
        return self.chunk(" " + word)

    def ordinary(self, text: str) -> list[int]:
        """Ids of a text in which no special token counts."""
        if RAGGED.search(text):
            return list(chain.from_iterable(map(self.chunks.__getitem__, CHUNK.findall(text))))
        first, *rest = text.split(" ")
        out = list(chain.from_iterable(map(self.chunks.__getitem__, CHUNK.findall(first))))
        out.extend(chain.from_iterable(map(self.spaced.__getitem__, rest)))
        return out

    def encode(self, text: str | None) -> list[int]:
        """As the library does it: special tokens inside a text are recognised."""
        if not text:
            return []
        for token, i in self.special.items():
            if token in text:
                head, _, tail = text.partition(token)
                out = self.ordinary(head)
                for part in tail.split(token):
                    out.append(i)
                    out.extend(self.ordinary(part))
                return out
        return self.ordinary(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


def load_codec(path: str) -> ByteCodec:
    codec = ByteCodec(Path(path).read_text(encoding="utf-8"))
    if len(codec.special) > 1:
        raise ValueError("more than one special token")
    return codec


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids (the encoding) and decoded (the text back from the ids)."""
    return _mapped(docs, path, text, "n_tokens long, ids array<int>, decoded string", _full)


def _full(codec: ByteCodec, texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        ids = codec.encode(t)
        rows.append((len(ids), ids, codec.decode(ids)))
    return pd.DataFrame(rows, columns=["n_tokens", "ids", "decoded"])


def encoding_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: the ids never leave the worker."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _mapped(docs, path, text, schema, _digests)


def _digests(codec: ByteCodec, texts: pd.Series) -> pd.DataFrame:
    rows = []
    for t in texts:
        ids = codec.encode(t)
        joined = ",".join(map(codec.names.__getitem__, ids)).encode()
        back = codec.decode(ids).encode()
        rows.append((len(ids), sha256(joined).hexdigest(), sha256(back).hexdigest()))
    return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])


def _mapped(docs: DataFrame, path: str, text: str, schema: str, work) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_codec(path))

    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.DataFrame:
        codec = shared.value
        release(codec.automaton.arcs, codec.chunks, codec.spaced)
        return work(codec, texts)

    names = [f.split()[0] for f in schema.split(", ")]
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    out = docs.select(*rest, run(F.col(text).cast("string")).alias("_encoded_"))
    return out.select(*rest, *[F.col(f"_encoded_.{n}").alias(n) for n in names])
