"""Edit-aware token counts: a segment tree of pre-tokens per document.

A leaf holds a run of pre-tokens (white space and the word after it, which a byte-level
tokenizer never merges across) with its characters and tokens; inner nodes hold sums. An
edit descends to its place by character sums, re-splits only the leaves it touches plus the
neighbours whose end or start it could move, encodes the new run, and updates the sums on
the way up. A run that has grown over RUN pre-tokens makes the tree be built anew.

`build_trees` stores the trees in a binary column, `edit_trees` applies edits to stored
trees. Edits are an array of (start, length, insert) per row, applied in order, in
characters of the text as it then is. Places outside the text are moved to its ends. An
edit without start is skipped; a null length counts as 0, a null insert as empty, null text
as empty. Special tokens inside texts count as ordinary text. Other columns stay; result
columns replace input columns of the same name.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import CHUNK, Cache, small_batches
from liftwise.llm.bpe import ByteCodec, load_codec

RUN = 32


class CountTree:
    def __init__(self, text: str, count, leaves: np.ndarray | None = None):
        """`count`: chunk -> tokens. `leaves`: stored (characters, tokens, chunks) of each
        leaf, so that a stored tree needs no encoding to come back."""
        self.text, self.count, self.encoded = text, count, 0
        if leaves is None:
            chunks = CHUNK.findall(text)
            leaves = np.ones((len(chunks), 3), np.int64)
            leaves[:, 0] = np.fromiter(map(len, chunks), np.int64, len(chunks))
            leaves[:, 1] = np.fromiter(map(count, chunks), np.int64, len(chunks))
            self.encoded = len(chunks)
        self.room = 1
        while self.room < max(1, len(leaves)):
            self.room *= 2
        self.sums = np.zeros((2 * self.room, 3), np.int64)
        self.sums[self.room : self.room + len(leaves)] = leaves
        level = self.room
        while level > 1:
            below = self.sums[level : 2 * level]
            self.sums[level // 2 : level] = below[::2] + below[1::2]
            level //= 2

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def leaves(self) -> np.ndarray:
        kept = self.sums[self.room :]
        return kept[kept[:, 2] > 0]

    def find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at `place`, and where the leaf starts."""
        node, start = 1, 0
        while node < self.room:
            node *= 2
            if place - start >= self.sums[node, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return node, start

    def _put(self, node: int, leaf: tuple[int, int, int]) -> None:
        change = np.array(leaf) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int, length: int, insert: str) -> None:
        size = len(self.text)
        start = min(max(start, 0), size)
        end = min(start + max(length, 0), size)
        fresh = self.text[:start] + insert + self.text[end:]
        if not size or not fresh:
            done = self.encoded
            self.__init__(fresh, self.count)
            self.encoded += done
            return
        # The leaf that ends where the edit starts may grow into it, and the one that starts
        # where it ends may lose its start; leaves beyond keep both of their ends.
        first, begins = self.find(max(start - 1, 0))
        last, after = self.find(min(end, size - 1))
        stops = after + int(self.sums[last, 0])
        chunks = CHUNK.findall(fresh[begins : stops + len(insert) - (end - start)])
        if len(chunks) > RUN * max(1, last - first + 1):
            done = self.encoded
            self.__init__(fresh, self.count)
            self.encoded += done
            return
        self.encoded += len(chunks)
        for node in range(first + 1, last + 1):
            if self.sums[node, 2]:
                self._put(node, (0, 0, 0))
        leaf = (sum(map(len, chunks)), sum(map(self.count, chunks)), len(chunks))
        self._put(first, leaf)
        self.text = fresh


def _counter(codec: ByteCodec):
    """chunk -> tokens, kept with the worker's codec."""
    if not hasattr(codec, "counts"):
        codec.counts = Cache(
            lambda c: len(codec.after_space(c[1:]) if c[0] == " " else codec.chunk(c))
        )
    return codec.counts.__getitem__


def build_trees(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Adds n_tokens and tree: the stored leaves."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_codec(path))

    @F.pandas_udf("n_tokens long, tree binary")
    def build(texts: pd.Series) -> pd.DataFrame:
        count = _counter(shared.value)
        trees = [CountTree(t or "", count) for t in texts]
        return pd.DataFrame(
            [(t.tokens, t.leaves.astype("<i4").tobytes()) for t in trees],
            columns=["n_tokens", "tree"],
        )

    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_tokens", "tree")]
    out = docs.select(*rest, build(F.col(text).cast("string")).alias("_built_"))
    return out.select(*rest, "_built_.n_tokens", "_built_.tree")


EDITED = "n_tokens long, n_leaves long, n_encoded long, tree binary, edited string"


def edit_trees(trees: DataFrame, edits: Column, path: str, text: str = "text") -> DataFrame:
    """Applies `edits` to documents from build_trees: n_tokens and tree become those of the
    edited text; n_encoded counts the pre-tokens that were encoded for it."""
    spark = trees.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(load_codec(path))

    @F.pandas_udf(EDITED)
    def change(texts: pd.Series, stored: pd.Series, edits: pd.Series) -> pd.DataFrame:
        count = _counter(shared.value)
        rows = []
        for t, leaves, todo in zip(texts, stored, edits, strict=True):
            kept = None if leaves is None else np.frombuffer(leaves, "<i4").reshape(-1, 3)
            tree = CountTree(t or "", count, kept)
            for e in [] if todo is None else todo:
                if e["start"] is not None:
                    tree.edit(int(e["start"]), int(e["length"] or 0), e["insert"] or "")
            final = tree.leaves
            rows.append((tree.tokens, len(final), tree.encoded,
                         final.astype("<i4").tobytes(), tree.text))
        return pd.DataFrame(rows, columns=[f.split()[0] for f in EDITED.split(", ")])

    names = [f.split()[0] for f in EDITED.split(", ")]
    rest = [F.col(f"`{c}`") for c in trees.columns if c not in names]
    out = trees.select(
        *rest, change(F.col(text).cast("string"), F.col("tree"), edits).alias("_changed_")
    )
    return out.select(*rest, *[F.col(f"_changed_.{n}").alias(n) for n in names])
