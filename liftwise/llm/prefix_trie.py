"""Conversation prefix trie: which conversations begin alike, and what sharing would save.

A turn's id is WIDTH bytes, big-endian: the hash of its role and text. A conversation is the
string of its turns' ids. Copies are collapsed first; the distinct strings are range-partitioned
into slices, and each slice becomes an adaptive radix tree: inner nodes of 4, 16, 48 or 256
children that grow when they are full, and runs of bytes without a branch kept as one prefix.
Of the tree's byte depths only those that end a turn are nodes of the result.

A prefix that continues over a slice's border is in both slices' trees. Slices are in order, so
such prefixes are the common beginning of two neighbouring strings, known from one row per
slice. Their numbers are sums over slices: a slice adds (members x characters) of every node it
sees, and takes a node's characters off (it saves one less) only if it is the first to see it;
children are counted by the slice that sees them first; a prefix of two slices always has
children and so is no leaf. So one aggregate of the border nodes merges all trees, however
many conversations begin with the same turn.

A conversation longer than HEAD turns that shares its first HEAD turns with nobody is a plain
chain from there on: its later nodes are made row by row and never collected. The ids that end
at a node are hashed in one stream, from pieces sorted and joined elsewhere.

Turns are in order of turn, null first; turns with the same number are in order of their ids,
and repeated rows are turns of their own. Null role or text is empty. Rows without conv_id
belong to no conversation. An empty table has no nodes. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from liftwise.llm.batches import bounded, small_batches, stored
from liftwise.operators.rank import ranked
from liftwise.session import materialize

WIDTH = 16
HEAD = 2048
# Turns of the distinct conversations that a task keeps as a tree.
SLICE_TURNS = 100_000
# Conversations ending at one node whose ids are joined in one value; more are hashed in pieces.
PIECE = 4096
BROADCAST_NODES = 200_000
NOBODY = hashlib.sha256(b"").hexdigest()

TURN = "conv_id long, pos long, id binary, chars long"
NODE = (
    "shared boolean, node binary, parent binary, conv_id long, depth long, parent_conv_id long,"
    " n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


# ---------------------------------------------------------------- the tree


class Few:
    """Up to `size` children: their bytes in order, beside them the children."""

    __slots__ = ("size", "bytes", "kids")

    def __init__(self, size: int, pairs=()):
        self.size, self.bytes, self.kids = size, bytearray(), []
        for b, kid in pairs:
            self.put(b, kid)

    def get(self, b: int):
        at = self.bytes.find(b)
        return self.kids[at] if at >= 0 else None

    def full(self) -> bool:
        return len(self.kids) == self.size

    def put(self, b: int, kid) -> None:
        at = self.bytes.find(b)
        if at >= 0:
            self.kids[at] = kid
            return
        at = sum(x < b for x in self.bytes)
        self.bytes.insert(at, b)
        self.kids.insert(at, kid)

    def items(self):
        return zip(self.bytes, self.kids, strict=True)

    def grown(self):
        return Few(16, self.items()) if self.size == 4 else Indexed(self.items())


class Indexed:
    """Up to 48 children: 256 places that point to them."""

    __slots__ = ("at", "kids")

    def __init__(self, pairs=()):
        self.at, self.kids = bytearray(b"\xff" * 256), []
        for b, kid in pairs:
            self.put(b, kid)

    def get(self, b: int):
        at = self.at[b]
        return self.kids[at] if at != 255 else None

    def full(self) -> bool:
        return len(self.kids) == 48

    def put(self, b: int, kid) -> None:
        if self.at[b] != 255:
            self.kids[self.at[b]] = kid
        else:
            self.at[b] = len(self.kids)
            self.kids.append(kid)

    def items(self):
        return ((b, self.kids[at]) for b, at in enumerate(self.at) if at != 255)

    def grown(self):
        return Direct(self.items())


class Direct:
    """A place for each of 256 children."""

    __slots__ = ("kids",)

    def __init__(self, pairs=()):
        self.kids = [None] * 256
        for b, kid in pairs:
            self.kids[b] = kid

    def get(self, b: int):
        return self.kids[b]

    def full(self) -> bool:
        return False

    def put(self, b: int, kid) -> None:
        self.kids[b] = kid

    def items(self):
        return ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)


class Node:
    """A run of bytes that all strings below share, the string that ends here, if any, and the
    children by their next byte."""

    __slots__ = ("run", "entry", "layout")

    def __init__(self, run: bytes = b"", entry: int | None = None):
        self.run, self.entry, self.layout = run, entry, Few(4)

    def add(self, b: int, kid: Node) -> None:
        if self.layout.full() and self.layout.get(b) is None:
            self.layout = self.layout.grown()
        self.layout.put(b, kid)


def agree(run: bytes, key: bytes, at: int) -> int:
    """How many bytes of `run` are those of `key` from `at`."""
    if key.startswith(run, at):
        return len(run)
    low, high = 0, len(run)  # the first `low` agree, the first `high` do not
    while high - low > 1:
        mid = (low + high) // 2
        if key.startswith(run[low:mid], at + low):
            low = mid
        else:
            high = mid
    return low


def insert(root: Node, key: bytes, entry: int) -> None:
    """Put a string into the tree; a string that is there gets the new entry."""
    node, at, above, turn = root, 0, None, 0
    while True:
        run = node.run
        same = agree(run, key, at)
        if same < len(run):  # a branch, or the end, inside the run
            upper = Node(run[:same])
            node.run = run[same + 1 :]
            upper.add(run[same], node)
            above.layout.put(turn, upper)
            node, run = upper, upper.run
        at += len(run)
        if at == len(key):
            node.entry = entry
            return
        above, turn = node, key[at]
        node = node.layout.get(turn)
        if node is None:
            above.add(turn, Node(key[at + 1 :], entry))
            return
        at += 1


def tree_nodes(
    keys: list[bytes], chars: list, first: list[int], count: list[int], ends: list,
    goes_on: list[bool], before: int = -1, after: int = -1,
) -> Iterator[tuple]:
    """Rows (NODE) of a slice's distinct strings. `before` and `after`: how many turns its
    smallest string shares with the slice before, its largest with the one after; -1: none."""
    if not keys:
        return
    root = Node()
    for k, key in enumerate(keys):
        insert(root, key, k)
    low, high = min(keys), max(keys)

    # Tree nodes from the top down: start and end of their bytes, the nearest node above that
    # ends a turn within its own bytes.
    nodes, span, above, over = [root], [(0, 0)], [-1], [-1]
    for i, node in enumerate(nodes):
        ends_turn = i == 0 or span[i][1] // WIDTH > span[i][0] // WIDTH
        for _, kid in node.layout.items():
            nodes.append(kid)
            span.append((span[i][1], span[i][1] + 1 + len(kid.run)))
            above.append(i)
            over.append(i if ends_turn else over[i])

    n, least, some = [0] * len(nodes), [None] * len(nodes), [0] * len(nodes)
    kids, leaves, saved = [0] * len(nodes), [0] * len(nodes), [0] * len(nodes)
    on_low, on_high = [False] * len(nodes), [False] * len(nodes)
    rows: list[tuple] = []

    def is_shared(i: int, depth: int) -> bool:
        return (on_low[i] and depth <= before) or (on_high[i] and depth <= after)

    for i in range(len(nodes) - 1, -1, -1):  # from the bottom up
        k = nodes[i].entry
        if k is not None:
            n[i] += count[k]
            least[i] = first[k] if least[i] is None else min(least[i], first[k])
            some[i] = k
            on_low[i] |= keys[k] == low
            on_high[i] |= keys[k] == high
            kids[i] += goes_on[k]
            leaves[i] += goes_on[k]
        start, end = span[i]
        inner, leaf, save = kids[i], leaves[i], saved[i]
        for depth in range(end // WIDTH, start // WIDTH if i else -1, -1):
            shared = is_shared(i, depth)
            owned = not (on_low[i] and depth <= before)
            if inner == 0 and not shared:
                leaf = 1
            size = chars[some[i]][depth - 1] if depth else 0
            save += size * n[i] - (size if owned else 0)
            own = k is not None and depth * WIDTH == end and not goes_on[k]
            top = depth == start // WIDTH + 1 or depth == 0
            rows.append((i, depth, top, shared, inner, leaf, save, ends[k] if own else None))
            inner = int(owned)
        up = above[i]
        if up >= 0:
            n[up] += n[i]
            least[up] = least[i] if least[up] is None else min(least[up], least[i])
            some[up] = some[i]
            kids[up] += inner
            leaves[up] += leaf
            saved[up] += save
            on_low[up] |= on_low[i]
            on_high[up] |= on_high[i]

    def name(i: int, depth: int) -> bytes:
        return hashlib.md5(keys[some[i]][: depth * WIDTH]).digest()

    for i, depth, top, shared, inner, leaf, save, ended in rows:
        parent, parent_conv = None, None
        if depth:
            p = over[i] if top else i
            if is_shared(p, depth - 1):
                parent = name(p, depth - 1)
            else:
                parent_conv = least[p]
        yield (
            shared, name(i, depth) if shared else None, parent, least[i], depth, parent_conv,
            n[i], inner, leaf, save, ended,
        )


# ---------------------------------------------------------------- tables


def turn_ids(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, id, chars): every turn's place in its conversation, from 1, and its id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    slim = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.md5(told.cast("binary"))).alias("id"),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("id").asc()]
    placed = ranked(slim, order, ["conv_id"])
    return placed.select("conv_id", F.col("rank").cast("long").alias("pos"), "id", "chars")


def rebuilt(turns: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Conversations that begin as another one does: c takes the first h turns of conversation
    c - c % every, h = crc32(c) % (most + 1), and goes on with its own after its first h. A
    row of place 0 stands for each conversation, also one left without turns."""
    turns = stored(turns, "turns")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most + 1)
    with_base = turns.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % every})
    heads = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") <= most)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("at"),
        F.col("id").alias("head_id"), F.col("chars").alias("head_chars"),
    )
    sizes = heads.groupBy("base").agg(F.max("at").alias("size"))
    own = (
        with_base.where("pos > h")
        .join(sizes, "base", "left")
        .select(
            "conv_id",
            (F.col("pos") - F.col("h") + F.least("h", F.coalesce("size", F.lit(0)))).alias("pos"),
            "id",
            "chars",
        )
    )
    each = with_base.where("pos = 1").select("conv_id", "base", "h")
    taken = each.join(heads, "base").where("at <= h").select(
        "conv_id", F.col("at").alias("pos"), F.col("head_id").alias("id"), F.col("head_chars").alias("chars")
    )
    empty = each.select(
        "conv_id", F.lit(0).cast("long").alias("pos"),
        F.lit(None).cast("binary").alias("id"), F.lit(0).cast("long").alias("chars"),
    )
    return own.union(taken).union(empty)


def _strings(turns: DataFrame) -> DataFrame:
    """(conv_id, key, chars, size): the ids of a conversation one after the other."""
    told = F.when(F.col("pos") > 0, F.struct("pos", F.hex("id").alias("id"), "chars"))
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(told)).alias("turns"))
    return listed.select(
        "conv_id",
        F.unhex(F.array_join("turns.id", "")).alias("key"),
        F.col("turns.chars").alias("chars"),
        F.size("turns").cast("long").alias("size"),
    )


def _ids_sha(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, ",").cast("binary"), 256)


def _ends(strings: DataFrame) -> DataFrame:
    """(key_hash, ends): the hash of the ids of the conversations that are one string."""
    ids = strings.select(F.unhex(F.md5("key")).alias("key_hash"), "conv_id")
    sizes = stored(ids.groupBy("key_hash").agg(F.count(F.lit(1)).alias("n")), "string-sizes")
    alone = ids.join(sizes.where("n = 1").drop("n"), "key_hash", "left_semi").select(
        "key_hash", F.sha2(F.col("conv_id").cast("string").cast("binary"), 256).alias("ends")
    )
    some = ids.join(sizes.where(f"n > 1 AND n <= {PIECE}").drop("n"), "key_hash", "left_semi")
    found = alone.union(
        some.groupBy("key_hash").agg(_ids_sha(F.sort_array(F.collect_list("conv_id"))).alias("ends"))
    )
    large = sizes.where(f"n > {PIECE}").drop("n")
    if large.isEmpty():
        return found
    placed = ranked(ids.join(large, "key_hash", "left_semi"), [F.col("conv_id").asc()], ["key_hash"])
    pieces = placed.groupBy("key_hash", F.floor((F.col("rank") - 1) / PIECE).alias("piece")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids")
    )
    streams = pieces.repartition("key_hash").sortWithinPartitions("key_hash", "piece")
    return found.union(streams.mapInArrow(_stream_hashes, "key_hash binary, ends string"))


def _stream_hashes(batches):
    """One hash per key over its pieces, which come in order."""
    key, state, done = None, None, []
    for batch in batches:
        hashes, ids = batch.column("key_hash"), batch.column("ids")
        for h, piece in zip(hashes, ids, strict=True):
            h = h.as_py()
            if h != key:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = h, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.as_py().encode())
    if key is not None:
        done.append((key, state.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done], pa.string())],
        names=["key_hash", "ends"],
    )


def _common_turns(a: Column, b: Column) -> Column:
    """How many leading ids two strings share."""
    most = (F.least(F.octet_length(a), F.octet_length(b)) / WIDTH).cast("int")

    def alike(i):
        return F.substr(a, F.lit(1), i * WIDTH) == F.substr(b, F.lit(1), i * WIDTH)

    return F.when(most > 0, F.size(F.filter(F.sequence(F.lit(1), most), alike))).otherwise(0)


def trie(turns: DataFrame, slice_turns: int = SLICE_TURNS, head: int = HEAD) -> DataFrame:
    """The nodes of the trie of (conv_id, pos, id, chars): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = turns.sparkSession
    small_batches(spark)
    turns = stored(turns, "rebuilt")
    strings = _strings(turns.where(F.col("pos") <= head)).withColumn("goes_on", F.lit(False))
    tails = None
    if not turns.where(F.col("pos") > head).isEmpty():
        strings, tails = _peeled(turns, strings, head)
    strings = stored(strings, "strings")

    distinct = strings.groupBy("key", "chars", "goes_on").agg(
        F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    named = distinct.withColumn("key_hash", F.unhex(F.md5("key")))
    entries = stored(named.join(_ends(strings), "key_hash").drop("key_hash"), "entries")
    total = entries.agg(F.sum(F.octet_length("key") / WIDTH + 1)).first()[0] or 0
    slices = max(1, -(-int(total) // slice_turns))
    sliced = materialize(entries.repartitionByRange(slices, "key"))

    # One row per slice: how many turns its first string shares with the last one before it.
    bounds = sliced.groupBy(F.spark_partition_id().alias("slice")).agg(
        F.min("key").alias("low"), F.max("key").alias("high")
    )
    last = F.lag("high").over(Window.orderBy("slice"))
    seams = bounds.select("slice", last.alias("last"), "low").select(
        "slice", F.when(F.col("last").isNull(), -1).otherwise(_common_turns(F.col("last"), F.col("low")))
    )
    found = sorted(map(tuple, seams.collect()))
    after = [common for _, common in found[1:]] + [-1]
    common = {s: (b, a) for (s, b), a in zip(found, after)}

    schema = pa.schema(
        [(f.split()[0], {"boolean": pa.bool_(), "binary": pa.binary(), "long": pa.int64()}.get(f.split()[1], pa.string()))
         for f in NODE.split(", ")]
    )

    def build(batches):
        rows = [r for batch in batches for r in batch.to_pylist()]
        before, after = common.get(TaskContext.get().partitionId(), (-1, -1))
        columns = [[r[c] for r in rows] for c in ("key", "chars", "first", "n", "ends", "goes_on")]
        held = []
        for row in tree_nodes(*columns, before, after):
            held.append(row)
            if len(held) == 10_000:
                yield _arrow(held, schema)
                held = []
        if held:
            yield _arrow(held, schema)

    return _merged(stored(sliced.mapInArrow(build, NODE), "trie-nodes"), tails)


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _peeled(turns: DataFrame, strings: DataFrame, head: int) -> tuple[DataFrame, DataFrame]:
    """Strings where only what others may share is collected, and the nodes of the rest."""
    full = strings.where(F.col("size") == head).select("conv_id", F.md5("key").alias("head_hash"))
    full = stored(full, "heads")
    single = full.groupBy("head_hash").agg(F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
    longer = turns.where(F.col("pos") > head).groupBy("conv_id").agg(F.max("pos").alias("size"))
    alone = stored(full.join(single, "head_hash").join(longer, "conv_id").select("conv_id", "size"), "alone")
    ids = alone.select("conv_id")
    others = longer.join(ids, "conv_id", "left_anti").select("conv_id")
    kept = strings.join(others, "conv_id", "left_anti").join(
        ids.withColumn("peeled", F.lit(True)), "conv_id", "left"
    )
    goes_on = F.coalesce("peeled", F.lit(False)).alias("goes_on")
    columns = ["conv_id", "key", "chars", "size"]
    whole = _strings(turns.join(others, "conv_id", "left_semi")).withColumn("goes_on", F.lit(False))
    last = F.col("pos") == F.col("size")
    nothing, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    ended = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    tails = (
        turns.where(F.col("pos") > head)
        .join(alone, "conv_id")
        .select(
            "conv_id", F.col("pos").alias("depth"), F.col("conv_id").alias("parent_conv_id"),
            one.alias("n_convs"), F.when(last, nothing).otherwise(one).alias("n_children"),
            one.alias("n_leaves"), nothing.alias("saved_tokens"),
            F.when(last, ended).otherwise(NOBODY).alias("ends_sha256"),
        )
    )
    return kept.select(*columns, goes_on).union(whole.select(*columns, "goes_on")), tails


def _merged(nodes: DataFrame, tails: DataFrame | None) -> DataFrame:
    """Border nodes summed over slices, and every node with its parent's smallest member."""
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    border = stored(
        nodes.where("shared")
        .groupBy("node")
        .agg(
            F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            *[F.sum(c).alias(c) for c in columns[3:7]], F.max("ends_sha256").alias("ends_sha256"),
        ),
        "border-nodes",
    )
    below = nodes.where("NOT shared AND parent IS NOT NULL").select("parent", *columns)
    parents = border.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_first"))
    waiting = below.union(border.select("parent", *columns))
    linked = waiting.join(bounded(parents, BROADCAST_NODES), "parent", "left").withColumn(
        "parent_conv_id", F.col("parent_first")
    )
    done = nodes.where("NOT shared AND parent IS NULL").select(*columns).union(linked.select(*columns))
    done = done.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOBODY)))
    return done.union(tails) if tails is not None else done
