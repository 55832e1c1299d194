"""WARC archives, importance resampling and the prefix trie, against brute force."""

import base64
import gzip
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from parity import SMALLEST, database, difference
from pyspark.sql import functions as F

from liftwise.llm import importance, prefix_trie, queries, warc
from liftwise.session import scratch

# ---------------------------------------------------------------- op11

PAGES = "page_id long, url string, html string, digest string, row long, value string"


def sha32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def page_rows():
    rows = [(i, f"http://h/{i}", f"<p>{i % 7}</p>\r\n\r\nWARC/1.1 é" * (i % 3), "x", i, "v") for i in range(40)]
    rows += [(3, "http://h/3", rows[3][2], "x", 1, "v")] * 3  # repeated rows
    rows += [(None, None, None, None, None, None), (None, None, "", None, None, None)]
    rows += [(90, "http://a\r\nb: c", "x" * 300_000, "x", 1, "v"), (None, "u", "x" * 300_000, "x", 1, "v")]
    rows += [(7, "z", "tie", "", 0, ""), (7, "y", "tie", "", 0, ""), (8, "a", "tie", "", 0, "")]
    return rows


def written(spark, rows, **more):
    path = scratch(spark, "test-archives")
    frame = spark.createDataFrame(rows, PAGES).repartition(5)
    warc.write_archives(warc.page_records(frame), path, **more)
    return path, warc.read_archives(spark, path).collect()


def test_pages_come_back_with_one_response_per_payload(spark):
    rows = page_rows()
    _, found = written(spark, rows)
    payload = defaultdict(list)
    for page_id, _, html, *_ in rows:
        payload[html or ""].append(page_id)
    want = Counter()
    for html, ids in payload.items():
        ids.sort(key=lambda i: (i is None, i))
        for k, i in enumerate(ids):
            want[(i, len(html.encode()), sha32(html), "revisit" if k else "response", ids[0] if k else None)] += 1

    def number(x):
        return None if x is None else int(x)

    got = Counter(
        (number(r["source_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to_source"]))
        for r in found
    )
    assert got == want
    assert len({r["record_id"] for r in found}) == len(found)
    response = {r["payload_digest"]: r for r in found if r["record_type"] == "response"}
    for r in found:
        first = response[r["payload_digest"]]
        assert first["payload"].decode() in payload
        if r["record_type"] == "revisit":
            assert r["refers_to"] == first["record_id"] and r["payload"] is None


def test_small_payloads_are_all_responses(spark):
    _, found = written(spark, page_rows(), min_bytes=10)
    for r in found:
        if r["payload_bytes"] < 10:
            assert r["record_type"] == "response"
    assert any(r["record_type"] == "revisit" for r in found)
    assert len({r["record_id"] for r in found}) == len(found)


def test_shuffle_join_gives_the_same_archives(spark, monkeypatch):
    def told(found):
        return sorted(str((r["record_type"], r["source_id"], r["payload_digest"], r["refers_to_source"])) for r in found)

    want = told(written(spark, page_rows())[1])
    monkeypatch.setattr(warc, "BROADCAST_DIGESTS", 0)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    path, found = written(spark, page_rows())
    assert told(found) == want
    assert spark.read.format("binaryFile").load(path).count() > 5


def test_archives_that_hold_revisits_are_resolved_again(spark):
    path, found = written(spark, page_rows())
    late = spark.createDataFrame(
        [("2001", "u", None, None, sha32(page_rows()[1][2]), 5), ("2002", "u", None, None, "NOBODYHASTHIS", None)],
        "id string, url string, date string, payload binary, digest string, n_bytes long",
    )
    again = scratch(spark, "test-archives")
    warc.write_archives(warc.archive_records(spark, path).unionByName(late), again)
    second = {(r["source_id"], r["record_id"]): r for r in warc.read_archives(spark, again).collect()}
    assert len(second) == len(found) + 2
    rows = {r["source_id"]: r for r in second.values()}
    assert rows["2001"]["record_type"] == "revisit" and rows["2001"]["refers_to_source"] == "1"
    assert rows["2002"]["record_type"] == "revisit" and rows["2002"]["refers_to"] is None
    assert sum(r["record_type"] == "response" for r in second.values()) == sum(
        r["record_type"] == "response" for r in found
    )


def test_archives_of_no_pages_are_empty(spark):
    assert written(spark, [])[1] == []


def test_parser_reads_gzip_members_and_refuses_damage():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    record = b"WARC/1.0\r\nWARC-Type: response\r\nContent-Type: application/http\r\nContent-Length: %d\r\n\r\n" % len(block)
    record += block + b"\r\n\r\n"
    packed = gzip.compress(record) + gzip.compress(record)
    assert [warc._parsed(*r)[6] for r in warc._records_of(packed)] == [8, 8]
    with pytest.raises(ValueError):
        list(warc._records_of(record[:-3]))
    with pytest.raises(ValueError):
        list(warc._records_of(b"HTTP/1.1\r\n\r\n" + record))
    wrong = record.replace(b"WARC-Type", b"WARC-Payload-Digest: sha1:AAAA\r\nWARC-Type")
    with pytest.raises(ValueError):
        [warc._parsed(*r) for r in warc._records_of(wrong)]


# ---------------------------------------------------------------- op12


def brute_features(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c.isascii() and not ("0" <= c <= "9" or "a" <= c <= "z"):
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]


def brute_draw(docs, target, percent=25):
    s, t = Counter(), Counter()
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            counts.update(brute_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    rows = []
    for k, (d, text) in enumerate(docs):
        words, found = brute_features(text)
        gain = sum(
            math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in found
        )
        weight = gain // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def draw_rows():
    r = random.Random(5)
    letters = ["ab", "Cd", "é", "zz9", "日本", "q" * 90, "x-y", "A\x85B", "İ"]
    docs = [(i, " ".join(r.choices(letters, k=r.randint(0, 60)))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, "—"), (None, "ab " * 30), (None, "ab " * 30), (5, docs[5][1]), (5, docs[5][1])]
    docs += [(400, "ab cd " * 400_000)]
    return docs, ["cd zz9 cd zz9", "x y", None, "日本 ab"]


@pytest.mark.parametrize("margin", [0.0, 0.005, 1.0])
def test_draw_equals_brute_force(spark, margin, monkeypatch):
    monkeypatch.setattr(importance.cut_row, "__defaults__", (margin,))
    docs, target = draw_rows()
    frame = spark.createDataFrame([(*d, 1, "s") for d in docs], "doc_id long, text string, score int, row string")
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = importance.resampled(frame.repartition(4), wanted).collect()
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found)
    assert got == brute_draw(docs, target)


def test_draw_with_equal_scores(spark):
    rows = [(i % 50, 30, 1, 0, i % 2) for i in range(400)]
    frame = spark.createDataFrame(rows, importance.SCORED).repartition(6)
    for percent in (1, 25, 50, 100):
        found = [r for r in importance.drawn(frame, percent).collect() if r["rank"]]
        k = 400 * percent // 100
        assert sorted(r["rank"] for r in found) == list(range(1, k + 1))
        best = sorted(((-s, d) for d, *_, s in rows))[:k]
        assert [(-r["score"], r["doc_id"]) for r in sorted(found, key=lambda r: r["rank"])] == best


def test_draw_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    target = spark.createDataFrame([], "text string")
    assert importance.resampled(docs, target).collect() == []
    few = spark.createDataFrame([(1, "too short")], "doc_id long, text string")
    assert importance.resampled(few, target).collect()[0]["rank"] is None


# ---------------------------------------------------------------- op13


def brute_trie(members):
    """members: conv_id -> list of (turn, characters)."""
    at = defaultdict(list)
    for c, turns in members.items():
        for d in range(len(turns) + 1):
            at[tuple(t for t, _ in turns[:d])].append(c)
    size = {tuple(t for t, _ in turns[: d + 1]): n for turns in members.values() for d, (_, n) in enumerate(turns)}
    kids = defaultdict(list)
    for node in at:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(at, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = (len(at[node]) - 1) * size.get(node, 0) + sum(saved[k] for k in kids[node])
    out = Counter()
    for node, inside in at.items():
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(members[c]) == len(node)))
        out[(
            min(inside), len(node), min(at[node[:-1]]) if node else None, len(inside), len(kids[node]),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        )] += 1
    return out


def trie_rows(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return Counter(tuple(r[n] for n in names) for r in df.collect())


def brute_rebuilt(rows):
    """Rows (conv_id, turn, role, text) as the rebuilt conversations."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, told, (role, text)))
    for c in own:
        own[c].sort(key=lambda x: x[:3])
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - c % 100
        out[c] = [x[3] for x in own.get(base, [])[:h] + own[c][h:]]
    return {c: [(t, len(t[1])) for t in turns] for c, turns in out.items()}


def conversation_rows(seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(900), 160):
        kind = r.randrange(4)
        for turn in range(r.choice([1, 2, 3, 5, 8, 12])):
            text = f"t{turn if kind < 3 else r.randrange(3)}" if kind else f"own {c} {turn}"
            rows.append((c, turn, r.choice(["user", "user", "bot"]) if kind == 2 else "user", text))
    rows += [(950, None, "user", "first"), (950, 0, None, None), (950, None, "", ""), (950, 0, None, None)]
    rows += [(None, 1, "user", "nobody"), (951, 1, "user", "é" * 5000), (951, 2, "user", None)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("slices, head", [(100_000, 2048), (40, 2048), (9, 3), (60, 2)])
def test_trie_equals_brute_force(spark, seed, slices, head, many_slices):
    rows = conversation_rows(seed)
    frame = spark.createDataFrame([(*x, 1, "k") for x in rows], "conv_id long, turn long, role string, text string, pos int, key string")
    turns = prefix_trie.rebuilt(prefix_trie.turn_ids(frame.repartition(4)))
    assert trie_rows(prefix_trie.trie(turns, slices, head)) == brute_trie(brute_rebuilt(rows))


def test_many_conversations_that_end_at_one_node(spark, monkeypatch, many_slices):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 1, "user", "same") for c in range(1, 100)] + [(c, 2, "bot", "same") for c in range(1, 60)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.turn_ids(frame)
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append(((role, text), len(text)))
    assert trie_rows(prefix_trie.trie(turns)) == brute_trie(own)


def test_trie_of_nothing(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turn_ids(frame))).collect() == []


def test_layouts_grow_with_their_children():
    root, r = prefix_trie.Node(), random.Random(3)
    keys = {bytes(r.randrange(256) for _ in range(4)) for _ in range(5000)}
    keys |= {bytes([7, 7, 7, b]) for b in range(40)} | {bytes([7, 8, b, 1]) for b in range(10)} | {b"", b"\x07"}
    for k, key in enumerate(sorted(keys, key=lambda _: r.random())):
        prefix_trie.insert(root, key, k)
    found, kinds, todo = {}, set(), [(b"", root)]
    while todo:
        path, node = todo.pop()
        path += node.run
        kinds.add(getattr(node.layout, "size", type(node.layout).__name__))
        if node.entry is not None:
            found[path] = node.entry
        todo += [(path + bytes([b]), kid) for b, kid in node.layout.items()]
    assert set(found) == keys and len(set(found.values())) == len(keys)
    assert kinds == {4, 16, "Indexed", "Direct"}


@pytest.mark.parametrize("name", ["op11_warc_revisits", "op12_importance_resampling", "op13_prefix_trie"])
def test_twins(spark, name):
    assert name in queries.QUERIES
    assert difference(spark, database(SMALLEST), name, SMALLEST) is None


def test_trie_of_the_table_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALLEST}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert trie_rows(queries.QUERIES["op13_prefix_trie"](spark, SMALLEST)) == brute_trie(brute_rebuilt(rows))
