"""Operators on whole tables, against brute force."""

import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from parity import database, sql_rows
from pyspark.sql import functions as F

from liftwise.llm import decontaminate, line_dedup, ngram_join, queries, suffix_tree
from liftwise.llm.components import components, merged

TABLES = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, text_ string").repartition(3)


def brute_components(rows, width, percent):
    sets = {}
    for d, t, *_ in rows:
        sets.setdefault(d, []).append(ngram_join.word_set(t, width))
    label = {d: d for d in sets if d is not None}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                linked = any(
                    x and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]
                )
                if linked and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    monkeypatch.setattr(ngram_join, "COMMON_FROM", 4)
    r = random.Random(seed)
    base = [[r.choice("abcdefghij") + r.choice("klmnop") for _ in range(r.randint(1, 60))] for _ in range(6)]
    rows = []
    for i in range(70):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2])):
            words[r.randrange(len(words))] = r.choice(["x1", "x2", "x3"])
        text = r.choice([" ", "\n", "  "]).join(words)
        rows.append((i * 3, r.choice([text, text.upper()]), "x"))
    rows += [(500, None, "x"), (501, "", "x"), (502, " \n", None), (None, rows[0][1], "x"), (0, rows[0][1], "x")]
    got = ngram_join.jaccard_components(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_components(rows, 3, 90)
    for g in got:
        assert g["component_id"] == (None if g["doc_id"] is None else want[g["doc_id"]])
        if g["doc_id"] in (500, 501, 502):
            assert g["n_shingles"] == 0


def test_empty_table_has_no_components(spark):
    assert ngram_join.jaccard_components(frame(spark, [(1, "a", "b")]).limit(0)).count() == 0


def test_line_dedup_cases(spark):
    rows = [
        (3, "A shared line\nown line three\n a SHARED line \t\nshort", "x"),
        (1, "a shared line\nshort", "x"),
        (2, "own", None), (4, None, "x"), (5, "", "x"), (None, "a shared line", "x"),
        (6, "a shared line\na shared line", "x"), (6, "a shared line\na shared line", "x"),
    ]
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"])
           for r in line_dedup.dedup_lines(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted([
        (1, 2, 0, "a shared line\nshort"), (2, 1, 0, "own"), (3, 4, 2, "own line three\nshort"),
        (4, 1, 0, None), (5, 1, 0, ""), (6, 2, 2, ""), (6, 2, 2, ""), (None, 1, 0, "a shared line"),
    ], key=repr)
    assert line_dedup.line_digests(frame(spark, rows).limit(0)).count() == 0


def test_line_dedup_stays_in_the_jvm(spark):
    plan = line_dedup.line_digests(spark.read.parquet(f"{TABLES}/documents.parquet"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_decontamination_finds_copies_and_new_parameters(spark):
    item = ("The train leaves Paris at 9 and travels 120 km to Lyon, then 60 km further. "
            "How many km did the train of Paris travel in all before it stopped?")  # fmt: skip
    benchmark = spark.createDataFrame(
        [(1, item), (2, "short item of four"), (3, None), (4, ""), (None, item)], "item_id long, text string"
    )
    renamed = item.replace("Paris", "Oslo").replace("Lyon", "Bergen").replace("120", "75").replace("60", "31")
    mixed = renamed.replace("Oslo", "Rome", 1)  # one name stands for two: not a question's copy
    rows = [
        (10, "Before it all. " + item + " After it all.", "x"), (11, renamed, "x"), (12, mixed, "x"),
        (13, "A short item of four words", "x"), (14, "The train leaves now and then.", "x"),
        (15, None, "x"), (16, "", None), (None, item, "x"), (10, "other text", "x"),
    ]
    got = {(r["doc_id"], r["item_id"]): r["verbatim"]
           for r in decontaminate.contaminated(frame(spark, rows), benchmark).collect()}
    assert got == {(10, 1): True, (11, 1): False, (13, 2): True}
    assert decontaminate.contaminated(frame(spark, rows), benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(frame(spark, rows).limit(0), benchmark).count() == 0


def test_decontamination_finds_changed_values_parts_and_lower_case(spark):
    r = random.Random(15)
    say = lambda n: " ".join("".join(r.choices("bcdfgklmnprst", k=7)) for _ in range(n))
    dated = f"In 2019 {say(12)} until 2019 {say(8)} with Paris {say(4)} here."
    long = say(250)
    names = "Der Hund von Anna sah im Park die Katze von Otto und lief mit Emma nach Hause."
    benchmark = spark.createDataFrame([(1, dated), (2, long), (3, names)], "item_id long, text string")
    words = long.split()
    rows = [
        (10, f"{say(9)} {dated.replace('until 2019', 'until 2020')}", "x"),
        (11, dated.replace("until 2019", "until 2020").replace("Paris", "Rome"), "x"),
        (20, f"{say(5)} {' '.join(words[70:170])} {say(5)}", "x"),
        (21, f"{say(5)} {' '.join(words[70:83])} {say(5)}", "x"),
        (22, f"{say(5)} {' '.join(words[70:82])} {say(5)}", "x"),
        (30, names.lower(), "x"), (31, say(60), "x"),
    ]
    got = decontaminate.contaminated(frame(spark, rows), benchmark).collect()
    found = {(g["doc_id"], g["item_id"]): (g["n_covered"], g["verbatim"]) for g in got}
    assert sorted(found) == [(10, 1), (11, 1), (20, 2), (21, 2), (30, 3)]
    assert found[20, 2] == (100, True) and found[21, 2] == (13, True) and found[30, 3] == (17, True)
    assert not found[10, 1][1] and not found[11, 1][1]


def test_scores(spark, monkeypatch):
    for name in ("HEAD_SHARE", "PAIR_SHARE", "CONTEXT_SHARE"):
        monkeypatch.setattr(suffix_tree, name, 0.004)
    r = random.Random(8)
    rows = []
    for i in range(300):
        words = []
        for _ in range(r.randint(0, 40)):
            words += ["New", "york", "city"] if r.random() < 0.2 else [r.choice("abcdefgh") * r.randint(1, 9)]
        rows.append((i, " ".join(words), "x"))
    rows += [(400, None, "x"), (401, "", "x"), (None, "new york", "x"), (1, "twice", "x")]
    got = suffix_tree.score_documents(frame(spark, rows)).collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    tokens = lambda t: [*((t or "").encode().lower().split()), b"\n"]
    counts = Counter(w for d, t, _ in rows if not held(d) for w in tokens(t))
    total, floor = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    want = sorted(
        (str(d), held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total,
         round(sum(math.log10((counts[w] + 1) / floor) for w in tokens(t)), 6)) for d, t, _ in rows
    )
    assert want == sorted(
        (str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in got
    )
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert suffix_tree.score_documents(frame(spark, rows).limit(0)).count() == 0


def test_shares_of_the_corpus_change_no_score(spark, monkeypatch):
    """A context and next word seen MIN_COUNT times count, however small their share is."""
    r = random.Random(12)
    rows = [(i, " ".join(r.choice("abcdefgh") for _ in range(60)), "x") for i in range(100)]
    rows += [(i, f"{r.choice('abcd')} one two three four", "x") for i in range(200, 212)]
    found = []
    for share in (0.0, 0.004, 0.5):
        for name in ("HEAD_SHARE", "PAIR_SHARE", "CONTEXT_SHARE"):
            monkeypatch.setattr(suffix_tree, name, share)
        got = suffix_tree.score_documents(frame(spark, rows)).collect()
        found.append({r["doc_id"]: (r["base_score"], r["score"]) for r in got})
    for d, (base, score) in found[0].items():
        assert all(f[d] == pytest.approx((base, score), abs=1e-6) for f in found)
        assert d < 200 or score > base + 3  # the rare phrase is learnt


def test_counted_grams_come_in_small_batches(monkeypatch):
    """What a task holds and hands on at once does not grow with the rows it reads."""
    r = random.Random(4)
    texts = [" ".join(r.choice("abcdefgh") * r.randint(1, 9) for _ in range(50)) for _ in range(400)]
    parts = [pa.RecordBatch.from_pydict({"text": texts[at : at + 20]}) for at in range(0, 400, 20)]
    every = np.full(suffix_tree.BITS // 8, 255, np.uint8)

    def counted():
        out, most = Counter(), 0
        for batch in suffix_tree.counted_grams(iter(parts), 3, every):
            most = max(most, batch.num_rows)
            for row in batch.to_pylist():
                out[row["ctx"], row["suf"]] += row["c"]
        return out, most

    whole, _ = counted()
    monkeypatch.setattr(suffix_tree, "HELD_GRAMS", 3_000)
    monkeypatch.setattr(suffix_tree, "SENT_ROWS", 100)
    assert counted() == (whole, 100)
    ends = [[*t.split(), "\n"] for t in texts]
    want = Counter(tuple(w[i : i + 3]) for w in ends for i in range(len(w) - 2))
    assert sorted(whole.values()) == sorted(want.values())


def test_scores_do_not_depend_on_the_buckets_of_ngrams(spark, monkeypatch):
    """N-grams are dealt into buckets, counted and looked up there; with many buckets, one context
    before every other word and all words looked up, scores stay the same."""
    r = random.Random(31)
    rows = [(i, " ".join(f"the {r.choice('abcdefgh')}{r.choice('ij')}" for _ in range(20)), "x") for i in range(120)]
    rows += [(200, None, "x"), (201, " ", "x"), (None, "the ai", "x"), (1, "the never", "x")]
    for name in ("HEAD_SHARE", "PAIR_SHARE"):
        monkeypatch.setattr(suffix_tree, name, 0.5)
    found = []
    for tokens in (500_000, 40):
        monkeypatch.setattr(suffix_tree, "BUCKET_TOKENS", tokens)
        monkeypatch.setattr(suffix_tree, "HELD_GRAMS", tokens)
        got = suffix_tree.score_documents(frame(spark, rows)).collect()
        found.append(sorted((str(x["doc_id"]), x["n_tokens"], x["n_known"], round(x["base_score"], 6),
                             round(x["score"], 6)) for x in got))
    assert found[0] == found[1] and len(found[0]) == len(rows)
    keys = np.random.default_rng(3).integers(0, 1 << 63, 1000, np.uint64) * np.uint64(2) + np.uint64(1)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    same = table.select(suffix_tree.bucket_column("key", 77).alias("b")).collect()
    assert [x["b"] for x in same] == suffix_tree.bucket_of(keys, 77).tolist()


def test_scores_do_not_depend_on_the_rounds_of_lookups(spark, monkeypatch):
    """What the caches lack is looked up for a part of the texts after the other, so that the disk
    never holds the lookups of all texts."""
    r = random.Random(32)
    rows = [(i, " ".join(f"the {r.choice('abcdefgh')}{r.choice('ij')}" for _ in range(20)), "x") for i in range(120)]
    rows += [(200, None, "x"), (201, " ", "x"), (None, "the ai", "x"), (None, None, "x"), (1, "the never", "x")]
    rows += [rows[0], rows[1], (None, None, "x")]
    for name in ("HEAD_SHARE", "PAIR_SHARE"):
        monkeypatch.setattr(suffix_tree, name, 0.5)
    rounds, found = [], []
    asked = suffix_tree.Tree.rounds
    monkeypatch.setattr(suffix_tree.Tree, "rounds", lambda *a: rounds.append(asked(*a)) or rounds[-1])
    for share in (100.0, 0.7):
        monkeypatch.setattr(suffix_tree, "ROUND_SHARE", share)
        got = suffix_tree.score_documents(frame(spark, rows)).collect()
        found.append(sorted((str(x["doc_id"]), x["n_tokens"], x["n_known"], round(x["base_score"], 6),
                             round(x["score"], 6)) for x in got))
    assert rounds[0] == 1 and rounds[1] > 2
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_caches_of_scores_are_filled_with_the_most_frequent(spark):
    """A cache has room for so many rows, whatever share of the corpus each of them has: nothing is
    looked up by a shuffle that would fit into it."""
    counts = spark.createDataFrame([(c,) for c in [1] * 50 + [8] * 30 + [9] * 15 + [700] * 3], "c long")
    for share, cached in ((0.0, 98), (1 / 98, 98), (1 / 97, 48), (1 / 48, 48), (1 / 47, 18), (1 / 17, 3), (0.5, 0)):
        assert counts.where(counts.c >= suffix_tree.least_count(counts, share)).count() == cached
    assert suffix_tree.least_count(counts.limit(0), 0.5) == 0
    rows = [(i, "the rare word is in a text of many other words", "x") for i in range(9)]
    rows += [(i, " ".join("ab"[i * j % 7 % 2] for j in range(900)), "x") for i in range(100, 300)]
    train = frame(spark, rows).select("text")
    tree = suffix_tree.fit(train, suffix_tree.word_counts(train).cache())
    few = tree.ids(["the", "rare", "word", "is"])
    assert tree.score(few)[1] > tree.score(few)[0] + 3 and not tree.bits.any() and tree.rounds(0) == 1


def test_bitmaps_grow_with_their_keys(spark, monkeypatch):
    monkeypatch.setattr(suffix_tree, "BITS", 1 << 16)
    monkeypatch.setattr(suffix_tree, "MOST_BITS", 1 << 18)
    keys = suffix_tree.mix(np.arange(1, 20_001, dtype=np.uint64))
    for n, bits in ((100, 1 << 16), (5_000, 1 << 17), (10_000, 1 << 18), (20_000, 1 << 18)):
        some = spark.createDataFrame([(int(k),) for k in keys[:n].view(np.int64)], "key long")
        got = suffix_tree.bitmap(some)
        assert 8 * len(got) == bits and suffix_tree._passes(got, keys[:n]).all()
        assert int(np.bitwise_count(got).sum()) == len(set((keys[:n] & np.uint64(bits - 1)).tolist()))


def test_shuffle_files_are_removed_when_rows_are_stored(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {f for f in files.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting, "false")
    table = suffix_tree.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "some")
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before and spark.conf.get(setting, "false") == was


def test_ngrams_of_a_context_lie_together_unless_it_is_frequent():
    suffix = suffix_tree.mix(np.arange(1, 5001, dtype=np.uint64))
    context = np.full(5000, 12345, np.uint64)
    near = suffix_tree.homes(context, suffix, suffix_tree.NONE)
    assert len(set(near)) == 1
    spread = np.array([7, 12345, 99999], np.uint64)
    assert len(set(suffix_tree.homes(context, suffix, spread))) == suffix_tree.SPREAD
    bucket, lists = suffix_tree.packed(np.array([0, 0, 3, 3, 3], np.int32), np.arange(5))
    assert bucket.to_pylist() == [0, 3] and lists.to_pylist() == [[0, 1], [2, 3, 4]]


def test_next_word_probabilities_sum_to_one(spark, monkeypatch):
    for name in ("HEAD_SHARE", "PAIR_SHARE", "CONTEXT_SHARE"):
        monkeypatch.setattr(suffix_tree, name, 0.0)
    rows = [(i, "a b c a b d a b c", "x") for i in range(30)]
    train = frame(spark, rows).select("text")
    tree = suffix_tree.fit(train, suffix_tree.word_counts(train).cache())
    unseen = 1 / (tree.total + tree.distinct + 1)
    for context in (["a"], ["b"], ["a", "b"], ["c", "a"]):
        mass = 0.0
        for w in tree.head:
            ids = tree.ids([*context, w])
            mass += 10 ** (tree.score(ids)[1] - tree.score(ids[:-1])[1])
        ids = tree.ids([*context, "never"])
        mass += unseen * 10 ** (tree.score(ids)[1] - tree.score(ids[:-1])[1])
        assert abs(mass - 1) < 1e-6


def test_line_dedup_twin(spark):
    got = queries.QUERIES["op5_line_dedup"](spark, TABLES).collect()
    names, want = sql_rows(database(TABLES), queries.ORACLES["op5_line_dedup"])
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(want)


def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline as pipeline
    from liftwise.llm.batches import stored

    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, TABLES), "test-stage")
        assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    assert pipeline.STAGES[-1][1](spark, docs, TABLES).count() == before
    assert pipeline.run(spark, TABLES).count() == before


def test_links_between_components_join_their_labels(spark):
    links = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labels = components(links([(1, 2), (2, 3), (10, 11)]))
    more = links([(3, 11), (3, 11), (2, 10), (20, 21), (21, 5), (1, 3)])
    got = {r["node"]: r["label"] for r in merged(labels, more).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 5: 5, 20: 5, 21: 5}
    assert merged(labels, links([(1, 3)])).count() == labels.count() == 5
    assert merged(labels.limit(0), links([(7, 6)])).orderBy("node").collect() == [(6, 6), (7, 6)]


def test_rows_outside_a_large_bucket_are_closed(spark):
    """More near copies than a block holds, some of them linked only through a few others."""
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join([*base, *(f"x{n}" for n in range(k % 6))]) for k in range(40)]
    texts += [" ".join([*base, *(f"x{n}" for n in range(m))]) for m in range(6, 16)]
    rows = [(k, t, "x") for k, t in enumerate([*texts, "apart " * 30])]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(frame(spark, rows)).collect()}
    want = brute_components(rows, 3, 90)
    assert got == want


def test_pipeline_join_takes_five_words_and_four_fifths(spark):
    """One word of 47 changed: 38 of 48 windows of five words in common, 42 of 48 of three."""
    import corpus_pipeline as pipeline

    words = [f"w{k}" for k in range(60)]
    near = [*words[:30], "changed", *words[31:]]  # 5 of 56 windows change: 51 of 61 in common
    far = [w if k not in (10, 30) else "other" for k, w in enumerate(words)]  # 46 of 66
    rows = [(1, " ".join(words), "x"), (2, " ".join(near), "x"), (3, " ".join(far), "x")]
    sets = [ngram_join.word_set(t, 5) for _, t, _ in rows]
    assert [round(len(sets[0] & s) / len(sets[0] | s), 3) for s in sets] == [1.0, 0.836, 0.697]
    kept = pipeline.jaccard_join(spark, frame(spark, rows), TABLES).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 3]
