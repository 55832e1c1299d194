"""Operators on single texts, against the libraries and brute force."""

import random
import time
import zlib
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from liftwise.llm import bpe, html_blocks, licences, quality, token_counts, wavelet

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdefgh eTHO'rsl \n\t0129.,!?éüñ中文 ́😀\x1cİΣ\xa0"


def random_texts(n, longest=40):
    r = random.Random(4)
    return ["".join(r.choices(LETTERS, k=r.randint(0, longest))) for _ in range(n)] + [
        "", " ", "x" * 5000, " " * 300 + "y", "a<|endoftext|>b <|endoftext|>", "'s 'll!", "word " * 9000,
    ]


@pytest.fixture(scope="module")
def codec():
    return bpe.load_codec(BYTES)


def test_automaton_encodes_and_decodes_as_the_library(codec):
    library = Tokenizer.from_file(BYTES)
    for text in random_texts(4000):
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_automaton_has_one_path_per_prefix():
    merges = [("a", "a"), ("aa", "a"), ("b", "aa"), ("a", "b")]
    vocab = {t: i for i, t in enumerate(["a", "b", "aa", "aaa", "baa", "ab"])}
    machine = bpe.MergeAutomaton(vocab, merges)
    r = random.Random(1)
    for _ in range(300):
        word = "".join(r.choices("ab", k=r.randint(1, 12)))
        parts = list(word)
        for u, v in merges:  # every merge in turn, left to right
            i = 0
            while i < len(parts) - 1:
                if parts[i] == u and parts[i + 1] == v:
                    parts[i : i + 2] = [u + v]
                i += 1
        assert list(machine.path(word)) == [vocab[p] for p in parts]


def test_encoding_columns_and_nulls(spark):
    rows = [(1, "Hello world", "x"), (2, None, None), (None, "", "y"), (1, "Hello world", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encoding_digests(docs, BYTES).collect()
    assert len(got) == 4
    empty = sha256(b"").hexdigest()
    for r in got:
        if not r["text"]:
            assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (0, empty, empty)
        else:
            assert r["n_tokens"] == 2 and r["decoded_sha256"] == sha256(b"Hello world").hexdigest()
    full = bpe.encode_documents(docs, BYTES).where("n_tokens > 0").first()
    assert full["ids"] == [15496, 995] and full["decoded"] == "Hello world"
    assert bpe.encoding_digests(docs.limit(0), BYTES).count() == 0


def test_edited_counts_equal_counts_of_the_edited_text(codec):
    count, r = token_counts._counter(codec), random.Random(2)
    for _ in range(400):
        tree = token_counts.CountTree("".join(r.choices("ab \n.,é'", k=r.randint(0, 120))), count)
        for _ in range(8):
            text, start, length = tree.text, r.randint(-3, len(tree.text) + 3), r.randint(0, 9)
            insert = "".join(r.choices("ab \n,'", k=r.choice([0, 1, 3, 90])))
            at = min(max(start, 0), len(text))
            tree.edit(start, length, insert)
            assert tree.text == text[:at] + insert + text[at + length :]
            assert tree.tokens == len(codec.ordinary(tree.text))


def test_stored_trees_encode_only_what_edits_touch(spark):
    text = "one two three four five six seven eight nine ten " * 200
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    edits = F.expr(
        "array(named_struct('start', 14, 'length', 4, 'insert', '4'), "
        "named_struct('start', int(null), 'length', 9, 'insert', 'skipped'))"
    )
    trees = token_counts.build_trees(docs, BYTES)
    got = {r["doc_id"]: r for r in token_counts.edit_trees(trees, edits, BYTES).collect()}
    changed = text[:14] + "4" + text[18:]
    assert got[1]["edited"] == changed and got[1]["n_encoded"] <= 4
    assert got[1]["n_tokens"] == len(bpe.load_codec(BYTES).ordinary(changed))
    assert got[2]["edited"] == got[3]["edited"] == "4"


def test_base_counts():
    text = "a b c d e\na b c d e\n\n \n# $x | y\nz"
    words = quality.words(text)
    assert quality.base_counts(text, words) == (15, 16, 3, 1, 10)
    assert quality.base_counts(None, []) == (0, 0, 0, 0, 0)
    assert quality.base_counts("## \n", quality.words("## \n")) == (1, 2, 2, 0, 0)
    r = random.Random(3)
    for _ in range(200):
        words = [r.choice([b"a", b"b", b"c"]) for _ in range(r.randint(0, 40))]
        windows = [tuple(words[i : i + 5]) for i in range(max(0, len(words) - 4))]
        inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
        assert quality.repeat_words(words) == len(inside)


def test_quality_learns_and_keeps_good_text(spark):
    r = random.Random(5)
    good = lambda: " ".join(r.choice(["river", "stone", "walks", "over", "the"]) + r.choice("abc") for _ in range(40))
    bad = lambda: " ".join(r.choice(["river", "stone"]) + r.choice("abcdefgh") + "###" for _ in range(40))
    rows = [(i, good() if i % 2 else bad(), "x") for i in range(200)] + [(900, None, "x"), (901, "short", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, quality int")
    judged = quality.judge(docs, quality.fit(docs, labels)).collect()
    held = [r for r in judged if 120 <= r["doc_id"] < 200 and not r["base_failed"]]
    assert np.mean([r["kept"] == (r["doc_id"] % 2 == 1) for r in held]) > 0.95
    assert all(r["base_failed"] and not r["kept"] for r in judged if r["doc_id"] >= 900)
    assert quality.fit(docs, labels.limit(0)) is None
    assert quality.judge(docs, None).where("kept").count() > 0


def test_wavelet_matrix_answers_from_its_planes():
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint32)
    body = wavelet.shard_bytes(ids, [7, None], [4000, 1000])
    matrix, names, lengths = wavelet.read_shard(body)
    assert names == [7, None] and list(lengths) == [4000, 1000]
    assert (matrix.tokens() == ids).all()
    assert all(matrix.access(i) == ids[i] for i in range(0, 5000, 97))
    for token in (0, 5, 299, 300, 70_000):
        assert matrix.places(token) == list(np.flatnonzero(ids == token))
        assert matrix.count(token, 1234) == (ids[:1234] == token).sum()


def test_shards_hold_the_library_encoding_in_id_order(spark):
    library = Tokenizer.from_file(WORDS)
    texts = random_texts(300) + [None]
    rows = [((i * 7919) % 1009, t) for i, t in enumerate(texts)] + [(3, "tie"), (3, "tie")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    path = wavelet.scratch(spark, "test-shards")
    wavelet.write_shards(docs, WORDS, path, tokens=500)
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"])
                 for r in wavelet.read_documents(spark, path).collect())
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0], r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((start, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert wavelet.round_trip(docs.limit(0), WORDS).count() == 0


def test_page_blocks():
    html = (
        "<html><head><title>T</title><style>p{}</style></head><body><!-- <p>no</p> -->"
        '<script>var a="</p><p>x";</script><nav class="top"><ul><li><a href="a>b">Go</a><li>To</ul>'
        "</nav><p>A &amp; <b>B</b>\n  c<br>d<p>E<select><option>no</select></div>"
    )
    blocks = html_blocks.page_blocks(html)
    assert [b.text for b in blocks] == ["Go", "To", "A & B c d", "E"]
    assert blocks[0].path == ("<html>", "<body>", "<nav>", "top", "<ul>", "<li>")
    assert html_blocks.page_blocks(None) == html_blocks.page_blocks("") == []


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<article><p>A</p><svg class="x"/><p>B</p><math/><p>C</p></article>', ["A", "B", "C"]),
        ("<article><svg><title/><path/>no</svg><p>B</p><svg href=x/>no</svg>C</article>", ["B", "C"]),
        ("<head><title>x</title><h1>A</h1><p>B", ["A", "B"]),
        ("<html><head><meta name=a><title>x <b>y</title><style>p{}</style><span>A</span><p>B", ["A", "B"]),
        ("<head><title>x</title> \n A<p>B", ["A", "B"]),
        ("<head><noscript><img src=x>no</noscript></head><body><p>B", ["B"]),
        ("<div><button>no<p>A</p><button>no</button><p>B", ["A", "B"]),
        ("<article><select><option>no<option>no<p>A</p>B</article>", ["A", "B"]),
        ("<button><div>no</div><p>no</p></button><select><option>no<hr>no</select><p>A", ["A"]),
    ],
)
def test_text_is_hidden_no_longer_than_its_container(html, want):
    assert [b.text for b in html_blocks.page_blocks(html)] == want


def test_labeller_on_layouts_it_has_not_seen(spark):
    pages = spark.createDataFrame([(1, "u", None), (2, None, "")], "page_id long, url string, html string")
    model = html_blocks.fit(pages, layouts=160)
    r, wrong, total = random.Random(99), 0, 0
    for _ in range(60):
        html, labels = html_blocks.layout(r)
        found = model.label([html_blocks.page_blocks(html)])[0]
        wrong, total = wrong + (found != np.array(labels)).sum(), total + len(labels)
    assert wrong / total < 0.05
    assert [(r["text"], r["n_chars"]) for r in html_blocks.main_text(pages, model).collect()] == [("", 0)] * 2


def test_licences_prune_but_lose_nothing():
    r = random.Random(6)
    scanner = licences.Scanner(licences.TEMPLATES, licences.DICE)
    for name, text in licences.TEMPLATES.items():
        words = text.split()
        for _ in range(20):
            unit = " ".join(w if r.random() > 0.04 else "zzz" for w in words)
            own = licences.bigrams(unit)
            dice = {n: 2 * len(own & b) / (len(own) + len(b))
                    for n, b in ((n, licences.bigrams(t)) for n, t in licences.TEMPLATES.items())}
            best = max(dice.values())
            assert scanner.best(unit) == (
                (best, min(n for n in dice if dice[n] == best)) if best >= licences.DICE else None
            )
        assert scanner.scan("Before.\n\n" + text + "\n\nAfter it.").get(name) == 1.0
    assert scanner.scan(None) == scanner.scan("") == scanner.scan("plain words only") == {}


def test_licences_in_paragraphs_and_longer_lines():
    r = random.Random(16)
    scanner = licences.Scanner(licences.TEMPLATES, licences.DICE)
    say = lambda n: " ".join("".join(r.choices("bcdfgklmnprst", k=6)) for _ in range(n))
    for name, text in licences.TEMPLATES.items():
        words = text.split()
        for parts in (2, 3, 5):
            cuts = [len(words) * k // parts for k in range(parts + 1)]
            blocks = [" ".join(words[a:b]) for a, b in zip(cuts, cuts[1:])]
            page = "\n\n".join([say(90), say(200), *blocks, say(300)])
            assert scanner.scan(page).get(name, 0) > 0.95  # copyright lines move
    mit = "Permission is hereby granted" + licences.TEMPLATES["MIT"][len("Permission is hereby granted") :]
    changed = mit.replace("free of charge, ", "").replace("THE SOFTWARE IS", "\n\nTHE SOFTWARE IS")
    assert 0.9 < scanner.scan(f"{say(50)}\n\n{changed}\n\n{say(50)}")["MIT"] < 1.0
    assert "MIT notice" in scanner.scan(f"{say(20)} This code is released under the MIT License {say(20)}")
    assert "MIT notice" in scanner.scan("Licensed under the MIT License.")
    assert list(scanner.scan("Licensed under CC BY-NC 4.0.")) == ["CC-BY-NC-4.0 notice"]
    assert scanner.scan(f"{say(9)} under the rule of the house the law is granted to any person {say(9)}") == {}


def test_licences_in_common_use_are_known():
    scanner = licences.Scanner(licences.TEMPLATES, licences.DICE)
    for said, name in (
        ("Licensed under CC BY-SA 4.0.", "CC-BY-SA-4.0 notice"),
        ("licensed under CC BY-NC-ND 3.0", "CC-BY-NC-ND-3.0 notice"),
        ("This code is licensed under the BSD 3-Clause license, see there.", "BSD-3-Clause notice"),
        ("Files are licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0 notice"),
        ("You may use it: licensed under the Mozilla Public License, version 2.0.", "MPL-2.0 notice"),
        ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0 notice"),
    ):
        assert list(scanner.scan(f"Some words before it. {said} And some after it.")) == [name]
    for name in ("BSD-2-Clause", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "LGPL-3.0", "MPL-2.0", "Unlicense"):
        text = licences.TEMPLATES[f"{name} text"]
        found = scanner.scan(f"A manual.\n\nCopyright (c) 2020 Somebody\n\n{text}\n\nIts end.")
        assert max(found, key=found.get) == f"{name} text"


def _best_windows(order, own, least):
    """By trying every stretch from the start of a run to the end of a run."""
    runs = [k for k, g in enumerate(order) if g in own and (k == 0 or order[k - 1] not in own)]
    ends = [k + 1 for k, g in enumerate(order) if g in own and order[k + 1 : k + 2] not in [[x] for x in own]]
    for a in runs:
        best = None
        for b in (b for b in ends if b > a):
            seen = set(order[a:b])
            if len(seen) <= len(own) * (2 - least) / least + 1e-9:
                dice = 2 * len(seen & own) / (len(seen) + len(own))
                if dice >= least and (best is None or dice > best[1]):
                    best = (len(seen & own), dice, a, b)
        if best:
            yield best


def test_licence_windows_equal_all_stretches():
    r = random.Random(26)
    for trial in range(300):
        words = [f"w{k}" for k in range(r.choice([4, 9, 30]))]
        template = " ".join(r.choices(words, k=r.randint(2, 25)))
        text = " ".join(
            r.choice([template, template[: r.randint(1, len(template))], " ".join(r.choices(words, k=5)), "zz yy"])
            for _ in range(r.randint(0, 8))
        )
        least = r.choice([0.4, 0.6, 0.8])
        scanner = licences.Scanner({"t": template}, least)
        order, own = licences.word_bigrams(text), licences.bigrams(template)
        number = {g: k for k, g in enumerate(dict.fromkeys(order))}
        ids = np.array([number[g] for g in order], dtype=int)
        inside = np.array([g in own for g in order], dtype=bool)
        got = scanner._windows(inside, licences._previous(ids), len(own)) if order else []
        assert got == list(_best_windows(order, own, least)), (trial, template, text)


def test_licences_in_very_long_texts():
    r = random.Random(27)
    words = licences.TEMPLATES["GPL-3.0 text"].split()
    scanner = licences.Scanner(licences.TEMPLATES, licences.DICE)
    pieces = []
    while len(pieces) < 20_000:
        at = r.randrange(len(words))
        pieces += [*words[at : at + 10], "zz"]
    began = time.monotonic()
    scanner.scan(" ".join(pieces * 5))  # 100,000 words of fragments
    notices = scanner.scan("Text. Licensed under the MIT License. " * 20_000)
    assert notices["MIT notice"] > 0.8 and time.monotonic() - began < 60


@pytest.mark.parametrize("entries", [3, 200, 100_000])
def test_words_equal_the_library_while_generations_change(entries):
    with open(WORDS, encoding="utf-8") as f:
        codec = wavelet.WordCodec(f.read(), entries)
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    more = ["Ünïcode, ÀÉÎ! º ª µ ß; naïve: ?", "a. .a ... . b,, Don't 'S x's", "ΑΒΓ İi dž é́ ﬁ", "ÿÞ×÷ 12a a12 ½",
            "stat*** Étés,%%% a.* A!!! ñ&&& *** #a $.$ x'!! x!!' don't%% b?!;:#$%&*., c*#!é é*é!"]
    texts = random_texts(600) + more * 3 + [chr(c) + " x" + chr(c) + "y" for c in range(1, 0x250)]
    for at in range(0, len(texts), 40):
        batch = [wavelet.words(t) for t in texts[at : at + 40]]
        codes = codec.codes(batch)
        for text, found in zip(texts[at : at + 40], batch, strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert wavelet.ids_of(found, codes).tolist() == want, text


def test_a_batch_asks_the_codec_once_for_each_piece():
    """Ids of a batch equal the library's, however words are split into pieces; a word of letters
    and marks costs no look-up of its own."""
    with open(WORDS, encoding="utf-8") as f:
        codec = wavelet.WordCodec(f.read(), 50)
    library = Tokenizer.from_file(WORDS)
    library.no_truncation()
    library.no_padding()
    texts = [None, "", " ", "  a b\t", "\x1ca\x1db\x85c\xa0d\u3000e", "a\x0bb\x0cc\rd\te\nf", "x\x00y ... .a a.",
             "<|endoftext|> DON'T don't, Ünïcode, ÀÉÎ! stat*** c*#! 12a", "x" * 1000 + "!!!"]
    texts += random_texts(200)
    for at in range(0, len(texts), 30):
        some = texts[at : at + 30]
        ids, sizes = wavelet.batch_ids(pa.array(some, pa.string()), codec)
        want = [[*library.encode(t or "", add_special_tokens=False).ids, wavelet.END] for t in some]
        assert np.split(ids, np.cumsum(sizes)[:-1])[0].tolist() == want[0]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert wavelet.batch_ids(pa.array([], pa.string()), codec)[0].tolist() == []
    asked = []
    merged, codec._merged = codec._merged, lambda piece: asked.append(piece) or merged(piece)
    wavelet.batch_ids(pa.array(["Zebu zebu, ZEBU. Zebu; zebu gnu,", "gnu. zebu"]), codec)
    assert len(asked) == len(set(asked)) <= 6  # zebu, gnu, three marks and none


def test_words_met_before_are_looked_up_whole_and_long_ones_go():
    with open(WORDS, encoding="utf-8") as f:
        codec = wavelet.WordCodec(f.read())
    long = [b"x" * 1000, "é".encode() * 1000, b"a-" * 1000]
    batch = [[b"Some", b"words,", b"don't", *long]]
    codec.codes([[b"stat,%%%"]])
    assert {b"stat", b",%%%"} <= set(codec.young)  # a run of marks is a piece
    first = {w: codec.codes(batch)[w] for w in batch[0]}
    assert all(first.values())
    asked = []
    codec._piece = asked.append
    codec.tokenizer = None
    again = codec.codes([[b"words,", b"don't", b"Some"]])
    assert not asked and all(again[w] == first[w] for w in batch[0][:3])
    assert max(map(len, codec.young)) <= wavelet.KEPT_LENGTH


def test_caches_keep_no_long_keys_and_are_released():
    from liftwise.llm import batches

    kept, other = batches.Cache(len, 3), batches.Cache(str)
    assert kept["x" * 10_000_000] == 10_000_000 and not kept
    assert [kept[k] for k in ("a", "bb", "ccc", "dddd")] == [1, 2, 3, 4] and len(kept) == 1
    assert other[7] == "7"
    batches.release(kept)
    assert len(kept) == 1 and not other
