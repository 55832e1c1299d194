"""Main text of web pages: a bidirectional LSTM labels every block of a page.

A page is read into its leaf blocks (the text between two block-level tags) with their tag
paths. Each block is a vector: hashed tags, classes and ids of its path, hashed words, and a
few measures (length, share of link text, punctuation, depth, place). A bidirectional LSTM in
numpy reads the page's blocks in both directions, so that each block's label depends on the
whole page. Blocks labelled as main text are joined in page order by an empty line.

Training, on the driver, has a fixed size: LAYOUTS generated pages, in which articles are
surrounded by menus, headers, footers, sidebars, notices, adverts, forms and comments under
many names, and up to SAMPLE pages of the table whose landmark tags (article or main, nav,
header, footer, aside, form) tell main text from the rest. Nothing else is collected; the
weights are broadcast.

Character references are decoded, white space inside a block becomes one space. Scripts,
styles, heads, form controls and comments of the markup are never text. A head ends at the
first tag or text that may not stand in it, a select or button without an end tag at the next
block. Null or empty html gives an empty text. Other columns are not read.
"""

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from liftwise.llm.batches import Cache, small_batches

LAYOUTS, SAMPLE, HIDDEN, EPOCHS, RATE = 320, 48, 24, 10, 0.01
PATH_DIM, WORD_DIM, MEASURES = 96, 48, 8
DIM = 2 * PATH_DIM + WORD_DIM + MEASURES
STEP_CELLS = 24_000  # blocks that are scored at once, padding included

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
    "ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset(
    "head title template noscript iframe object svg math canvas audio video map select option "
    "textarea button datalist input".split()
)
IN_HEAD = frozenset(
    "html head title base basefont bgsound link meta noscript noframes script style template".split()
)
FOREIGN = frozenset(("svg", "math"))
LOOSE = frozenset(("option", "optgroup", "select", "button"))  # a block ends them if unclosed
RAW = frozenset(("script", "style", "xmp"))
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
             "td": {"td", "th"}, "th": {"td", "th"}}
SCOPES = frozenset("ul ol dl table div section article main body td th".split())

MARKUP = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|</?[a-zA-Z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>", re.S
)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
PART = re.compile(r"[a-z]+")
# Not a tag that closes itself: the slash belongs to an attribute's value.
VALUE_SLASH = re.compile(r"=\s*[^\s\"'>]+/>$")


class Block:
    __slots__ = ("text", "path", "links")

    def __init__(self, text: str, path: tuple[str, ...], links: int):
        self.text, self.path, self.links = text, path, links


def page_blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page, with decoded text and the names along their path."""
    blocks: list[Block] = []
    stack: list[tuple[str, tuple[str, ...], bool]] = []  # tag, names, whether it is loose
    parts: list[str] = []
    state = {"links": 0, "in_link": 0, "hidden": 0}

    def flush() -> None:
        text = " ".join(unescape("".join(parts)).split())
        if text:
            path = tuple(name for _, names, _ in stack for name in names)
            blocks.append(Block(text, path, min(state["links"], len(text))))
        parts.clear()
        state["links"] = 0

    def add(text: str) -> None:
        if stack and stack[-1][0] == "head" and not text.isspace() and text:
            pop(len(stack) - 1)
        if text and not state["hidden"]:
            parts.append(text)
            if state["in_link"]:
                state["links"] += len(text)

    def pop(to: int) -> None:
        for tag, _, _ in stack[to:]:
            if tag in NEVER:
                state["hidden"] -= 1
        del stack[to:]

    def leave_head() -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in ("title", "template", "noscript"):
                break
            if stack[i][0] == "head":
                pop(i)
                break

    def unclosed(tag: str) -> bool:
        if tag not in ends:
            ends[tag] = re.compile(f"<(/?){tag}(?=[\\s/>])", re.I)
        found = ends[tag].search(html, at)
        return not found or not found[1]

    html = html or ""
    at = 0
    ends: dict[str, re.Pattern] = {}
    while at < len(html):
        m = MARKUP.search(html, at)
        if not m:
            add(html[at:])
            break
        add(html[at : m.start()])
        at, tag_text = m.end(), m[0]
        if tag_text[1] in "!?":
            continue
        closing = tag_text[1] == "/"
        tag = re.match(r"</?([^\s/>]+)", tag_text)[1].lower()
        if not closing and tag not in IN_HEAD:
            leave_head()
        if tag == "br":
            add(" ")
        elif tag == "a":
            state["in_link"] = 0 if closing else 1
        elif tag in RAW:
            if not closing:
                end = re.compile(f"</{tag}", re.I).search(html, at)
                at = end.start() if end else len(html)
        elif tag in BLOCKS or tag in NEVER:
            if tag in BLOCKS:
                flush()
            if closing:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        pop(i)
                        break
                continue
            if tag in BLOCKS and stack and stack[-1][0] == "p":
                pop(len(stack) - 1)
            if tag in BLOCKS:
                while stack and stack[-1][2]:
                    pop(len(stack) - 1)
            if tag in CLOSED_BY:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in CLOSED_BY[tag]:
                        pop(i)
                        break
                    if stack[i][0] in SCOPES and stack[i][0] not in ("td", "th"):
                        break
            if tag in VOID:
                continue
            if tag_text.endswith("/>") and not VALUE_SLASH.search(tag_text):
                if tag in FOREIGN or any(open_ in FOREIGN for open_, _, _ in stack):
                    continue
            names = [f"<{tag}>"]
            for found in NAMES.finditer(tag_text):
                names += PART.findall((found[1] or found[2] or found[3] or "").lower())
            loose = tag in LOOSE and (tag in ("option", "optgroup") or unclosed(tag))
            stack.append((tag, tuple(names), loose))
            if tag in NEVER:
                state["hidden"] += 1
    flush()
    return blocks


def _spot(name: str, size: int) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) % size


_path_spot = Cache(lambda n: _spot(n, PATH_DIM), 50_000)
_word_spot = Cache(lambda n: _spot(n, WORD_DIM), 200_000)


def vectors(blocks: list[Block]) -> np.ndarray:
    """A row per block: path names, the last names, words, measures."""
    out = np.zeros((len(blocks), DIM), np.float32)
    for i, b in enumerate(blocks):
        row = out[i]
        for name in b.path:
            row[_path_spot[name]] = 1
        for name in b.path[-3:]:
            row[PATH_DIM + _path_spot[name]] = 1
        words = b.text.lower().split()
        places = np.fromiter(map(_word_spot.__getitem__, words), np.int64, len(words))
        counts = np.bincount(places, minlength=WORD_DIM)
        row[2 * PATH_DIM : 2 * PATH_DIM + WORD_DIM] = counts / max(1, len(words))
        size = len(b.text)
        row[-MEASURES:] = (
            min(np.log1p(size) / 8, 1.5), b.links / size,
            sum(map(b.text.count, ".,;:!?")) / len(words), len(b.path) / 20,
            i / len(blocks), (len(blocks) - i) / len(blocks), min(len(words), 10) / 10, 1,
        )
    return out


class Labeller:
    """Both directions' LSTM weights (input, recurrent, bias; gates i, f, o, g) and output."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {}
        for d in "fb":
            self.p["x" + d] = (r.standard_normal((DIM, 4 * h)) * 0.1).astype(np.float32)
            self.p["h" + d] = (r.standard_normal((h, 4 * h)) * 0.15).astype(np.float32)
            self.p["c" + d] = np.concatenate([np.zeros(h), np.ones(h), np.zeros(2 * h)]).astype(
                np.float32
            )
        self.p["w"] = (r.standard_normal((2 * h + DIM,)) * 0.1).astype(np.float32)
        self.p["o"] = np.zeros(1, np.float32)

    def _pass(self, d: str, x: np.ndarray, mask: np.ndarray, keep: list | None = None):
        """States of one direction for x (page, step, DIM); padding carries states through."""
        n, steps, _ = x.shape
        k = HIDDEN
        gates = x @ self.p["x" + d] + self.p["c" + d]
        h, c = np.zeros((n, k), np.float32), np.zeros((n, k), np.float32)
        out = np.zeros((n, steps, k), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = gates[:, t] + h @ self.p["h" + d]
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * k], -30, 30)))
            g = np.tanh(z[:, 3 * k :])
            m = mask[:, t : t + 1]
            fresh = s[:, k : 2 * k] * c + s[:, :k] * g
            shown = np.tanh(fresh)
            if keep is not None:
                keep.append((t, h, c, s, g, shown, m))
            c = m * fresh + (1 - m) * c
            h = m * s[:, 2 * k :] * shown + (1 - m) * h
            out[:, t] = h
        return out

    def scores(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self._pass("f", x, mask), self._pass("b", x, mask), x], 2)
        return both @ self.p["w"] + self.p["o"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict:
        """Back-propagation through time of the mean logistic loss over blocks."""
        k, kept = HIDDEN, {"f": [], "b": []}
        states = [self._pass(d, x, mask, kept[d]) for d in "fb"]
        both = np.concatenate([*states, x], 2)
        p = 1 / (1 + np.exp(-np.clip(both @ self.p["w"] + self.p["o"], -30, 30)))
        gap = ((p - y) * mask / mask.sum()).astype(np.float32)
        grads = {"w": np.einsum("nt,ntk->k", gap, both), "o": gap.sum(keepdims=True)[0]}
        for j, d in enumerate("fb"):
            top = gap[:, :, None] * self.p["w"][j * k : (j + 1) * k]
            dz_all = np.zeros((*x.shape[:2], 4 * k), np.float32)
            dh, dc = np.zeros((len(x), k), np.float32), np.zeros((len(x), k), np.float32)
            gh = np.zeros_like(self.p["h" + d])
            for t, h, c, s, g, shown, m in reversed(kept[d]):
                dh = dh + top[:, t]
                live, rest_h, rest_c = dh * m, dh * (1 - m), dc * (1 - m)
                do = live * shown
                df = dc * m + live * s[:, 2 * k :] * (1 - shown * shown)
                dz = np.concatenate(
                    [df * g, df * c, do], 1
                ) * s * (1 - s)
                dz = np.concatenate([dz, df * s[:, :k] * (1 - g * g)], 1)
                dz_all[:, t] = dz
                gh += h.T @ dz
                dh, dc = dz @ self.p["h" + d].T + rest_h, df * s[:, k : 2 * k] + rest_c
            grads["h" + d] = gh
            grads["x" + d] = np.einsum("ntd,ntk->dk", x, dz_all, optimize=True)
            grads["c" + d] = dz_all.sum((0, 1))
        return grads

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """For each page, which of its blocks are main text. Pages of like length are scored
        together; a page is never cut."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while order:
            longest = len(pages[order[-1]])
            take, order = order[-max(1, STEP_CELLS // longest) :], order[: -max(1, STEP_CELLS // longest)]
            x, mask = _padded([vectors(pages[i]) for i in take])
            for i, s in zip(take, self.scores(x, mask), strict=True):
                out[i] = s[: len(pages[i])] > 0
        return out


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, rows))
    x, mask = np.zeros((len(rows), steps, DIM), np.float32), np.zeros((len(rows), steps), np.float32)
    for i, r in enumerate(rows):
        x[i, : len(r)], mask[i, : len(r)] = r, 1
    return x, mask


# What generated layouts are made of: (tag, names) of containers, and words for their texts.
MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post body"),
        ("div", "article-body"), ("div", "entry-content"), ("section", "story"),
        ("div", "main-content"), ("div", "text")]
AROUND = {
    "menu": [("nav", ""), ("div", "menu"), ("ul", "navigation"), ("div", "navbar top-nav"),
             ("nav", "breadcrumb"), ("div", "breadcrumbs"), ("div", "toc")],
    "header": [("header", ""), ("div", "header"), ("div", "site-header masthead"),
               ("div", "banner"), ("div", "topbar")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright")],
    "sidebar": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("div", "related"),
                ("section", "recommended"), ("div", "popular"), ("div", "tags")],
    "notice": [("div", "cookie-notice"), ("div", "notice"), ("div", "consent"),
               ("div", "alert"), ("div", "popup modal"), ("div", "gdpr"), ("div", "message")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"),
               ("ins", "adsbygoogle"), ("div", "sponsored"), ("div", "promo")],
    "form": [("form", ""), ("form", "search"), ("div", "newsletter subscribe"),
             ("div", "login"), ("form", "signup")],
    "share": [("div", "share"), ("div", "social"), ("ul", "share-buttons")],
    "comments": [("section", "comments"), ("div", "comments"), ("ol", "commentlist"),
                 ("div", "reader-comments"), ("div", "comment-list"), ("div", "responses")],
}
SAID = {
    "menu": "home about contact news products archive help", "header": "welcome site logo",
    "footer": "copyright all rights reserved privacy terms imprint contact ©",
    "sidebar": "related more popular latest posts recommended read also tags",
    "notice": "we use cookies accept this site consent privacy policy",
    "advert": "buy now sponsored offer sale discount advertisement click",
    "form": "email subscribe search name password send log in", "share": "share tweet like pin",
    "comments": "reply says comment great thanks posted ago",
}


def _words(r: random.Random, n: int) -> str:
    made = ["".join(r.choice("bcdfglmnprstv") + r.choice("aeiouéü") for _ in range(r.randint(1, 4)))
            for _ in range(n)]
    return " ".join(made).capitalize() + r.choice([".", ".", "", "!", "?"])


def layout(r: random.Random) -> tuple[str, list[bool]]:
    """A generated page and the labels of its blocks."""
    html, labels = [], []

    def put(tag: str, text: str, main: bool) -> str:
        labels.append(main)
        return f"<{tag}>{text}" + ("" if tag == "p" and r.random() < 0.2 else f"</{tag}>")

    def around(kind: str) -> str:
        tag, names = r.choice(AROUND[kind])
        attribute = f' {r.choice(["class", "id"])}="{names}"' if names else ""
        said = SAID[kind].split()
        body = []
        for _ in range(r.randint(1, 8 if kind in ("menu", "comments", "sidebar") else 3)):
            text = " ".join(r.sample(said, r.randint(0, min(4, len(said)))))
            if kind in ("comments", "notice", "advert", "sidebar", "footer") or not text:
                text = f"{text} {_words(r, r.randint(1, 40 if kind == 'comments' else 14))}"
            if kind in ("menu", "share") or r.random() < 0.2:
                text = f'<a href="/{r.randint(1, 99)}">{text}</a>'
            inner = r.choice(["li"] if tag in ("ul", "ol") else ["p", "div", "li", "h3"])
            body.append(put(inner, text, False))
        if len(body) > 1 and r.random() < 0.3:
            return f"<{tag}{attribute}><ul>{''.join(body)}</ul></{tag}>"
        return f"<{tag}{attribute}>{''.join(body)}</{tag}>"

    for kind in r.sample(["header", "menu", "notice", "advert", "form", "sidebar"], r.randint(0, 5)):
        html.append(around(kind))
    tag, names = r.choice(MAIN) if r.random() < 0.7 else ("article", "")
    wrap = r.random() < 0.3
    html.append('<div class="page wrapper">' if wrap else "")
    html.append(f'<{tag} class="{names}">' if names else f"<{tag}>")
    if r.random() < 0.85:
        html.append(put("h1", _words(r, r.randint(1, 10)), True))
    for _ in range(r.choice([0, 1, 2, 3, 5, 9, 20])):
        kind = r.choice(["p"] * 9 + ["h2", "h3", "li", "blockquote", "pre"])
        n = r.randint(1, 8) if kind in HEADINGS else r.choice([1, 2, 6, 20, 60, 150])
        shout = r.random() < 0.1
        text = _words(r, n)
        html.append(put(kind, text.upper() if shout else text, True))
        if r.random() < 0.06:
            html.append(around(r.choice(["advert", "share", "sidebar", "form", "notice"])))
    html.append(f"</{tag}>")
    html.append("</div>" if wrap else "")
    after = ["comments", "sidebar", "footer", "share", "advert", "form", "menu", "notice"]
    for kind in r.sample(after, r.randint(0, 4)):
        html.append(around(kind))
    return "<html><body>" + "".join(html) + "</body></html>", labels


def landmark_labels(blocks: list[Block]) -> np.ndarray | None:
    """Labels that landmark tags give to a page's blocks; None without such tags."""
    body, other = {"<article>", "<main>"}, {"<nav>", "<header>", "<footer>", "<aside>", "<form>"}
    if not any(body & set(b.path) for b in blocks):
        return None
    return np.array([bool(body & set(b.path)) and not other & set(b.path) for b in blocks])


_fitted: dict[int, Labeller] = {}


def fit(pages: DataFrame, sample: int = SAMPLE, layouts: int = LAYOUTS) -> Labeller:
    """A labeller from generated layouts and `sample` pages, those with the smallest hash."""
    rows = (
        pages.select(F.xxhash64(F.lit("page"), F.col("html").cast("string")).alias("h"),
                     F.col("html").cast("string").alias("html"))
        .where("html IS NOT NULL")
        .orderBy("h").limit(sample).collect()
    )
    r, found = random.Random(11), []
    for _ in range(layouts):
        html, labels = layout(r)
        blocks = page_blocks(html)
        if len(blocks) == len(labels):
            found.append((blocks, np.array(labels)))
    for row in rows:
        blocks = page_blocks(row["html"])
        labels = landmark_labels(blocks)
        if labels is not None:
            found.append((blocks, labels))
    key = hash(tuple(b.text for blocks, _ in found for b in blocks))
    if key not in _fitted:
        _fitted.clear()
        _fitted[key] = _trained(found)
    return _fitted[key]


def _trained(found: list[tuple[list[Block], np.ndarray]]) -> Labeller:
    model, r = Labeller(), random.Random(3)
    rows = [(vectors(b), y) for b, y in found if b]
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(w) for k, w in model.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        r.shuffle(rows)
        parts = [sorted(rows, key=lambda t: len(t[0]))[i : i + 24] for i in range(0, len(rows), 24)]
        r.shuffle(parts)
        for part in parts:
            x, mask = _padded([p[0] for p in part])
            y = np.zeros_like(mask)
            for i, p in enumerate(part):
                y[i, : len(p[1])] = p[1]
            step += 1
            rate = RATE * (1 - epoch / EPOCHS)
            for k, g in model.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                move = (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
                model.p[k] = (model.p[k] - rate * move).astype(np.float32)
    return model


def main_text(pages: DataFrame, model: Labeller) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("text string, n_chars long, n_blocks long, n_main long")
    def extract(htmls: pd.Series) -> pd.DataFrame:
        read = [page_blocks(h) for h in htmls]
        rows = []
        for blocks, main in zip(read, shared.value.label(read), strict=True):
            text = "\n\n".join(b.text for b, keep in zip(blocks, main, strict=True) if keep)
            rows.append((text, len(text), len(blocks), int(main.sum())))
        return pd.DataFrame(rows, columns=["text", "n_chars", "n_blocks", "n_main"])

    return pages.select(
        "page_id", "url", extract(F.col("html").cast("string")).alias("e")
    ).select("page_id", "url", "e.text", "e.n_chars", "e.n_blocks", "e.n_main")
