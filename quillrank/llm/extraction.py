"""Main text of raw web pages: boosted trees over the nodes of a page, decoded down its tree.

A page is read into block elements (inline markup belongs to the block around it). Every element gets features of its
subtree (text, link share, density, punctuation), of its attribute tokens and those above it, of depth and siblings.
Boosted trees tell how likely its own text is main text. The decoder then finds the most likely set of kept elements in
which a kept element has only kept ancestors, so that no menu inside a dropped sidebar comes back and no paragraph is
kept without its article.

There are no labels for pages: the trees learn on at most SAMPLE pages, those with the smallest hashes of their keys, in
one task. What tags or tokens of a page call main text is laid out LAYOUTS times anew: with and without links in the
article, in more or fewer wrappers, among menus, notices, forms, comments and teasers with and without links, and in part
without any telling tag or token. So no single feature separates the labels, and every tree sees a random half of the
features only, so that density, tokens, depth and siblings all count.

Blocks: character references are decoded, white space inside a block becomes one space, blocks are joined in page order
by one line break. Script, style and other raw elements, comments and the page's head are no text.

Defined cases: null and empty pages give empty text; unclosed and unmatched tags are tolerated; a ``<`` that starts no
tag is text; without pages that call anything main text, all blocks are kept; repeated rows are judged alike, and one row
of a key at most is learnt from.
"""

from __future__ import annotations

import html as references
import random
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillrank.session import stage

SAMPLE = 400
LAYOUTS, LAYOUT_TEXTS = 4, 40
TREES, DEPTH, RATE, BINS, MIN_LEAF = 80, 5, 0.3, 32, 5
ROWS = 20_000
TOGETHER = 1.0

# Fixed values of the HTML standard.
RAW = set("script style noscript template textarea title svg math iframe object select option button canvas audio video head".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
BARRIER = set("ul ol dl table body html div section article".split())
# Tags and attribute tokens that say what an element is.
OUTER_TAGS = set("nav footer aside form menu dialog fieldset".split())
INNER_TAGS = set("article main".split())
OUTER_TOKENS = set("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer gdpr header login menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toolbar widget".split())
INNER_TOKENS = set("article articlebody body content entry main maincontent post postbody story text".split())
GROUPS = ("p", "h1 h2 h3 h4 h5 h6", "li ul ol dl dt dd", "div section", "table tr td th tbody thead", "pre blockquote figure figcaption")
_GROUP = {tag: k for k, group in enumerate(GROUPS) for tag in group.split()}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_PARTS = re.compile(r"[A-Za-z]+")
MARKS = ".,;:!?"


def raw_end(page: str, tag: str, at: int) -> int:
    """Where the content of a raw element ends; an element that is never closed takes the rest of the page."""
    found = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
    return found.end() if found else len(page)


class Page:
    """Block elements in page order (a parent before its children) and text blocks with the element they belong to."""

    def __init__(self, page: str):
        self.tag, self.parent, self.inner, self.outer, self.near = ["html"], [-1], [0], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._stack: list[tuple[str, int]] = [("html", 0)]
        self._text: list[str] = []
        self._links, self._in_link = 0, 0
        at = 0
        scan = _TOKEN.finditer(page)
        for m in scan:
            if m.start() < at:
                continue
            self._add(page[at : m.start()])
            at = m.end()
            close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if name is None:
                continue
            name = name.lower()
            if close:
                self._close(name)
            elif name == "body" or name == "html":
                continue
            elif name in RAW:
                if not attributes.rstrip().endswith("/") and name != "head":
                    at = raw_end(page, name, at)
            else:
                self._open(name, attributes)
        self._add(page[at:])
        self._flush()

    def _add(self, text: str) -> None:
        if text:
            self._text.append(text)
            if self._in_link:
                self._links += len(text.strip())

    def _flush(self) -> None:
        if self._text:
            text = "".join(self._text)
            text = " ".join((references.unescape(text) if "&" in text else text).split())
            if text:
                self.blocks.append((self._stack[-1][1], text, min(self._links, len(text))))
            self._text = []
        self._links = 0

    def _open(self, name: str, attributes: str) -> None:
        if name in INLINE:
            if name == "br":
                self._text.append(" ")
            elif name == "a":
                self._in_link = 1
            return
        self._flush()
        if name in VOID:
            return
        if name in CLOSES_P:
            self._end({"p"}, BARRIER)
        if name in SAME_ENDS:
            self._end(SAME_ENDS[name], {"ul", "ol", "dl", "table"})
        above = self._stack[-1][1]
        words = {w.lower() for value in _NAMED.findall(attributes) for w in _PARTS.findall(value)} if attributes.strip() else ()
        inner = name in INNER_TAGS or any(w in INNER_TOKENS for w in words)
        outer = name in OUTER_TAGS or (name == "header" and not self.inner[above]) or any(w in OUTER_TOKENS for w in words)
        self.tag.append(name)
        self.parent.append(above)
        # Evidence is inherited; what is inside an outer element stays outer.
        self.inner.append(int(inner or self.inner[above]))
        self.outer.append(int(outer or self.outer[above]))
        # What the nearest clear evidence says; inside an outer element, only an article speaks up again.
        near = self.near[above]
        if outer != inner:
            near = -1 if outer else 1 if near >= 0 or name in INNER_TAGS else near
        self.near.append(near)
        self._stack.append((name, len(self.tag) - 1))

    def _end(self, names: set[str], barrier: set[str]) -> None:
        """Close the nearest open element of these names unless one of the barrier is open inside it."""
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k][0] in names:
                del self._stack[k:]
                return
            if self._stack[k][0] in barrier:
                return

    def _close(self, name: str) -> None:
        if name in INLINE:
            if name == "a":
                self._in_link = 0
            return
        if any(tag == name for tag, _ in self._stack[1:]):
            self._flush()
            while self._stack[-1][0] != name:
                self._stack.pop()
            self._stack.pop()

    def features(self) -> np.ndarray:
        """One row per element; see the names in the code."""
        n = len(self.tag)
        chars, links, marks, words, blocks = (np.zeros(n) for _ in range(5))
        for node, text, linked in self.blocks:
            chars[node] += len(text)
            links[node] += linked
            marks[node] += sum(map(text.count, MARKS))
            words[node] += text.count(" ") + 1
            blocks[node] += 1
        own = chars.copy(), links.copy()
        parent = np.array(self.parent)
        nodes, depth, index, siblings = np.ones(n), np.zeros(n), np.zeros(n), np.zeros(n)
        for k in range(1, n):
            depth[k] = depth[parent[k]] + 1
            index[k] = siblings[parent[k]]
            siblings[parent[k]] += 1
        for total in (chars, links, marks, words, blocks, nodes):
            for k in range(n - 1, 0, -1):
                total[parent[k]] += total[k]
        up = np.maximum(parent, 0)
        group = np.array([_GROUP.get(t, -1) for t in self.tag])
        brothers = np.maximum(siblings[up], 1)
        columns = [
            np.array(self.inner), np.array(self.outer), np.array(self.near), np.array(self.near)[up],
            np.log1p(chars), np.log1p(own[0]), links / np.maximum(chars, 1), own[1] / np.maximum(own[0], 1),
            chars / nodes, chars / np.maximum(blocks, 1), marks / np.maximum(chars, 1) * 100, words / np.maximum(blocks, 1),
            chars / max(chars[0], 1), links[up] / np.maximum(chars[up], 1), np.log1p(chars[up] / np.maximum(nodes[up], 1)),
            np.minimum(depth, 50), index / brothers, np.log1p(brothers), np.log1p((chars[up] - chars) / brothers),
            *[(group == k) for k in range(len(GROUPS))],
        ]
        return np.stack(columns, axis=1).astype(np.float32)

    def decode(self, odds: np.ndarray) -> np.ndarray:
        """Kept elements: the best labels in which all ancestors of a kept element are kept.

        An element counts with the logarithm of its own text; one that differs from its parent costs TOGETHER. The value
        of dropping an element is that of dropping all below it.
        """
        n = len(self.tag)
        weight = np.zeros(n)
        for node, text, _ in self.blocks:
            weight[node] += np.log1p(len(text))
        keep, drop = odds * weight, -odds * weight
        best = np.zeros(n, dtype=bool)
        for k in range(n - 1, 0, -1):
            p = self.parent[k]
            best[k] = keep[k] > drop[k] - TOGETHER
            keep[p] += max(keep[k], drop[k] - TOGETHER)
            drop[p] += drop[k]
        kept = np.ones(n, dtype=bool)
        for k in range(1, n):
            kept[k] = best[k] and kept[self.parent[k]]
        return kept


class Trees:
    """Boosted regression trees for the logistic loss, on binned features; complete trees of DEPTH levels."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.base, self.trees = 0.0, []
        if len(y) == 0 or y.min() == y.max():
            self.base = 4.0
            return
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        mean = float(np.clip(y.mean(), 0.01, 0.99))
        self.base = float(np.log(mean / (1 - mean)))
        margin, rng = np.full(len(y), self.base), np.random.default_rng(0)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            usable = rng.choice(x.shape[1], size=(x.shape[1] + 1) // 2, replace=False)
            tree, leaf = _grow(binned, edges, sorted(usable.tolist()), p - y, p * (1 - p))
            self.trees.append(tree)
            margin += tree[2][leaf]

    @cached_property
    def _stacked(self) -> list[np.ndarray]:
        return [np.stack([t[k] for t in self.trees]) for k in range(3)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.base)
        feature, limit, value = self._stacked
        inner, tree = feature.shape[1], np.arange(len(self.trees))[None, :]
        out = np.empty(len(x))
        for at in range(0, len(x), ROWS):  # all trees at once, for a bounded number of elements
            part = x[at : at + ROWS]
            rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(self.trees)), dtype=np.int64)
            while node[0, 0] < inner:
                node = 2 * node + 1 + (part[rows, feature[tree, node]] > limit[tree, node])
            out[at : at + ROWS] = value[tree, node - inner].sum(axis=1)
        return self.base + out


def _grow(binned: np.ndarray, edges: list[np.ndarray], usable: list[int], g: np.ndarray, h: np.ndarray):
    """A tree (feature and limit of its splits, value of its leaves) on the usable features, and the leaf of every row."""
    inner = (1 << DEPTH) - 1
    feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
    node = np.zeros(len(g), dtype=np.int64)
    for level in range(DEPTH):
        first, width = (1 << level) - 1, 1 << level
        local = node - first
        best = np.full(width, 1e-6)
        cut = np.full(width, -1, dtype=np.int64)
        for f in usable:
            if not len(edges[f]):
                continue
            size = len(edges[f]) + 1
            key = local * size + binned[:, f]
            sums = [np.bincount(key, weights=w, minlength=width * size).reshape(width, size) for w in (g, h, None)]
            left = [np.cumsum(part, axis=1)[:, :-1] for part in sums]
            whole = [part.sum(axis=1, keepdims=True) for part in sums]
            right = [w - part for w, part in zip(whole, left)]
            gain = left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - whole[0] ** 2 / (whole[1] + 1)
            gain[(left[2] < MIN_LEAF) | (right[2] < MIN_LEAF)] = 0
            top = gain.argmax(axis=1)
            value = gain[np.arange(width), top]
            better = value > best
            best[better], feature[first : first + width][better] = value[better], f
            cut[better] = top[better]
            limit[first : first + width][better] = edges[f][top[better]]
        own = cut[local]
        node = 2 * node + 1 + ((own >= 0) & (binned[np.arange(len(g)), feature[node]] > own))
    leaf = node - inner
    total = [np.bincount(leaf, weights=w, minlength=inner + 1) for w in (g, h)]
    return (feature, limit, -RATE * total[0] / (total[1] + 1)), leaf


class _Layout:
    """A page laid out at random around given main texts, and the label of every element with text of its own."""

    def __init__(self, texts: list[str], rnd: random.Random):
        self.page, self.label, self.rnd = Page(""), {}, rnd
        self.words = " ".join(texts).split()
        self.telling = rnd.random() < 0.6
        self.linked = rnd.choice([0.0, 0.0, 0.1, 0.4])
        wrappers = [("div", self._attribute(INNER_TOKENS if rnd.random() < 0.3 else ()))] * rnd.randint(0, 3)
        if rnd.random() < 0.15:  # a wrapper may name what stands beside the article
            wrappers.insert(0, ("div", self._attribute(INNER_TOKENS, OUTER_TOKENS)))
        for tag, attribute in wrappers:
            self.page._open(tag, attribute if self.telling else "")
        self._others()
        self._article(texts)
        self._others()
        for tag, _ in wrappers:
            self.page._close(tag)
        self.page._flush()

    def _attribute(self, *kinds) -> str:
        return f'class="{"-".join(self.rnd.choice(sorted(k)) if k else "w" for k in kinds)}"'

    def _some(self, least: int, most: int) -> str:
        size = self.rnd.randint(least, most)
        at = self.rnd.randrange(max(len(self.words) - size, 1))
        return " ".join(self.words[at : at + size])

    def _put(self, tag: str, text: str, label: int, links: float = 0.0, attribute: str = "") -> None:
        """One element with the text; ``links`` is the probability that a run of its words, or all of it (1), is a link."""
        self.page._open(tag, attribute)
        self.label[self.page._stack[-1][1]] = label
        words = text.split()
        a, b = (0, len(words)) if links >= 1 else (0, 0)
        if 0 < links < 1 and self.rnd.random() < links:
            a = self.rnd.randrange(len(words))
            b = a + self.rnd.randint(1, 4)
        for part, link in ((words[:a], 0), (words[a:b], 1), (words[b:], 0)):
            self.page._in_link = link
            self.page._add(" ".join(part) + " " if part else "")
        self.page._in_link = 0
        self.page._close(tag)

    def _article(self, texts: list[str]) -> None:
        rnd, page = self.rnd, self.page
        tag = rnd.choice(["article", "article", "main", "div", "section"]) if self.telling else rnd.choice(["div", "section"])
        told = tag in INNER_TAGS
        kinds = [INNER_TOKENS] if not told or rnd.random() < 0.4 else []
        if rnd.random() < 0.1:
            kinds = [INNER_TOKENS, OUTER_TOKENS]
        page._open(tag, self._attribute(*kinds) if self.telling and kinds else "")
        if rnd.random() < 0.7:
            self._put(rnd.choice(["h1", "h2"]), self._some(2, 12), 1)
        group = rnd.choice(["", "", "div", "section"])
        if group:
            page._open(group, "")
        for text in texts:
            if rnd.random() < 0.4:
                text = " ".join(text.split()[: rnd.randint(2, 30)])
            kind = rnd.choice(["p"] * 8 + ["div", "blockquote", "pre", "h2", "h3", "ul", "table"])
            if kind == "ul":
                page._open("ul", "")
                for _ in range(rnd.randint(2, 5)):
                    self._put("li", self._some(3, 25), 1, self.linked)
                page._close("ul")
            elif kind == "table":
                page._open("table", "")
                page._open("tr", "")
                for _ in range(rnd.randint(2, 5)):
                    self._put("td", self._some(1, 6), 1, self.linked)
                page._close("table")
            else:
                self._put(kind, text, 1, self.linked)
            if self.telling and rnd.random() < 0.05:
                self._other(rnd.choice(["comments", "notice", "related"]))
        if group:
            page._close(group)
        page._close(tag)

    def _others(self) -> None:
        for _ in range(self.rnd.randint(0, 3)):
            kinds = ["menu", "menu", "footer", "notice", "form"]
            self._other(self.rnd.choice(kinds + ["comments", "comments", "related"] if self.telling else kinds))

    def _other(self, kind: str) -> None:
        """A region that is no main text. Comments and teasers read like articles, so they always say what they are."""
        rnd, page = self.rnd, self.page
        token = self._attribute(OUTER_TOKENS)
        links = rnd.choice([0, 0.5, 1, 1])
        if kind == "menu":
            tag = rnd.choice(["nav", "menu", "div"]) if self.telling else "div"
            page._open(tag, token if self.telling and tag == "div" else "")
            page._open("ul", "")
            for _ in range(rnd.randint(3, 12)):
                self._put("li", self._some(1, 3), 0, links)
            page._close("ul")
            page._close(tag)
        elif kind in ("footer", "notice"):
            tag = rnd.choice([kind if kind == "footer" else "aside", "div"]) if self.telling else "div"
            attribute = token if self.telling and tag == "div" else ""
            if rnd.random() < 0.5:
                self._put(tag, self._some(2, 30), 0, min(links, 0.5), attribute)
            else:
                page._open(tag, attribute)
                for _ in range(rnd.randint(1, 3)):
                    self._put("p", self._some(2, 15), 0, links)
                page._close(tag)
        elif kind == "form":
            tag = "form" if self.telling else "div"
            page._open(tag, "")
            for _ in range(rnd.randint(1, 4)):
                self._put(rnd.choice(["p", "div"]), self._some(1, 4), 0)
            page._close(tag)
        else:
            tag = rnd.choice(["section", "div", "aside"])
            page._open(tag, token if tag != "aside" else "")
            for _ in range(rnd.randint(1, 6)):
                inside = rnd.choice(["", "div", "article"])
                if inside:
                    page._open(inside, self._attribute(OUTER_TOKENS, INNER_TOKENS) if rnd.random() < 0.5 else "")
                if rnd.random() < 0.5:
                    self._put("h3", self._some(1, 6), 0, links)
                self._put("p", self._some(3, 60), 0, 0.1)
                if inside:
                    page._close(inside)
            page._close(tag)


def _examples(pages: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all elements with text of their own in the layouts of the pages' main texts."""
    rnd, xs, ys = random.Random(0), [], []
    for text in pages:
        page = Page(text)
        texts = [t for node, t, _ in page.blocks if page.near[node] > 0]
        for _ in range(LAYOUTS if texts else 0):
            size = rnd.randint(1, LAYOUT_TEXTS)
            at = rnd.randrange(max(len(texts) - size, 0) + 1)
            layout = _Layout(texts[at : at + size], rnd)
            nodes = sorted(layout.label)
            xs.append(layout.page.features()[nodes])
            ys.append(np.array([layout.label[k] for k in nodes], dtype=float))
    width = Page("").features().shape[1]
    return np.concatenate(xs or [np.zeros((0, width), np.float32)]), np.concatenate(ys or [np.zeros(0)])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per tree (feature, limit, value), and the base as a tree without splits."""
    trees = Trees(*_examples([t for b in batches for t in b.column(0).to_pylist()]))
    rows = [([], [], [trees.base]), *[(f.tolist(), l.tolist(), v.tolist()) for f, l, v in trees.trees]]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
    columns = [pa.array(range(len(rows)), pa.int64()), *[pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]]
    yield pa.RecordBatch.from_arrays(columns, ["k", "feature", "limit", "value"])


def fitted(pages: DataFrame, sample: int = SAMPLE) -> Trees:
    """The trees, from at most ``sample`` pages (page_id, html)."""
    keys = pages.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    one = pages.join(F.broadcast(keys), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))
    rows = one.repartition(1).sortWithinPartitions("page_id").select("html")
    table = stage(rows.mapInArrow(_fit, "k long, feature array<long>, limit array<double>, value array<double>"), "trees")
    trees = Trees(np.zeros((0, 1)), np.zeros(0))
    for r in table.orderBy("k").collect():  # TREES rows and the base
        if not r["feature"]:
            trees.base = r["value"][0]
        else:
            trees.trees.append((np.array(r["feature"]), np.array(r["limit"]), np.array(r["value"])))
    return trees


def main_text(page: str, trees: Trees) -> str:
    parsed = Page(page)
    kept = parsed.decode(trees.margins(parsed.features()))
    return "\n".join(text for node, text, _ in parsed.blocks if kept[node])


def extract(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", sample: int = SAMPLE) -> DataFrame:
    """page_id, url, text and n_chars of every page. Runs jobs while it builds its result."""
    pages = df.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    shared = df.sparkSession.sparkContext.broadcast(fitted(pages, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, shared.value) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    out = pages.mapInArrow(run, "page_id long, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))
