"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

Method. A page is read into its block elements. Each gets features of its subtree (text, density of
links and tags, paragraphs, marks), its tag and attribute tokens, those of its ancestors, its depth and its siblings.
Gradient-boosted trees give the log-odds that it belongs to the main text. Decoding then chooses labels for all nodes of a page at
once: the sum of log-odds of kept nodes is greatest among choices in which nothing below a dropped node is kept.

The trees are trained here, on pages made by rule (``html_pages``), in seconds; no page of the input is used.

Defined results: a null, empty or textless page has an empty text; a page without a body element is read as if it had one; broken markup is
closed where the next block begins; a quote without an end does not keep its tag open; a tag cut off by the end of the page is dropped;
text of any length is read in time in proportion; main text in a page-wide form or a wrapper with a name of clutter is kept, and so is
the headline in an article's own header; repeated rows give a row each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from selvatrace.llm import html_pages
from selvatrace.llm.common import pick

TRAINING_PAGES = 700
TREES = 60
DEPTH = 5
RATE = 0.2
BINS = 32

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT = frozenset("script style template noscript svg iframe head title select textarea object canvas".split())
RAW = frozenset("script style textarea title iframe noscript".split())
TAGS = (
    "body article main section div p ul ol li nav header footer aside form table tr td th h1 h2 h3 h4 h5 h6 blockquote pre figure "
    "figcaption dl dt dd address fieldset label button details summary center caption"
).split()
BLOCK = frozenset(TAGS)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What a head holds; all else ends it. Blocks that may lie in elements without text of their own.
IN_HEAD = frozenset("html head base link meta title style script noscript template".split())
INSIDE = {"select": frozenset(("div", "button")), **dict.fromkeys(("template", "object", "canvas"), BLOCK)}
#: Elements that end an open one of the same kind, and those that such a search does not leave.
SIBLINGS = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}
GOOD = frozenset("article content post body entry main story text".split())
BAD = frozenset(
    "nav menu navbar breadcrumb toolbar header masthead topbar logo footer copyright sidebar widget related recommended popular "
    "cookie notice banner alert consent disclaimer popup modal ad ads advert advertisement sponsored promo search newsletter login "
    "subscribe signup form comments comment reply respond responses discussion disqus share social tags meta author byline".split()
)

#: Every alternative matches whatever follows its beginning and gives nothing back, so that reading stays linear. A quote counts
#: only after an equals sign; one without an end does not keep its tag open.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?:[!?]|/(?![a-zA-Z]))[^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(>|\Z)""",
    re.DOTALL,
)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_MARK = re.compile(r'data-y="([01])"')
_SPLIT = re.compile(r"[^a-z]+")


class Page:
    """Block elements in page order (a parent before its children), and text blocks with the element each lies in."""

    def __init__(self, source: str, marks: bool = False):
        self.tag = ["body"]
        self.parent = [-1]
        self.names: list[frozenset[str]] = [frozenset()]
        self.links = [0]  # characters inside links
        self.inline = [0]  # inline elements
        self.blocks: list[tuple[int, str]] = []
        self.mark = [1]
        self._read(source, marks)

    def _read(self, source: str, marks: bool) -> None:
        stack: list[tuple[str, int]] = [("body", 0)]
        opened: dict[str, list[int]] = {"body": [0]}  # where in the stack elements of each name are
        blocks_at = [0]  # where in the stack block elements are
        buffer: list[str] = []
        silent = anchors = at = 0
        here = 0

        def flush() -> None:
            if buffer:
                text = " ".join(html.unescape("".join(buffer)).split())
                buffer.clear()
                if text:
                    self.blocks.append((here, text))

        def close_to(depth: int) -> None:
            """Leaves all elements from ``depth`` of the stack on."""
            nonlocal silent, anchors, here
            for name, _ in reversed(stack[depth:]):
                opened[name].pop()
                if name in BLOCK:
                    blocks_at.pop()
                silent -= name in SILENT
                anchors -= name == "a"
            del stack[depth:]
            here = stack[-1][1]

        ends: dict[str, int] = {}

        def unclosed(name: str) -> bool:
            """Whether no end tag of that name follows."""
            if name not in ends:
                ends[name] = max((m.start() for m in re.finditer(rf"</{name}[\s>]", source, re.IGNORECASE)), default=-1)
            return ends[name] < at

        end = len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            stop = m.start() if m else end
            if silent and stack[-1][0] == "head" and source[at:stop].strip():
                close_to(len(stack) - 1)
            if stop > at and not silent:
                piece = source[at:stop]
                buffer.append(piece)
                if anchors:
                    self.links[here] += len(piece)
            if not m:
                break
            at = m.end()
            name = m[2]
            if not name:
                continue
            if not m[4]:
                break
            name = name.lower()
            if m[1]:
                places = opened.get(name, ())
                if len(places) > (name == "body"):
                    if blocks_at[-1] >= places[-1]:
                        flush()
                    close_to(places[-1])
                continue
            if stack[-1][0] == "head" and name not in IN_HEAD:
                close_to(len(stack) - 1)
            if name in VOID:
                if name in ("br", "hr"):
                    buffer.append(" ")
                continue
            if name in ("html", "body"):
                continue
            if name in BLOCK:
                flush()
                if silent:
                    for depth, (outer, _) in enumerate(stack):
                        if outer == "svg" and opened.get("foreignobject") and not unclosed(outer):
                            break
                        if outer in SILENT and outer not in RAW and (name not in INSIDE.get(outer, ()) or unclosed(outer)):
                            close_to(depth)
                            break
                # An open paragraph or heading with nothing but inline elements above it ends here.
                depth = blocks_at[-1]
                if stack[depth][0] == "p" or (name in HEADINGS and stack[depth][0] in HEADINGS):
                    close_to(depth)
                if name in SIBLINGS:
                    twins = ("dt", "dd") if name in ("dt", "dd") else ("td", "th") if name in ("td", "th") else (name,)
                    last = lambda names: max((opened[t][-1] for t in names if opened.get(t)), default=-1)
                    depth = last(twins)
                    if depth > max(last(SIBLINGS[name]), 0):
                        close_to(depth)
                found = _NAMES.findall(m[3]) if m[3] else ()
                tokens = frozenset(t for f in found for t in _SPLIT.split(f.lower()) if t)
                self.tag.append(name)
                self.parent.append(here)
                self.names.append(tokens)
                self.links.append(0)
                self.inline.append(0)
                if marks:
                    y = _MARK.search(m[3])
                    self.mark.append(int(y[1]) if y else self.mark[here])
                here = len(self.tag) - 1
            else:
                self.inline[here] += 1
            if m[3].endswith("/") and name in ("svg", "iframe", "object", "canvas"):
                continue
            if name in BLOCK:
                blocks_at.append(len(stack))
            opened.setdefault(name, []).append(len(stack))
            stack.append((name, here))
            silent += name in SILENT
            anchors += name == "a"
            if name in RAW:
                close = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(source, at)
                at = close.start() if close else end
        flush()


FEATURES = 26 + len(TAGS)


def features(page: Page) -> np.ndarray:
    """One row per node."""
    n = len(page.tag)
    parent, tag = page.parent, page.tag
    own, marks, links = [0] * n, [0] * n, page.links[:]
    inline, nodes, paragraphs, texts = page.inline[:], [1] * n, [0] * n, [0] * n
    first = [0] * n
    total = 0
    for i, text in page.blocks:
        own[i] += len(text)
        texts[i] += 1
        marks[i] += text.count(",") + text.count(".")
    chars = own[:]
    children: list[list[int]] = [[] for _ in range(n)]
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        marks[p] += marks[i]
        links[p] += links[i]
        inline[p] += inline[i]
        nodes[p] += nodes[i]
        texts[p] += texts[i]
        paragraphs[p] += paragraphs[i] + (tag[i] == "p")
        children[p].append(i)
    depth, good, bad = [0] * n, [0] * n, [0] * n
    side = [0.0] * n
    place, alike, before, after = [0.0] * n, [0.0] * n, [0] * n, [0] * n
    for i in range(n):
        row = children[i]
        row.reverse()
        count = len(row)
        kinds: dict[str, int] = {}
        for c in row:
            kinds[tag[c]] = kinds.get(tag[c], 0) + 1
        for j, c in enumerate(row):
            depth[c] = depth[i] + 1
            good[c] = good[i] + (1 if page.names[i] & GOOD or tag[i] in ("article", "main") else 0)
            bad[c] = bad[i] + (1 if page.names[i] & BAD or tag[i] in ("nav", "footer", "aside", "form", "header") else 0)
            place[c] = j / count
            alike[c] = kinds[tag[c]] / count
            before[c] = chars[row[j - 1]] if j else 0
            after[c] = chars[row[j + 1]] if j + 1 < count else 0
            side[c] = chars[c] / (chars[i] or 1)
    position = 0
    order = iter(page.blocks)
    upcoming = next(order, None)
    for i in range(n):  # text before each node, in page order
        while upcoming is not None and upcoming[0] < i:
            position += len(upcoming[1])
            upcoming = next(order, None)
        first[i] = position
    total = chars[0] or 1
    out = np.zeros((n, FEATURES), dtype=np.float32)
    names = page.names
    heads = np.array([h for h in (_heads(names[i]) for i in range(n))], dtype=np.float32).reshape(n, 2)
    a = lambda x: np.array(x, dtype=np.float32)
    c, own_a, link, nod, mk = a(chars), a(own), a(links), a(nodes), a(marks)
    up = a(parent).astype(np.int64)
    up[0] = 0
    columns = [
        np.log1p(c), np.log1p(own_a), link / (c + 1), np.log1p(nod), c / nod, mk / (c + 1) * 100, np.log1p(a(paragraphs)), np.log1p(a(texts)),
        a(inline) / (c + 1) * 100, a(depth), heads[:, 0], heads[:, 1], a(good), a(bad), a(place), a(alike), np.log1p(a(before)), np.log1p(a(after)),
        a(side), c / total, a(first) / total, np.log1p(c[up]), (link / (c + 1))[up], heads[up, 1], a([len(x) for x in children]), np.full(n, np.log1p(total), np.float32),
    ]
    out[:, :26] = np.stack(columns, axis=1)
    out[np.arange(n), 26 + a([_TAG_INDEX[t] for t in tag]).astype(np.int64)] = 1
    return out


def _heads(tokens: frozenset[str]) -> tuple[int, int]:
    return (len(tokens & GOOD), len(tokens & BAD)) if tokens else (0, 0)


_TAG_INDEX = {t: i for i, t in enumerate(TAGS)}


class Trees:
    """Boosted trees of equal depth: for each, split features and limits in heap order, and leaf values."""

    def __init__(self, feature: np.ndarray, limit: np.ndarray, value: np.ndarray, base: float):
        self.feature, self.limit, self.value, self.base = feature, limit, value, base

    def __call__(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, limit, value in zip(self.feature, self.limit, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > limit[at])
            total += value[at - len(f)]
        return total


def boosted(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss over binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    inner = 2**DEPTH - 1
    told: list[tuple[np.ndarray, ...]] = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, limit = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf, dtype=np.float32)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(DEPTH):
            start, width = 2**level - 1, 2**level
            slot = at - start
            best = np.full(width, 1e-6)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                key = slot * BINS + binned[:, j]
                sg = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                sh = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                all_g, all_h = sg[:, -1:], sh[:, -1:]
                gain = sg**2 / (sh + 1) + (all_g - sg) ** 2 / (all_h - sh + 1) - all_g**2 / (all_h + 1)
                gain[(sh < 2) | (all_h - sh < 2)] = -1
                cut = gain[:, : len(c)].argmax(axis=1)
                won = gain[np.arange(width), cut]
                for s in np.flatnonzero(won > best):
                    best[s], feature[start + s], limit[start + s] = won[s], j, c[cut[s]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > limit[at])
        leaf = at - inner
        value = -RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        margin += value[leaf]
        told.append((feature, limit, value))
    return Trees(*[np.stack(t) for t in zip(*told, strict=True)], base)


@lru_cache(maxsize=2)
def trained(pages: int = TRAINING_PAGES) -> Trees:
    xs, ys = [], []
    for seed in range(pages):
        page = Page(html_pages.Writer(seed).page(), marks=True)
        xs.append(features(page)[1:])
        ys.append(np.array(page.mark[1:], dtype=float))
    return boosted(np.concatenate(xs), np.concatenate(ys))


def decoded(parent: list[int], odds: list[float]) -> list[bool]:
    """Which nodes stay: the body does, no node does below one that goes, and the stayers' log-odds sum up to most."""
    n = len(parent)
    best = odds[:]
    for i in range(n - 1, 0, -1):
        if best[i] > 0:
            best[parent[i]] += best[i]
    kept = [True] * n
    for i in range(1, n):
        kept[i] = kept[parent[i]] and best[i] > 0
    return kept


def main_text(pages: list[Page], trees: Trees) -> list[str]:
    if not pages:
        return []
    odds = trees(np.concatenate([features(p) for p in pages])).tolist()
    out, at = [], 0
    for p in pages:
        kept = decoded(p.parent, odds[at : at + len(p.tag)])
        at += len(p.tag)
        out.append("\n".join(text for i, text in p.blocks if kept[i]))
    return out


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html", trees: Trees | None = None) -> DataFrame:
    """(key, url, text): one row per row of ``pages``; blocks of the main text are joined by line ends."""
    model = trees or trained()
    parts = (model.feature, model.limit, model.value, model.base)
    rows = pick(pages, key, url, source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Trees(*parts)
        for b in batches:
            sources = b.column(2).to_pylist()
            texts: list[str] = []
            for i in range(0, len(sources), 64):
                texts += main_text([Page(s or "") for s in sources[i : i + 64]], judge)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=[key, url, "text"])

    kinds = {c: rows.schema[c].dataType.simpleString() for c in (key, url)}
    return rows.mapInArrow(run, f"`{key}` {kinds[key]}, `{url}` {kinds[url]}, text string")
