"""Main text of web pages: boosted trees over DOM nodes, decoded over the tree.

Every element gets features of its subtree (text, links, elements, paragraphs,
punctuation and their densities), its attribute tokens, its depth and siblings,
and what its ancestors' tokens say.  Gradient-boosted trees give each element
the probabilities of three roles: *mixed* (holds content and other things),
*content*, *boilerplate*.  Decoding takes the most probable roles of the whole
tree under the rule that a mixed element may hold anything, a content element
content or boilerplate, and a boilerplate element boilerplate alone, so no
element contradicts the ones around it.  The text of content elements is cut
into blocks at block-level borders, white space within a block becomes one
space, and the blocks are joined by a newline.

The trees are fitted on a bounded sample of the table's pages
(``fit_pages`` of at most ``FIT_BYTES``): on the pages themselves, labelled by their semantic elements
and attribute words, and on ``layouts`` further pages that lay the sample's
paragraphs out with menus, sidebars, notices, adverts, forms and comments under
varied or meaningless names, so that structure is learned beside names.

A null page is empty and has an empty text; rows that repeat an id are pages of
their own.  Nothing is dropped or cut for length.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .boost import BoostedTrees
from .dom import RAW, attributes, parse

FIT_BYTES = 64 << 10
CHUNK_CHARS = 1 << 20
MIXED, CONTENT, BOILERPLATE = 0, 1, 2

# Words of class, id, role and label attributes by what they tell.
GROUPS = {
    "content": "article content main post entry story body text prose maincontent articlebody postbody storybody",
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc skip tabs",
    "head": "header masthead topbar banner logo branding hero",
    "foot": "footer colophon copyright legal bottom imprint",
    "side": "sidebar aside side widget widgets rail complementary related recommended recommendations trending popular more",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion adsense adslot adbox banners outbrain taboola",
    "notice": "cookie cookies consent gdpr notice notification alert modal popup overlay toast warning disclaimer paywall",
    "comment": "comment comments commentlist reply replies respond disqus discussion thread responses reviews feedback",
    "form": "form newsletter subscribe subscription signup signin login register search searchbox contact input field",
    "social": "share sharing social follow twitter facebook tags tag byline author meta credits",
}
_GROUP_OF = {w: i for i, ws in enumerate(GROUPS.values()) for w in ws.split()}
_TAG_GROUP = {"nav": 1, "menu": 1, "header": 2, "footer": 3, "aside": 4, "dialog": 6, "form": 8, "fieldset": 8, "button": 8, "select": 8,
              "article": 0, "main": 0, "search": 8}
_TAG_KINDS = [{"article", "main"}, {"p", "pre", "blockquote"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"ul", "ol", "dl", "menu"},
              {"li", "dt", "dd"}, {"a"}, {"div", "section"}, {"table", "tbody", "tr", "td", "th", "thead"}, set(RAW) | {"head", "link", "meta"},
              {"html", "body", "#root"}, {"nav"}, {"header"}, {"footer"}, {"aside", "dialog"},
              {"form", "fieldset", "button", "select", "option", "label", "input"}, {"figure", "figcaption", "img", "picture"}]
_KIND_OF = {t: i for i, ts in enumerate(_TAG_KINDS) for t in ts}
_NG, _NK = len(GROUPS), len(_TAG_KINDS)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def _groups(tag: str, raw: str, cache: dict) -> tuple[int, ...]:
    key = (tag, raw)
    if key not in cache:
        if len(cache) > 50_000:
            cache.clear()
        hit = {_TAG_GROUP[tag]} if tag in _TAG_GROUP else set()
        if raw:
            a = attributes(raw)
            words = " ".join(a.get(k, "") for k in ("class", "id", "role", "aria-label", "itemprop"))
            hit |= {_GROUP_OF[w] for w in _WORD.findall(_CAMEL.sub(" ", words).lower()) if w in _GROUP_OF}
        cache[key] = tuple(sorted(hit))
    return cache[key]


class Forest:
    """The trees of some pages in arrays: nodes of all pages in page order."""

    def __init__(self, pages: list[str], cache: dict) -> None:
        self.pieces, self.start = [], [0]
        parent, depth, kind, own, link, mark, hits = [], [], [], [], [], [], []
        self.raw: list[str] = []
        for page in pages:
            nodes, pieces = parse(page)
            base = self.start[-1]
            self.pieces.append(pieces)
            self.start.append(base + len(nodes))
            text, marks = [0] * len(nodes), [0] * len(nodes)
            for i, s in pieces:
                if s:
                    text[i] += len(s) if not s.isspace() else 0
                    marks[i] += s.count(".") + s.count(",")
            anchor = [False] * len(nodes)
            for i, node in enumerate(nodes):
                anchor[i] = node.tag == "a" or (node.parent >= 0 and anchor[node.parent])
                parent.append(base + node.parent if node.parent >= 0 else -1)
                depth.append(node.depth)
                kind.append(_KIND_OF.get(node.tag, _NK))
                hits.append(_groups(node.tag, node.attrs, cache))
                self.raw.append(node.attrs)
            own += text
            mark += marks
            link += [t if a else 0 for t, a in zip(text, anchor)]
        self.parent = np.array(parent, dtype=np.int64)
        self.depth = np.array(depth, dtype=np.int64)
        self.kind = np.array(kind, dtype=np.int64)
        self.group = np.zeros((len(parent), _NG), dtype=np.float64)
        rows = [i for i, h in enumerate(hits) for _ in h]
        self.group[rows, [g for h in hits for g in h]] = 1
        self.page = np.repeat(np.arange(len(pages)), np.diff(self.start))
        self.own = np.array([own, link, mark], dtype=np.float64).T.reshape(-1, 3)
        by = np.argsort(self.depth, kind="stable")
        cut = np.searchsorted(self.depth[by], np.arange(1, (self.depth.max(initial=0)) + 2))
        self.levels = [by[a:b] for a, b in zip(cut[:-1], cut[1:])]  # nodes below the roots, by depth

    def up(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees."""
        out = values.copy()
        for level in reversed(self.levels):
            np.add.at(out, self.parent[level], out[level])
        return out

    def features(self) -> np.ndarray:
        n = len(self.parent)
        one = np.ones((n, 1))
        para = (self.kind == 1).astype(float)[:, None]
        total = self.up(np.hstack([self.own, one, para, (self.kind == 5)[:, None].astype(float), self.group[:, :1]]))
        text, link, marks, elements, paras, anchors, inside = total.T
        has = self.parent >= 0
        up = np.where(has, self.parent, np.arange(n))
        roots = np.array(self.start[:-1], dtype=np.int64)
        # siblings: how many, and which one this is
        children = np.bincount(self.parent[has], minlength=n)
        order = np.argsort(self.parent, kind="stable")
        first = np.searchsorted(self.parent[order], self.parent[order])
        index = np.empty(n)
        index[order] = np.arange(n) - first
        above = np.zeros((n, _NG))
        for level in self.levels:
            above[level] = np.minimum(1, above[self.parent[level]] + self.group[self.parent[level]])
        whole = np.maximum(text[roots][self.page], 1)
        kinds = np.zeros((n, _NK))
        known = self.kind < _NK
        kinds[known, self.kind[known]] = 1
        parent_text = np.maximum(text[up], 1)
        siblings = np.maximum(children[up], 1)
        return np.column_stack([
            np.log1p(text), link / np.maximum(text, 1), text / elements, marks / np.maximum(text, 1) * 100, np.log1p(elements),
            np.log1p(paras), paras / elements, np.log1p(anchors), np.log1p(self.own[:, 0]), self.depth, siblings, index,
            index / siblings, text / parent_text, text / whole, text / (parent_text / siblings), np.log1p(children),
            text[up] / elements[up], link[up] / parent_text, np.minimum(inside, 3), self.group, above, self.group[up], kinds,
            kinds[up][:, [0, 1, 4, 6, 9]]])

    def decode(self, logp: np.ndarray) -> np.ndarray:
        """Most probable roles of whole trees: mixed over anything, content over
        content and boilerplate, boilerplate over itself."""
        best = logp.copy()
        for level in reversed(self.levels):
            b = best[level]
            low = b[:, BOILERPLATE]
            mid = np.maximum(low, b[:, CONTENT])
            np.add.at(best, self.parent[level], np.column_stack([np.maximum(mid, b[:, MIXED]), mid, low]))
        role = best.argmax(axis=1)
        for level in self.levels:
            b = best[level].copy()
            above = role[self.parent[level]]
            b[above >= CONTENT, MIXED] = -np.inf
            b[above == BOILERPLATE, CONTENT] = -np.inf
            role[level] = b.argmax(axis=1)
        return role

    def texts(self, role: np.ndarray) -> list[str]:
        keep = (role == CONTENT).tolist()
        out = []
        for base, pieces in zip(self.start, self.pieces):
            blocks, block = [], []
            for i, s in pieces:
                if s is None:
                    if block:
                        blocks.append(" ".join("".join(block).split()))
                        block = []
                elif keep[base + i]:
                    block.append(s)
            if block:
                blocks.append(" ".join("".join(block).split()))
            out.append("\n".join(b for b in blocks if b))
        return out


def weak_labels(forest: Forest) -> np.ndarray:
    """Roles by semantic elements and attribute words: content is what lies in
    an article or main element, less what a boilerplate word or element holds."""
    n = len(forest.parent)
    article = forest.kind == 0
    bad = (forest.group[:, 1:].any(axis=1) & ~article) | (forest.kind == 8)
    role = np.full(n, MIXED)
    holds = forest.up(article.astype(float)[:, None])[:, 0] > 0
    role[~holds] = BOILERPLATE
    role[article] = CONTENT
    for level in forest.levels:
        above = role[forest.parent[level]]
        own = role[level]
        own = np.where(above == BOILERPLATE, BOILERPLATE, np.where(above == CONTENT, CONTENT, own))
        role[level] = np.where(bad[level], BOILERPLATE, own)
    return role


def marked_labels(forest: Forest) -> np.ndarray:
    """Roles of made layouts: from the mark of the element or the nearest one above."""
    n = len(forest.parent)
    marks = np.array([int(r[r.index("data-r=") + 7]) if "data-r=" in r else -1 for r in forest.raw])
    role = np.full(n, MIXED)
    holds = forest.up((marks == CONTENT).astype(float)[:, None])[:, 0] > 0
    for level in forest.levels:
        above = role[forest.parent[level]]
        own = np.where(above == MIXED, np.where(holds[level], MIXED, BOILERPLATE), above)
        role[level] = np.where(marks[level] >= 0, marks[level], own)
    return role


def make_layout(rnd: random.Random, prose: list[str]) -> str:
    """A page of the given paragraphs' text with boilerplate around and within."""
    word = lambda: re.sub(r"\W", "", rnd.choice(rnd.choice(prose).split() or ["x"])) or "x"
    short = lambda a, b: " ".join(word() for _ in range(rnd.randint(a, b)))
    odd = lambda: "".join(rnd.choice("abcdefghijk0123456789") for _ in range(rnd.randint(2, 6)))
    links = lambda n: "".join(f"<li><a href='/{word()}'>{short(1, 4)}</a></li>" for _ in range(n))
    para = lambda: f"<p>{rnd.choice(prose)}</p>"

    def name(group: str) -> str:
        if rnd.random() < 0.25:
            return f" class='{odd()}'"
        w = rnd.choice(GROUPS[group].split())
        return f" {rnd.choice(['class', 'id', 'class'])}='{rnd.choice([w, w, odd() + '-' + w, w + '-' + odd()])}'"

    def bad(group: str, tags: list[str], body: str) -> str:
        tag = rnd.choice(tags)
        return f"<{tag}{name(group)} data-r=2>{body}</{tag}>"

    kinds = [
        lambda: bad("nav", ["nav", "nav", "div", "ul"], f"<ul>{links(rnd.randint(2, 12))}</ul>"),
        lambda: bad("head", ["header", "header", "div"], f"<h1>{short(1, 4)}</h1><p>{short(2, 9)}</p>" + (f"<nav><ul>{links(4)}</ul></nav>" if rnd.random() < .5 else "")),
        lambda: bad("foot", ["footer", "footer", "div"], rnd.choice([f"&copy; {short(2, 12)}.", f"<p>{short(3, 20)}.</p><ul>{links(3)}</ul>"])),
        lambda: bad("side", ["aside", "aside", "div", "section"], f"<h3>{short(1, 3)}</h3>" + rnd.choice([f"<ul>{links(5)}</ul>", f"<p>{short(5, 40)}.</p>", para()])),
        lambda: bad("ad", ["div", "div", "aside", "ins", "section"], rnd.choice([f"{short(3, 25)}.", f"<a href='#'>{short(2, 9)}</a>", f"<p>{short(5, 30)}.</p>", f"{short(3, 9)}.\n{short(9, 20)}."])),
        lambda: bad("notice", ["div", "div", "section", "dialog", "p"], f"{short(5, 30)}. <button>{short(1, 2)}</button>"),
        lambda: bad("comment", ["section", "div", "div", "ol"], "".join(f"<div class='{rnd.choice(['comment', 'reply', odd()])}'><b>{word()}</b><p>{rnd.choice([short(3, 30), rnd.choice(prose)])}</p></div>" for _ in range(rnd.randint(1, 5)))),
        lambda: bad("form", ["form", "form", "div"], f"<label>{short(1, 3)}</label><input name=q><button>{short(1, 2)}</button><p>{short(2, 12)}</p>"),
        lambda: bad("social", ["div", "ul"], f"<ul>{links(rnd.randint(2, 5))}</ul>"),
    ]
    pick = lambda k: "".join(rnd.choice(kinds)() for _ in range(rnd.randint(0, k)))
    blocks = []
    for _ in range(rnd.choice([1, 1, 2, 3, 5, 8, 15])):
        r = rnd.random()
        blocks.append(para() if r < .7 else f"<h2>{short(1, 8)}</h2>" if r < .8 else f"<ul><li>{short(4, 20)}.</li><li>{short(4, 20)}.</li></ul>" if r < .87
                      else f"<blockquote>{rnd.choice(prose)}</blockquote>" if r < .92 else f"<p><b>{rnd.choice(prose)}<br>" if r < .96
                      else f"<table><tr><td>{short(1, 5)}</td><td>{short(1, 5)}</td></tr></table>")
        if rnd.random() < 0.12:
            blocks.append(rnd.choice(kinds[4:])())
    title = short(2, 9)
    inner = (f"<h1>{title}</h1>" if rnd.random() < .7 else "") + "".join(blocks)
    tag = rnd.choice(["article", "article", "main", "div", "div", "section"])
    main = f"<{tag}{name('content') if tag in ('div', 'section') or rnd.random() < .3 else ''} data-r=1>{inner}</{tag}>"
    if rnd.random() < 0.4:
        main = f"<div class='{rnd.choice(['wrap', 'container', 'row', odd()])}'>{pick(2)}{main}{pick(2)}</div>"
    if rnd.random() < 0.2:
        main = f"<main>{main}{pick(1)}</main>"
    return (f"<html><head><title>{title}</title><script>{odd()}</script></head><body>{pick(4)}{main}{pick(4)}</body>"
            + ("</html>" if rnd.random() < .8 else ""))


class Extractor:
    """Fitted trees; fitting sees at most the given pages."""

    def __init__(self, pages: list[str], layouts: int, rounds: int, seed: int = 7) -> None:
        cache: dict = {}
        real = Forest(pages, cache)
        x, y = [real.features()], [weak_labels(real)]
        content = [t for t in real.texts(y[0])]
        prose = [p for t in content for p in t.split("\n") if p][:4000] or ["text"]
        rnd = random.Random(seed)
        prose = [p.replace("&", "&amp;").replace("<", "&lt;")[:rnd.choice([120, 400, 1500])] for p in prose]
        made = Forest([make_layout(rnd, prose) for _ in range(layouts)], cache)
        x.append(made.features())
        y.append(marked_labels(made))
        self.trees = BoostedTrees(rounds=rounds).fit(np.concatenate(x), np.concatenate(y), 3)

    def extract(self, pages: list[str], cache: dict) -> list[str]:
        forest = Forest(pages, cache)
        return forest.texts(forest.decode(self.trees.log_proba(forest.features())))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              fit_pages: int = 120, layouts: int = 400, rounds: int = 12) -> DataFrame:
    """One row per page: ``page_id, url, text``."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("c0"), F.col(f"`{url_col}`").alias("c1"), F.col(f"`{html_col}`").alias("c2"))
    # the least hashes first, then the pages that have them: only numbers are sorted
    small = rows.where((F.octet_length("c2") > 0) & (F.octet_length("c2") <= FIT_BYTES)).withColumn("h", F.xxhash64("c0", "c1"))
    least = [r["h"] for r in small.select("h").orderBy("h").limit(fit_pages).collect()]
    sample = sorted(small.where(F.col("h") <= least[-1]).select("h", "c2").limit(2 * fit_pages).collect())[:fit_pages] if least else []
    extractor = Extractor([r["c2"] for r in sample], layouts, rounds)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            html = [h or "" for h in batch.column(2).to_pylist()]
            at = 0
            while at < len(html):
                end, size = at, 0
                while end < len(html) and (end == at or size + len(html[end]) <= CHUNK_CHARS):
                    size += len(html[end])
                    end += 1
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), batch.column(1).slice(at, end - at),
                                                  pa.array(extractor.extract(html[at:end], cache), type=pa.string())], ["page_id", "url", "text"])
                at = end

    return rows.mapInArrow(extract, "page_id bigint, url string, text string")
