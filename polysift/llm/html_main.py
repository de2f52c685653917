"""Main text of web pages: gradient-boosted trees over block features, and a decoding that follows the tree.

Every block of a page is neutral (a frame around text and other things), main text, or dropped. The trees see the block's
depth, the density of text, links and marks below it, its tag, the words of its class, id and role, those of its ancestors, and
its siblings. The labels of a page are then chosen together, as the most likely ones in which a dropped block holds
only dropped blocks and a main block no neutral ones, by one pass up and one down the tree.

No table has labelled pages, so the trees are fitted on pages made from a small grammar of layouts whose labels are known,
``TRAIN_PAGES`` of them, ``LONG_PAGES`` with hundreds of siblings and ``BARE_PAGES`` of a few paragraphs alone, from fixed seeds; the fitted trees are broadcast. Pages are read whole, row by row.
"""

from __future__ import annotations

import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polysift.llm import boosting
from polysift.llm.common import Shared, map_texts
from polysift.llm.dom import Block, read

TRAIN_PAGES = 1000
LONG_PAGES = 30
BARE_PAGES = 40
DROP, NEUTRAL, MAIN = range(3)
#: Log odds that a block inside main text needs to be dropped.
SWITCH = 3.0

#: Words of class, id and role that hint at what a block is.
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pager pagination skip toc",
    "head": "header masthead topbar banner logo branding site",
    "foot": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside rail widget complementary related recommended recommend more trending popular teaser teasers",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted commercial dfp outbrain taboola",
    "note": "cookie cookies consent gdpr notice alert popup modal overlay dialog disclaimer paywall subscribe newsletter signup toast",
    "talk": "comment comments reply replies respond discussion disqus reviews review feedback thread commentlist",
    "social": "share sharing social follow like tweet facebook twitter meta byline author tags tag",
    "form": "form search login register input contact captcha",
    "body": "article content main post entry story text body hentry page prose markdown",
}
_GROUPS = list(HINTS)
_HINT = {w: i for i, g in enumerate(_GROUPS) for w in HINTS[g].split()}
_TAGS = {
    t: i
    for i, group in enumerate(
        ("article main", "nav menu", "header", "footer", "aside", "form fieldset button label select textarea input legend dialog", "section div body #page html",
         "p pre blockquote figcaption", "h1 h2 h3 h4 h5 h6", "ul ol dl", "li dt dd", "table tbody thead tr td th", "figure")
    )
    for t in group.split()
}
_N_TAGS = 14


def block_features(blocks: list[Block]) -> np.ndarray:
    """One row per block."""
    n, total = len(blocks), max(1, blocks[0].chars)
    deepest = max(b.depth for b in blocks) or 1
    width = 16 + _N_TAGS + 3 * len(_GROUPS) + 5
    x = np.zeros((n, width))
    above = np.zeros((n, len(_GROUPS) + 5))  # hints and sectioning tags of all ancestors
    for i, b in enumerate(blocks):
        chars = max(1, b.chars)
        own = np.zeros(len(_GROUPS))
        for t in b.tokens:
            if (g := _HINT.get(t)) is not None:
                own[g] += 1
        kind = _TAGS.get(b.tag, _N_TAGS - 1)
        up = blocks[b.parent] if b.parent >= 0 else b
        parent_links = up.link_chars / max(1, up.chars)
        x[i, :16] = (
            b.depth, b.depth / deepest, np.log1p(b.chars), b.link_chars / chars, np.log1p(b.own_chars), b.elements / chars * 100, b.marks / chars * 100,
            b.words / max(1, b.chunks), b.chars / total, b.start / total, b.end / total, np.log1p(b.paragraphs), np.log1p(b.items),
            b.place / max(1, len(up.children) - 1), b.chars / max(1, up.chars), parent_links,
        )
        x[i, 16 + kind] = 1
        at = 16 + _N_TAGS
        x[i, at : at + len(_GROUPS)] = own
        if b.parent >= 0:
            above[i] = above[b.parent]
        x[i, at + len(_GROUPS) : at + 2 * len(_GROUPS) + 5] = above[i]
        if b.children:  # hints right below
            for c in b.children:
                for t in blocks[c].tokens:
                    if (g := _HINT.get(t)) is not None:
                        x[i, at + 2 * len(_GROUPS) + 5 + g] += 1
        above[i, : len(_GROUPS)] = np.maximum(above[i, : len(_GROUPS)], own > 0)
        if kind < 5:
            above[i, len(_GROUPS) + kind] = 1
    return x


def decode(blocks: list[Block], log_p: np.ndarray) -> np.ndarray:
    """The most likely labels in which children never contradict their ancestors."""
    n = len(blocks)
    best = log_p.copy()
    for i, b in enumerate(blocks):
        if b.hidden:
            best[i] = (0.0, -np.inf, -np.inf)
    best[0, MAIN] = best[0, DROP] = -np.inf
    for i in range(n - 1, 0, -1):
        drop, neutral, main = best[i].tolist()
        p = blocks[i].parent
        best[p, DROP] += drop
        best[p, MAIN] += max(main, drop - SWITCH)
        best[p, NEUTRAL] += max(drop, neutral, main)
    labels = np.zeros(n, np.int64)
    labels[0] = NEUTRAL
    for i in range(1, n):
        up = labels[blocks[i].parent]
        allowed = (DROP,) if up == DROP else (MAIN, DROP) if up == MAIN else (MAIN, DROP, NEUTRAL)
        labels[i] = max(allowed, key=lambda s: best[i, s] - (SWITCH if up == MAIN and s == DROP else 0.0))
    return labels


def main_text(blocks: list[Block], runs: list[tuple[int, str]], labels: np.ndarray) -> str:
    return "\n".join(text for block, text in runs if labels[block] == MAIN)


# ---- pages with known labels -------------------------------------------------------------------------------------


class _Maker:
    """Random pages from a grammar of layouts; every block carries its label in a ``data-y`` attribute."""

    def __init__(self, seed: int, kind: str = "usual"):
        self.r, self.kind = random.Random(seed), kind

    def many(self, usual: int) -> int:
        """So many siblings, or hundreds on some pages."""
        return self.r.randint(65, 400) if self.kind == "long" and self.r.random() < 0.7 else usual

    def words(self, low: int, high: int) -> str:
        r = self.r
        out = ["".join(r.choice("abcdefghilmnoprstuvé") for _ in range(r.randint(2, 10))) for _ in range(r.randint(low, high))]
        return " ".join(w + r.choice(("", "", "", "", "", ",", ".", ". ")) for w in out).strip()

    def sentence(self, low: int, high: int) -> str:
        return self.words(low, high).capitalize() + "."

    def box(self, tag: str, label: int, inner: str, *names: str) -> str:
        cls = f' class="{self.r.choice(names)}"' if names and self.r.random() < 0.85 else ""
        cls = cls.replace("class", "id") if self.r.random() < 0.25 else cls
        return f'<{tag}{cls} data-y="{label}">{inner}</{tag}>'

    def links(self, n: int, label: int = DROP) -> str:
        link = lambda: f'<a href="/{self.words(1, 1)}">{self.words(1, 4)}</a>'
        if self.r.random() < 0.75:
            return f'<ul data-y="{label}">' + "".join(f'<li data-y="{label}">{link()}</li>' for _ in range(n)) + "</ul>"
        return " | ".join(link() for _ in range(n))

    def menu(self) -> str:
        tag = self.r.choice(("nav", "nav", "div", "ul"))
        return self.box(tag, DROP, self.links(self.r.randint(3, 12)), *(("main-menu", "navbar", "top-nav", "breadcrumbs") if tag != "nav" else ("", "menu")))

    def top(self) -> str:
        inner = self.r.choice((f'<h1 data-y="0"><a href="/">{self.words(1, 3)}</a></h1>', f'<div data-y="0">{self.words(1, 4)}</div>', ""))
        return self.box(self.r.choice(("header", "header", "div")), DROP, inner + f'<p data-y="0">{self.sentence(3, 9)}</p>' * (self.r.random() < 0.6) + self.menu() * (self.r.random() < 0.5), "site-header", "masthead", "topbar")

    def advert(self) -> str:
        text = self.sentence(4, 30)
        inner = self.r.choice((text, f'<p data-y="0">{text}</p>', f'<a href="/x">{text}</a>'))
        return self.box(self.r.choice(("div", "div", "aside", "section")), DROP, inner, "ad", "ads", "advert", "sponsored", "promo-box", "ad-slot", "banner-ad")

    def notice(self) -> str:
        inner = f'<p data-y="0">{self.sentence(6, 30)}</p>' + '<button data-y="0">Ok</button>' * (self.r.random() < 0.5)
        return self.box("div", DROP, inner, "cookie-notice", "consent", "alert", "notice", "popup", "newsletter", "subscribe-box")

    def side(self) -> str:
        r = self.r
        parts = [f'<h3 data-y="0">{self.words(1, 4)}</h3>' + (self.links(r.randint(3, 8)) if r.random() < 0.6 else "".join(f'<p data-y="0">{self.sentence(5, 25)}</p>' for _ in range(r.randint(1, 4)))) for _ in range(r.randint(1, 3))]
        return self.box(r.choice(("aside", "aside", "div")), DROP, "".join(parts), "sidebar", "side", "widget-area", "related", "rail")

    def talk(self) -> str:
        r = self.r
        one = lambda: self.box(r.choice(("div", "li", "article")), DROP, f'<p data-y="0">{self.sentence(4, 60)}</p>' * r.randint(1, 2), "comment", "reply", "comment-body", "review")
        inner = f'<h2 data-y="0">{r.choice(("Comments", "Replies", self.words(1, 3)))}</h2>' * (r.random() < 0.7) + "".join(one() for _ in range(self.many(r.randint(1, 8))))
        return self.box(r.choice(("section", "div", "ul")), DROP, inner, "comments", "discussion", "comment-list", "responses comments")

    def form(self) -> str:
        inner = f'<label data-y="0">{self.words(1, 4)}</label><input type="text"><button data-y="0">{self.words(1, 2)}</button>' + f'<p data-y="0">{self.sentence(4, 15)}</p>' * (self.r.random() < 0.4)
        return self.box("form", DROP, inner, "search-form", "contact", "login", "signup")

    def bottom(self) -> str:
        inner = self.r.choice((f"&copy; {self.sentence(3, 25)}", f'<p data-y="0">&copy; {self.sentence(3, 25)}</p>')) + self.links(self.r.randint(2, 8)) * (self.r.random() < 0.5)
        return self.box(self.r.choice(("footer", "footer", "div")), DROP, inner, "footer", "site-footer", "bottom legal")

    def paragraph(self) -> str:
        r, kind = self.r, self.r.random()
        if kind < 0.72:
            text = self.sentence(1, r.choice((3, 12, 60, 150)))
            if r.random() < 0.2:
                text += f' <a href="/y">{self.words(1, 5)}</a> {self.sentence(2, 20)}'
            if r.random() < 0.15:
                return f'<p data-y="2"><b>{text}<br>'
            return f'<p data-y="2">{text}' + "</p>" * (r.random() < 0.85)
        if kind < 0.82:
            return f'<h{(h := r.randint(2, 4))} data-y="2">{self.words(1, 8)}</h{h}>'
        if kind < 0.9:
            return '<ul data-y="2">' + "".join(f'<li data-y="2">{self.sentence(1, 25)}</li>' for _ in range(r.randint(1, 7))) + "</ul>"
        if kind < 0.94:
            return f'<blockquote data-y="2"><p data-y="2">{self.sentence(5, 50)}</p></blockquote>'
        if kind < 0.96:
            return '<table data-y="2">' + "".join('<tr data-y="2">' + "".join(f'<td data-y="2">{self.words(1, 5)}</td>' for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>"
        if kind < 0.98:
            return f'<figure data-y="2"><img src="a.png"><figcaption data-y="2">{self.sentence(3, 15)}</figcaption></figure>'
        return f'<div data-y="2">{self.sentence(5, 60)}</div>'

    def story(self) -> str:
        r = self.r
        parts = [f'<h1 data-y="2">{self.words(2, 12)}</h1>'] * (r.random() < 0.8) + [self.paragraph() for _ in range(self.many(r.choice((1, 1, 2, 2, 3, 5, 8, 20))))]
        for make, p in ((self.advert, 0.25), (self.notice, 0.1), (self.side, 0.12), (self.form, 0.1), (self.talk, 0.12)):
            if r.random() < p:
                parts.insert(r.randint(1, len(parts)), make())
        return "".join(parts)

    def bare(self) -> str:
        """A few paragraphs and nothing else."""
        r = self.r
        head = f"<head><title>{self.words(1, 8)}</title></head>" * (r.random() < 0.5)
        text = "".join(f'<p data-y="2">{self.sentence(1, r.choice((3, 12, 60, 150)))}</p>' for _ in range(r.choice((1, 1, 1, 2, 3))))
        return f'<html data-y="1">{head}<body data-y="1">{text}</body></html>'

    def page(self) -> str:
        if self.kind == "bare":
            return self.bare()
        r = self.r
        shape = r.random()
        tag, names = ("article", ("", "post", "story")) if shape < 0.5 else ("main", ("", "content")) if shape < 0.65 else ("div", ("content", "post-body", "entry", "article-text", "main", "x"))
        core = self.box(tag, MAIN, self.story(), *names) if shape < 0.92 else self.story()
        for depth in range(r.choice((0, 0, 0, 1, 2))):
            extra = self.side() * (r.random() < 0.4 and depth == 0)
            core = self.box(r.choice(("div", "section", "main")), NEUTRAL, core + extra, "wrapper", "container", "page", "layout", "content")
        before = [f() for f, p in ((self.top, 0.5), (self.menu, 0.7), (self.notice, 0.3), (self.advert, 0.5), (self.form, 0.15), (self.side, 0.2)) if r.random() < p]
        after = [f() for f, p in ((self.advert, 0.25), (self.talk, 0.35), (self.side, 0.35), (self.form, 0.15), (self.notice, 0.1), (self.bottom, 0.8)) if r.random() < p]
        r.shuffle(before)
        head = f"<head><title>{self.words(2, 8)}</title><style>p{{margin:0}}</style></head>"
        return f'<!DOCTYPE html><html data-y="1">{head}<body data-y="1">{"".join(before)}{core}{"".join(after)}</body></html>'


def training_pages(n: int = TRAIN_PAGES, seed: int = 7, kind: str = "usual") -> list[tuple[str, list[int]]]:
    """Pages and the labels of their blocks, in page order."""
    import re

    out = []
    maker = _Maker(seed, kind)
    for _ in range(n):
        marked = maker.page()
        labels = [NEUTRAL] + [int(y) for y in re.findall(r'data-y="(\d)"|<(?:head|title|style)>', marked) if y]
        out.append((re.sub(r' data-y="\d"', "", marked), labels))
    return out


@lru_cache(maxsize=2)
def fitted(n: int = TRAIN_PAGES, seed: int = 7) -> boosting.Boosted:
    xs, ys = [], []
    for html, labels in training_pages(n, seed) + training_pages(LONG_PAGES, seed + 1, "long") + training_pages(BARE_PAGES, seed + 2, "bare"):
        blocks, _ = read(html)
        shown = [i for i, b in enumerate(blocks) if not b.hidden]
        if len(shown) == len(labels):
            xs.append(block_features(blocks)[shown])
            ys += labels
    return boosting.fit(np.concatenate(xs), np.array(ys), 3)


def extract(html: str | None, model: boosting.Boosted) -> str:
    blocks, runs = read(html)
    return main_text(blocks, runs, decode(blocks, model.log_probabilities(block_features(blocks)))) if runs else ""


def extract_all(pages: DataFrame, model: boosting.Boosted, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, ``text`` (blocks joined by line feeds, empty without main text), ``n_chars``.

    Null html counts as empty, a null id or url stays null, repeated rows give repeated rows; other columns are ignored.
    """
    shared = Shared(pages.sparkSession, model)

    def start():
        trees = shared.get()

        def step(ids, urls, htmls):
            read_all = [read(h) for h in htmls]
            features = [block_features(b) for b, _ in read_all]
            log_p = trees.log_probabilities(np.concatenate(features)) if features else np.zeros((0, 3))
            at, texts = 0, []
            for blocks, runs in read_all:
                texts.append(main_text(blocks, runs, decode(blocks, log_p[at : at + len(blocks)])))
                at += len(blocks)
            return {"id_": ids, "url_": urls, "text": texts, "n_chars": [len(t) for t in texts]}

        return step

    shown = "bigint" if pages.schema[id_col].dataType.simpleString() == "bigint" else "string"
    fields = {"id_": pa.int64() if shown == "bigint" else pa.string(), "url_": pa.string(), "text": pa.string(), "n_chars": pa.int64()}
    picked = pages.select(F.col(id_col).cast(shown).alias("id_"), F.col(url_col).cast("string").alias("url_"), F.col(html_col).alias("html_"))
    out = map_texts(picked, ["id_", "url_", "html_"], f"id_ {shown}, url_ string, text string, n_chars long", fields, start)
    return out.withColumnRenamed("id_", id_col).withColumnRenamed("url_", url_col)
