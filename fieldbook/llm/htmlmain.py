"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded over the tree.

Nodes are judged by text and link density of their subtree, words of their attributes, depth, position and siblings.
A dynamic programme over the tree then picks, for each node, outside, content or away, so that the sum of the nodes'
log odds is greatest and choices do not contradict: below "away" all is away, below "content" is content or away.

There are no labelled pages, so the trees learn from a bounded sample (``sample_pages``): the pages as they are,
labelled by their own article element, and the same texts set in random layouts with menus, notices, adverts, forms,
side columns and reader comments around and inside the article, half of them without telling element names.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldbook.llm import dom

#: training pages are at most so long, which bounds what the driver receives
TRAIN_CHARS = 65_536


@dataclass(frozen=True)
class Settings:
    sample_pages: int = 240
    layouts: int = 3  # random layouts for each sampled page
    trees: int = 40
    depth: int = 4
    bins: int = 32
    rate: float = 0.25
    least: int = 20  # rows in a leaf
    seed: int = 11


@dataclass
class Forest:
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    leaf: np.ndarray  # trees x leaves
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(int(np.log2(len(leaf)))):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            out += leaf[at - len(feature)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, s: Settings) -> Forest:
    """Second-order boosting of complete trees on binned features; the same rows give the same forest."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, s.bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
    rate = np.clip((weight * y).sum() / weight.sum(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate / (1 - rate)))
    score = np.full(len(y), base)
    inner = 2**s.depth - 1
    features, cuts, leaves = [], [], []
    for _ in range(s.trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(s.depth):
            low, width = 2**level - 1, 2**level
            slot = at - low
            best, pick = np.full(width, 1e-6), np.zeros(width, dtype=np.int64)
            where = np.full(width, -1, dtype=np.int64)
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                cell = slot * (len(e) + 1) + binned[:, j]
                sums = [np.bincount(cell, v, width * (len(e) + 1)).reshape(width, -1).cumsum(axis=1) for v in (g, h, np.ones(len(y)))]
                left = [v[:, :-1] for v in sums]
                right = [v[:, -1:] - v[:, :-1] for v in sums]
                part = lambda v: v[0] ** 2 / (v[1] + 1.0)
                gain = part(left) + part(right) - sums[0][:, -1:] ** 2 / (sums[1][:, -1:] + 1.0)
                gain = np.where((left[2] >= s.least) & (right[2] >= s.least), gain, 0)
                k = gain.argmax(axis=1)
                top = gain[np.arange(width), k]
                better = top > best
                best, pick, where = np.where(better, top, best), np.where(better, j, pick), np.where(better, k, where)
            for i in np.flatnonzero(where >= 0):
                feature[low + i], cut[low + i] = pick[i], edges[pick[i]][where[i]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > cut[at])
        slot = at - inner
        leaf = s.rate * np.bincount(slot, g, inner + 1) / (np.bincount(slot, h, inner + 1) + 1.0)
        score += leaf[slot]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Forest(np.array(features), np.array(cuts), np.array(leaves), base)


def decode(page: dom.Page, odds: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether each node is content, under choices that fit together."""
    n = len(page.tag)
    gain = odds.clip(-6, 6) * (0.3 + np.log1p(own))
    content, away, outside = gain.tolist(), (-gain).tolist(), (-np.abs(gain) * (own > 0)).tolist()
    for i in range(n - 1, -1, -1):
        p = page.parent[i]
        if p >= 0:
            content[p] += max(content[i], away[i])
            away[p] += away[i]
            outside[p] += max(outside[i], content[i], away[i])
    keep, state = np.zeros(n, dtype=bool), [0] * n
    for i in range(n):
        above = state[page.parent[i]] if page.parent[i] >= 0 else 0
        options = [(outside[i], 0), (content[i], 1), (away[i], 2)]
        state[i] = max(options[above:] if above < 2 else options[2:], key=lambda o: o[0])[1]
        keep[i] = state[i] == 1
    return keep


def _labels(page: dom.Page) -> np.ndarray:
    """Training labels: data-keep where given, else inside an article or main element and not in a part that is named otherwise."""
    marked = any(page.keep)
    out = np.zeros(len(page.tag))
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        out[i] = out[p] if p >= 0 else 0
        if marked:
            out[i] = float(page.keep[i]) if page.keep[i] else out[i]
        elif tag in ("article", "main"):
            out[i] = 1
        elif tag in ("nav", "footer", "aside", "form") or page.away[i]:
            out[i] = 0
    return out


class _Layouts:
    """Random pages from sampled paragraphs, with ``data-keep`` on what is article and what is not."""

    def __init__(self, paragraphs: list[str], bits: list[str], rng: np.random.Generator):
        self.paragraphs, self.bits, self.rng = paragraphs, bits, rng

    def one(self, options):
        return options[int(self.rng.integers(len(options)))]

    def few(self, pool: list[str], low: int, high: int) -> list[str]:
        return [html.escape(self.one(pool)) for _ in range(int(self.rng.integers(low, high)))]

    def element(self, tag: str, name: str, inside: str, keep: int) -> str:
        tag = tag if self.rng.random() < 0.6 else self.one(["div", "section"])
        name = f' {self.one(["class", "id"])}="{name}"' if name and self.rng.random() < 0.85 else ""
        return f'<{tag}{name} data-keep="{keep}">{inside}</{tag}>'

    def links(self) -> str:
        rows = "".join(f'<li><a href="/{i}">{b}</a></li>' for i, b in enumerate(self.few(self.bits, 3, 9)))
        return f"<ul>{rows}</ul>" if self.rng.random() < 0.7 else rows.replace("<li>", "").replace("</li>", " | ")

    def comments(self) -> str:
        rows = "".join(f'<div class="{self.one(["comment", "reply", "c"])}"><b>{self.few(self.bits, 1, 2)[0]}</b><p>{self.few(self.paragraphs, 1, 2)[0]}</p></div>' for _ in range(int(self.rng.integers(1, 5))))
        return self.element("section", self.one(["comments", "comment-list", "disqus_thread", "responses", "discussion", "reader-comments"]), "<h3>Comments</h3>" + rows, 0).replace("<section data", '<section class="comments" data').replace("<div data", '<div class="comments" data')

    def boilerplate(self) -> str:
        short = " ".join(self.few(self.bits, 1, 4))
        one = self.few(self.paragraphs, 1, 2)[0]
        kind = int(self.rng.integers(9))
        if kind == 0:
            return f'<div class="{self.one(["ad", "ads", "advert", "banner", "sponsored", "promo", "ad-slot"])}" data-keep="0">{self.one([short, one])}</div>'
        if kind == 1:
            return f'<div class="{self.one(["cookie-notice", "notice", "consent", "alert", "gdpr-banner", "popup"])}" data-keep="0"><p>{self.one([short, one])}</p></div>'
        if kind == 2:
            return f'<form data-keep="0"><label>{short}</label><input name="q"><p>{short}</p></form>'
        if kind == 3:
            return f'<aside data-keep="0">{self.one([self.links(), f"<h4>{short}</h4><p>{one}</p>"])}</aside>'
        if kind == 4:
            return self.element("div", self.one(["related", "share", "social", "tags", "newsletter", "subscribe", "breadcrumb", "popular"]), self.links(), 0)
        if kind == 5:
            return f'<div class="{self.one(["sidebar", "widget", "side", "rail"])}" data-keep="0"><h4>{short}</h4>{self.one([self.links(), f"<p>{one}</p>"])}</div>'
        if kind == 6:
            return self.element("nav", self.one(["nav", "menu", "navbar"]), self.links(), 0)
        if kind == 7:
            return self.comments()
        tag = self.one(["header", "footer"])
        return f'<{tag} data-keep="0"><p>{short}</p></{tag}>'

    def article(self, title: str, paragraphs: list[str]) -> str:
        rows = [f"<h1>{html.escape(title)}</h1>"] if self.rng.random() < 0.85 else []
        for text in paragraphs:
            text, kind = html.escape(text), self.rng.random()
            rows.append(f"<p>{text}</p>" if kind < 0.8 else f"<h2>{text[:60]}</h2><p>{text}</p>" if kind < 0.87 else f"<ul><li>{text}</li></ul>" if kind < 0.92 else f"<blockquote>{text}</blockquote>" if kind < 0.95 else f"<div>{text}</div>")
            if self.rng.random() < 0.12:
                rows.append(self.boilerplate())
        if self.rng.random() < 0.2:
            rows.append(self.comments())
        if self.rng.random() < 0.15:  # no element of its own
            return "".join(re.sub(r"^<(\w+)>", r'<\1 data-keep="1">', re.sub(r"</h2><p>", '</h2><p data-keep="1">', r)) for r in rows)
        name = self.one(["", "content", "post", "article", "main", "entry-content", "story", "article-body"])
        return self.element(self.one(["article", "article", "main"]), name, "".join(rows), 1)

    def page(self, title: str, paragraphs: list[str]) -> str:
        title = " ".join(title.split()[: int(self.rng.integers(1, 16))])
        head = self.element("header", self.one(["header", "masthead", "top"]), f"<p>{' '.join(self.few(self.bits, 1, 3))}</p>", 0) if self.rng.random() < 0.5 else ""
        menu = self.element("nav", self.one(["nav", "menu", "main-menu", "navigation"]), self.links(), 0) if self.rng.random() < 0.8 else ""
        before = "".join(self.boilerplate() for _ in range(int(self.rng.integers(0, 3))))
        after = "".join(self.boilerplate() for _ in range(int(self.rng.integers(0, 4))))
        foot = self.element("footer", self.one(["footer", "copyright", "site-footer"]), f"&copy; {' '.join(self.few(self.bits, 1, 4))}", 0) if self.rng.random() < 0.8 else ""
        middle = before + self.article(title, paragraphs) + after
        if self.rng.random() < 0.4:
            middle = f'<div class="{self.one(["wrapper", "container", "page", "row"])}">{middle}</div>'
        if self.rng.random() < 0.1:
            return menu + middle + foot
        return f"<html><head><title>{html.escape(title)}</title></head><body>{head}{menu}{middle}{foot}</body></html>"


def train(sources: list[str], s: Settings) -> Forest | None:
    """A forest from sampled pages; None if they hold no text."""
    rng = np.random.default_rng(s.seed)
    pages = [dom.read(x) for x in sources]
    labels = [_labels(p) for p in pages]
    marked = any(y.any() for y in labels)
    texts = [[run for i, run, link in p.runs if (y[i] if marked else len(run) > 80 and 5 * link < len(run))] for p, y in zip(pages, labels, strict=True)]
    bits = [run[:80] for p, y in zip(pages, labels, strict=True) for i, run, _ in p.runs if not y[i] or len(run) < 40]
    paragraphs = [t for page in texts for t in page]
    if not paragraphs:
        return None
    made = _Layouts(paragraphs, bits or [t[:40] for t in paragraphs], rng)
    extra = [dom.read(made.page(t[0][:120], t[1:] or t)) for t in texts if t for _ in range(s.layouts)]
    known = [(p, y) for p, y in zip(pages, labels, strict=True) if y.any()] + [(p, _labels(p)) for p in extra]
    rows = [(*dom.features(p), y) for p, y in known if p.tag]
    x, own, y = (np.concatenate([r[i] for r in rows]) for i in range(3))
    return boost(x, y, 0.2 + np.log1p(own), s)


def learn(pages: DataFrame, settings: Settings | None = None) -> Forest | None:
    """A forest from the ``sample_pages`` distinct pages of least hash (with html, at most 65,536 characters).

    Hashes are sorted out first, so a task sends as many numbers, not pages; then those pages are fetched.
    """
    s = settings or Settings()
    usable = pages.where(F.length("html").between(1, TRAIN_CHARS)).select(F.xxhash64("html").alias("h"), "html")
    least = usable.select("h").distinct().orderBy("h").limit(s.sample_pages)
    rows = usable.join(F.broadcast(least), "h").groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect()
    return train([r["html"] for r in rows], s)


def main_text(source: str | None, forest: Forest | None) -> str:
    return _texts([source], forest)[0]


def _texts(sources: list[str | None], forest: Forest | None) -> list[str]:
    pages = [dom.read(x or "") for x in sources]
    parts = [dom.features(p) for p in pages]
    if forest is None:
        return [""] * len(sources)
    odds = forest.log_odds(np.concatenate([x for x, _ in parts])) if parts else np.zeros(0)
    out, at = [], 0
    for page, (x, own) in zip(pages, parts, strict=True):
        keep = decode(page, odds[at : at + len(x)], own)
        at += len(x)
        out.append("\n\n".join(run for i, run, _ in page.runs if keep[i]))
    return out


def _extracted(forest: Forest | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                texts = _texts(part.column("html").to_pylist(), forest)
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, forest: Forest | None) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages(page_id, url, html)``.

    Text of content nodes: character references decoded, white space inside a block one space, blocks trimmed and
    joined in page order by two newlines; ``n_chars`` counts code points.  Null, empty and wordless pages give an empty
    text, as do all pages without a forest.  Broken markup is read as far as it goes.  Repeated rows give repeated
    results; null ids and urls stay; empty tables give empty tables; other columns are ignored.
    """
    return pages.select("page_id", "url", "html").mapInArrow(_extracted(forest), "page_id long, url string, text string, n_chars long")
