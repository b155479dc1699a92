"""Main text of pages: boosted trees over DOM-node features, and a hierarchical decoding.

Every element that lays out a page (and every inline element with attributes) is a node.
A classifier gives each node the log-odds of belonging to the article, from its tag, the
words of its attributes and of its ancestors', its depth and place, the density of text,
links and controls in its subtree, and how it compares with its siblings. The labels of a
page are then chosen together: a node under a dropped ancestor is dropped, and the choice
with the greatest total log-odds wins, found bottom-up in one pass. No page can keep a
descendant of what it dropped, and a doubtful node goes with its subtree.

The classifier is fitted on the driver from a bounded sample: about SAMPLE pages, chosen by
a hash, used as fragments for LAYOUTS generated pages with known labels, and
as they are where their own markup names one article. Extraction is one narrow Arrow map.
"""

from __future__ import annotations

import re
from math import log1p

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lidarlattice.llm._common import map_text, table
from lidarlattice.llm.boosting import BoostedTrees
from lidarlattice.llm.html_nodes import BLOCKS, CLOSES_P, SAME, SCOPE, VOID, attributes, plain_text, squeeze, tokens
from lidarlattice.llm.page_layouts import Layouts

#: Bounds of the training sample: real pages about, characters of a page that may teach (longer pages do not), generated pages.
SAMPLE, LONGEST, LAYOUTS = 200, 100_000, 700

_ATTRIBUTE = frozenset("class id role itemprop data-y".split())
_WORD = re.compile(r"[a-z]+")
_POINT = re.compile(r"[.,;!?:]")
_ASIDE = frozenset("nav header footer aside form menu dialog button select".split())
_CONTROLS = frozenset("form input button select textarea label fieldset option".split())
_TABLE = frozenset("table tr tbody thead tfoot body html".split())
_HEADS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Page:
    """The nodes of a page in document order, and its text blocks as (node, raw text) parts."""

    def __init__(self, source: str):
        self.tag, self.parent, self.words, self.label = ["#root"], [-1], [()], [-1]
        self.blocks: list[list[tuple[int, str]]] = []
        self.links: list[int] = [0]
        names, block, link = ["#root"], [], False
        nodes = [0]  # the nearest node of each open element
        bars = [0]  # the place of the nearest block among the open elements
        places: dict[str, list[int]] = {}  # where each name is open: finds an element without a walk through the others

        def pop_to(k):
            for name in names[k:]:
                places[name].pop()
            del names[k:], nodes[k:], bars[k:]

        def last(*some):
            return max((places[name][-1] for name in some if places.get(name)), default=0)

        def end_block():
            nonlocal block
            if block:
                self.blocks.append(block)
                block = []

        for kind, name, data in tokens(source):
            if kind == "text":
                node = nodes[-1]
                block.append((node, data))
                if link:
                    self.links[node] += len(data)
            elif kind == "open":
                if name in BLOCKS:
                    end_block()
                    link = False
                    if name in CLOSES_P and names[bars[-1]] == "p":
                        pop_to(bars[-1])
                    if name in SAME:
                        k = last(*SAME[name].split())
                        if k > last(*SCOPE[name].split()):
                            pop_to(k)
                elif name == "a":
                    link = True
                elif name == "br" or name == "img":
                    block.append((nodes[-1], " "))
                if name in ("html", "body") and places.get(name):
                    continue
                found = [(k, v) for k, v in attributes(data) if k in _ATTRIBUTE] if "=" in data else []
                control = name in _CONTROLS and name not in BLOCKS
                if name in BLOCKS or control or (found and name not in VOID and name != "a"):
                    self.tag.append(name)
                    self.parent.append(nodes[-1])
                    self.label.append(next((int(v) for k, v in found if k == "data-y" and v in ("0", "1")), -1))
                    self.words.append(tuple(w for k, v in found if k != "data-y" for w in _WORD.findall(v.lower())))
                    self.links.append(0)
                    node = len(self.tag) - 1
                else:
                    node = nodes[-1]
                if name not in VOID:
                    places.setdefault(name, []).append(len(names))
                    bars.append(len(names) if name in BLOCKS else bars[-1])
                    names.append(name)
                    nodes.append(node)
            else:
                if name == "a":
                    link = False
                if name in BLOCKS:
                    end_block()
                    link = False
                bar = last("table", "td", "th") if name not in _TABLE else 0
                k = last(name)
                if k and k >= max(bar, bars[-1] if name not in BLOCKS else 0):
                    pop_to(k)
        end_block()


def word_scores(pages: list[tuple[Page, list[int]]]) -> dict[str, float]:
    """Log-odds of being dropped for each attribute word of the training nodes, smoothed."""
    seen: dict[str, list[int]] = {}
    for page, labels in pages:
        for words, y in zip(page.words, labels, strict=True):
            if y >= 0:
                for w in set(words):
                    seen.setdefault(w, [0, 0])[y] += 1
    return {w: float(np.log((n + 1) / (y + 1))) for w, (n, y) in seen.items() if n + y >= 3}


def features(page: Page, scores: dict[str, float]) -> np.ndarray:
    """A row per node."""
    n = len(page.tag)
    text, words, points, pieces = [0] * n, [0] * n, [0] * n, [0] * n
    start: list[int] = [0] * n
    total, seen = 0, set()
    for block in page.blocks:
        for node, data in block:
            size = len(data.strip())
            if size:
                text[node] += size
                words[node] += data.count(" ") + 1
                points[node] += len(_POINT.findall(data))
                pieces[node] += 1
    offset = 0
    first = [-1] * n
    for block in page.blocks:
        for node, data in block:
            k = node
            while k >= 0 and first[k] < 0:
                first[k] = offset
                k = page.parent[k]
            offset += len(data)
    total = max(1, offset)
    del seen
    link = list(page.links)
    count, p, li, heads, controls = [1] * n, [0] * n, [0] * n, [0] * n, [0] * n
    children, child_text = [0] * n, [0] * n
    same: dict[tuple[int, str], int] = {}
    for k in range(n):
        t = page.tag[k]
        p[k], li[k], heads[k], controls[k] = t == "p", t == "li", t in _HEADS, t in _CONTROLS
    own = text[:]
    for k in range(n - 1, 0, -1):
        up = page.parent[k]
        for values in (text, words, points, pieces, link, count, p, li, heads, controls):
            values[up] += values[k]
        children[up] += 1
        child_text[up] += text[k]
        same[up, page.tag[k]] = same.get((up, page.tag[k]), 0) + 1
    depth, least, most, aside, article, index = [0] * n, [0.0] * n, [0.0] * n, [0] * n, [0] * n, [0] * n
    sofar = [0] * n
    last = 0
    rows = []
    for k in range(n):
        up, t = page.parent[k], page.tag[k]
        known = [scores[w] for w in page.words[k] if w in scores]
        low, high = min(known, default=0.0), max(known, default=0.0)
        if k:
            depth[k] = depth[up] + 1
            least[k], most[k] = min(least[up], low), max(most[up], high)
            aside[k], article[k] = aside[up] + (t in _ASIDE), article[up] + (t in ("article", "main"))
            index[k] = sofar[up]
            sofar[up] += 1
        last = max(last, first[k])
        siblings, others = children[up] if k else 1, (child_text[up] - text[k]) / max(1, children[up] - 1) if k else 0
        rows.append(
            (
                t == "p", t in _HEADS, t in ("ul", "ol", "dl", "menu"), t in ("li", "dt", "dd"), t in ("table", "tr", "td", "th", "tbody"), t in ("article", "main"), t == "section", t == "div", t in _ASIDE, t in _CONTROLS, t in ("body", "html", "#root"), t in ("blockquote", "pre", "figure", "figcaption"),
                low, high, sum(known), len(page.words[k]), least[up] if k else 0.0, most[up] if k else 0.0, aside[k], article[k], depth[k], (first[k] if first[k] >= 0 else last) / total, log1p(text[k]), log1p(own[k]), text[k] / total, text[k] / max(1, text[up] if k else text[k]),
                link[k] / max(1, text[k]), count[k] / (1 + text[k]), log1p(count[k]), words[k] / max(1, pieces[k]), points[k] / max(1, words[k]), log1p(p[k]), log1p(li[k]), heads[k], controls[k], log1p(siblings), same.get((up, t), 1) / siblings if k else 1.0, index[k] / siblings, log1p(text[k]) - log1p(others),
            )
        )
    return np.array(rows, np.float64)


def decode(page: Page, logit: np.ndarray) -> list[bool]:
    """The labels with the greatest total log-odds in which every kept node has kept ancestors."""
    n = len(page.tag)
    gain = [float(x) for x in logit]
    for k in range(n):
        if page.tag[k] in ("#root", "html", "body"):
            gain[k] = 1e9
    for k in range(n - 1, 0, -1):
        if gain[k] > 0:
            gain[page.parent[k]] += min(gain[k], 1e6)
    keep = [True] * n
    for k in range(1, n):
        keep[k] = keep[page.parent[k]] and gain[k] > 0
    return keep


def own_labels(page: Page) -> list[int]:
    """Labels from markup that names one article: 1 in it and above it, 0 in clear asides, else -1."""
    n = len(page.tag)
    articles = [k for k in range(n) if page.tag[k] == "article"] or [k for k in range(n) if page.tag[k] == "main"]
    if len(articles) != 1:
        return [-1] * n
    labels, inside = [-1] * n, [False] * n
    for k in range(n):
        up = page.parent[k]
        inside[k] = k == articles[0] or (k > 0 and inside[up])
        labels[k] = 0 if page.tag[k] in _ASIDE or (k and labels[up] == 0) else 1 if inside[k] else -1
    k = articles[0]
    while k >= 0:
        labels[k], k = 1, page.parent[k]
    return labels


class Extractor:
    """A fitted classifier with its table of attribute words."""

    def __init__(self, pages: list[str], seed: int = 7):
        lines = [line for source in pages for line in plain_text(source).split("\n")]
        long = [line for line in lines if len(line) > 60] or [line for line in lines if line]
        short = [w for line in lines for w in line.split()[:6] if w]
        drawn = Layouts(long, short, seed)
        train = []
        for _ in range(LAYOUTS):
            page = Page(drawn.page())
            labels = page.label[:]
            labels[0] = 1
            for k in range(1, len(labels)):
                if labels[k] < 0:
                    labels[k] = labels[page.parent[k]]
            train.append((page, labels))
        train += [(page, own_labels(page)) for page in (Page(source) for source in pages)]
        self.scores = word_scores(train)
        x = np.concatenate([features(page, self.scores) for page, _ in train])
        y = np.concatenate([np.array(labels) for _, labels in train])
        self.trees = BoostedTrees().fit(x[y >= 0], y[y >= 0].astype(np.float64))

    def extract(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s or "") for s in sources]
        if not pages:
            return []
        rows = [features(page, self.scores) for page in pages]
        logits = np.split(self.trees.logit(np.concatenate(rows)), np.cumsum([len(r) for r in rows])[:-1])
        return [self.text(page, logit) for page, logit in zip(pages, logits, strict=True)]

    @staticmethod
    def text(page: Page, logit: np.ndarray) -> str:
        keep = decode(page, logit)
        lines = (squeeze("".join(data for node, data in block if keep[node])) for block in page.blocks)
        return "\n".join(line for line in lines if line)


def fit(df: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Extractor:
    """Fit on about `sample` pages, twice as many at most: those with the least hashes of id and length; no pages give a classifier from layouts alone.

    Pages of more than LONGEST characters teach nothing, so that the sample is bounded in
    size without cutting a page. The share of pages below a hash is thinned on the
    executors, so that what reaches the driver does not grow with the number of tasks.
    """
    pages = df.where(F.col(html_col).isNotNull() & (F.length(html_col) <= LONGEST))
    parts = 1 << 30
    below = int(min(1.0, sample / max(1, pages.count())) * parts)
    some = pages.where(F.pmod(F.xxhash64(id_col, F.length(html_col)), F.lit(parts)) < below).select(F.col(html_col).alias("x")).limit(2 * sample)
    return Extractor(sorted(r["x"] for r in some.collect()))


def main_text(df: DataFrame, extractor: Extractor, html_col: str = "html") -> DataFrame:
    """Append `text` and `n_chars` (code points) to every row, and leave the html out.

    Null and empty pages give the empty text. Rows are neither dropped nor moved; repeated
    rows stay; an empty table stays empty.
    """
    added = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    held = df.sparkSession.sparkContext.broadcast(extractor)  # some hundred kB: trees and words of a bounded sample

    def run(batch):
        texts = held.value.extract(batch.column(html_col).to_pylist())
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return map_text(df, run, added, html_col)


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, fit(pages))


QUERIES = {"op2_main_text": op2_main_text}
ORACLE_SQL: dict[str, str] = {}
