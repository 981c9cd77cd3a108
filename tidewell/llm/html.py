"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is a variable: main content or not. Each has a potential from its own
features (tag, words of its class and id, length and links of its text), and each parent-child pair has one from
both labels and the kind of child. Sum-product message passing, once up and once down the tree, gives every
element's exact marginal; blocks with a marginal above one half are the main text. The weights are fitted to
labelled pages by gradient ascent on the likelihood, with the same message passing.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that start a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead"
    " tr ul caption".split()
)
# Elements without visible text of a page, or with controls of a form only.
UNSEEN = frozenset(
    "script style template noscript head title svg math iframe object audio video canvas select option textarea button"
    " datalist noembed noframes".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BREAKS = frozenset("br hr wbr".split())
# A start tag of the key ends an open element of the values, but for those above the listed bounds.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
    "th": ("td", "th"), "option": ("option",),
}
BOUNDS = {
    "li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"),
    "option": ("select",),
}

# Words of class, id and role that speak for what a page has besides its main text, and for the main text.
MARKS = {
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc skip",
    "head": "header masthead topbar logo branding site",
    "foot": "footer copyright colophon legal bottom",
    "side": "sidebar side aside rail widget related recommended popular trending more also teaser",
    "notice": "cookie cookies consent gdpr notice alert modal popup overlay paywall banner dialog",
    "advert": "ad ads advert adverts advertisement adsbygoogle sponsor sponsored promo promoted promotion",
    "form": "form search login signin signup subscribe newsletter register",
    "comment": "comment comments commentlist reply replies respond responses discussion disqus thread",
    "social": "share sharing social follow like tweet",
    "good": "article content post entry story body main text prose page",
}
_MARK_OF = {word: kind for kind, words in MARKS.items() for word in words.split()}
_BAD_TAGS = frozenset("nav header footer aside form search menu dialog".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

_TAGS = sorted(BLOCKS)
_NAMES = [
    *[f"tag {t}" for t in _TAGS], *[f"mark {m}" for m in MARKS], *[f"above {m}" for m in MARKS],
    *[f"length {i}" for i in range(5)], *[f"links {i}" for i in range(4)], *[f"inner links {i}" for i in range(4)],
    "sentence", "copyright", "bias", "paragraphs below", "inside a bad tag", "first heading",
]
_ID = {name: i for i, name in enumerate(_NAMES)}
#: Kinds of child for the parent-child potentials.
EDGES = ("heading", "paragraph", "item", "structure", "marked")


@dataclass
class Page:
    """Block elements in page order, parents first, and the page's pieces of text."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    marks: list[frozenset] = field(default_factory=list)
    labels: list[int | None] = field(default_factory=list)
    texts: list[tuple[int, str]] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)


class _Reader(HTMLParser):
    """Builds a Page; open inline elements only matter for links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.page = Page()
        self.stack: list[tuple[str, int]] = []  # tag, block it belongs to
        self.unseen = 0
        self.links = 0
        self.parts: list[str] = []
        self.block = self._add("html", -1, [])

    def _add(self, tag: str, parent: int, attrs: list) -> int:
        page = self.page
        words: set[str] = set()
        label = None
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                words |= {w.lower() for w in _WORD.findall(value)}
            elif name == "data-main-text":
                label = int(value)
        page.tags.append(tag)
        page.parents.append(parent)
        page.marks.append(frozenset(_MARK_OF[w] for w in words if w in _MARK_OF))
        page.labels.append(label)
        page.own.append(0)
        page.linked.append(0)
        return len(page.tags) - 1

    def flush(self) -> None:
        """Close the run of text that was being collected."""
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.page.texts.append((self.block, text))
                self.page.own[self.block] += len(text)

    def _pop(self, upto: int) -> None:
        while len(self.stack) > upto:
            tag, block = self.stack.pop()
            if tag in UNSEEN or block == -2:
                self.unseen -= 1
            elif tag in BLOCKS:
                self.flush()
                self.block = self.page.parents[block]
            elif tag == "a":
                self.links -= 1

    def _close(self, names: tuple, bounds: tuple) -> None:
        """End the innermost open element called one of `names`, unless one of `bounds` is further in."""
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in names:
                self._pop(i)
                return
            if tag in bounds:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BREAKS and not self.unseen:
            self.parts.append(" ")
        if tag in VOID or tag in ("html", "body") and any(t == tag for t, _ in self.stack):
            return
        if tag == "body" or tag in BLOCKS:
            # What a truncated head left open ends here.
            if tag == "body":
                self._close(("head",), ())
            self._close(("p",), ("table", "td", "th", "button", "object", "template"))
        if tag in ENDS:
            self._close(ENDS[tag], BOUNDS[tag])
        if tag == "a":
            self._close(("a",), ("table", "td", "th"))
        hidden = any(
            name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and value and _HIDDEN.search(value)
            for name, value in attrs
        )
        if tag in UNSEEN or hidden:
            self.unseen += 1
            self.stack.append((tag, -2))
        elif tag in BLOCKS and not self.unseen:
            self.flush()
            self.block = self._add(tag, self.block, attrs)
            self.stack.append((tag, self.block))
        else:
            self.links += tag == "a"
            self.stack.append((tag, self.block) if tag not in BLOCKS else ("(" + tag, self.block))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        names = (tag, "(" + tag)
        if tag in BLOCKS or tag in UNSEEN:
            self._close(names, ())
        else:
            self._close(names, tuple(BLOCKS))

    def handle_data(self, data: str) -> None:
        if not self.unseen:
            self.parts.append(data)
            if self.links:
                self.page.linked[self.block] += len(data.strip())


def read_page(html: str | None) -> Page:
    """The blocks of a page; broken or truncated markup is read as far as it goes."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    reader._pop(0)
    reader.flush()
    return reader.page


def _bucket(value: float, bounds: tuple) -> int:
    return sum(value > b for b in bounds)


@dataclass
class Forest:
    """Several pages' blocks as arrays."""

    parents: np.ndarray
    depths: np.ndarray
    edges: np.ndarray
    rows: np.ndarray  # block of each active feature
    features: np.ndarray
    starts: list[int]


def forest(pages: list[Page]) -> Forest:
    parents, depths, edges, rows, features, starts = [], [], [], [], [], []
    base = 0
    for page in pages:
        starts.append(base)
        count = len(page.tags)
        inner, inner_links, paragraphs = page.own[:], page.linked[:], [0] * count
        for i in range(count - 1, 0, -1):
            up = page.parents[i]
            inner[up] += inner[i]
            inner_links[up] += inner_links[i]
            paragraphs[up] += page.tags[i] == "p" and page.own[i] > 60
        last = {}
        for block, text in page.texts:
            last[block] = text
        above: list[frozenset] = []
        bad: list[bool] = []
        depth: list[int] = []
        heading = False
        for i in range(count):
            up, tag, marks = page.parents[i], page.tags[i], page.marks[i]
            above.append(above[up] | page.marks[up] if i else frozenset())
            bad.append(i > 0 and (bad[up] or page.tags[up] in _BAD_TAGS))
            depth.append(depth[up] + 1 if i else 0)
            own = page.own[i]
            names = ["bias", f"tag {tag}", f"length {_bucket(own, (0, 25, 80, 200))}"]
            names += [f"mark {m}" for m in marks] + [f"above {m}" for m in above[i]]
            if own:
                names.append(f"links {_bucket(page.linked[i] / own, (0.05, 0.4, 0.75))}")
                text = last[i]
                if text[-1] in ".!?…。！？\"”»":
                    names.append("sentence")
                if "©" in text or "all rights reserved" in text.lower():
                    names.append("copyright")
            if inner[i]:
                names.append(f"inner links {_bucket(inner_links[i] / inner[i], (0.05, 0.4, 0.75))}")
            if paragraphs[i] > 1:
                names.append("paragraphs below")
            if bad[i]:
                names.append("inside a bad tag")
            if tag == "h1" and not heading:
                heading = True
                names.append("first heading")
            features += [_ID[n] for n in names]
            rows += [base + i] * len(names)
            if marks - {"good"} or tag in _BAD_TAGS:
                kind = "marked"
            elif tag in _HEADINGS:
                kind = "heading"
            elif tag in ("p", "blockquote", "pre", "figcaption"):
                kind = "paragraph"
            elif tag in ("li", "td", "th", "dt", "dd", "tr"):
                kind = "item"
            else:
                kind = "structure"
            edges.append(EDGES.index(kind))
            parents.append(base + up if i else -1)
            depths.append(depth[i])
        base += count
    return Forest(*(np.array(x, np.int64) for x in (parents, depths, edges, rows, features)), starts)


@dataclass
class Model:
    """unary: a weight per feature; pair: per kind of child, parent's label and child's label."""

    unary: np.ndarray
    pair: np.ndarray

    def marginals(self, trees: Forest, pairs: bool = False):
        """Every block's probability to be main text; with `pairs` also of each label pair with its parent."""
        count = len(trees.parents)
        up = np.bincount(trees.rows, self.unary[trees.features], count)
        psi = self.pair[trees.edges]
        sent = np.zeros(count)
        levels = [np.flatnonzero(trees.depths == d) for d in range(trees.depths.max() + 1 if count else 0)]
        for level in levels[:0:-1]:
            sent[level] = np.logaddexp(psi[level, 1, 0], psi[level, 1, 1] + up[level]) - np.logaddexp(
                psi[level, 0, 0], psi[level, 0, 1] + up[level]
            )
            up += np.bincount(trees.parents[level], sent[level], count)
        belief, rest = up.copy(), np.zeros(count)
        for level in levels[1:]:
            # What the parent believes without this child's own message.
            rest[level] = belief[trees.parents[level]] - sent[level]
            belief[level] += np.logaddexp(psi[level, 0, 1], psi[level, 1, 1] + rest[level]) - np.logaddexp(
                psi[level, 0, 0], psi[level, 1, 0] + rest[level]
            )
        chance = 0.5 * (1 + np.tanh(belief / 2))
        if not pairs:
            return chance
        joint = psi.copy()
        joint[:, 1, :] += rest[:, None]
        joint[:, :, 1] += up[:, None]
        joint -= joint.max(axis=(1, 2), keepdims=True)
        joint = np.exp(joint)
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        return chance, joint


def labels_of(page: Page) -> np.ndarray:
    """Labels of a labelled page's blocks: marked ones pass theirs on to unmarked ones below; others are what most
    of the text below them is."""
    count = len(page.tags)
    given = page.labels[:]
    for i in range(1, count):
        if given[i] is None:
            given[i] = given[page.parents[i]]
    main, rest = [0] * count, [0] * count
    for i in range(count - 1, -1, -1):
        (main if given[i] else rest)[i] += page.own[i]
        if i:
            main[page.parents[i]] += main[i]
            rest[page.parents[i]] += rest[i]
    # Text that nothing is said about is main text of a page without any marks.
    plain = not any(label is not None for label in page.labels)
    return np.array([1] * count) if plain else np.array([int(g) if g is not None else int(m > r) for g, m, r in zip(given, main, rest)])


def fit(pages: list[Page], steps: int = 200, rate: float = 0.15, decay: float = 2e-3) -> Model:
    """Weights that make the labels of `pages` likely, by gradient ascent (Adam) on the mean log-likelihood."""
    trees = forest(pages)
    labels = np.concatenate([labels_of(p) for p in pages])
    inner = trees.parents >= 0
    seen_pairs = np.zeros((len(EDGES), 2, 2))
    np.add.at(seen_pairs, (trees.edges[inner], labels[trees.parents[inner]], labels[inner]), 1)
    model = Model(np.zeros(len(_NAMES)), np.zeros((len(EDGES), 2, 2)))
    weights = [model.unary, model.pair]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        chance, joint = model.marginals(trees, pairs=True)
        unary = np.bincount(trees.features, (labels - chance)[trees.rows], len(_NAMES))
        expected = np.zeros_like(seen_pairs)
        np.add.at(expected, trees.edges[inner], joint[inner])
        grads = [g / len(labels) - decay * w for g, w in zip((unary, seen_pairs - expected), weights)]
        for w, g, m, v in zip(weights, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def main_texts(pages: list[Page], model: Model) -> list[str]:
    """The main text of each page: its blocks in page order, one line each."""
    trees = forest(pages)
    chosen = model.marginals(trees) > 0.5
    return [
        "\n".join(text for block, text in page.texts if chosen[start + block]) for page, start in zip(pages, trees.starts)
    ]


@functools.lru_cache(maxsize=4)
def trained(pages: int = 240, seed: int = 1) -> Model:
    """A model fitted to `pages` labelled pages."""
    from tidewell.llm.html_pages import labelled_pages

    return fit([read_page(html) for html in labelled_pages(pages, seed)])


def extract(
    pages: DataFrame, model: Model, columns: tuple[str, ...] = ("page_id",), html_col: str = "html", pages_at_once: int = 200
) -> DataFrame:
    """`columns`, text and n_chars (code points) of every row.

    White space within a block is one space; blocks are joined by line feeds in page order; null html, and html without main
    text, gives an empty text. Repeated rows are read each; other columns are not read.
    """

    @F.pandas_udf("string")
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts: list[str] = []
            for at in range(0, len(batch), pages_at_once):
                texts += main_texts([read_page(html) for html in batch.iloc[at:at + pages_at_once]], model)
            yield pd.Series(texts, dtype=object)

    found = pages.select(*columns, text_of(F.col(html_col)).alias("_text"))
    return found.select(*columns, F.col("_text").alias("text"), F.length("_text").cast("bigint").alias("n_chars"))
