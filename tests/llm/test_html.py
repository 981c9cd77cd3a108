import html as entities
import itertools
import re

import numpy as np
import pytest

from tidewell.llm import html
from tidewell.llm.html_pages import labelled_pages
from tidewell.llm.queries import QUERIES

PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><a href=/>Site</a><nav><ul><li><a href=a>Home</a></li>
<li><a href=b>News</a></li></ul></nav></header><div class="cookie-banner">We use cookies to improve this site. Accept them now.</div>
<main><article><h1>Title&nbsp;here</h1><p>First   paragraph,
which says <b>things</b> &amp; more.<br>After a break.</p><aside class="related"><h3>Related</h3><ul><li><a href=c>x y</a></li></ul></aside>
<script>var x = "<p>no</p>";</script><p>Second one ends here.<ul><li>point one of the list<li>point two</ul>
<div class="share"><a href=s>tweet</a></div></article><section id="comments"><h2>Comments</h2><div class="comment">
<p>I think this is a great article, thanks for writing it.</p></div></section></main><aside class="sidebar"><p>Subscribe to our letter.
It is good for you.</p></aside><form><p>Sign up here.</p><input name=q><button>Go</button></form>
<footer><p>&copy; 2020 Company. All rights.</p></footer></body></html>"""
MAIN = "Title here\nFirst paragraph, which says things & more. After a break.\nSecond one ends here.\npoint one of the list\npoint two"


@pytest.fixture(scope="module")
def model():
    return html.trained()


def text(page, model):
    return html.main_texts([html.read_page(page)], model)[0]


def test_a_page_with_everything(model):
    assert text(PAGE, model) == MAIN


def test_odd_pages(model):
    pages = ["", None, "<", "<p", "</p></div>", "<p>one<p>two", "just text", PAGE[:700], "<div hidden>gone</div><p>here it is.</p>", "<!-- -->"]
    found = [text(p, model) for p in pages]
    assert found[:3] == ["", "", "<"] and found[5] == "one\ntwo" and found[6] == "just text" and found[8] == "here it is."
    deep = "<div>" * 3000 + "<p>deep down there is one sentence.</p>"
    assert isinstance(text(deep, model), str)


def test_marginals_are_exact():
    """Sum-product against summing over all labellings."""
    rng = np.random.default_rng(0)
    page = html.read_page("<body><div><p>a</p><p>b</p></div><ul class=nav><li>c</li></ul><h1>d</h1></body>")
    trees = html.forest([page])
    model = html.Model(rng.normal(size=len(html._NAMES)), rng.normal(size=(len(html.EDGES), 2, 2)))
    count = len(trees.parents)
    own = np.bincount(trees.rows, model.unary[trees.features], count)
    total, ones, joint = 0.0, np.zeros(count), np.zeros((count, 2, 2))
    for labels in itertools.product((0, 1), repeat=count):
        weight = sum(own[i] * labels[i] for i in range(count))
        weight += sum(model.pair[trees.edges[i], labels[trees.parents[i]], labels[i]] for i in range(1, count))
        weight = np.exp(weight)
        total += weight
        ones += weight * np.array(labels)
        for i in range(1, count):
            joint[i, labels[trees.parents[i]], labels[i]] += weight
    chance, pairs = model.marginals(trees, pairs=True)
    assert np.allclose(chance, ones / total)
    assert np.allclose(pairs[1:], joint[1:] / total)


def test_pages_do_not_influence_each_other(model):
    pages = [html.read_page(p) for p in [PAGE, "", *labelled_pages(10, 5)]]
    assert html.main_texts(pages, model) == [html.main_texts([p], model)[0] for p in pages]


def test_held_out_layouts(model):
    pages = [html.read_page(p) for p in labelled_pages(150, 77)]
    right = np.concatenate([html.labels_of(p) for p in pages]) == (model.marginals(html.forest(pages)) > 0.5)
    own = np.concatenate([p.own for p in pages])
    assert (own * right).sum() >= 0.98 * own.sum()


def article(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", inner)]
    return "\n".join(b for b in blocks if b)


def test_query(spark, folder):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = QUERIES["op1_main_text"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])
        assert r["text"] == article(pages[r["page_id"]]["html"])


def test_awkward_rows(spark, model):
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, None, ""), (3, "v", "<p>" + "long text. " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = html.extract(pages.selectExpr("*", "'x' AS text", "1 AS n_chars", "2 AS _text"), model)
    assert found.columns == ["page_id", "text", "n_chars"]
    out = sorted(((r["page_id"], r["n_chars"]) for r in found.collect()), key=repr)
    assert out == sorted([(1, len(MAIN)), (1, len(MAIN)), (None, 0), (2, 0), (3, 549_999)], key=repr)
    assert html.extract(pages.limit(0), model).count() == 0
