"""Compiled selectors against hand-made pages and a plain matcher over a tree."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsdesk.functions import pages as pg
from newsdesk.functions import selectors as sl

FEED = """<html><body><nav><ul><li><a href="/nav">nav</a></li></ul></nav>
<ol><li class="newsFeed_item newsFeed_item-ranking"><a class="newsFeed_item_link" href="/1"><div class="newsFeed_item_title big">One &amp; two</div></a></li>
<li class="newsFeed_item"><a class="newsFeed_item_link" href="/ad"><div class="newsFeed_item_title">ad</div></a></li>
<li class='newsFeed_item-ranking'><div class="newsFeed_item_title">Three<script>var x = "no"</script></div><a class="newsFeed_item_link" href="/3">x</a></li></ol></body></html>"""
RANKING = """<div class="main x"><article>first</article><article><p>Now</p> <b>1</b><i>word</i>
<b>2</b><i>more words</i></article><ol><li><a href="/a">a</a></li><li><b><a href="/deep">no</a></b></li><li><a href="/b">b</a></li></ol></div>"""
SEARCH = """<div class="xrnccd c"><article><h3><a href="./articles/1">First</a></h3></article><h3><a href="/second">Second</a></h3></div>
<div class="c"><h3><a href="/other">Other</a></h3></div><div class="c xrnccd"><h4><a href="/none">x</a></h4></div>"""


def read(html, rules):
    return [(r["rule"], r["pos"], r["fields"]) for r in sl.records_of(html, json.dumps(rules))]


def test_feed():
    """Ranked entries only, not the navigation and not the advertisements."""
    rule = {"item": "li.newsFeed_item-ranking", "limit": 7, "fields": {"title": {"at": ".newsFeed_item_title"}, "url": {"at": ".newsFeed_item_link", "take": "@href"}}}
    assert read(FEED, {"feed": rule}) == [("feed", 0, {"title": "One & two", "url": "/1"}), ("feed", 1, {"title": "Three", "url": "/3"})]
    assert read(FEED, {"feed": {**rule, "limit": 1}})[-1][1] == 0


def test_ranking_page():
    """The second article as lines, and the links directly inside the list items."""
    rules = {"block": {"item": "div.main article:nth(1)", "fields": {"text": {"take": "lines"}}}, "links": {"item": "div.main ol > li > a", "fields": {"url": {"take": "@href"}}}}
    got = read(RANKING, rules)
    assert [f["text"] for n, _, f in got if n == "block"] == ["Now\n1\nword\n2\nmore words"]
    assert [f["url"] for n, _, f in got if n == "links"] == ["/a", "/b"]


def test_search_page():
    rule = {"item": ".xrnccd", "limit": 11, "fields": {"title": {"at": "h3 a"}, "url": {"at": "h3 a", "take": "@href"}}}
    assert [f for _, _, f in read(SEARCH, {"hit": rule})] == [{"title": "First", "url": "./articles/1"}, {"title": "Second", "url": "/second"}][:1] + [{}]


def test_attributes_and_edges():
    html = '<ul><li data-k="abc" HREF=x>1<li data-k="xbc">2<br/><li data-k>3</ul><p>a<p class="q">b'
    pick = lambda item, **f: [x for _, _, x in read(html, {"r": {"item": item, "fields": f or {"t": {}}}})]
    assert pick("li[data-k^=ab]", k={"take": "@data-k"}, h={"take": "@href"}) == [{"k": "abc", "h": "x"}]
    assert len(pick("[data-k*=bc]")) == 2 and len(pick("li[data-k='xbc']")) == 1 and len(pick("li[data-k]")) == 3
    assert pick("p") == [{"t": "a"}, {"t": "b"}] and pick("p.q") == [{"t": "b"}] and pick("br") == [{"t": ""}]
    assert read(None, {"r": {"item": "p"}}) == read("", {"r": {"item": "p"}}) == [] and read("</p></div>", {"r": {"item": "p"}}) == []
    for bad in ("p..x", "p:nth(x)", "!"):
        with pytest.raises(ValueError):
            sl.compiled(bad)
    with pytest.raises(ValueError):
        read("<p>", {"r": {"item": ""}})


TAGS, CLASSES = ["div", "ul", "li", "b"], ["x", "y"]


def page(rng, depth=0):
    out = []
    for _ in range(rng.randint(0, 3 if depth else 5)):
        tag, cls = rng.choice(TAGS), " ".join(rng.sample(CLASSES, rng.randint(0, 2)))
        out.append(f'<{tag} class="{cls}">t{rng.randint(0, 9)}{page(rng, depth + 1) if depth < 4 else ""}</{tag}>')
    return "".join(out)


@given(st.integers(0, 2**32))
@settings(max_examples=150, deadline=None)
def test_equal_to_a_tree(seed):
    """Descendant and child steps find what a search of the tree finds, in the same order."""
    rng = random.Random(seed)
    html = page(rng)
    selector = ""
    for i in range(rng.randint(1, 3)):
        step = rng.choice([*TAGS, ""]) + "".join(f".{c}" for c in rng.sample(CLASSES, rng.randint(0, 1)))
        selector += (rng.choice([" ", " > "]) if i else "") + (step or "b")
    tree = [n.text() for n in pg._select(pg._tree(html), selector)]
    assert [f["t"] for _, _, f in read(html, {"r": {"item": selector, "fields": {"t": {}}}})] == tree


def test_in_spark(spark):
    frame = spark.createDataFrame([(1, FEED), (2, None), (3, "")], "id int, html string")
    item = {"item": "li", "fields": {"title": {"at": ".newsFeed_item_title"}, "url": {"at": "a.newsFeed_item_link", "take": "@href"}}}
    got = {r.id: [(a.title, a.url) for a in r.a] for r in frame.select("id", sl.article_links(F.col("html"), item, 2).alias("a")).collect()}
    assert got == {1: [("One & two", "/1"), ("ad", "/ad")], 2: [], 3: []}
