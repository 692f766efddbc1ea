"""Page extraction and the jobs built on it, on invented pages."""

from __future__ import annotations

import gc
import json
import weakref

from pyspark.sql import functions as F

from newsdesk.functions import pages as pg
from newsdesk.plans import jobs

LIST_PAGE = """<html><body><script>var a="<li class='item'>no</li>";</script>
<ul><li class="item hot"><a href="/n/1"><h3 class="t">First &amp; best</h3></a><p>sum one</p></li>
<li class="other"><a href="/n/9">skip</a></li>
<li class="item"><a href="n/2"><h3 class="t">Second</h3></a></li></ul></body></html>"""

DETAIL = """<article><time datetime="2022-05-01T10:00:00+09:00">x</time>
<p class="body lead">One <b>bold</b></p><img class="fig" src="a.png"><p class="note">no</p>
<p class="body">Two<p class="body">Three</article>"""

RULES = json.dumps({"tag": "li", "class": "item", "items": [["headline", "h3", "t"], ["summary", "p", "None"], ["author", "i", "None"]]})
BODY = json.dumps({"time_attr": "datetime", "paragraph": ["p", "^body"], "figure": ["img", "fig", "src"]})


def frame(spark, *html):
    return spark.createDataFrame([(i, h) for i, h in enumerate(html)], "page_id bigint, html string")


def test_blocks(spark):
    rows = frame(spark, LIST_PAGE).select(F.inline(pg.extract_blocks(F.col("html"), F.lit(RULES)))).collect()
    assert [(r.pos, r.fields["headline"], r.fields["summary"], r.href) for r in rows] == [
        (0, "First & best", "sum one", "/n/1"), (1, "Second", None, "n/2")]


def test_body(spark):
    rows = frame(spark, DETAIL, "<p>bare</p>", None).select("page_id", pg.extract_body(F.col("html"), F.lit(BODY)).alias("a"))
    got = {r.page_id: r.a for r in rows.collect()}
    assert got[0].date == "2022-05-01T10:00:00+09:00"
    assert [(e.pos, e.kind, e.value) for e in got[0].body] == [
        (0, "paragraph", "One bold"), (1, "figure", "a.png"), (2, "paragraph", "Two"), (3, "paragraph", "Three")]
    assert got[1].date is None and got[1].body == [] and got[2].body == []


def test_meta_and_cards(spark):
    html = ('<meta content="2022-05-01T01:02:03Z" name="article.published"><meta name="author" content="A &amp; B">'
            '<article> Head  Sum12 <h3>x <a class="k" href="/u1">t</a></h3></article><article>Alone</article>')
    row = frame(spark, html).select(
        pg.extract_meta(F.col("html"), "author").alias("a"), pg.extract_meta(F.col("html"), "article.published").alias("d"),
        pg.extract_meta(F.col("html"), "nothing").alias("n"), pg.extract_cards(F.col("html")).alias("c")).first()
    assert (row.a, row.d, row.n) == ("A & B", "2022-05-01T01:02:03Z", None)
    assert [(c.text.split()[0], c.url) for c in row.c] == [("Head", "/u1"), ("Alone", None)]


def test_links(spark):
    html = '<a href="/1">one</a><!-- <a href="/no">no</a> --><p><A class="x" HREF="/2"><b>ニュース</b></A></p><a name="z">none</a>'
    links = frame(spark, html).select(pg.extract_links(F.col("html")).alias("l"))
    assert [(a.title, a.url) for a in links.first().l] == [("one", "/1"), ("ニュース", "/2")]
    assert links.select(pg.link_by_text(F.col("l"), "ニュース")).first()[0] == "/2"


TECH = """<div class="mid"><article><a><p>who</p></a><time datetime="2022-05-01"></time><h2><a href="/i/1">T1</a></h2>
<div><a href="/tags/x">x</a><a href="/users/u">u</a><a href="/tags/y">y</a></div></article></div>
<div class="low"><article><a><p>her</p></a><time datetime="2022-05-02"></time><h2><a href="/i/2">T2</a></h2></article>
<article><a><p>her</p></a><time datetime="2022-05-03"></time><h2><a href="/i/3">T3</a></h2></article></div>"""
TECH_RULES = json.dumps({"regions": {"top": "div.mid", "new": "div.low"}, "card": "article", "writer": "a p", "title": "h2",
                         "tags": "div a", "tag_mark": "tag"})


def test_tech_job(spark):
    conf = spark.createDataFrame([("w",), ("v",)], "word string")
    pages = spark.createDataFrame([("s/w", TECH), ("s/v", TECH)], "url string, html string")
    columns = "word string, writer string, date string, title string, url string, site string, site_url string, pick_up boolean, summary string"
    card = lambda w, n, d, top: (w, "who" if top else "her", d, f"T{n}", f"/i/{n}", "S", "u", top, "none")
    history = spark.createDataFrame([card("w", 1, "2022-05-01", True), card("w", 2, "2022-05-02", False)], columns)
    out = jobs.tech_articles(conf, pages, history, TECH_RULES, "S", "u", "s/", "top")
    assert [r.tags for r in out["articles"].filter("pick_up AND word = 'w'").collect()] == [["x", "y"]]
    assert sorted((r.word, r.title) for r in out["new"].collect()) == [("v", "T1"), ("v", "T2"), ("v", "T3"), ("w", "T3")]
    assert out["pages"].count() == 4
    page = json.loads(out["pages"].filter("title = 'T1'").first().payload)["properties"]
    assert page["タグ"]["multi_select"] == [{"name": "x"}, {"name": "y"}] and page["注目"]["checkbox"] is True


def test_rules_job(spark):
    conf = spark.createDataFrame([("Daily News", "eco", "l1", "https://d.example/top/", RULES, BODY),
                                  ("Other", "x", "l1", "https://o.example/", RULES, BODY),
                                  ("Daily News", "pol", "l2", "https://d.example/", RULES, BODY)],
                                 "site string, category string, url string, base_url string, block_rules string, body_rules string")
    pages = spark.createDataFrame([("l1", 0, LIST_PAGE), ("l2", 1, "MARK" + LIST_PAGE)], "url string, page_no bigint, html string")
    details = spark.createDataFrame([("https://d.example/n/1", DETAIL)], "url string, html string")
    history = spark.createDataFrame([("Daily News_eco", "Daily News", "eco", "Second", None, None, "https://d.example/top/n/2", None)],
                                    "target string, site string, category string, headline string, summary string, author string, url string, date string")
    out = jobs.news_by_rules(conf, pages, details, history, "Daily", "MARK")
    assert sorted((r.category, r.url) for r in out["topics"].collect()) == [("eco", "https://d.example/n/1"), ("eco", "https://d.example/top/n/2")]
    assert [r.headline for r in out["new"].collect()] == ["First & best"]
    assert [r.url for r in out["refused"].collect()] == ["l2"]
    blocks = [json.loads(r.payload) for r in out["blocks"].orderBy("block_pos").collect()]
    assert [b["type"] for b in blocks] == ["paragraph", "embed", "paragraph", "paragraph"]
    assert out["pages"].first().page_key == blocks[0]["id"]


def test_cards_job(spark):
    front = '<article>Big Summary1 <h3><a href="u1">x</a></h3></article><article>Old Text <h3><a href="u2">x</a></h3></article>'
    body = "".join(f"<p>p{i}</p>" for i in range(7))
    meta = '<meta name="article.published" content="2022-05-01T15:00:00Z">'
    pages = spark.createDataFrame([("front", front)], "url string, html string")
    details = spark.createDataFrame([("u1", meta + body), ("u2", meta + "<p>short</p>")], "url string, html string")
    history = spark.createDataFrame([("S", "Old", "Text", "u2", None, "2022-05-02T00:00:00+09:00")],
                                    "site string, headline string, summary string, url string, author string, date string")
    out = jobs.news_cards(pages, details, history, "S")
    assert [r.headline for r in out["new"].collect()] == ["Big"]
    # Both share the date of the new one, so both are published.
    assert sorted(r.headline for r in out["pages"].collect()) == ["Big", "Old"]
    assert [json.loads(r.payload)["paragraph"]["rich_text"][0]["plain_text"] for r in out["blocks"].collect()] == ["p2"]


def test_trend_jobs(spark):
    day = F.lit("2022-05-01 12:30:00").cast("timestamp_ntz")
    ranked = spark.createDataFrame([("us", 1, "cat"), ("us", 2, "dog"), ("japan", 1, "cat"), ("us", 21, "late")],
                                   "country string, rank int, word string").withColumn("ts", day)
    conf = spark.createDataFrame([("us", "https://old.example", 0), ("us", "https://news.g.example/s", 1), ("japan", "https://else.example", 2)],
                                 "country string, search_url string, pos int")
    items = "".join(f'<h3><a href="./a/{i}">t{i}</a></h3>' for i in range(12))
    found = spark.createDataFrame([("https://news.g.example/s", "cat", items)], "search_url string, word string, html string")
    memory = spark.createDataFrame([("google", "cat", "猫"), ("google", "t0", "零")], "engine string, src string, dst string")
    out = jobs.trend_country(ranked, conf, found, memory, "google")
    blocks = [json.loads(r.payload)["heading_1"] for r in out["blocks"].collect()]
    heads = sorted(b["rich_text"][0]["plain_text"] for b in blocks)
    assert heads == ["1 : cat", "1 : cat\n [G翻訳] 猫", "2 : dog"]
    children = next(b["children"] for b in blocks if "猫" in b["rich_text"][0]["plain_text"])
    assert len(children) == 11
    assert children[0]["paragraph"]["rich_text"][0]["text"] == {
        "content": "t0\n [G翻訳] 零", "link": {"type": "url", "url": "https://news.g.example/a/0"}}
    page = {r.name: json.loads(r.payload)["properties"] for r in out["pages"].collect()}["trend  us"]
    assert [t["name"] for t in page["Tag"]["multi_select"]] == ["cat", "dog", "@2022年", "@05月", "@05月01日"]
    assert page["Date"]["date"]["start"] == "2022-05-01T12:30:00+09:00"
    matrix = {(r.source, r.word): r["rank"] for r in out["matrix"].collect()}
    assert matrix[("us", "dog")] == 2 and matrix[("us", "@2022年")] == 99 and ("us", "late") not in matrix


def test_realtime_job(spark):
    rank_page = ('<div class="main"><article>ad</article><article><h2>now</h2><ol><li>1<a href="/r/1">cat</a></li></ol>2<b>dog</b></article>'
                 '<ol><li><a href="/r/2">second</a></li></ol></div>')
    rules = json.dumps({"region": "div.main", "links": "ol > li > a", "block": "article", "block_no": 1})
    ranking = spark.createDataFrame([("rt", "https://s.example/top", rank_page)], "name string, url string, html string").withColumn(
        "ts", F.lit("2022-05-01").cast("timestamp_ntz"))
    results = spark.createDataFrame([("https://s.example/r/1", '<a href="https://n.example/f">ニュース</a>')], "url string, html string")
    feed = "".join(f'<li><a href="https://n.example/{i}">n{i}</a></li>' for i in range(9))
    feeds = spark.createDataFrame([("https://n.example/f", feed)], "url string, html string")
    out = jobs.trend_realtime(ranking, results, feeds, rules, "ニュース")
    heads = [json.loads(r.payload)["heading_1"] for r in out["blocks"].orderBy("block_pos").collect()]
    assert [(h["rich_text"][0]["plain_text"], len(h["children"])) for h in heads] == [("1 : cat", 7), ("2 : dog", 0)]


def test_links_of_every_quoting(spark):
    html = """<a href="/q?a=1&amp;b=2">x&nbsp;y</a><a class=c href='/single'>s</a><A HREF=/bare>b</A>
    <a data-href="/no" href="/yes">d</a><a title="a > b href='/t'" href="/u">u</a><a name="n">none</a><a href="/v">&#x65E5;&#26412; &amp;lt; &zz;</a>"""
    links = frame(spark, html).select(pg.extract_links(F.col("html")).alias("l")).first()["l"]
    assert [(a["title"], a["url"]) for a in links] == [
        ("x\u00a0y", "/q?a=1&b=2"), ("s", "/single"), ("b", "/bare"), ("d", "/yes"), ("u", "/u"), ("日本 &lt; &zz;", "/v")]


def test_references_of_no_character(spark):
    rows = spark.createDataFrame([("&#0;",), ("&#xD800;",), ("&#x110000;",), ("&#99999999999999999999;",), ("&#x1F600;",), (None,), ("",)], "t string")
    got = [r[0] for r in rows.select(pg.decode_references(F.col("t"))).collect()]
    assert got == ["�"] * 4 + ["\U0001f600", None, ""]


def test_meta_attributes_and_cards_of_every_form(spark):
    html = """<html data-lang='xx' lang='de'><meta content='A &amp; B' name=author>
    <article><h3>T</h3><p><a href="/other">o</a></p></article><article><h3>T</h3><h3><a href='/in'>i</a></h3></article>
    <ul><li><a href="/1">1</a><ul><li><a href="/2">2</a></li></ul></li><li><a href="/3">3</a></li></ul>"""
    row = frame(spark, html).select(
        pg.extract_attribute(F.col("html"), "html", "lang").alias("lang"), pg.extract_meta(F.col("html"), "Author").alias("author"),
        pg.extract_cards(F.col("html")).alias("cards"), pg.element_links(F.col("html"), "li").alias("items")).first()
    assert (row["lang"], row["author"]) == ("de", "A & B")
    assert [c["url"] for c in row["cards"]] == [None, "/in"]
    assert [i["url"] for i in row["items"]] == ["/1", "/2", "/3"]


def test_pages_are_parsed_once_and_freed(spark, tmp_path):
    """One evaluation in the query's plan; a tree goes without the garbage collector."""
    from newsdesk.queries.pages import extract_body

    frame(spark, DETAIL, "<p>one<p>two").write.parquet(str(tmp_path / "pages.parquet"))
    rows = extract_body(spark, str(tmp_path))
    assert rows._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [(r.pos, r.kind, r.value) for r in rows.filter("page_id = 1").collect()] == [(0, "paragraph", "one"), (1, "paragraph", "two")]
    gc.disable()
    try:
        root = pg._tree(DETAIL)
        gone = [weakref.ref(root), *(weakref.ref(n) for n in root.walk())]
        assert all(n.up is not None for n in root.walk())
        del root
        assert len(gone) > 5 and not any(ref() for ref in gone)
    finally:
        gc.enable()
