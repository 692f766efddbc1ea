"""Page extraction (X)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.functions import links as ln
from newsdesk.functions import pages as pg
from newsdesk.functions import selectors as sl
from newsdesk.functions import text as tx
from newsdesk.operators import ranking
from newsdesk.queries import standins as st
from newsdesk.queries.projections import SPACES
from newsdesk.queries.registry import query

LIST_RULES = json.dumps({"tag": "li", "class": "", "items": [["headline", "a", "None"], ["author", "b", "None"]]})
#: Every second list item gets an author, every third page a named author, every article links of its own.
MARKED = r"(<li>)(<a [^>]*>)([^<]*[aeiou])(</a>)"
AD_RULES = json.dumps({"tag": "div", "class": "ad", "items": []})
BODY_RULES = json.dumps({"time_attr": "datetime", "paragraph": ["p", ""], "figure": ["img", "", "src"]})
CARD_RULES = json.dumps({
    "regions": {"top": "body", "side": "nav"}, "card": "article", "writer": "h1", "title": "h1",
    "tags": "a", "tag_mark": "th",
})
REGION_RULES = json.dumps({"region": "body", "links": "ul > li > a", "block": "article", "block_no": 0})


@query("extract_links", rf"""WITH {st.SHOWN}, {st.LINKS}
SELECT page_id, pos, {st.sql_text('markup')} AS title, {st.SQL_RESOLVED} AS link FROM links WHERE pos < 5""")
def extract_links(spark, sf):
    capped = st.page_links(spark, sf).withColumn("links", ar.first_n(F.col("links"), 5))
    rows = ar.item_rows(capped, "links", "page_id", "url", item="a", pos="pos")
    return rows.select("page_id", F.col("pos").cast("bigint").alias("pos"), F.col("a.title").alias("title"),
                       ln.resolve_url(F.col("url"), F.col("a.url")).alias("link"))


@query("link_by_text", rf"""WITH {st.SHOWN}, {st.LINKS}
SELECT page_id, arg_min(href, pos) AS href FROM links WHERE {st.sql_text('markup')} = 'the' GROUP BY page_id""")
def link_by_text(spark, sf):
    found = st.page_links(spark, sf).select("page_id", pg.link_by_text(F.col("links"), "the").alias("href"))
    return found.filter("href IS NOT NULL")


@query("extract_meta", r"""SELECT page_id, regexp_extract(html, '(?i)<html\b[^>]*\blang="([^"]*)"', 1) AS lang,
  regexp_extract(html, '(?i)<meta\b[^>]*\bcharset="([^"]*)"', 1) AS charset,
  CASE page_id % 3 WHEN 0 THEN 'none' ELSE 'A & <' || page_id || '>' END AS author FROM pages""")
def extract_meta(spark, sf):
    """Pages without an author, with one before and one after the other attributes."""
    name = F.concat(F.lit("'A &amp; &lt;"), "page_id", F.lit("&#62;'"))
    meta = F.when(F.col("page_id") % 3 == 1, F.concat(F.lit("<meta name=author data-content='no' content="), name, F.lit("><title>"))).when(
        F.col("page_id") % 3 == 2, F.concat(F.lit("<META content="), name, F.lit(' name="Author"><title>'))).otherwise(F.lit("<title>"))
    html = F.replace("html", F.lit("<title>"), meta)
    return st.table(spark, sf, "pages").select(
        "page_id", pg.extract_attribute(html, "html", "lang").alias("lang"),
        pg.extract_attribute(html, "meta", "charset").alias("charset"),
        F.coalesce(pg.extract_meta(html, "author"), F.lit("none")).alias("author"))


CARDS = r"""cards AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)) AS markup FROM shown)"""


@query("extract_cards", rf"""WITH {st.SHOWN}, {CARDS},
w AS (SELECT page_id, list_filter(regexp_split_to_array({st.sql_text('markup')}, '{SPACES}+'), lambda x: x <> '') AS t FROM cards)
SELECT page_id, t[1] AS headline, regexp_replace(coalesce(t[2], t[1]), '[0-9]+$', '') AS summary,
  CASE page_id % 2 WHEN 0 THEN '/card/' || page_id || '?a=1&b=2' END AS link FROM w""")
def extract_cards(spark, sf):
    """The heading of every second card is a link."""
    link = F.concat(F.lit("<h1><b></b><a href='/card/"), "page_id", F.lit("?a=1&amp;b=2'>$1</a></h1>"))
    html = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("html", F.lit(r"(?is)<h1>(.*?)</h1>"), link)).otherwise(F.col("html"))
    cards = st.table(spark, sf, "pages").select("page_id", pg.extract_cards(html, link_in="h1").alias("cards"))
    rows = ar.item_rows(cards, "cards", "page_id", item="c")
    return rows.select("page_id", tx.headline_summary(F.col("c.text")).alias("h"), F.col("c.url").alias("link")).select("page_id", "h.*", "link")


@query("extract_element_text", rf"""WITH {st.SHOWN}, m AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)) AS markup FROM shown)
SELECT page_id, {st.sql_text('markup')} AS heading FROM m""")
def extract_element_text(spark, sf):
    pages = st.table(spark, sf, "pages").select("page_id", pg.element_markup(F.col("html"), "h1").alias("m"))
    return ar.item_rows(pages, "m", "page_id", item="markup").select("page_id", pg.inner_text(F.col("markup")).alias("heading"))


@query("extract_blocks", rf"""WITH {st.SHOWN}, li AS (SELECT page_id, url,
  unnest(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1)) AS markup,
  generate_subscripts(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1), 1) - 1 AS pos FROM shown),
a AS (SELECT page_id, url, pos, markup, regexp_extract(markup, 'href="([^"]*)"', 1) AS href FROM li)
SELECT page_id, pos, {st.sql_text('markup')} AS headline, CASE WHEN regexp_matches(markup, '[aeiou]</a>') THEN 'by ' || {st.sql_text('markup')}
  ELSE 'none' END AS author, {st.SQL_RESOLVED} AS link FROM a""")
def extract_blocks(spark, sf):
    """List items whose word ends in a vowel carry an author, which is that word."""
    pages = st.table(spark, sf, "pages")
    html = F.regexp_replace("html", MARKED, "$1$2$3$4<b>by $3</b>")
    blocks = pages.select("page_id", "url", F.inline(pg.extract_blocks(html, F.lit(LIST_RULES))))
    return blocks.select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.col("fields")["headline"].alias("headline"),
        F.coalesce(F.col("fields")["author"], F.lit("none")).alias("author"),
        ln.resolve_url(F.col("url"), F.col("href")).alias("link"))


@query("extract_blocks_by_class", r"""WITH m AS (SELECT page_id,
  unnest(regexp_extract_all(html, '<div class="ad">', 0)) AS x FROM pages) SELECT page_id, count(*) AS blocks FROM m GROUP BY page_id""")
def extract_blocks_by_class(spark, sf):
    pages = st.table(spark, sf, "pages")
    blocks = pages.select("page_id", F.explode(pg.extract_blocks(F.col("html"), F.lit(AD_RULES))).alias("b"))
    return blocks.groupBy("page_id").agg(F.count("*").alias("blocks"))


# An open paragraph ends where the next one starts or its article ends.
@query("extract_body", rf"""WITH {st.SHOWN}, m AS (SELECT page_id,
  regexp_extract_all(regexp_replace(html, '<p>', '</p><p>', 'g'), '(?s)<p>(.*?)(?:</p>|</article>)', 1) AS ps FROM shown),
p AS (SELECT page_id, unnest(ps) AS markup, (generate_subscripts(ps, 1) - 1)::BIGINT AS pos FROM m)
SELECT page_id, pos, 'paragraph' AS kind, {st.sql_text('markup')} AS value FROM p""")
def extract_body(spark, sf):
    pages = st.table(spark, sf, "pages")
    read = pages.select("page_id", pg.extract_body(F.col("html"), F.lit(BODY_RULES)).alias("a"))
    rows = ar.item_rows(read.select("page_id", F.col("a.body").alias("body")), "body", "page_id", item="b")
    return rows.select("page_id", F.col("b.pos").cast("bigint").alias("pos"), "b.kind", "b.value")


@query("extract_tagged_cards", rf"""WITH {st.SHOWN} SELECT page_id, 'top' AS region, 0::BIGINT AS pos,
  {st.sql_text("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")} AS writer,
  {st.sql_text("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")} AS title,
  CASE page_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'one' ELSE 'one|t' || page_id END AS tags, '2024-02-0' || (page_id % 9 + 1) AS date, '/th/1' AS url FROM shown""")
def extract_tagged_cards(spark, sf):
    """Cards with a time, a link in the heading, and up to two tag links among others."""
    pages = st.table(spark, sf, "pages")
    tags = F.when(F.col("page_id") % 4 == 0, F.lit("")).when(F.col("page_id") % 4 == 1, F.lit("<a href='/th/one'>one</a>")).otherwise(
        F.concat(F.lit("<a href='/th/one'>one</a><a href='/x/no'>no</a><a href='/th/t'>t"), "page_id", F.lit("</a>")))
    head = F.concat(F.lit("<time datetime='2024-02-0"), F.col("page_id") % 9 + 1, F.lit("'></time>"), tags, F.lit("<h1><a href='/th/1'></a>"))
    html = F.replace("html", F.lit("<h1>"), head)
    cards = pages.select("page_id", F.inline(pg.extract_tagged_cards(html, F.lit(CARD_RULES))))
    return cards.select("page_id", "region", F.col("pos").cast("bigint").alias("pos"), "writer", "title",
                        F.array_join(F.filter("tags", lambda t: t != ""), "|").alias("tags"), "date", "url")


@query("extract_region_text", rf"""WITH {st.SHOWN}, {st.LINKS},
arts AS (SELECT page_id, regexp_split_to_array(regexp_extract(html, '(?is)<article>(.*?)</article>', 1), '<[^>]*>') AS pieces FROM shown),
lines AS (SELECT page_id, list_filter(list_transform(pieces, lambda x: regexp_replace({st.sql_text("x")}, '^{SPACES}+|{SPACES}+$', '', 'g')), lambda x: x <> '') AS ls FROM arts),
hrefs AS (SELECT page_id, string_agg(href, '|' ORDER BY pos) AS links FROM links GROUP BY page_id)
SELECT page_id, coalesce(links, '') AS links, array_to_string(ls, chr(10)) AS block FROM lines LEFT JOIN hrefs USING (page_id)""")
def extract_region_text(spark, sf):
    pages = st.table(spark, sf, "pages")
    regions = pages.select("page_id", pg.extract_region_text(F.col("html"), F.lit(REGION_RULES)).alias("r"))
    return regions.select("page_id", F.array_join("r.links", "|").alias("links"), "r.block")


@query("cap_page_links", rf"""WITH {st.SHOWN}, {st.LINKS}
SELECT url, href FROM links QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) <= 3""")
def cap_page_links(spark, sf):
    rows = ar.item_rows(st.page_links(spark, sf), "links", "page_id", "url", item="a", pos="pos")
    return ranking.cap_per_group(rows, ["page_id"], ["pos"], 3).select("url", F.col("a.url").alias("href"))


SELECTOR_RULES = json.dumps({
    "nav": {"item": "nav > ul > li > a", "fields": {"text": {}, "url": {"take": "@href"}}},
    "second": {"item": "nav li:nth(1)", "fields": {"text": {"at": "a"}, "url": {"at": "a[href^=/]", "take": "@href"}}},
    "article": {"item": "body > article", "fields": {"text": {"at": "h1"}, "url": {"at": "p:nth(1)", "take": "text"}}},
    "head": {"item": "html[lang]", "fields": {"text": {"take": "@lang"}, "url": {"at": "head meta[charset]", "take": "@charset"}}},
    "news": {"item": "ul.feed li.ranked", "limit": 3, "fields": {"text": {"at": ".title"}, "url": {"at": ".more", "take": "@href"}}},
})


@query("select_records", rf"""WITH {st.SHOWN}, {st.LINKS},
m AS (SELECT page_id, regexp_extract_all(regexp_replace(html, '<p>', '</p><p>', 'g'), '(?s)<p>(.*?)(?:</p>|</article>)', 1) AS ps FROM shown)
SELECT 'nav' AS rule, page_id, pos, {st.sql_text('markup')} AS text, href AS url FROM links
UNION ALL SELECT 'second', page_id, 0, {st.sql_text('markup')}, href FROM links WHERE pos = 1
UNION ALL SELECT 'article', page_id, 0, {st.sql_text("regexp_extract(html, '(?is)<h1>(.*?)</h1>', 1)")}, {st.sql_text("coalesce(ps[2], '-')")} FROM shown JOIN m USING (page_id)
UNION ALL SELECT 'head', page_id, 0, regexp_extract(html, '(?i)<html\b[^>]*\blang="([^"]*)"', 1), regexp_extract(html, '(?i)<meta\b[^>]*\bcharset="([^"]*)"', 1) FROM pages
UNION ALL SELECT 'news', page_id, k - 1, 'Story ' || page_id || ' & ' || k, '/story/' || page_id || '/' || k FROM pages, range(1, 4) r(k) WHERE k <= page_id % 6""")
def select_records(spark, sf):
    """Five rules in one pass over pages that carry a feed of stories and advertisements."""
    story = lambda k: F.concat(
        F.lit('<li class="item ranked"><b class="big title">Story '), "page_id", F.lit(" &amp; "), k, F.lit("</b><a href='/story/"), "page_id", F.lit("/"), k,
        F.lit("' class=more>read</a></li><li class=item><b class=title>ad</b></li>"))
    feed = F.array_join(F.transform(F.sequence(F.lit(1), F.col("page_id") % 6), lambda k: F.when(F.col("page_id") % 6 > 0, story(k)).otherwise("")), "")
    html = F.concat(F.regexp_replace("html", "</body>", ""), F.lit('<ul class="x feed">'), feed, F.lit("</ul></body>"))
    pages = st.table(spark, sf, "pages").select("page_id", F.inline(sl.select_records(html, F.lit(SELECTOR_RULES))))
    return pages.select("rule", "page_id", F.col("pos").cast("bigint").alias("pos"), F.col("fields")["text"].alias("text"), F.coalesce(F.col("fields")["url"], F.lit("-")).alias("url"))
