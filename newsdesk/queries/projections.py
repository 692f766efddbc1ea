"""Projections, filters and predicates (B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import links as ln
from newsdesk.functions import pages as pg
from newsdesk.functions import payloads as pl
from newsdesk.operators import corpus, trends
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.sources import tables


@query("filter_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def filter_contains(spark, sf):
    return tables.filter_contains(st.table(spark, sf, "part"), "p_name", "ring").select("p_partkey", "p_name")


@query("lookup_cell", "SELECT n_regionkey FROM nation WHERE n_name = 'NATION_7'")
def lookup_cell(spark, sf):
    return tables.lookup_cell(st.table(spark, sf, "nation"), "n_name", "NATION_7", "n_regionkey")


@query("first_value", "SELECT arg_min(c_mktsegment, c_custkey) AS c_mktsegment FROM customer")
def first_value(spark, sf):
    return tables.first_value(st.table(spark, sf, "customer"), "c_custkey", "c_mktsegment")


@query("select_by_name", "SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def select_by_name(spark, sf):
    return tables.select_by_name(st.table(spark, sf, "orders"), "o_order")


@query("drop_columns", "SELECT doc_id, lang, source, n_chars FROM documents")
def drop_columns(spark, sf):
    return st.table(spark, sf, "documents").drop("text")


@query("filter_tag", f"WITH {st.SNAP} SELECT source, ts FROM snap WHERE word = 'u1'")
def filter_tag(spark, sf):
    records = trends.snapshot_tags(st.snapshot(spark, sf), ["source", "ts"], "ts")
    return trends.filter_tag(records, "u1").select("source", "ts")


SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINES = r"""l AS (
  SELECT doc_id, unnest(ls) AS line, (generate_subscripts(ls, 1) - 1)::BIGINT AS line_no FROM (
    SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r') AS ls
    FROM documents))"""


@query("filter_content_lines", rf"""WITH {LINES}
SELECT doc_id, line_no, regexp_replace(line, '{SPACES}+$', '') AS stream
FROM l WHERE line <> '' AND NOT contains(line, 'the ')""")
def filter_content_lines(spark, sf):
    kept = corpus.content_lines(st.table(spark, sf, "documents"), "doc_id", "text", "the ")
    return kept.withColumn("line_no", F.col("line_no").cast("bigint"))


@query("route_by_host", "SELECT page_id, contains(url, '//blog.') AS is_blog FROM pages")
def route_by_host(spark, sf):
    return st.table(spark, sf, "pages").select(
        "page_id", ln.link_host_contains(F.col("url"), "//blog.").alias("is_blog"))


@query("drop_property_if", """SELECT d.doc_id, l.doc_id IS NOT NULL AS has_date
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def drop_property_if(spark, sf):
    docs, labels = st.table(spark, sf, "documents"), st.table(spark, sf, "labels")
    rated = docs.select("doc_id", "source").join(labels.select("doc_id", "quality"), "doc_id", "left")
    blank = F.lit(None).cast("string")
    page = pl.news_page(blank, F.col("source"), blank, blank, blank, F.col("source"), F.col("quality").cast("string"))
    made = F.get_json_object(F.to_json(page), f"$.properties.{pl.NEWS['date']}")
    return rated.select("doc_id", made.isNotNull().alias("has_date"))


@query("rename_relabel", "SELECT 'world' AS place, r_regionkey AS no, r_name AS label FROM region")
def rename_relabel(spark, sf):
    return tables.relabel(st.table(spark, sf, "region"), ["place", "no", "label"], {"x": F.lit("world")})


@query("cast_columns", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus FROM orders")
def cast_columns(spark, sf):
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return tables.ids_to_text(orders, ["o_orderkey", "o_custkey"])


@query("literal_columns", """SELECT page_id, url, 'site' AS site, 'https://site.example/' AS site_url,
  false AS pick_up, 'none' AS summary FROM pages""")
def literal_columns(spark, sf):
    constants = {"site": "site", "site_url": "https://site.example/", "pick_up": False, "summary": "none"}
    pages = st.table(spark, sf, "pages").select("page_id", "url")
    return pages.withColumns({k: F.lit(v) for k, v in constants.items()})


@query("quarantine_marker", "SELECT page_id, contains(html, 'Nicht') AS refused FROM pages")
def quarantine_marker(spark, sf):
    usable, refused = tables.quarantine(st.table(spark, sf, "pages"), "html", "Nicht")
    return usable.select("page_id", F.lit(False).alias("refused")).unionByName(
        refused.select("page_id", F.lit(True).alias("refused")))


@query("search_keyword", rf"""WITH t AS (SELECT page_id,
  {st.sql_text("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")} AS title FROM pages)
SELECT page_id, title FROM t WHERE contains(lower(title), 'the')""")
def search_keyword(spark, sf):
    title = pg.inner_text(F.regexp_extract("html", r"(?is)<title>(.*?)</title>", 1))
    return tables.search_keyword(st.table(spark, sf, "pages").select("page_id", title.alias("title")), "title", "The")
