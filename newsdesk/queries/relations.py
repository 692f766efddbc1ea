"""Joins (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import payloads as pl
from newsdesk.operators import corpus, joins, threads
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.session import tune


@query("semi_join_new_dates", """SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate IN (SELECT o_orderdate FROM orders WHERE o_totalprice > 450000)""")
def semi_join_new_dates(spark, sf):
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    fresh = orders.filter("o_totalprice > 450000")
    return joins.semi_join_new_dates(orders.drop("o_totalprice"), fresh, "o_orderdate")


@query("join_author", """SELECT o_orderkey, o_custkey, c_name AS user_c_name, c_mktsegment AS user_c_mktsegment
FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_author(spark, sf):
    orders = st.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = st.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.join_author(orders, customer, "o_custkey", "c_custkey")


@query("join_detail", """SELECT d.doc_id, d.n_chars, CASE WHEN l.doc_id IS NULL THEN d.lang ELSE 'rated' END AS lang,
  coalesce(l.quality, -1)::BIGINT AS quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def join_detail(spark, sf):
    topics = st.table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    details = st.table(spark, sf, "labels").select("doc_id", F.lit("rated").alias("lang"), "quality")
    joined = joins.join_detail(topics, details, "doc_id")
    return joined.withColumn("quality", F.coalesce("quality", F.lit(-1)).cast("bigint"))


@query("cross_config", """SELECT c_custkey, s_name FROM customer JOIN (
  SELECT s_nationkey, arg_max(s_name, s_suppkey) AS s_name FROM supplier GROUP BY s_nationkey)
ON c_nationkey = s_nationkey""")
def cross_config(spark, sf):
    rows = st.table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("s_nationkey"))
    conf = st.table(spark, sf, "supplier")
    return joins.apply_config(rows, conf, "s_nationkey", "s_name", "s_suppkey").select("c_custkey", "s_name")


@query("resolve_thread", f"""WITH RECURSIVE
posts AS (SELECT conv_id * {st.POSTS_PER_CHAIN} + turn AS id,
                 CASE WHEN turn > 0 THEN conv_id * {st.POSTS_PER_CHAIN} + turn - 1 END AS parent FROM conversations),
chain(start_id, depth, post_id) AS (
  SELECT id, 0::BIGINT, id FROM posts WHERE id NOT IN (SELECT parent FROM posts WHERE parent IS NOT NULL)
  UNION ALL
  SELECT start_id, depth + 1, p.parent FROM chain JOIN posts p ON p.id = chain.post_id
  WHERE p.parent IN (SELECT id FROM posts) AND p.parent <> p.id)
SELECT start_id, depth, post_id FROM chain""")
def resolve_thread(spark, sf):
    post_id = F.col("conv_id") * st.POSTS_PER_CHAIN + F.col("turn")
    posts = st.table(spark, sf, "conversations").select(
        post_id.alias("id"), F.when(F.col("turn") > 0, post_id - 1).alias("parent")
    )
    answered = posts.select(F.col("parent").alias("id"))
    leaves = posts.select("id").join(answered, "id", "left_anti")
    return threads.resolve_thread(posts, leaves, "id", "parent")


@query("title_lookup", """SELECT source, min(doc_id) AS doc_id, arg_min(n_chars, doc_id) AS n_chars
FROM documents GROUP BY source""")
def title_lookup(spark, sf):
    docs = st.table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return joins.title_lookup(docs, docs.select("source"), "source", "doc_id")


@query("anti_join_stopwords", r"""WITH counts AS MATERIALIZED (
  SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents) GROUP BY token),
stop AS MATERIALIZED (SELECT token FROM counts ORDER BY n DESC, token LIMIT 20)
SELECT c.token, c.n FROM counts c ANTI JOIN stop s ON c.token = s.token""")
def anti_join_stopwords(spark, sf):
    counts = st.counts(spark, sf)
    return corpus.anti_join_stopwords(counts, corpus.frequency_stopwords(counts, top_n=20))


@query("newest_copies", """WITH newest AS (SELECT lang, source, max(doc_id) AS doc_id FROM documents GROUP BY lang, source)
SELECT d.doc_id, n.doc_id AS landed, t.n_chars, md5(t.text) AS body FROM documents d
JOIN newest n ON d.lang = n.lang AND d.source = n.source JOIN documents t ON t.doc_id = n.doc_id""")
def newest_copies(spark, sf):
    """Every document with the last one of its language and source, as if these named a page that landed again and again."""
    docs = tune(spark).read.parquet(f"{sf}/documents.parquet")
    landed = docs.select("lang", "source", F.col("doc_id").alias("landed"), "n_chars", "text")
    newest = joins.newest_copies(landed, ["lang", "source"], "landed")
    rows = joins.join_unique(docs.select("doc_id", "lang", "source"), newest, ["lang", "source"])
    return rows.select("doc_id", "landed", "n_chars", F.md5(F.col("text").cast("binary")).alias("body"))


@query("join_detail_newest", """SELECT d.doc_id, d.n_chars, CASE WHEN l.doc_id IS NULL THEN d.lang ELSE 'rated' || l.quality END AS lang
FROM documents d LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) l USING (doc_id)""")
def join_detail_newest(spark, sf):
    """Labels landed three times, the right ones last."""
    topics = st.table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    labels = st.table(spark, sf, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    copies = labels.withColumn("landed", F.explode(F.array(F.lit(2), F.lit(3), F.lit(1))))
    details = copies.select("doc_id", "landed", F.when(F.col("landed") == 3, F.concat(F.lit("rated"), "quality")).otherwise(F.lit("old")).alias("lang"))
    return joins.join_detail(topics, details, "doc_id", newest="landed").select("doc_id", "n_chars", "lang")


def _memory(spark, sf):
    names = st.table(spark, sf, "part").select("p_name", "p_type").distinct()
    google = names.filter("p_name LIKE '%ring%'").select(F.lit("google").alias("engine"), "p_name")
    deepl = names.filter("p_name LIKE 'small%'").select(F.lit("deepl").alias("engine"), "p_name")
    both = google.unionByName(deepl).distinct()
    return both.select("engine", F.col("p_name").alias("src"), F.upper("p_name").alias("dst"))


@query("translate_lookup", """WITH rows AS (SELECT p_partkey, p_name,
  CASE p_size % 3 WHEN 0 THEN 'google' WHEN 1 THEN 'deepl' ELSE 'off' END AS engine,
  CASE WHEN p_brand = 'Brand#1' THEN 'trend  japan' ELSE 'trend  ' || p_brand END AS title FROM part)
SELECT p_partkey, p_name, engine, title, CASE
  WHEN contains(title, 'japan') THEN p_name
  WHEN engine = 'google' AND p_name LIKE '%ring%' THEN p_name || chr(10) || ' [G翻訳] ' || upper(p_name)
  WHEN engine = 'deepl' AND p_name LIKE 'small%' THEN p_name || chr(10) || ' [Deepl翻訳] ' || upper(p_name)
  ELSE p_name END AS shown FROM rows""")
def translate_lookup(spark, sf):
    kind = F.col("p_size") % 3
    rows = st.table(spark, sf, "part").select(
        "p_partkey", "p_name",
        F.when(kind == 0, "google").when(kind == 1, "deepl").otherwise("off").alias("engine"),
        F.concat(F.lit("trend  "), F.when(F.col("p_brand") == "Brand#1", "japan").otherwise(F.col("p_brand"))).alias("title"),
    )
    return joins.translate_lookup(rows, _memory(spark, sf), "engine", "p_name", "shown", "title")


@query("page_block_key", """SELECT sha256(conv_id::VARCHAR) AS page_key, turn, role,
  count(*) OVER (PARTITION BY conv_id) AS turns FROM conversations""")
def page_block_key(spark, sf):
    talks = st.table(spark, sf, "conversations").withColumn("page_key", pl.page_key(F.col("conv_id")))
    pages = talks.groupBy("page_key").agg(F.count("*").alias("turns"))
    return joins.link_blocks(talks.select("page_key", "turn", "role"), pages)
