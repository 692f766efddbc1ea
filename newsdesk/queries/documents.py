"""Nested page and block documents (P)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import payloads as pl
from newsdesk.functions import text as tx
from newsdesk.operators import trends
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.queries.sources import PARAGRAPH_BLOCK
from newsdesk.sources import sinks

NEWS_SQL = {
    "カテゴリ": st.j_choice("coalesce(lang, ' ')"),
    "ヘッドライン": st.j_text("source", "'https://site.example/' || d.doc_id", "title"),
    "サマリ": st.j_text("text"),
    "記者": st.j_text("' '"),
    "ニュースサイト": st.j_text("'site'"),
}


@query("payload_news", f"""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN {st.j_page(**NEWS_SQL)}
  ELSE {st.j_page(**NEWS_SQL, 日時=st.j_date("'2024-01-01T00:00:00+09:00'"))} END AS payload
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def payload_news(spark, sf):
    labels = st.table(spark, sf, "labels").select("doc_id", F.lit("2024-01-01T00:00:00+09:00").alias("date"))
    docs = st.table(spark, sf, "documents").join(labels, "doc_id", "left")
    url = F.concat(F.lit("https://site.example/"), "doc_id")
    payload = pl.news_page(F.col("lang"), F.col("source"), url, F.col("text"),
                           F.lit(None).cast("string"), F.lit("site"), F.col("date"))
    return docs.select("doc_id", F.to_json(payload).alias("payload"))


@query("payload_article", "SELECT doc_id, " + st.j_page(
    タグ=st.j_choices("[lang, source]"), タイトル=st.j_text("source", "'https://site.example/' || doc_id", "title"),
    ライター=st.j_text("lang"), サマリー=st.j_text("'none'"), サイト=st.j_text("'site'", "'https://site.example/'"),
    掲載日時=st.j_date("'2024-01-01'", "Asia/Tokyo"), 注目="json_object('checkbox', n_chars > 2000, 'type', 'checkbox')",
) + " AS payload FROM documents")
def payload_article(spark, sf):
    payload = pl.article_page(
        F.array("lang", "source"), F.col("source"), F.concat(F.lit("https://site.example/"), "doc_id"), F.col("lang"),
        F.lit("none"), F.lit("site"), F.lit("https://site.example/"), F.lit("2024-01-01"), F.col("n_chars") > 2000)
    return st.table(spark, sf, "documents").select("doc_id", F.to_json(payload).alias("payload"))


@query("payload_post", "SELECT event_id, " + st.j_page(
    ツイートタイプ=st.j_choice("event_type"), ユーザーID=st.j_text("user_id::VARCHAR"), ツイートID=st.j_text("event_id::VARCHAR"),
    ツイート=st.j_text("props", "'https://posts.example/' || event_id"),
    ツイート日時=st.j_date("strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000+09:00'"),
    ユーザー名=st.j_text("'u' || user_id", kind="title"), 参照URL=st.j_text("'[ LINK ]'", "'https://ref.example/' || user_id"),
) + " AS payload FROM events")
def payload_post(spark, sf):
    from newsdesk.functions import times as tm

    payload = pl.post_page(
        F.col("event_type"), F.col("user_id"), F.col("event_id"), F.col("props"),
        F.concat(F.lit("https://posts.example/"), "event_id"), tm.utc_to_jst_text(F.col("ts")),
        F.concat(F.lit("u"), "user_id"), F.lit("[ LINK ]"), F.concat(F.lit("https://ref.example/"), "user_id"))
    return st.table(spark, sf, "events").select("event_id", F.to_json(payload).alias("payload"))


TREND_TAGS = f"""{st.SNAP}, lists AS (SELECT source, ts, list(word ORDER BY rank) ||
  ['@' || strftime(ts, '%Y') || '年', '@' || strftime(ts, '%m') || '月', '@' || strftime(ts, '%m') || '月' || strftime(ts, '%d') || '日'] AS tags
  FROM snap GROUP BY source, ts)"""


@query("payload_trend", f"WITH {TREND_TAGS} SELECT source, ts, " + st.j_page(
    Tag=st.j_choices("tags"), Translate=st.j_choice("'off'"), Name=st.j_text("'trend  ' || source", kind="title"),
    Date=st.j_date("strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+09:00'")) + " AS payload FROM lists")
def payload_trend(spark, sf):
    from newsdesk.functions import times as tm

    lists = trends.snapshot_lists(st.snapshot(spark, sf), ["source", "ts"])
    tags = pl.trend_page_tags(F.transform("ranked", lambda e: e["word"]), F.col("ts"))
    stamp = tm.compact_to_iso(tm.to_compact(F.col("ts")))
    payload = pl.trend_page(tags, F.lit("off"), F.concat(F.lit("trend  "), "source"), stamp)
    return lists.select("source", "ts", F.to_json(payload).alias("payload"))


@query("trend_page_tags", f"WITH {TREND_TAGS} SELECT source, ts, array_to_string(tags, '|') AS tags FROM lists")
def trend_page_tags(spark, sf):
    lists = trends.snapshot_lists(st.snapshot(spark, sf), ["source", "ts"])
    tags = pl.trend_page_tags(F.transform("ranked", lambda e: e["word"]), F.col("ts"))
    return lists.select("source", "ts", F.array_join(tags, "|").alias("tags"))


@query("text_objects", f"""SELECT p_partkey, json_array({st.j_run("p_name", "p_brand", "blue")}, {st.j_run("p_type", color="blue")})::VARCHAR AS runs
FROM part""")
def text_objects(spark, sf):
    links = F.create_map(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.lit(None).cast("string"))
    return st.table(spark, sf, "part").select("p_partkey", F.to_json(pl.text_objects(links, "blue")).alias("runs"))


@query("block_object", f"""SELECT p_partkey, 'embed' AS kind,
  {st.j_block("p_brand", "embed", "json_object('url', p_name)")}::VARCHAR AS block FROM part
UNION ALL SELECT p_partkey, 'paragraph', {st.j_block("p_brand", "paragraph",
    f"json_object('rich_text', json_array({st.j_run('p_name')}), 'color', 'default')")}::VARCHAR FROM part
UNION ALL SELECT p_partkey, 'heading', json_object('object', 'block', 'id', p_brand, 'has_children', true, 'type', 'heading_1',
  'heading_1', json_object('rich_text', json_array({st.j_run('p_name')}), 'color', 'blue', 'children', json_array(
    {st.j_block("p_brand", "paragraph", f"json_object('rich_text', json_array({st.j_run('p_type')}), 'color', 'default')")})))::VARCHAR FROM part""")
def block_object(spark, sf):
    part, key = st.table(spark, sf, "part"), F.col("p_brand")
    child = pl.paragraph_block(key, F.array(pl.text_run(F.col("p_type"))))
    kinds = {
        "embed": pl.embed_block(key, F.col("p_name")),
        "paragraph": pl.paragraph_block(key, F.array(pl.text_run(F.col("p_name")))),
        "heading": pl.heading_block(key, F.col("p_name"), F.array(child)),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), F.to_json(b).alias("block")) for k, b in kinds.items()])
    return part.select("p_partkey", F.inline(rows))


@query("body_to_blocks", f"""WITH d AS (SELECT doc_id::VARCHAR AS page_key,
  list_filter(string_split(text, '.'), lambda x: x <> '') AS ls FROM documents),
l AS (SELECT page_key, unnest(ls) AS line, (generate_subscripts(ls, 1) - 1)::BIGINT AS block_pos FROM d)
SELECT page_key, block_pos, CASE WHEN contains(line, 'the') THEN {st.j_block("page_key", "embed", "json_object('url', line)")}
  ELSE {PARAGRAPH_BLOCK} END::VARCHAR AS payload FROM l""")
def body_to_blocks(spark, sf):
    docs = st.table(spark, sf, "documents")
    key = F.col("doc_id").cast("string")
    kind = lambda t: F.when(t.contains("the"), F.lit("figure")).otherwise(F.lit("paragraph"))
    body = F.transform(F.split("text", r"\."), lambda t, i: F.struct(i.alias("pos"), kind(t).alias("kind"), t.alias("value")))
    blocks = sinks.block_rows(docs, key, pl.body_blocks(key, body))
    return blocks.withColumn("block_pos", F.col("block_pos").cast("bigint"))


@query("trend_to_blocks", f"""WITH {st.SNAP},
arts AS (SELECT event_type AS source, date_trunc('day', ts)::TIMESTAMP AS ts, 'u' || user_id AS word, event_id, props FROM events
  QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('day', ts), user_id ORDER BY event_id) <= 11),
heads AS (SELECT source, ts, rank, word, sha256(source || chr(1) || strftime(ts, '%Y-%m-%d %H:%M:%S')) AS page_key,
  list({{'title': props, 'url': 'https://e.example/' || event_id}} ORDER BY event_id) AS arts
  FROM snap JOIN arts USING (source, ts, word) GROUP BY source, ts, rank, word)
SELECT page_key, rank - 1 AS block_pos, json_object('object', 'block', 'id', page_key, 'has_children', true, 'type', 'heading_1',
  'heading_1', json_object('rich_text', json_array({st.j_run("rank || ' : ' || word")}), 'color', 'blue', 'children',
    list_transform(arts, lambda a: {st.j_block("page_key", "paragraph",
        f"json_object('rich_text', json_array({st.j_run('a.title', 'a.url')}), 'color', 'default')")})))::VARCHAR AS payload
FROM heads""")
def trend_to_blocks(spark, sf):
    from newsdesk.functions import times as tm

    articles = st.table(spark, sf, "events").select(
        F.col("event_type").alias("source"), tm.day(F.col("ts")).alias("ts"), F.concat(F.lit("u"), "user_id").alias("word"),
        F.col("event_id").alias("pos"), F.col("props").alias("title"), F.concat(F.lit("https://e.example/"), "event_id").alias("url"))
    nested = trends.nest_snapshot(st.snapshot(spark, sf), articles, ["source", "ts"])
    key = pl.page_key(F.col("source"), F.col("ts"))
    blocks = sinks.block_rows(nested, key, pl.trend_blocks(key, F.col("rank_list")))
    return blocks.withColumn("block_pos", F.col("block_pos").cast("bigint"))


@query("block_defaults", """SELECT d.doc_id, coalesce(l.quality::VARCHAR, ' ') AS url FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def block_defaults(spark, sf):
    labels = st.table(spark, sf, "labels").select("doc_id", "quality")
    docs = st.table(spark, sf, "documents").select("doc_id").join(labels, "doc_id", "left")
    block = pl.embed_block(F.col("doc_id").cast("string"), F.col("quality").cast("string"))
    return docs.select("doc_id", F.get_json_object(F.to_json(block), "$.embed.url").alias("url"))
