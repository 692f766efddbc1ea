"""Scans, sources and sinks (A)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsdesk.functions import pages as pg
from newsdesk.functions import payloads as pl
from newsdesk.functions import text as tx
from newsdesk.operators import corpus, ranking, trends
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.sources import files, landed, publisher, sinks, tables
from newsdesk.sources.history import History


@query("read_table_pruned", "SELECT * FROM customer")
def read_table_pruned(spark, sf):
    customer = st.table(spark, sf, "customer")
    empty = customer.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in customer.schema])
    padded = customer.unionByName(empty).withColumn("note", F.lit(None).cast("string"))
    return tables.pruned(padded)


@query("ensure_table", "SELECT *, false AS before, true AS after FROM nation")
def ensure_table(spark, sf):
    nation = st.table(spark, sf, "nation")
    folder = st.scratch(spark)
    name = "nation_" + folder[-32:]
    before = tables.ensure_table(spark, name, nation.schema, folder)
    nation.write.insertInto(name)
    after = tables.ensure_table(spark, name, nation.schema, folder)
    return tables.read_table_pruned(spark, name).select("*", F.lit(before).alias("before"), F.lit(after).alias("after"))


def _stored(spark, sf) -> tuple[History, object]:
    past, batch = st.events_split(spark, sf)
    history = History(spark, st.scratch(spark), "event_id")
    history.merge(past, 0)
    return history, history.merge(batch, 1)


@query("merge_history", f"WITH {st.PARTS} SELECT * FROM b WHERE event_id IN ({st.FRESH})")
def merge_history(spark, sf):
    return _stored(spark, sf)[1]


@query("merge_history_table", f"""WITH {st.PARTS},
both_parts AS (SELECT *, 0 AS old FROM b UNION ALL SELECT *, 1 AS old FROM h)
SELECT event_id, user_id, event_type, value FROM both_parts
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY old, event_id) = 1""")
def merge_history_table(spark, sf):
    return _stored(spark, sf)[0].current().select(*st.COMPARED)


@query("csv_history_merge", f"WITH {st.PARTS} SELECT * FROM b WHERE event_id IN ({st.FRESH})")
def csv_history_merge(spark, sf):
    past, batch = st.events_split(spark, sf)
    folder = st.scratch(spark)
    files.csv_history_merge(past, f"{folder}/v0", f"{folder}/v1", "event_id")
    return files.csv_history_merge(batch, f"{folder}/v1", f"{folder}/v2", "event_id")


@query("csv_accumulate", """SELECT event_type, count(*)::BIGINT AS n,
  sum(round(value * 100)::BIGINT)::BIGINT AS cents FROM events GROUP BY event_type""")
def csv_accumulate(spark, sf):
    folder = st.scratch(spark)
    for turn, part in enumerate(st.events_split(spark, sf)):
        sums = part.groupBy("event_type").agg(
            F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")
        )
        total = files.csv_accumulate(sums, f"{folder}/v{turn}", f"{folder}/v{turn + 1}", "event_type")
    return total


@query("text_lines", r"""WITH l AS (
  SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents)
SELECT regexp_replace(line, '[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '')
  AS stream, count(*) AS n
FROM l WHERE line <> '' AND NOT contains(line, 'the ') GROUP BY 1""")
def text_lines(spark, sf):
    folder = st.scratch(spark)
    st.table(spark, sf, "documents").select("text").write.text(folder)
    read = files.text_lines(spark, folder, "the ")
    return read.groupBy("stream").agg(F.count("*").alias("n"))


@query("xml_docs", r"""SELECT doc_id::VARCHAR AS title,
  regexp_replace(text, '[\s\x{00}-\x{20}]+', '', 'g') AS body FROM documents""")
def xml_docs(spark, sf):
    safe = F.col("text")
    for raw, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        safe = F.replace(safe, F.lit(raw), F.lit(name))
    safe = F.regexp_replace(safe, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")
    markup = F.concat(F.lit('<doc title="'), F.col("doc_id"), F.lit('">'), safe, F.lit("</doc>"))
    docs = st.table(spark, sf, "documents").select(files.xml_doc(markup).alias("d"))
    body = F.regexp_replace(F.coalesce("d._VALUE", F.lit("")), r"[\x00-\x20]+", "")
    return docs.select(F.col("d._title").alias("title"), body.alias("body"))


@query("landed_posts", """SELECT event_id, user_id, ts, event_type AS text,
  (props->>'$.k')::BIGINT AS k FROM events""")
def landed_posts(spark, sf):
    props = landed.parse_props(F.col("props"), "k bigint")
    return st.table(spark, sf, "events").select(
        "event_id", "user_id", "ts", F.col("event_type").alias("text"), props["k"].alias("k")
    )


@query("landed_answers", """WITH a AS (SELECT *, user_id AS u, date_trunc('day', ts) AS d, max(event_id) OVER (PARTITION BY user_id, date_trunc('day', ts)) AS newest FROM events),
posts AS (SELECT 'post' AS kind, event_id AS id, event_type || CASE WHEN event_id = newest THEN '!' ELSE '' END AS text, strftime(ts, '%Y-%m-%d %H:%M:%S') AS created, user_id AS author,
  CASE WHEN event_id % 2 = 1 THEN 'https://ref.example/' || event_id END AS url, CASE WHEN event_id % 3 = 0 THEN event_id - 1 ELSE -9 END AS parent FROM a)
SELECT * FROM posts
UNION ALL SELECT 'user', u, 'name ' || max(newest), NULL, -9, NULL, -9 FROM a GROUP BY u
UNION ALL SELECT 'referenced', id, text, NULL, -9, NULL, -9 FROM (SELECT event_id - 1 AS id, 'was ' || event_id AS text FROM a WHERE event_id % 3 = 0)
UNION ALL SELECT 'refused', count(*), NULL, NULL, -9, NULL, -9 FROM (SELECT DISTINCT u, d FROM a)""")
def landed_answers(spark, sf):
    """One answer per user and day, written and read again: each also has an older copy of its newest post,
    the state of its user at that time, and a line cut off in the middle."""
    events = st.table(spark, sf, "events")
    newest = F.max("event_id").over(Window.partitionBy("user_id", F.to_date("ts")))
    rows = events.withColumn("newest", newest)
    odd = F.col("event_id") % 2 == 1
    url = F.concat(F.lit("https://ref.example/"), "event_id")
    text = F.concat("event_type", F.when(F.col("event_id") == F.col("newest"), "!").otherwise(""))
    post = F.struct(
        F.col("event_id").alias("id"), text.alias("text"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), F.col("user_id").alias("author_id"),
        F.when(odd, F.struct(F.array(F.struct(url.alias("url"), url.alias("expanded_url"))).alias("urls"))).alias("entities"),
        F.when(F.col("event_id") % 3 == 0, F.array(F.struct(F.lit("replied_to").alias("type"), (F.col("event_id") - 1).alias("id")))).alias("referenced_tweets"))
    side = F.when(F.col("event_id") % 3 == 0, F.struct((F.col("event_id") - 1).alias("id"), F.concat(F.lit("was "), "event_id").alias("text")))
    days = rows.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.collect_list(post).alias("data"), F.collect_list(side).alias("tweets"), F.max("newest").alias("newest_id"))
    user = F.struct(F.col("user_id").alias("id"), F.concat(F.lit("name "), "newest_id").alias("name"))
    answer = lambda data, tweets, newest_id: F.to_json(F.struct(
        data.alias("data"), F.struct(F.array(user).alias("users"), tweets.alias("tweets")).alias("includes"), F.struct(newest_id.alias("newest_id")).alias("meta")))
    last = F.filter("data", lambda p: p["id"] == F.col("newest_id"))
    older = F.transform(last, lambda p: p.withField("text", F.lit("old")))
    lines = F.array(answer(F.col("data"), F.col("tweets"), F.col("newest_id")), answer(older, F.slice("tweets", 1, 0), F.lit(-5).cast("bigint")),
                    F.substring(answer(F.col("data"), F.col("tweets"), F.col("newest_id")), 1, 30))
    folder = st.scratch(spark)
    days.select(F.explode(lines).alias("value")).write.text(folder)
    found = landed.read_answers(spark, folder)
    none = lambda *names: [(F.lit(-9).cast("bigint") if n in ("author", "parent") else F.lit(None).cast("string")).alias(n) for n in names]
    posts = found["posts"].select(F.lit("post").alias("kind"), "id", "text", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created"), F.col("author_id").alias("author"),
                                  F.get("entities.urls", F.lit(0))["url"].alias("url"), F.coalesce(landed.parent_of(F.col("referenced_tweets")), F.lit(-9)).alias("parent"))
    users = found["users"].select(F.lit("user").alias("kind"), "id", F.col("name").alias("text"), *none("created", "author", "url", "parent"))
    referenced = found["referenced"].select(F.lit("referenced").alias("kind"), "id", "text", *none("created", "author", "url", "parent"))
    refused = found["refused"].agg(F.count("*").alias("id")).select(F.lit("refused").alias("kind"), "id", *none("text", "created", "author", "url", "parent"))
    return posts.unionByName(users).unionByName(referenced).unionByName(refused)


@query("page_source", """SELECT url, max(page_id) AS page_id, arg_max(length(html), page_id)::BIGINT AS n
FROM pages GROUP BY url""")
def page_source(spark, sf):
    pages = st.table(spark, sf, "pages")
    found = tables.landed_pages(pages.select("url").distinct(), pages.withColumn("landed_at", F.col("page_id")))
    return found.select("url", "page_id", F.length("html").cast("bigint").alias("n"))


@query("ranked_source", f"WITH {st.SNAP} SELECT source, ts, rank, word FROM snap")
def ranked_source(spark, sf):
    lists = trends.snapshot_tags(st.snapshot(spark, sf), ["source", "ts"], "ts")
    plain = lists.withColumn("tags", F.filter("tags", lambda t: ~t.startswith("@")))
    return ranking.position_rank(plain, "tags").select("source", "ts", F.col("rank").cast("bigint").alias("rank"), "word")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def interest(spark, sf):
    """(region, keyword, value): account balances in cents by region and market segment."""
    customer = st.table(spark, sf, "customer")
    nation = st.table(spark, sf, "nation")
    region = st.table(spark, sf, "region")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    return rows.select(
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("keyword"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("value"),
    )


INTEREST = """interest AS (SELECT r_name AS region, c_mktsegment AS keyword,
  round(c_acctbal * 100)::BIGINT AS value
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("region_interest", f"WITH {INTEREST} SELECT region, " + ", ".join(
    f"coalesce(sum(value) FILTER (keyword = '{s}'), 0)::BIGINT AS \"{s}\"" for s in SEGMENTS
) + " FROM interest GROUP BY region")
def region_interest(spark, sf):
    return trends.region_interest(interest(spark, sf), SEGMENTS)


@query("stopword_source", f"WITH {st.TOK}, {st.TOP} SELECT token AS word FROM stop")
def stopword_source(spark, sf):
    folder = st.scratch(spark)
    frequent = corpus.top_ngrams(corpus.token_counts(st.words(spark, sf)), 20)
    padded = frequent.select(F.concat(F.lit("  "), "token", F.lit("　\n")).alias("value"))
    padded.write.text(folder)
    return files.stopwords(spark, folder)


LANGUAGES = [("en", "google"), ("fr", "deepl"), ("de", "off"), ("es", "google")]


@query("config_source", r"""WITH conf(lang, engine) AS (VALUES ('en', 'google'), ('fr', 'deepl'), ('de', 'off'), ('es', 'google'))
SELECT page_id, lang, engine FROM (
  SELECT page_id, regexp_extract(html, '(?i)<html\b[^>]*\blang="([^"]*)"', 1) AS lang FROM pages) JOIN conf USING (lang)""")
def config_source(spark, sf):
    conf = spark.createDataFrame(LANGUAGES, "lang string, engine string")
    pages = st.table(spark, sf, "pages")
    tagged = pages.select("page_id", pg.extract_attribute(F.col("html"), "html", "lang").alias("lang"))
    return tagged.join(conf, "lang")


def _doc_pages(spark, sf):
    docs = st.table(spark, sf, "documents")
    key = pl.page_key(F.col("source"), F.col("doc_id"))
    payload = pl.trend_page(F.array("lang"), F.lit("none"), F.col("source"), F.lit(None).cast("string"))
    return sinks.page_rows(docs, key, F.col("lang"), payload, "doc_id")


@query("publish_pages", f"""SELECT sha256(source || chr(1) || doc_id) AS page_key, lang AS database, doc_id, {st.j_page(
    Tag=st.j_choices("[lang]"), Translate=st.j_choice("'none'"), Name=st.j_text("source", kind="title"))} AS payload
FROM documents""")
def publish_pages(spark, sf):
    folder = st.scratch(spark)
    pages = _doc_pages(spark, sf)
    sinks.publish_pages(pages, folder)
    return spark.read.schema(pages.schema).json(folder).select(*pages.columns)


PARAGRAPH_BLOCK = st.j_block(
    "page_key", "paragraph", f"json_object('rich_text', json_array({st.j_run('line')}), 'color', 'default')")


@query("publish_blocks", f"""WITH d AS (
  SELECT sha256(source || chr(1) || doc_id) AS page_key,
         list_filter(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r'), lambda x: x <> '') AS ls
  FROM documents),
l AS (SELECT page_key, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS block_pos FROM d)
SELECT page_key, block_pos::BIGINT AS block_pos, {PARAGRAPH_BLOCK}::VARCHAR AS payload FROM l""")
def publish_blocks(spark, sf):
    folder = st.scratch(spark)
    docs = st.table(spark, sf, "documents")
    key = pl.page_key(F.col("source"), F.col("doc_id"))
    body = F.transform(
        tx.lines(F.col("text")),
        lambda t, i: F.struct(i.alias("pos"), F.lit("paragraph").alias("kind"), t.alias("value")),
    )
    sinks.publish_blocks(sinks.block_rows(docs, key, pl.body_blocks(key, body)), folder)
    return spark.read.parquet(folder).withColumn("block_pos", F.col("block_pos").cast("bigint"))


@query("publish_documents", f"""WITH d AS (
  SELECT doc_id, sha256(source || chr(1) || doc_id) AS page_key,
         list_filter(regexp_split_to_array(regexp_replace(text, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r'), lambda x: x <> '') AS ls
  FROM documents),
l AS (SELECT doc_id, page_key, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS block_pos FROM d)
SELECT page_key, block_pos::BIGINT AS block_pos, {PARAGRAPH_BLOCK}::VARCHAR AS payload, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS run FROM l""")
def publish_documents(spark, sf):
    """Two runs through the document writer, the first of them written twice."""
    folder = st.scratch(spark)
    docs = st.table(spark, sf, "documents")
    key = pl.page_key(F.col("source"), F.col("doc_id"))
    body = F.transform(
        tx.lines(F.col("text")),
        lambda t, i: F.struct(i.alias("pos"), F.lit("paragraph").alias("kind"), t.alias("value")),
    )
    blocks = lambda rows: sinks.block_rows(rows, key, pl.body_blocks(key, body))
    for run, rows in (("even", docs.filter("doc_id % 2 = 0")), ("odd", docs.filter("doc_id % 2 = 1")), ("even", docs.filter("doc_id % 2 = 0"))):
        publisher.write_documents(blocks(rows), folder, run)
    return publisher.read_documents(spark, folder).withColumn("block_pos", F.col("block_pos").cast("bigint"))


@query("route_target", "SELECT 'site_' || event_type AS target, count(*) AS n FROM events GROUP BY event_type")
def route_target(spark, sf):
    folder = st.scratch(spark)
    events = st.table(spark, sf, "events").withColumn("site", F.lit("site"))
    sinks.write_targets(tables.with_target(events, "site", "event_type"), folder)
    return spark.read.parquet(folder).groupBy("target").agg(F.count("*").alias("n"))
