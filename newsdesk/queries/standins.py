"""The given tables in the roles the operators need, in Spark and as SQL fragments.

* trend snapshot: `events` by day and event type; user ids are the words, ranked by mentions
* history / batch: `events` before / from 2024-01-16
* corpus: `documents`; page: `pages`; thread: `conversations`
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.functions import pages as pg
from newsdesk.functions import times as tm
from newsdesk.operators import corpus, trends
from newsdesk.session import cut_lineage, shared_dir, tune
from newsdesk.sources import tables

SPLIT = "2024-01-16"
POSTS_PER_CHAIN = 1 << 20
POST_SITE = "https://posts.example"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    rows = tune(spark).read.parquet(f"{sf}/{name}.parquet")
    return tables.spread(rows) if name in ("documents", "pages") else rows


def scratch(spark: SparkSession) -> str:
    """A new folder for one run, below the shared one."""
    return f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"


def snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """(source, ts, rank, word)"""
    events = table(spark, sf, "events").select(
        F.col("event_type").alias("source"), tm.day(F.col("ts")).alias("ts"), "user_id"
    )
    ranked = trends.trend_snapshot(events, ["source", "ts"], "user_id")
    return ranked.select("source", "ts", "rank", F.concat(F.lit("u"), "user_id").alias("word"))


SNAP = """snap AS (
  SELECT source, ts, rank, word FROM (
    SELECT event_type AS source, date_trunc('day', ts)::TIMESTAMP AS ts, 'u' || user_id AS word,
           row_number() OVER (PARTITION BY event_type, date_trunc('day', ts)
                              ORDER BY count(*) DESC, user_id) AS rank
    FROM events GROUP BY event_type, date_trunc('day', ts), user_id)
  WHERE rank <= 20)"""

COMPARED = ["event_id", "user_id", "event_type", "value"]


def events_split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(history, batch)"""
    events = table(spark, sf, "events")
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    return (
        events.filter(F.col("ts") < cut).select(*COMPARED),
        events.filter(F.col("ts") >= cut).select(*COMPARED),
    )


PARTS = f"""h AS (SELECT event_id, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '{SPLIT}'),
b AS (SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '{SPLIT}')"""

FRESH = """SELECT b.event_id FROM b WHERE NOT (
  user_id IN (SELECT user_id FROM h) AND event_type IN (SELECT event_type FROM h)
  AND value IN (SELECT value FROM h))"""


def words(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return corpus.split_tokens(docs, "text").drop("text")


def counts(spark: SparkSession, sf: str) -> DataFrame:
    """Token counts of the corpus, stored once because stopwords and rests are made from them."""
    return cut_lineage(corpus.token_counts(words(spark, sf)))


TOK = r"""tok AS MATERIALIZED (
  SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS token FROM documents)"""

TOP = """counts AS MATERIALIZED (SELECT token, count(*) AS n FROM tok GROUP BY token),
stop AS (SELECT token FROM counts ORDER BY n DESC, token LIMIT 20)"""


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    """(page_id, url, links array<struct<title, url>>)"""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", pg.extract_links(F.col("html")).alias("links"))


# Markup without scripts, styles and comments, as `newsdesk.functions.pages.visible` sees it.
SHOWN = r"""shown AS (SELECT page_id, url,
  regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>', '', 'g'),
    '(?is)<style\b.*?</style>', '', 'g'), '(?s)<!--.*?-->', '', 'g') AS html FROM pages)"""


def sql_text(markup: str) -> str:
    """Inner text of a piece of markup in SQL."""
    out = f"regexp_replace({markup}, '<[^>]*>', '', 'g')"
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        out = f"replace({out}, '{name}', '{char}')"
    return out


LINKS = r"""links AS (SELECT page_id, url,
  unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>', 1)) AS href,
  unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>', 2)) AS markup,
  generate_subscripts(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref="([^"]*)"[^>]*>(.*?)</a>', 1), 1) - 1 AS pos
  FROM shown)"""

# The links of the given pages are all root-relative.
SQL_RESOLVED = r"regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) || href"


# --- documents as JSON: the same objects as newsdesk.functions.payloads, written in SQL


def j_run(content: str, url: str | None = None, color: str = "default") -> str:
    marks = ", ".join(f"'{m}', false" for m in ("bold", "code", "italic", "strikethrough", "underline"))
    link = "" if url is None else f", 'link', json_object('type', 'url', 'url', {url})"
    return (f"json_object('annotations', json_object({marks}, 'color', '{color}'), 'plain_text', {content}, "
            f"'text', json_object('content', {content}{link}), 'type', 'text')")


def j_text(content: str, url: str | None = None, kind: str = "rich_text") -> str:
    return f"json_object('{kind}', json_array({j_run(content, url)}), 'type', '{kind}')"


def j_choice(name: str) -> str:
    return f"json_object('select', json_object('name', {name}), 'type', 'select')"


def j_choices(names: str) -> str:
    return f"json_object('multi_select', list_transform({names}, lambda t: {{'name': t}}), 'type', 'multi_select')"


def j_date(start: str, zone: str | None = None) -> str:
    tail = "" if zone is None else f", 'time_zone', '{zone}'"
    return f"json_object('date', json_object('start', {start}{tail}), 'type', 'date')"


def j_page(**properties: str) -> str:
    inner = ", ".join(f"'{name}', {value}" for name, value in properties.items())
    return f"json_object('properties', json_object({inner}))::VARCHAR"


def j_block(key: str, kind: str, inner: str) -> str:
    return f"json_object('object', 'block', 'id', {key}, 'type', '{kind}', '{kind}', {inner})"
