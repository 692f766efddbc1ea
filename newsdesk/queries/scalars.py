"""Scalar functions (H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.functions import links as ln
from newsdesk.functions import text as tx
from newsdesk.functions import times as tm
from newsdesk.operators import corpus, localise, trends
from newsdesk.queries import standins as st
from newsdesk.queries.aggregates import TAGS
from newsdesk.queries.projections import LINES, SPACES
from newsdesk.queries.registry import query


@query("utc_to_jst", "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d_%H:%M:%S') AS t FROM events")
def utc_to_jst(spark, sf):
    return st.table(spark, sf, "events").select("event_id", tm.utc_to_jst_text(F.col("ts")).alias("t"))


@query("iso_to_jst", """SELECT event_id,
  CASE WHEN event_id % 2 = 0 OR microsecond(ts) % 1000000 = 0 THEN strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S')
    ELSE strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S.%f') END || '+09:00' AS t
FROM events""")
def iso_to_jst(spark, sf):
    # Texts in three shapes: with `Z`, with an offset, and with no zone at all.
    whole = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    fine = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 2 == 0, F.concat(whole, F.lit("Z"))).when(
        F.col("event_id") % 3 == 0, F.concat(fine, F.lit("+00:00"))).otherwise(fine)
    return st.table(spark, sf, "events").select("event_id", tm.iso_to_jst(text).alias("t"))


@query("snapshot_time", "SELECT event_id, ts + INTERVAL 9 HOUR AS stamped FROM events")
def snapshot_time(spark, sf):
    return st.table(spark, sf, "events").select("event_id", tm.snapshot_time(F.col("ts")).alias("stamped"))


@query("compact_ts", """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M') AS compact,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS iso FROM orders""")
def compact_ts(spark, sf):
    compact = tm.to_compact(F.col("o_orderdate"))
    return st.table(spark, sf, "orders").select(
        "o_orderkey", compact.alias("compact"), tm.compact_to_iso(compact).alias("iso"))


@query("post_ts_iso", "SELECT event_id, strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || '.000+09:00' AS t FROM events")
def post_ts_iso(spark, sf):
    return st.table(spark, sf, "events").select(
        "event_id", tm.post_time_to_iso(tm.utc_to_jst_text(F.col("ts"))).alias("t"))


@query("date_tags", """WITH d AS (SELECT o_orderkey, '@' || strftime(o_orderdate, '%Y') || '年' AS y,
  '@' || strftime(o_orderdate, '%m') || '月' AS m, strftime(o_orderdate, '%d') || '日' AS dd FROM orders)
SELECT o_orderkey, y AS tag, 99::BIGINT AS rank FROM d UNION ALL SELECT o_orderkey, m, 99 FROM d
UNION ALL SELECT o_orderkey, m || dd, 99 FROM d""")
def date_tags(spark, sf):
    tags = st.table(spark, sf, "orders").select("o_orderkey", F.explode(tm.date_tags(F.col("o_orderdate"))).alias("tag", "rank"))
    return tags.withColumn("rank", F.col("rank").cast("bigint"))


@query("post_type", """SELECT event_id, CASE event_type WHEN 'error' THEN 'Retweet' WHEN 'click' THEN 'Reply' ELSE 'Tweet' END AS t
FROM events""")
def post_type(spark, sf):
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("RT "), "props")).when(
        F.col("event_type") == "click", F.concat(F.lit("@"), "props")).otherwise(F.concat(F.lit("a RT @"), "props"))
    return st.table(spark, sf, "events").select("event_id", tx.post_type(text).alias("t"))


@query("first_external_url", rf"""WITH {st.SHOWN}, {st.LINKS},
hits AS (SELECT page_id, arg_min(href, pos) AS href FROM links WHERE NOT contains(href, 'th') GROUP BY page_id)
SELECT page_id, coalesce(href, 'None') AS ref_url, CASE WHEN href IS NULL THEN 'None' ELSE '[ LINK ]' END AS ref_text
FROM pages LEFT JOIN hits USING (page_id)""")
def first_external_url(spark, sf):
    urls = F.transform("links", lambda a: F.struct(a["url"].alias("url"), a["url"].alias("expanded_url")))
    return st.page_links(spark, sf).select("page_id", ln.first_external_url(urls, F.lit("th")).alias("r")).select("page_id", "r.*")


@query("post_url", "SELECT event_id, 'https://posts.example/u' || user_id || '/status/' || event_id AS url FROM events")
def post_url(spark, sf):
    user = F.concat(F.lit("u"), "user_id")
    return st.table(spark, sf, "events").select("event_id", ln.post_url(st.POST_SITE, user, F.col("event_id")).alias("url"))


@query("regex_after", r"""SELECT event_id, regexp_extract(props, '"k": (\w+)', 1) AS k FROM events""")
def regex_after(spark, sf):
    return st.table(spark, sf, "events").select("event_id", ln.regex_after(F.col("props"), '"k": ').alias("k"))


@query("resolve_url", rf"WITH {st.SHOWN}, {st.LINKS} SELECT page_id, pos, {st.SQL_RESOLVED} AS link FROM links")
def resolve_url(spark, sf):
    links = ar.item_rows(st.page_links(spark, sf), "links", "page_id", "url", item="a", pos="pos")
    return links.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                        ln.resolve_url(F.col("url"), F.col("a.url")).alias("link"))


@query("strip_trailing_digits", "SELECT c_custkey, regexp_replace(c_name, '[0-9]+$', '') AS name FROM customer")
def strip_trailing_digits(spark, sf):
    return st.table(spark, sf, "customer").select("c_custkey", tx.strip_trailing_digits(F.col("c_name")).alias("name"))


WORDS = rf"list_filter(regexp_split_to_array(text, '{SPACES}+'), lambda x: x <> '')"


@query("headline_summary", rf"""SELECT doc_id, t[1] AS headline, regexp_replace(coalesce(t[2], t[1]), '[0-9]+$', '') AS summary
FROM (SELECT doc_id, {WORDS} AS t FROM documents)""")
def headline_summary(spark, sf):
    return st.table(spark, sf, "documents").select("doc_id", tx.headline_summary(F.col("text")).alias("h")).select("doc_id", "h.*")


@query("sanitise_comma", "SELECT doc_id, replace(text, ',', ' ') AS text FROM documents")
def sanitise_comma(spark, sf):
    return st.table(spark, sf, "documents").select("doc_id", tx.without_commas(F.col("text")).alias("text"))


@query("heading_text", f"WITH {st.SNAP} SELECT source, ts, rank || ' : ' || word AS heading FROM snap")
def heading_text(spark, sf):
    return st.snapshot(spark, sf).select("source", "ts", tx.heading(F.col("rank"), F.col("word")).alias("heading"))


@query("pairs_from_alternating", """SELECT p_partkey, n::BIGINT AS pos, CASE n WHEN 0 THEN p_name ELSE p_type END AS title,
  CASE n WHEN 0 THEN p_brand ELSE p_name END AS url
FROM part, (VALUES (0), (1)) v(n) WHERE n < CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END""")
def pairs_from_alternating(spark, sf):
    # Two full pairs for even sizes, one pair and an odd tail for the others.
    odd = F.array("p_name", "p_brand", "p_type")
    flat = F.when(F.col("p_size") % 2 == 0, F.concat(odd, F.array("p_name"))).otherwise(odd)
    parts = st.table(spark, sf, "part").select("p_partkey", F.posexplode(ar.pairs(flat)).alias("pos", "p"))
    return parts.select("p_partkey", F.col("pos").cast("bigint").alias("pos"), "p.title", "p.url")


@query("alternating_from_pairs", "SELECT p_partkey, p_name || '|' || p_brand || '|' || p_type || '|' || p_name AS flat FROM part")
def alternating_from_pairs(spark, sf):
    pairs = ar.pairs(F.array("p_name", "p_brand", "p_type", "p_name"))
    return st.table(spark, sf, "part").select("p_partkey", F.array_join(ar.alternating(pairs), "|").alias("flat"))


@query("lines_to_rank_word", f"WITH {st.SNAP} SELECT source, ts, rank::VARCHAR AS rank, word FROM snap")
def lines_to_rank_word(spark, sf):
    lists = trends.snapshot_lists(st.snapshot(spark, sf), ["source", "ts"])
    rows = F.transform("ranked", lambda e: F.concat_ws("\n", e["rank"].cast("string"), e["word"]))
    block = F.concat(F.lit("title\n"), F.array_join(rows, "\n"))
    return lists.select("source", "ts", F.inline(ar.rank_word_lines(block)))


@query("default_value", """SELECT d.doc_id, coalesce(CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, ' ') AS summary
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def default_value(spark, sf):
    docs, labels = st.table(spark, sf, "documents").select("doc_id"), st.table(spark, sf, "labels")
    rated = docs.join(labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("s")), "doc_id", "left")
    return rated.select("doc_id", tx.or_blank(F.col("s")).alias("summary"))


@query("sentinel_zero", """SELECT d.doc_id, coalesce(l.quality::VARCHAR, '0') AS date
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def sentinel_zero(spark, sf):
    docs, labels = st.table(spark, sf, "documents").select("doc_id"), st.table(spark, sf, "labels")
    rated = docs.join(labels.select("doc_id", "quality"), "doc_id", "left")
    return rated.select("doc_id", tx.or_zero_text(F.col("quality")).alias("date"))


@query("rstrip_unicode", rf"WITH {LINES} SELECT doc_id, line_no, regexp_replace(line, '{SPACES}+$', '') AS stream FROM l")
def rstrip_unicode(spark, sf):
    lines = corpus.lines_of(st.table(spark, sf, "documents"), "doc_id", "text")
    return lines.withColumn("line_no", F.col("line_no").cast("bigint"))


@query("trim_nonempty", rf"""SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, '.'),
  lambda x: regexp_replace(regexp_replace(x, '^{SPACES}+', ''), '{SPACES}+$', '')), lambda x: x <> ''), '|') AS parts FROM documents""")
def trim_nonempty(spark, sf):
    parts = tx.trim_nonempty(F.split("text", r"\."))
    return st.table(spark, sf, "documents").select("doc_id", F.array_join(parts, "|").alias("parts"))


@query("engine_normalise", """SELECT event_id, CASE event_type WHEN 'click' THEN 'google' WHEN 'view' THEN 'deepl' ELSE 'none' END AS engine
FROM events""")
def engine_normalise(spark, sf):
    named = F.when(F.col("event_type") == "click", "google").when(F.col("event_type") == "view", "deepl").otherwise(F.col("event_type"))
    return st.table(spark, sf, "events").select("event_id", tx.engine_name(named).alias("engine"))


SUFFIX = """SELECT p_partkey, {prefix}CASE p_size % 3 WHEN 0 THEN chr(10) || ' [G翻訳] ' || upper(p_name)
  WHEN 1 THEN chr(10) || ' [Deepl翻訳] ' || upper(p_name) ELSE {other} END AS t FROM part"""


def _engine(size):
    return F.when(size % 3 == 0, "google").when(size % 3 == 1, "deepl").otherwise("none")


@query("translated_suffix", SUFFIX.format(prefix="", other="' '"))
def translated_suffix(spark, sf):
    return st.table(spark, sf, "part").select(
        "p_partkey", tx.translated_suffix(_engine(F.col("p_size")), F.upper("p_name")).alias("t"))


@query("engine_registry", SUFFIX.format(prefix="p_name || ", other="''"))
def engine_registry(spark, sf):
    registry = localise.default_registry()
    return st.table(spark, sf, "part").select(
        "p_partkey", registry.apply(_engine(F.col("p_size")), F.col("p_name"), F.upper("p_name")).alias("t"))


@query("token_repeat", f"""WITH {st.SNAP} SELECT word, sum(21 - rank)::BIGINT AS copies, count(*) AS bags FROM snap GROUP BY word""")
def token_repeat(spark, sf):
    bags = trends.token_bags(st.snapshot(spark, sf))
    return bags.groupBy("word").agg(F.sum(F.size("bag")).alias("copies"), F.count("*").alias("bags"))


@query("date_tag_test", f"""WITH {TAGS} SELECT source, ts, tag, rank FROM tags""")
def date_tag_test(spark, sf):
    lists = trends.snapshot_tags(st.snapshot(spark, sf), ["source", "ts"], "ts")
    long = ar.item_rows(lists, "tags", "source", "ts", item="tag", pos="pos")
    return long.select("source", "ts", "tag", tx.tag_rank(F.col("tag"), F.col("pos")).cast("bigint").alias("rank"))
