"""Ranks, windows, caps and top-k (F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.functions import text as tx
from newsdesk.operators import corpus, ranking, trends
from newsdesk.plans import jobs
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.queries.sources import INTEREST, SEGMENTS, interest


@query("position_rank", f"WITH {st.SNAP} SELECT source, ts, word, rank FROM snap")
def position_rank(spark, sf):
    lists = trends.snapshot_lists(st.snapshot(spark, sf), ["source", "ts"])
    words = lists.select("source", "ts", F.transform("ranked", lambda e: e["word"]).alias("words"))
    return ranking.position_rank(words, "words").withColumn("rank", F.col("rank").cast("bigint"))


@query("last_wins", """SELECT l_partkey, arg_max(l_returnflag, l_orderkey * 8 + l_linenumber) AS l_returnflag
FROM lineitem GROUP BY l_partkey""")
def last_wins(spark, sf):
    items = st.table(spark, sf, "lineitem").withColumn("pos", F.col("l_orderkey") * 8 + F.col("l_linenumber"))
    return ranking.last_wins(items, ["l_partkey"], "pos", "l_returnflag")


@query("first_match", "SELECT user_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def first_match(spark, sf):
    return ranking.first_match(st.table(spark, sf, "events"), "user_id", "event_id", "event_type")


@query("stacked_offset", f"""WITH {INTEREST}, s AS (SELECT region, keyword, sum(value)::BIGINT AS value FROM interest GROUP BY ALL)
SELECT region, keyword, value, coalesce(sum(value) OVER (PARTITION BY region ORDER BY keyword
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM s""")
def stacked_offset(spark, sf):
    sums = interest(spark, sf).groupBy("region", "keyword").agg(F.sum("value").alias("value"))
    return ranking.stacked_offset(sums, "region", "keyword", "value", "start")


@query("topk_tokens", f"WITH {st.TOK} SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 400")
def topk_tokens(spark, sf):
    return ranking.topk(corpus.token_counts(st.words(spark, sf)), 400)


@query("cap_per_group", """SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) <= 11""")
def cap_per_group(spark, sf):
    items = st.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
    capped = ranking.cap_per_group(items, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], 11)
    return capped.drop("l_partkey")


@query("recent_per_user", """SELECT user_id, event_id, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 10""")
def recent_per_user(spark, sf):
    events = st.table(spark, sf, "events").select("user_id", "event_id", "ts")
    return ranking.recent_per_user(events, "user_id", "ts", "event_id", 10)


@query("trim_ends", r"""SELECT doc_id, array_to_string(ls[3:greatest(len(ls) - 4, 0)], '|') AS kept FROM (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\r\n|\n|\r)\z', ''), '\r\n|\n|\r') AS ls FROM documents)""")
def trim_ends(spark, sf):
    docs = st.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(ar.trim_ends(tx.lines(F.col("text"))), "|").alias("kept"))


@query("limit_rank", f"WITH {st.SNAP} SELECT source, ts, word FROM snap WHERE rank <= 5")
def limit_rank(spark, sf):
    return ranking.limit_rank(st.snapshot(spark, sf), 5).drop("rank")


@query("post_columns_recent", f"""SELECT event_id AS post_id, user_id,
  strftime(ts + INTERVAL 9 HOUR, '%Y-%m-%d_%H:%M:%S') AS post_time FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 5""")
def post_columns_recent(spark, sf):
    from newsdesk.queries.jobs import posts_and_users

    posts, users = posts_and_users(spark, sf)
    return jobs.flat_posts(posts, users, st.POST_SITE, 5).select("post_id", "user_id", "post_time")
