"""Diff and set operations (D) and the polling stream (S)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import times as tm
from newsdesk.operators import novelty, trends
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.sources.history import History
from newsdesk.streaming import ingest as ing
from newsdesk.streaming import stateful


@query("novelty_cells", f"WITH {st.PARTS} SELECT * FROM b WHERE event_id IN ({st.FRESH})")
def novelty_cells(spark, sf):
    past, batch = st.events_split(spark, sf)
    return novelty.novelty_cells(batch, past, "event_id")


@query("novelty_rows", f"""WITH {st.PARTS} SELECT * FROM b WHERE NOT EXISTS (
  SELECT 1 FROM h WHERE h.user_id = b.user_id AND h.event_type = b.event_type AND h.value = b.value)""")
def novelty_rows(spark, sf):
    past, batch = st.events_split(spark, sf)
    return novelty.novelty_rows(batch, past, ["event_id"])


@query("novelty_sequential", f"""WITH {st.PARTS},
a AS (SELECT event_type, user_id, value, -1 AS seq FROM h
      UNION ALL SELECT event_type, user_id, value, event_id FROM b),
f AS (SELECT *, min(seq) OVER (PARTITION BY event_type, user_id) AS fu,
             min(seq) OVER (PARTITION BY event_type, value) AS fv FROM a)
SELECT seq AS event_id, event_type, user_id, value FROM f WHERE seq >= 0 AND (fu = seq OR fv = seq)""")
def novelty_sequential(spark, sf):
    past, batch = st.events_split(spark, sf)
    return novelty.novelty_sequential(batch, past, "event_id", ["event_type"])


@query("merge_newest_first", f"""WITH {st.PARTS},
both_parts AS (SELECT *, 0 AS old FROM b UNION ALL SELECT *, 1 AS old FROM h)
SELECT event_id, user_id, event_type, coalesce(value, 0) AS value FROM both_parts
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY old, event_id) = 1""")
def merge_newest_first(spark, sf):
    past, batch = st.events_split(spark, sf)
    return novelty.merge_newest_first(batch, past, "event_id", fill=0)


@query("union_outer_schema", """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS code FROM customer
UNION ALL SELECT s_suppkey, s_name, NULL, 's' || s_suppkey FROM supplier""")
def union_outer_schema(spark, sf):
    customer = st.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = st.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("s"), "s_suppkey").alias("code"))
    return novelty.union_outer_schema(customer, supplier)


@query("union_all_flagged", """SELECT o_orderkey, true AS pick_up FROM orders WHERE o_totalprice > 400000
UNION ALL SELECT o_orderkey, false FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def union_all_flagged(spark, sf):
    orders = st.table(spark, sf, "orders")
    featured = orders.filter("o_totalprice > 400000").select("o_orderkey")
    latest = orders.filter(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")).select("o_orderkey")
    return novelty.union_flagged(featured, latest)


@query("distinct_rows", "SELECT DISTINCT user_id, event_type, date_trunc('day', ts)::TIMESTAMP AS ts FROM events")
def distinct_rows(spark, sf):
    events = st.table(spark, sf, "events")
    return events.select("user_id", "event_type", tm.day(F.col("ts")).alias("ts")).distinct()


@query("map_union", f"""WITH {st.SNAP},
t AS (SELECT DISTINCT source, ts FROM snap)
SELECT source, ts, word, rank FROM snap
UNION ALL SELECT source, ts, '@' || strftime(ts, '%Y') || '年', 99 FROM t
UNION ALL SELECT source, ts, '@' || strftime(ts, '%m') || '月', 99 FROM t
UNION ALL SELECT source, ts, '@' || strftime(ts, '%m') || '月' || strftime(ts, '%d') || '日', 99 FROM t""")
def map_union(spark, sf):
    lists = trends.snapshot_lists(st.snapshot(spark, sf), ["source", "ts"])
    maps = lists.select("source", "ts", trends.rank_map(F.col("ranked"), F.col("ts")).alias("m"))
    return maps.select("source", "ts", F.explode("m").alias("word", "rank")).withColumn("rank", F.col("rank").cast("bigint"))


POLLS = ("2024-01-11", "2024-01-21", "2024-02-01")


def _polls(spark, sf):
    """Three polls over a landing folder; gives the history."""
    folder = st.scratch(spark)
    events = st.table(spark, sf, "events")
    history = History(spark, f"{folder}/history", "event_id")
    low = F.lit("1900-01-01").cast("timestamp_ntz")
    for high_text in POLLS:
        high = F.lit(high_text).cast("timestamp_ntz")
        arrived = events.filter((F.col("ts") >= low) & (F.col("ts") < high)).select(*st.COMPARED)
        arrived.write.mode("append").parquet(f"{folder}/landing")
        stream = ing.landing(spark, f"{folder}/landing", arrived.schema)
        ing.ingest(stream, history, f"{folder}/checkpoint", lambda fresh: {"news": fresh.select("event_id")}).awaitTermination()
        low = high
    return history


_BOUNDS = "\nUNION ALL ".join(
    f"SELECT * FROM (SELECT e.event_id, {n}::BIGINT AS poll FROM events e WHERE poll_of = {n}"
    f" AND NOT (user_id IN (SELECT user_id FROM ev WHERE poll_of < {n})"
    f" AND event_type IN (SELECT event_type FROM ev WHERE poll_of < {n})"
    f" AND value IN (SELECT value FROM ev WHERE poll_of < {n})))".replace("FROM events e", "FROM ev e")
    for n in range(3)
)


@query("incremental_ingest", f"""WITH ev AS (SELECT *, CASE WHEN ts < TIMESTAMP '{POLLS[0]}' THEN 0
  WHEN ts < TIMESTAMP '{POLLS[1]}' THEN 1 ELSE 2 END AS poll_of FROM events)
{_BOUNDS}""")
def incremental_ingest(spark, sf):
    return _polls(spark, sf).published("news").select("event_id", F.col("batch_id").alias("poll"))


@query("incremental_history", f"""SELECT event_id, user_id, event_type, value FROM (
  SELECT *, CASE WHEN ts < TIMESTAMP '{POLLS[0]}' THEN 0 WHEN ts < TIMESTAMP '{POLLS[1]}' THEN 1 ELSE 2 END AS poll FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id, event_type, value ORDER BY poll DESC, event_id) = 1""")
def incremental_history(spark, sf):
    return _polls(spark, sf).current().select(*st.COMPARED)


@query("stateful_ingest", f"""WITH ev AS (SELECT *, CASE WHEN ts < TIMESTAMP '{POLLS[0]}' THEN 0
  WHEN ts < TIMESTAMP '{POLLS[1]}' THEN 1 ELSE 2 END AS poll_of FROM events)
SELECT b.event_id, b.event_type, b.poll FROM ({_BOUNDS.replace("SELECT e.event_id,", "SELECT e.event_id, e.event_type,")}) b WHERE poll > 0""")
def stateful_ingest(spark, sf):
    """Two polls of a stream whose state begins with the values that a history had seen before."""
    folder = st.scratch(spark)
    events = st.table(spark, sf, "events")
    time = [F.lit(t).cast("timestamp_ntz") for t in POLLS]
    poll = F.when(F.col("ts") < time[0], 0).when(F.col("ts") < time[1], 1).otherwise(2).cast("bigint").alias("poll")
    rows = events.filter(F.col("ts") < time[2]).select(*st.COMPARED, poll)
    history = History(spark, f"{folder}/history", "event_id")
    history.merge(rows.filter("poll = 0").drop("poll"), 0)
    for n in (1, 2):
        rows.filter(F.col("poll") == n).coalesce(2).write.mode("append").parquet(f"{folder}/landing")
        stream = ing.landing(spark, f"{folder}/landing", rows.schema)
        stateful.start(stateful.fresh_ids(stream, "event_id", ["poll"], seen=history.seen()), folder).awaitTermination()
    landed = spark.read.schema(rows.schema).parquet(f"{folder}/landing")
    return stateful.fresh_rows(landed, folder, "event_id").select("event_id", "event_type", "poll")
