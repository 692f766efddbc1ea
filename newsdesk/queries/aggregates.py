"""Trend aggregations (E)."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsdesk.functions import times as tm
from newsdesk.operators import ranking, trends
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.sources.matrix import Matrix

@query("accumulate_sum", """SELECT date_trunc('day', ts)::TIMESTAMP AS day,
  sum(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN round(value * 100)::BIGINT ELSE 0 END)::BIGINT AS early,
  sum(CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN round(value * 100)::BIGINT ELSE 0 END)::BIGINT AS late,
  count(*)::BIGINT AS n FROM events GROUP BY 1""")
def accumulate_sum(spark, sf):
    events = st.table(spark, sf, "events")
    cut = F.lit(st.SPLIT).cast("timestamp_ntz")
    cents = F.round(F.col("value") * 100).cast("bigint")
    day = tm.day(F.col("ts")).alias("day")
    one = F.lit(1).cast("bigint").alias("n")
    early = events.filter(F.col("ts") < cut).select(day, cents.alias("early"), one)
    late = events.filter(F.col("ts") >= cut).select(day, cents.alias("late"), one)
    return trends.accumulate_sum([early, late], "day")


@query("rank_weight", f"""WITH {st.SNAP}
SELECT word, sum(greatest(21 - rank, 0))::BIGINT AS weight FROM snap WHERE rank <> 0
GROUP BY word HAVING sum(greatest(21 - rank, 0)) > 0""")
def rank_weight(spark, sf):
    return trends.rank_weight(st.snapshot(spark, sf))


def _matrix(spark, sf):
    """The snapshots of all sources, added in two batches, the second of them twice."""
    ranked = st.snapshot(spark, sf)
    table = Matrix(spark, st.scratch(spark))
    cut = F.lit(st.SPLIT).cast("timestamp_ntz")
    for batch_id, part in enumerate((ranked.filter(F.col("ts") < cut), ranked.filter(F.col("ts") >= cut))):
        table.add(part, batch_id)
    table.add(ranked.filter(F.col("ts") >= cut), 1)
    return table


@query("pivot_matrix", f"""WITH {st.SNAP}, stamps AS (SELECT DISTINCT source, ts FROM snap), words AS (SELECT DISTINCT source, word FROM snap)
SELECT source, ts, word, coalesce(rank, 0)::BIGINT AS rank FROM stamps JOIN words USING (source) LEFT JOIN snap USING (source, ts, word)""")
def pivot_matrix(spark, sf):
    return _matrix(spark, sf).dense()


@query("unpivot_matrix", f"WITH {st.SNAP} SELECT source, ts, word, rank FROM snap")
def unpivot_matrix(spark, sf):
    return _matrix(spark, sf).cells()


@query("pivot_matrix_words", f"""WITH {st.SNAP}, top AS (SELECT word FROM snap GROUP BY word ORDER BY count(*) DESC, word LIMIT 3),
named AS (SELECT word, row_number() OVER (ORDER BY word) AS i FROM top)
SELECT s.source, s.ts, {", ".join(f"coalesce(max(rank) FILTER (i = {i}), 0)::BIGINT AS w{i}" for i in (1, 2, 3))}
FROM snap s LEFT JOIN named USING (word) GROUP BY s.source, s.ts""")
def pivot_matrix_words(spark, sf):
    """The three words most often ranked, as columns."""
    often = ranking.topk(st.snapshot(spark, sf).groupBy("word").agg(F.count("*").alias("n")), 3, tie="word")
    words = sorted(r["word"] for r in often.collect())
    return _matrix(spark, sf).wide(words).toDF("source", "ts", *[f"w{i}" for i in (1, 2, 3)])


def _records(spark, sf):
    tags = trends.snapshot_tags(st.snapshot(spark, sf), ["source", "ts"], "ts")
    return tags.select(F.col("source").alias("name"), F.date_format("ts", "yyyy-MM-dd").alias("date"), "tags")


TAGS = f"""{st.SNAP}, stamps AS (SELECT DISTINCT source, ts FROM snap),
tags AS (SELECT source, ts, word AS tag, rank FROM snap
  UNION ALL SELECT source, ts, '@' || strftime(ts, '%Y') || '年', 99 FROM stamps
  UNION ALL SELECT source, ts, '@' || strftime(ts, '%m') || '月', 99 FROM stamps
  UNION ALL SELECT source, ts, '@' || strftime(ts, '%m') || '月' || strftime(ts, '%d') || '日', 99 FROM stamps)"""


@query("tag_options", f"WITH {TAGS} SELECT DISTINCT tag FROM tags")
def tag_options(spark, sf):
    return trends.tag_options(_records(spark, sf))


@query("tag_rank_counts", f"""WITH {TAGS}
SELECT source AS name, strftime(ts, '%Y-%m-%d') AS date, tag, sum(rank)::BIGINT AS rank FROM tags GROUP BY ALL""")
def tag_rank_counts(spark, sf):
    return trends.tag_rank_counts(_records(spark, sf), ["name", "date"])


@query("tag_date_totals", f"""WITH {TAGS}
SELECT source AS name, tag, count(*) AS snapshots FROM tags WHERE tag LIKE '@%' GROUP BY ALL""")
def tag_date_totals(spark, sf):
    counts = trends.tag_rank_counts(_records(spark, sf), ["name", "date"])
    dated = counts.filter(F.col("tag").startswith("@"))
    return dated.groupBy("name", "tag").agg(F.sum(F.col("rank") / 99).cast("bigint").alias("snapshots"))


@query("collect_nested", """WITH words AS (
  SELECT l_returnflag, l_partkey, rank FROM (
    SELECT l_returnflag, l_partkey, row_number() OVER (PARTITION BY l_returnflag ORDER BY count(*) DESC, l_partkey) AS rank
    FROM lineitem GROUP BY l_returnflag, l_partkey) WHERE rank <= 20),
found AS (SELECT l_returnflag, l_partkey, l_orderkey, l_linenumber FROM lineitem JOIN words USING (l_returnflag, l_partkey)
  QUALIFY row_number() OVER (PARTITION BY l_returnflag, l_partkey ORDER BY l_orderkey * 8 + l_linenumber, l_suppkey::VARCHAR) <= 11)
SELECT l_returnflag AS source, string_agg(rank || ':' || l_partkey || '=' || arts, ';' ORDER BY rank) AS doc FROM (
  SELECT l_returnflag, l_partkey, rank, string_agg(l_orderkey || '-' || l_linenumber, ',' ORDER BY l_orderkey, l_linenumber) AS arts
  FROM words JOIN found USING (l_returnflag, l_partkey) GROUP BY ALL) GROUP BY l_returnflag""")
def collect_nested(spark, sf):
    items = st.table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("source"), F.col("l_partkey").alias("word"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("title"), F.col("l_suppkey").cast("string").alias("url"),
    )
    ranked = trends.trend_snapshot(items, ["source"], "word")
    nested = trends.nest_snapshot(ranked, items.join(ranked.select("source", "word"), ["source", "word"], "left_semi"), ["source"])
    entry = F.transform(
        "rank_list",
        lambda e: F.concat(
            e["rank"].cast("string"), F.lit(":"), e["word"].cast("string"), F.lit("="),
            F.array_join(F.transform(e["articles"], lambda a: a["title"]), ","),
        ),
    )
    return nested.select("source", F.array_join(entry, ";").alias("doc"))
