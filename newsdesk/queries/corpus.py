"""Corpus statistics (E3-E9, H26, H27, U1)."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from newsdesk.operators import cooccurrence as co
from newsdesk.operators import corpus
from newsdesk.queries import standins as st
from newsdesk.queries.registry import query
from newsdesk.session import store


@query("pos_filter", "SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('click', 'view', 'error')")
def pos_filter(spark, sf):
    tagged = st.table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return corpus.pos_filter(tagged, "event_type", ("click", "view", "error"))


@query("split_tokens", r"""SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '\p{L}+'), ' ') AS words FROM documents""")
def split_tokens(spark, sf):
    return st.words(spark, sf).select("doc_id", F.array_join("words", " ").alias("words"))


def _letters():
    pattern = re.compile(r"[^\W\d_]+")
    return lambda text: pattern.findall(text.lower())


@query("apply_tokenizer", r"""SELECT doc_id, len(t)::BIGINT AS n, md5(array_to_string(t, ' ')) AS words
FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{No}\p{Nl}]+') AS t FROM documents)""")
def apply_tokenizer(spark, sf):
    tokenize = corpus.apply_tokenizer(_letters)
    docs = st.table(spark, sf, "documents").select("doc_id", tokenize("text").alias("words"))
    return docs.select("doc_id", F.size("words").cast("bigint").alias("n"), F.md5(F.array_join("words", " ").cast("binary")).alias("words"))


@query("ngram_count", f"""WITH {st.TOK} SELECT token, count(*) AS n FROM tok GROUP BY token""")
def ngram_count(spark, sf):
    return corpus.ngram_count(st.words(spark, sf))


@query("ngram_count_pairs", r"""WITH w AS (SELECT regexp_extract_all(lower(text), '\p{L}+') AS t FROM documents),
g AS (SELECT unnest(list_transform(generate_series(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1])) AS token FROM w WHERE len(t) > 1)
SELECT token, count(*) AS n FROM g GROUP BY token""")
def ngram_count_pairs(spark, sf):
    return corpus.ngram_count(st.words(spark, sf), n=2)


@query("ngram_count_pairs_stopwords", rf"""WITH {st.TOK}, {st.TOP},
p AS (SELECT doc_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM (
  SELECT doc_id, regexp_extract_all(lower(text), '\p{{L}}+') AS ws FROM documents)),
g AS (SELECT token || ' ' || lead(token) OVER (PARTITION BY doc_id ORDER BY pos) AS token FROM p
  WHERE token NOT IN (SELECT token FROM stop))
SELECT token, count(*) AS n FROM g WHERE token IS NOT NULL GROUP BY token""")
def ngram_count_pairs_stopwords(spark, sf):
    words = st.words(spark, sf)
    stop = corpus.frequency_stopwords(st.counts(spark, sf), top_n=20)
    return corpus.ngram_count(words, n=2, stopwords=stop, doc="doc_id")


@query("treemap_share", f"""WITH {st.TOK}, t AS (SELECT token, count(*) AS n FROM tok GROUP BY token ORDER BY n DESC, token LIMIT 400)
SELECT token, n, round(n / sum(n) OVER (), 9) AS share FROM t""")
def treemap_share(spark, sf):
    shares = corpus.treemap_share(corpus.token_counts(st.words(spark, sf)))
    return shares.withColumn("share", F.round("share", 9))


@query("wordcloud_weight", f"""WITH {st.TOK}, {st.TOP},
c AS (SELECT source, token, count(*) AS n FROM tok WHERE token NOT IN (SELECT token FROM stop) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, token) AS rank FROM c QUALIFY rank <= 100)
SELECT source, token, n, rank, round(n * 100.0::DOUBLE / max(n) OVER (PARTITION BY source), 6) AS size FROM r""")
def wordcloud_weight(spark, sf):
    words = st.words(spark, sf)
    stop = corpus.frequency_stopwords(st.counts(spark, sf), top_n=20)
    cloud = corpus.wordcloud_weight(words, group=["source"], stopwords=stop)
    return cloud.withColumns({"rank": F.col("rank").cast("bigint"), "size": F.round("size", 6)})


@query("frequency_stopwords", f"""WITH {st.TOK}, counts AS (SELECT token, count(*) AS n FROM tok GROUP BY token)
SELECT token FROM counts WHERE n <= 2 UNION SELECT token FROM (SELECT token FROM counts ORDER BY n DESC, token LIMIT 50)""")
def frequency_stopwords(spark, sf):
    return corpus.frequency_stopwords(st.counts(spark, sf), top_n=50, min_freq=2)


def edges(spark, sf):
    """Pairs that share at least a tenth of all documents."""
    floor = max(st.table(spark, sf, "documents").count() // 10, 1)
    return co.cooccurrence_edges(st.words(spark, sf), "doc_id", min_edge=floor)


@query("cooccurrence_edges_tiled", f"""WITH {st.TOK}, dt AS (SELECT DISTINCT doc_id, token FROM tok),
floor AS (SELECT count(*) // 8 AS m FROM documents),
kept AS (SELECT doc_id, token FROM dt WHERE token IN (
  SELECT token FROM dt GROUP BY token HAVING count(*) >= (SELECT m FROM floor)))
SELECT x.token AS a, y.token AS b, count(*) AS n FROM kept x JOIN kept y ON x.doc_id = y.doc_id AND x.token < y.token
GROUP BY ALL HAVING count(*) >= (SELECT m FROM floor)""")
def cooccurrence_edges_tiled(spark, sf):
    """The way of a long vocabulary."""
    floor = max(st.table(spark, sf, "documents").count() // 8, 1)
    return co.cooccurrence_edges(st.words(spark, sf), "doc_id", min_edge=floor, matrix_tokens=0)


EDGES = f"""{st.TOK}, dt AS (SELECT DISTINCT doc_id, token FROM tok),
floor AS (SELECT count(*) // 10 AS m FROM documents),
kept AS (SELECT doc_id, token FROM dt WHERE token IN (
  SELECT token FROM dt GROUP BY token HAVING count(*) >= (SELECT m FROM floor))),
edges AS MATERIALIZED (SELECT x.token AS a, y.token AS b, count(*) AS n FROM kept x JOIN kept y ON x.doc_id = y.doc_id AND x.token < y.token
  GROUP BY ALL HAVING count(*) >= (SELECT m FROM floor)),
both_ways AS (SELECT a AS token, b AS other, n FROM edges UNION ALL SELECT b, a, n FROM edges)"""


@query("cooccurrence_edges", f"WITH {EDGES} SELECT a, b, n FROM edges")
def cooccurrence_edges(spark, sf):
    return edges(spark, sf)


@query("cooccurrence_nodes", f"""WITH {EDGES},
deg AS (SELECT token, count(*) AS degree, sum(n)::BIGINT AS weighted_degree FROM both_ways GROUP BY token),
tri AS (SELECT x.token, count(*) AS t FROM both_ways x JOIN both_ways y ON x.token = y.token AND x.other < y.other
  JOIN edges e ON e.a = x.other AND e.b = y.other GROUP BY x.token)
SELECT token, degree, weighted_degree,
  CASE WHEN degree > 1 THEN round(coalesce(t, 0)::DOUBLE / (degree * (degree - 1) / 2), 9) ELSE 0.0 END::DOUBLE AS clustering
FROM deg LEFT JOIN tri USING (token)""")
def cooccurrence_nodes(spark, sf):
    nodes = co.cooccurrence_nodes(edges(spark, sf))
    return nodes.withColumn("clustering", F.round("clustering", 9))


_ROUNDS = ",\n".join(
    f"""l{i} AS MATERIALIZED (SELECT token, label FROM (
  SELECT v.token, l.label, sum(v.n) AS w FROM votes v JOIN l{i - 1} l ON l.token = v.other GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY token ORDER BY w DESC, label) = 1)"""
    for i in range(1, 6)
)


@query("communities", f"""WITH {EDGES},
votes AS (SELECT * FROM both_ways UNION ALL SELECT token, token, max(n) FROM both_ways GROUP BY token),
l0 AS (SELECT DISTINCT token, token AS label FROM both_ways),
{_ROUNDS},
w AS (SELECT token, sum(n)::BIGINT AS weight FROM both_ways GROUP BY token)
SELECT l5.label AS community, token, weight, round(weight / sum(weight) OVER (PARTITION BY l5.label), 9) AS share
FROM l5 JOIN w USING (token)""")
def communities(spark, sf):
    stored = store(edges(spark, sf))
    return co.community_shares(co.communities(stored), stored).withColumn("share", F.round("share", 9))
