from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsdesk.operators import cooccurrence as co
from newsdesk.operators import corpus, threads, trends
from newsdesk.sources import tables


def docs_frame(spark, seed=1, docs=40, vocabulary=30):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    rows = [(d, [rnd.choice(names[: 1 + rnd.randrange(vocabulary)]) for _ in range(rnd.randrange(60))]) for d in range(docs)]
    return rows, spark.createDataFrame(rows, "doc bigint, words array<string>")


def brute_edges(rows, floor, stop=()):
    pairs = Counter(p for _, ws in rows for p in combinations(sorted(set(ws) - set(stop)), 2))
    return {p: n for p, n in pairs.items() if n >= floor}


@pytest.mark.parametrize("matrix_tokens, narrow", [(0, True), (0, False), (2000, True)])
def test_edges(spark, matrix_tokens, narrow, monkeypatch):
    monkeypatch.setattr(co, "PAIRS_HELD", 20)
    monkeypatch.setattr(co, "PAIRS_AT_ONCE", 50)
    monkeypatch.setattr(co, "is_narrow", lambda frame: narrow)
    rows, docs = docs_frame(spark)
    stop = spark.createDataFrame([("w0",), ("w1",)], "word string")
    got = co.cooccurrence_edges(docs, "doc", min_edge=5, matrix_tokens=matrix_tokens).collect()
    assert {(r.a, r.b): r.n for r in got} == brute_edges(rows, 5)
    got = co.cooccurrence_edges(docs, "doc", min_edge=3, stopwords=stop, matrix_tokens=matrix_tokens).collect()
    assert {(r.a, r.b): r.n for r in got} == brute_edges(rows, 3, ("w0", "w1"))


def test_pairs_of_rows():
    """Pieces of any size hold every pair of numbers of a row once."""
    rows = [[1, 4, 6], [], [2], list(range(9)), [3, 5]]
    ids, ends = np.concatenate([np.array(r, np.int64) for r in rows]), np.cumsum([len(r) for r in rows])
    expected = sorted(p for r in rows for p in combinations(r, 2))
    for most in (1, 5, 1000):
        assert sorted((int(a), int(b)) for x, y in co.row_pairs(ids, ends, most) for a, b in zip(x, y)) == expected


def test_repeated_documents_and_missing_words(spark):
    """Rows that repeat an id are rows each; NULL lists and words count nothing."""
    docs = spark.createDataFrame([(1, ["a", "b", "a", None])] * 3 + [(2, None), (3, [])], "doc bigint, words array<string>")
    for matrix_tokens in (0, 10):
        got = co.cooccurrence_edges(docs, "doc", min_edge=2, matrix_tokens=matrix_tokens).collect()
        assert [(r.a, r.b, r.n) for r in got] == [("a", "b", 3)]


def test_nodes_and_communities(spark):
    # Two triangles joined by one weak edge.
    edges = spark.createDataFrame([("a", "b", 5), ("a", "c", 5), ("b", "c", 5), ("x", "y", 5), ("x", "z", 5), ("y", "z", 5), ("c", "x", 1)],
                                  "a string, b string, n bigint")
    nodes = {r.token: r for r in co.cooccurrence_nodes(edges).collect()}
    assert (nodes["a"].degree, nodes["a"].weighted_degree, nodes["a"].clustering) == (2, 10, 1.0)
    assert (nodes["c"].degree, nodes["c"].weighted_degree, round(nodes["c"].clustering, 6)) == (3, 11, round(1 / 3, 6))
    labels = {r.token: r.community for r in co.communities(edges).collect()}
    assert len({labels[t] for t in "abc"}) == 1 and len({labels[t] for t in "xyz"}) == 1 and labels["a"] != labels["x"]
    shares = co.community_shares(co.communities(edges), edges).groupBy("community").agg(F.round(F.sum("share"), 6).alias("s"))
    assert {r.s for r in shares.collect()} == {1.0}


def test_threads(spark):
    # 5 -> 4 -> 3 -> 2 -> 1 (root), 9 -> 8 -> (missing 7), 6 names itself, 30 branches off 3.
    posts = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 4), (8, 7), (9, 8), (6, 6), (30, 3)], "id bigint, parent bigint")
    starts = spark.createDataFrame([(5,), (9,), (6,), (1,), (30,), (77,)], "id bigint")
    got = {}
    for r in threads.resolve_thread(posts, starts, "id", "parent").orderBy("start_id", "depth").collect():
        got.setdefault(r.start_id, []).append(r.post_id)
    assert got == {5: [5, 4, 3, 2, 1], 9: [9, 8], 6: [6], 1: [1], 30: [30, 3, 2, 1]}
    cycle = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "id bigint, parent bigint")
    with pytest.raises(ValueError):
        threads.resolve_thread(cycle, starts, "id", "parent")


def test_long_thread(spark):
    posts = spark.range(1, 301).select("id", (F.col("id") - 1).alias("parent"))
    chain = threads.resolve_thread(posts, spark.createDataFrame([(300,)], "id bigint"), "id", "parent").collect()
    assert sorted((r.depth, r.post_id) for r in chain) == [(d, 300 - d) for d in range(300)]


def test_ngrams_behind_stopwords(spark, monkeypatch):
    rows, docs = docs_frame(spark, seed=2)
    stop = spark.createDataFrame([("w0",), ("w3",)], "word string")
    want = Counter(" ".join(p) for _, ws in rows for kept in [[w for w in ws if w not in ("w0", "w3")]] for p in zip(kept, kept[1:]))
    in_row = corpus.ngram_count(docs, n=2, stopwords=stop, doc="doc").collect()
    assert {r.token: r.n for r in in_row} == want
    monkeypatch.setattr(corpus, "STOP_LITERALS", 1)
    joined = corpus.ngram_count(docs, n=2, stopwords=stop, doc="doc").collect()
    assert {r.token: r.n for r in joined} == want


def test_word_classes_and_tokenizer(spark):
    tagged = spark.createDataFrame([("d", 0, "猫", "名詞"), ("d", 1, "が", "助詞"), ("d", 2, "走る", "動詞"), ("d", 3, "速い", "形容詞")],
                                   "doc string, pos_no int, surface string, pos string")
    assert [r.surface for r in corpus.pos_filter(tagged).orderBy("pos_no").collect()] == ["猫", "走る", "速い"]
    split = corpus.apply_tokenizer(lambda: str.split)
    texts = spark.createDataFrame([("a b",), (None,)], "text string")
    assert [r[0] for r in texts.select(split("text")).collect()] == [["a", "b"], None]


def test_weights_and_ranks(spark):
    ranked = spark.createDataFrame([("a", 1), ("a", 20), ("b", 21), ("c", 99), ("d", 0), ("e", 5)], "word string, rank int")
    assert {r.word: r.weight for r in trends.rank_weight(ranked).collect()} == {"a": 21, "e": 16}
    stamped = ranked.withColumns({"source": F.lit("s"), "ts": F.lit("2022-05-01").cast("timestamp_ntz")})
    cells = {r.word: r["rank"] for r in trends.matrix_cells(stamped).collect()}
    assert cells["a"] == 20 and cells["@05月01日"] == 99
    wide = trends.pivot_matrix(ranked.withColumn("ts", F.lit("t")), ["a", "e", "zz"]).first().asDict()
    assert wide == {"ts": "t", "a": 20, "e": 5, "zz": 0}


def test_spread_leaves_wide_tables_alone(spark):
    wide = spark.range(0, 100, 1, spark.sparkContext.defaultParallelism)
    assert tables.spread(wide) is wide
    assert tables.spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
