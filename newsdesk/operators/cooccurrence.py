"""Co-occurrence graph: frequent token pairs, node measures, communities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.operators.joins import accepted_rows, is_narrow, join_unique
from newsdesk.operators.ranking import numbered
from newsdesk.session import cut_lineage, store

MIN_EDGE = 100
# Vocabularies up to this size are counted as a matrix per task, larger ones as rows.
MATRIX_TOKENS = 2000
MATRIX_DOCS = 2048
# Pairs of numbers a task makes before it adds them up, and different ones it holds before it sends them.
PAIRS_AT_ONCE = 1 << 22
PAIRS_HELD = 1 << 24


def cooccurrence_edges(
    docs: DataFrame,
    doc: str,
    words: str = "words",
    min_edge: int = MIN_EDGE,
    stopwords: DataFrame | None = None,
    matrix_tokens: int = MATRIX_TOKENS,
) -> DataFrame:
    """Unordered token pairs (a < b) that share at least `min_edge` rows (a document or a line of one).

    An edge needs both tokens in `min_edge` rows, so rarer tokens leave before any pair is
    counted (exact).  What is left is usually a short vocabulary: its size is checked, and each task
    then sums one matrix over its documents instead of making pairs.  A longer vocabulary is
    counted by `_pairs_by_product`.
    """
    docs = docs.filter(F.col(words).isNotNull()).withColumn(words, F.array_compact(words))
    tokens = ar.item_rows(docs.select(doc, F.array_distinct(words).alias("t")), "t", doc, item="token")
    judged = tokens.groupBy("token").agg(F.count("*").alias("n")).withColumn("ok", F.col("n") >= min_edge)
    if stopwords is not None:
        marked = stopwords.toDF("token").distinct().withColumn("stop", F.lit(True))
        judged = judged.join(marked, "token", "left").withColumn("ok", F.col("ok") & F.col("stop").isNull())
    judged = cut_lineage(judged.select("token", "n", "ok"))
    listed = judged.filter("ok").select("token").limit(matrix_tokens + 1).collect()
    if len(listed) <= matrix_tokens:
        return _pairs_by_matrix(docs, words, sorted(r[0] for r in listed)).filter(F.col("n") >= min_edge)
    return _pairs_by_product(docs, words, judged, min_edge)


def _pairs_by_matrix(docs: DataFrame, words: str, vocabulary: list[str]) -> DataFrame:
    """Pair counts over a short vocabulary: one matrix per task, summed by pair."""
    kept = docs.select(F.filter(words, lambda t: t.isin(vocabulary)).alias("t"))
    local = kept.mapInPandas(_matrix_counter(vocabulary), "a string, b string, n bigint")
    return local.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _matrix_counter(vocabulary: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    names = np.array(vocabulary, dtype=object)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = pd.Index(names)
        total = np.zeros((len(names), len(names)), dtype=np.int64)
        for batch in batches:
            for start in range(0, len(batch), MATRIX_DOCS):
                lists = batch["t"].iloc[start : start + MATRIX_DOCS].tolist()
                sizes = [len(t) for t in lists]
                if not sum(sizes):
                    continue
                held = np.zeros((len(lists), len(names)), dtype=np.float32)
                held[np.repeat(np.arange(len(lists)), sizes), index.get_indexer(np.concatenate(lists))] = 1
                total += (held.T @ held).astype(np.int64)
        a, b = np.nonzero(np.triu(total, 1))
        yield pd.DataFrame({"a": names[a], "b": names[b], "n": total[a, b]})

    return count


def _pairs_by_product(docs: DataFrame, words: str, judged: DataFrame, min_edge: int) -> DataFrame:
    """Pair counts over a long vocabulary: numbered tokens, one sparse product per task, names joined last.

    The frequent tokens are numbered and every document becomes the row of its numbers. A task adds up
    the products of its rows; what it sends is one row per pair of numbers that it has met, never one
    per document.
    """
    names = store(numbered(judged.filter("ok").select("token"), ["token"], "id"))
    if is_narrow(names):
        listed = names.orderBy("id").toPandas()["token"].tolist()
        sent = docs.sparkSession.sparkContext.broadcast(listed)
        rows, mapped = docs.select(F.array_distinct(words).alias("t")), True
    else:  # documents are numbered once and stored, so that a repeated id does not merge its rows
        sent, mapped = None, False
        stored = store(docs.select(F.monotonically_increasing_id().alias("row"), F.array_distinct(words).alias("t")))
        tokens = ar.item_rows(stored, "t", "row", item="token")
        kept = accepted_rows(tokens, judged, ["token"]).join(names, "token")
        rows = kept.groupBy("row").agg(F.collect_list("id").alias("t")).select("t")
    pairs = rows.mapInArrow(_product_counter(sent, mapped), "a bigint, b bigint, n bigint")
    edges = pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_edge)
    first, second = (names.select(F.col("token").alias(t), F.col("id").alias(i)) for t, i in (("x", "a"), ("y", "b")))
    named = join_unique(join_unique(edges, first, "a", hot=0, narrow=True), second, "b", hot=0, narrow=True)
    return named.select(F.col("x").alias("a"), F.col("y").alias("b"), "n")


def row_pairs(ids: np.ndarray, ends: np.ndarray, most: int = PAIRS_AT_ONCE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of numbers that stand in the same row, in pieces of about `most` pairs.

    Row r is ids[ends[r - 1]:ends[r]], ascending.
    """
    partners = np.repeat(ends, np.diff(np.append(0, ends))) - np.arange(len(ids)) - 1
    upto = np.cumsum(partners)
    start = 0
    while start < len(ids):
        base = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, base + most, "right")))
        many = partners[start:stop]
        first = np.repeat(np.arange(start, stop), many)
        second = np.arange(len(first)) - np.repeat(np.cumsum(many) - many, many) + first + 1
        yield ids[first], ids[second]
        start = stop


def _product_counter(sent, mapped: bool):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pd.Index(sent.value) if mapped else None
        codes, counts, waiting, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            fresh, times = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (codes[:0], counts[:0])
            every, place = np.unique(np.concatenate([codes, fresh]), return_inverse=True)
            total = np.zeros(len(every), np.int64)
            np.add.at(total, place, np.concatenate([counts, times]))
            return every, total

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes >> 32), pa.array(codes & 0xFFFFFFFF), pa.array(counts)], ["a", "b", "n"])

        for batch in batches:
            lists = batch.column(0)
            flat = lists.flatten()
            owner = np.repeat(np.arange(len(lists)), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
            ids = index.get_indexer(flat.to_pandas()) if mapped else flat.to_numpy(zero_copy_only=False)
            owner, ids = owner[ids >= 0], ids[ids >= 0].astype(np.int64)
            order = np.lexsort((ids, owner))
            owner, ids = owner[order], ids[order]
            ends = np.cumsum(np.bincount(owner, minlength=len(lists)))
            for a, b in row_pairs(ids, ends):
                waiting.append(a << 32 | b)
                size += len(a)
                if size >= PAIRS_AT_ONCE:
                    codes, counts = merged()
                    waiting, size = [], 0
                    if len(codes) > PAIRS_HELD:  # sent early, summed by Spark all the same
                        yield rows()
                        codes, counts = codes[:0], counts[:0]
        codes, counts = merged()
        if len(codes):
            yield rows()

    return count


def both_ways(edges: DataFrame) -> DataFrame:
    """Every edge in both directions as (token, other, n); edges are read once."""
    ends = F.array(
        F.struct(F.col("a").alias("token"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("token"), F.col("a").alias("other")),
    )
    return edges.select(F.explode(ends).alias("e"), "n").select("e.*", "n")


def cooccurrence_nodes(edges: DataFrame) -> DataFrame:
    """Degree, weighted degree and clustering coefficient of every node.

    Edges point from the node of lower degree to the one of higher degree, which bounds the
    partners of any node by the square root of twice the number of edges; every triangle is then
    found exactly once.
    """
    edges = cut_lineage(edges)
    nodes = both_ways(edges).groupBy("token").agg(
        F.count("*").alias("degree"), F.sum("n").alias("weighted_degree")
    )
    degree = nodes.select("token", "degree")
    a = degree.toDF("a", "da")
    b = degree.toDF("b", "db")
    forward = F.struct("da", "a") < F.struct("db", "b")
    ranked = edges.select("a", "b").join(a, "a").join(b, "b")
    oriented = ranked.select(
        F.when(forward, F.col("a")).otherwise(F.col("b")).alias("low"),
        F.when(forward, F.col("b")).otherwise(F.col("a")).alias("high"),
        F.when(forward, F.col("db")).otherwise(F.col("da")).alias("rank"),
    )
    oriented = cut_lineage(oriented)
    one = oriented.select("low", F.col("high").alias("x"), F.col("rank").alias("rx"))
    two = oriented.select("low", F.col("high").alias("y"), F.col("rank").alias("ry"))
    wedges = one.join(two, "low").filter(F.struct("rx", "x") < F.struct("ry", "y"))
    closing = oriented.select(F.col("low").alias("x"), F.col("high").alias("y"))
    triangles = wedges.join(closing, ["x", "y"])
    corners = triangles.select(F.explode(F.array("low", "x", "y")).alias("token"))
    per_node = corners.groupBy("token").agg(F.count("*").alias("triangles"))
    possible = F.col("degree") * (F.col("degree") - 1) / 2
    share = F.when(F.col("degree") > 1, F.coalesce("triangles", F.lit(0)) / possible).otherwise(F.lit(0.0))
    return nodes.join(per_node, "token", "left").select(
        "token", "degree", "weighted_degree", share.alias("clustering")
    )


def communities(edges: DataFrame, rounds: int = 5) -> DataFrame:
    """Community of every node by label propagation with a fixed number of rounds.

    In each round a node takes the label with the largest edge weight among its neighbours and
    itself (its own label counts with its heaviest edge); ties go to the smallest label.  Labels
    are written to the shared folder after every round but the last, which keeps plans short and
    lets the next join split the edges of a hub.
    """
    links = cut_lineage(both_ways(edges))
    own = links.groupBy("token").agg(F.max("n").alias("n"))
    votes_from = links.unionByName(own.select("token", F.col("token").alias("other"), "n"))
    labels = own.select("token", F.col("token").alias("label"))
    for turn in range(1, rounds + 1):
        spread = votes_from.join(labels.withColumnRenamed("token", "other"), "other")
        votes = spread.groupBy("token", "label").agg(F.sum("n").alias("n"))
        best = votes.groupBy("token").agg(F.min(F.struct(-F.col("n"), F.col("label").alias("label"))).alias("m"))
        labels = best.select("token", F.col("m.label").alias("label"))
        if turn < rounds:
            labels = cut_lineage(labels)
    return labels.withColumnRenamed("label", "community")


def community_shares(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """Word, community and the word's share of its community's edge weight."""
    weight = both_ways(edges).groupBy("token").agg(F.sum("n").alias("weight"))
    rows = labels.join(weight, "token")
    total = rows.groupBy("community").agg(F.sum("weight").alias("total"))
    return rows.join(total, "community").select(
        "community", "token", "weight", (F.col("weight") / F.col("total")).alias("share")
    )
