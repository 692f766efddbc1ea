"""Connected components of a table of edges by alternating large-star and small-star steps.

Each step hangs neighbours on the smallest of them; the number of rounds grows with the logarithm of
the number of vertices. Only per-vertex minima are gathered, so a vertex of any degree is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.session import store


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = store(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    larger = both.filter("v > u")
    return larger.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges come as u > v."""
    least = store(edges.groupBy("u").agg(F.min("v").alias("m")))
    hung = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of `edges` (columns u, v); the component is its smallest id."""
    now = store(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        now = store(_small_star(store(_large_star(now))))
    members = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.union(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
