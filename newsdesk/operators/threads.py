"""Reply threads: from a post up to its root by pointer doubling.

The number of joins grows with the logarithm of the longest chain, not with its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsdesk.session import cut_lineage


def jump_tables(posts: DataFrame, post: str, parent: str) -> list[DataFrame]:
    """Tables (id, up): table k leads 2^k steps up; ids with fewer ancestors are absent.

    A parent that is missing from the posts, or a post that names itself, ends the chain.  A cycle
    of several posts has no root and is refused.
    """
    ids = posts.select(F.col(post).alias("up"))
    first = posts.select(F.col(post).alias("id"), F.col(parent).alias("up")).filter("up <> id")
    level = cut_lineage(first.join(ids, "up", "left_semi").select("id", "up"))
    links = level.count()
    tables, steps = [], 1
    while not level.isEmpty():
        tables.append(level)
        if steps > links:
            raise ValueError("the reply chain has a cycle")
        onward = level.select(F.col("id").alias("up"), F.col("up").alias("far"))
        level = cut_lineage(level.join(onward, "up").select("id", F.col("far").alias("up")))
        steps *= 2
    return tables


def resolve_thread(posts: DataFrame, starts: DataFrame, post: str, parent: str) -> DataFrame:
    """The chain of every start post: (start_id, depth, post_id), depth 0 being the post itself.

    `starts` has the post ids in its first column.  First the length of each chain is summed up
    from the jumps that fit, largest first; then each place in it is reached by the jumps of the
    binary form of its depth.
    """
    tables = jump_tables(posts, post, parent)
    start = starts.toDF("start_id").distinct()
    ids = posts.select(F.col(post).alias("start_id"))
    at = start.join(ids, "start_id", "left_semi").select("start_id", F.col("start_id").alias("at"))
    at = at.withColumn("length", F.lit(0).cast("long"))
    for k in reversed(range(len(tables))):
        jump = tables[k].toDF("at", "up")
        at = at.join(jump, "at", "left").select(
            "start_id",
            F.coalesce("up", "at").alias("at"),
            (F.col("length") + F.when(F.col("up").isNotNull(), F.lit(1 << k)).otherwise(F.lit(0))).alias("length"),
        )
    places = at.select(
        "start_id",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("length"))).alias("depth"),
        F.col("start_id").alias("at"),
    )
    for k, table in enumerate(tables):
        # A place that skips this jump keeps its own id as key and simply finds no partner.
        jump = table.toDF("at", "up").withColumn("jumps", F.lit(True))
        places = (
            places.withColumn("jumps", F.col("depth").bitwiseAND(F.lit(1 << k)) != 0)
            .join(jump, ["at", "jumps"], "left")
            .select("start_id", "depth", F.coalesce("up", "at").alias("at"))
        )
    return places.select("start_id", "depth", F.col("at").alias("post_id"))
