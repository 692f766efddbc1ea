"""Ranks, caps per group and top-k.  Caps cut inside each task before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsdesk.functions import arrays as ar
from newsdesk.operators.joins import join_unique
from newsdesk.session import store

#: Rows a task gathers before it drops those beyond their key's limit.
GATHERED_ROWS = 50_000


def position_rank(lists: DataFrame, items: str, out: str = "word") -> DataFrame:
    """One row per list item with its rank, starting at 1."""
    others = [c for c in lists.columns if c != items]
    long = ar.item_rows(lists, items, *others, item=out, pos="rank")
    return long.withColumn("rank", F.col("rank") + 1)


def limit_rank(ranked: DataFrame, top: int = 20) -> DataFrame:
    return ranked.filter(F.col("rank").between(1, top))


def cap_per_group(df: DataFrame, group: Iterable[str], order: Iterable[Column | str], k: int,
                  rank: str | None = None) -> DataFrame:
    """First `k` rows of every group in the given order; `rank` names a column for their number."""
    name = rank or "_rank"
    numbered = df.withColumn(name, F.row_number().over(W.partitionBy(*group).orderBy(*order)))
    capped = numbered.filter(F.col(name) <= k)
    return capped if rank else capped.drop(name)


def recent_per_user(posts: DataFrame, user: str, time: str, post_id: str, n: int) -> DataFrame:
    """At most `n` posts of every user, newest first."""
    return cap_per_group(posts, [user], [F.desc(time), F.desc(post_id)], n)


def _first_of_keys(rows: pa.Table, key: str, order: list[str], limit: str) -> pa.Table:
    """The rows of a table within the limit of their key, greatest first."""
    at = pc.sort_indices(rows, [(key, "ascending"), *[(c, "descending") for c in order]], null_placement="at_end")
    rows = rows.take(at)
    keys = pc.dictionary_encode(rows[key].combine_chunks(), null_encoding="encode")
    code = keys.indices.to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, int)
    number = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
    return rows.filter(pa.array(number < rows[limit].to_numpy()))


def top_per_key(df: DataFrame, limits: DataFrame, key: str, order: list[str], n: str = "n") -> DataFrame:
    """The rows of every listed key with the greatest `order` columns, as many as `limits` (key, n) grants it.

    Keys that are not listed have no rows; of a key that is listed twice the larger number counts. Each
    task keeps no more than the granted rows of a key of what it has read (numbers, texts or times;
    NULL comes last), so a key that holds much of the table sends no more than that from any task.
    """
    granted = limits.groupBy(key).agg(F.max(n).cast("bigint").alias("_granted")).filter("_granted > 0")
    rows = join_unique(df, granted, key, hot=0, narrow=True)
    schema = rows.schema

    def cut(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= GATHERED_ROWS:
                kept = _first_of_keys(pa.Table.from_batches(held), key, order, "_granted")
                if kept.num_rows > GATHERED_ROWS // 2:  # many keys: they go on, and are cut again at the end
                    yield from kept.to_batches()
                    held, size = [], 0
                else:
                    held, size = kept.to_batches(), kept.num_rows
        if size:
            yield from _first_of_keys(pa.Table.from_batches(held), key, order, "_granted").to_batches()

    few = rows.mapInArrow(cut, schema)
    place = F.row_number().over(W.partitionBy(key).orderBy(*[F.desc(c) for c in order]))
    return few.withColumn("_place", place).filter("_place <= _granted").select(*df.columns)


def numbered(df: DataFrame, order: list[str], out: str = "number") -> DataFrame:
    """`df` with the place of every row in the given order, from 0.

    Rows are dealt out by ranges and counted per task; only these counts, one per task, meet in one place.
    """
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = store(ordered.withColumn("_part", F.shiftright("_at", 33)))
    parts = ordered.groupBy("_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    shifts = parts.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return ordered.join(F.broadcast(shifts), "_part").withColumn(out, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def first_match(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """Value at the smallest position of every key."""
    return df.groupBy(key).agg(F.min_by(value, pos).alias(value))


def last_wins(df: DataFrame, keys: Iterable[str], pos: str, value: str) -> DataFrame:
    """Value at the largest position of every key."""
    return df.groupBy(*keys).agg(F.max_by(value, pos).alias(value))


def topk(counts: DataFrame, k: int, weight: str = "n", tie: str = "token") -> DataFrame:
    """The `k` heaviest rows; ties go by name."""
    return counts.orderBy(F.desc(weight), tie).limit(k)


def stacked_offset(df: DataFrame, group: str, pos: str, value: str, out: str = "offset") -> DataFrame:
    """Where each value starts when the values of a group are stacked in order.

    Meant for one row per group and series, so a group holds as many rows as there are series.
    """
    before = W.partitionBy(group).orderBy(pos).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(out, F.coalesce(F.sum(value).over(before), F.lit(0)))
