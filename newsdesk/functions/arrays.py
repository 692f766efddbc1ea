"""Array columns: alternating lists, capped and trimmed lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.functions import text as tx


def pairs(items: Column, skip: int = 0, names: tuple[str, str] = ("title", "url")) -> Column:
    """A flat list `[a, b, a, b, …]` as array of structs; an odd tail is dropped.

    `skip` leading items are passed over.
    """
    count = F.floor((F.size(items) - skip) / 2).cast("int")
    made = F.transform(
        F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1),
        lambda i: F.struct(
            F.get(items, i * 2 + skip).alias(names[0]),
            F.get(items, i * 2 + skip + 1).alias(names[1]),
        ),
    )
    return F.when(count >= 1, made).otherwise(F.slice(made, 1, 0))


def item_rows(df: DataFrame, array: str, *keep: str, item: str = "item", pos: str | None = None) -> DataFrame:
    """One row per item of an array column, with its zero-based position if `pos` names one.

    For a plain `explode` the optimiser adds a filter on the size of the array and pushes it below
    the projection that computes the array, so a costly array is computed twice, and inside a
    lambda once per item.  The outer form with a filter on its output avoids that.
    """
    if pos is None:
        return df.select(*keep, F.explode_outer(array).alias(item)).filter(F.col(item).isNotNull())
    return df.select(*keep, F.posexplode_outer(array).alias(pos, item)).filter(F.col(pos).isNotNull())


def alternating(pair_list: Column, names: tuple[str, str] = ("title", "url")) -> Column:
    """The inverse of `pairs`."""
    return F.flatten(F.transform(pair_list, lambda p: F.array(p[names[0]], p[names[1]])))


def rank_word_lines(block: Column) -> Column:
    """Text block whose first line is a title and whose other lines alternate rank and word."""
    return pairs(tx.lines(block, r"\R"), skip=1, names=("rank", "word"))


def trim_ends(items: Column, head: int = 2, tail: int = 4) -> Column:
    """Drop the first `head` and last `tail` items; short lists become empty."""
    return F.slice(items, F.lit(head + 1), F.greatest(F.size(items) - (head + tail), F.lit(0)))


def first_n(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)
