"""What is new against stored history: per cell value, per row, or row after row; and merging.

A row is *new* when at least one of its cells holds a value its column has not seen before.  This
is weaker than "the row is unseen": history {(1,x),(2,y)} makes (1,y) not new.

Cells are compared as text with a mark for their type class, so NULL is an ordinary value, the text
"1" differs from the number 1, and 1 and 1.0 are one number. Long values are compared by digest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsdesk.operators.joins import HOT_KEYS, accepted_rows
from newsdesk.session import cut_lineage

# Keys of a batch that are sent to the history instead of shuffling it; a cell has at most CELL_CHARS
# characters, or 65 with its digest.
BROADCAST_KEYS = 500_000
CELL_CHARS = 64


def _plain(df: DataFrame, name: str) -> Column:
    """A value as text; equal numbers of different types (1, 1.0, 1.00) have one text."""
    kind, text = df.schema[name].dataType, F.col(name).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        whole = (F.col(name) == F.floor(name)) & (F.abs(name) < F.lit(float(1 << 53)))
        return F.when(whole, F.col(name).cast("bigint").cast("string")).otherwise(text)
    if isinstance(kind, T.DecimalType) and kind.scale > 0:
        return F.regexp_replace(text, r"\.?0+$", "")
    return text


def _cell(df: DataFrame, name: str) -> Column:
    """A value as a key of bounded length: the text of long values gives way to its digest."""
    mark = F.lit("t" if isinstance(df.schema[name].dataType, T.StringType) else "v")
    text = F.coalesce(F.concat(mark, _plain(df, name)), F.lit(""))
    digest = F.concat(F.lit("d"), F.sha2(text, 256))
    return F.when(F.length(text) <= CELL_CHARS, text).otherwise(digest).alias(name)


def cells(df: DataFrame, columns: list[str], ids: Iterable[str] = ()) -> DataFrame:
    """One row per cell: the id columns, `col` and `val`."""
    ids = list(ids)
    kept = [F.col(i).alias(f"_{i}") for i in ids]
    shaped = df.select(*kept, *[_cell(df, c) for c in columns])
    long = shaped.unpivot([f"_{i}" for i in ids], columns, "col", "val")
    return long.withColumnsRenamed({f"_{i}": i for i in ids})


def compared_columns(batch: DataFrame, excluded: Iterable[str]) -> list[str]:
    excluded = set(excluded)
    return [c for c in batch.columns if c not in excluded]


def unseen(tally: DataFrame, past: DataFrame | Callable[[DataFrame], DataFrame], key: list[str]) -> DataFrame:
    """The tally (one row per key) with the verdict `ok`: the key does not occur in `past`.

    `past` may be a function that gives the past for the stored tally: an index reads only what its keys need.

    A batch is usually small against its history.  The tally is stored and counted: up to
    `BROADCAST_KEYS` keys it is sent to the history, which is then filtered where it lies and
    never shuffled; beyond that, history is reduced to distinct keys before the join.  The verdicts
    are stored as well: they are used several times and history must be read only once.
    """
    tally = cut_lineage(tally)
    past = past(tally) if callable(past) else past
    if tally.count() <= BROADCAST_KEYS:
        known = past.join(F.broadcast(tally.select(*key)), key, "left_semi").distinct()
    else:
        known = past.distinct()
    judged = tally.join(known.withColumn("_known", F.lit(True)), key, "left")
    return cut_lineage(judged.withColumn("ok", F.col("_known").isNull()).drop("_known"))


def past_cells(history: DataFrame, columns: list[str], group: Iterable[str] = ()) -> DataFrame:
    """The cells of the named columns of history, one row per cell."""
    group = list(group)
    return cells(history.select(*group, *columns), columns, group)


def rows_with_fresh_cells(
    batch: DataFrame, past: DataFrame, row_id: str, columns: list[str], group: Iterable[str] = (),
    hot: int = HOT_KEYS,
) -> DataFrame:
    """Batch rows with a cell outside `past` (group, col, val).

    Values are first counted and judged once each, so the comparison with history has one row per
    value on both sides.  The verdict then returns to the rows: the most frequent values by
    broadcast of at most `hot` rows, the others by a join in which no value is frequent.
    """
    key = [*group, "col", "val"]
    ours = cells(batch, columns, [row_id, *group])
    judged = unseen(ours.groupBy(*key).agg(F.count("*").alias("n")), past, key)
    fresh = accepted_rows(ours, judged, key, hot).select(row_id).distinct()
    return batch.join(fresh, row_id, "left_semi")


def novelty_cells(
    batch: DataFrame, history: DataFrame, row_id: str, excluded: Iterable[str] = (),
    group: Iterable[str] = (), hot: int = HOT_KEYS,
) -> DataFrame:
    """Batch rows with at least one unseen cell value.

    `row_id` is a stable unique id of the batch rows; it and the `excluded` columns are not
    compared.  `group` columns (never NULL) name the table a row belongs to: every table has its
    own history.  A compared column that history lacks makes every row new.
    """
    group = list(group)
    columns = compared_columns(batch, [row_id, *group, *excluded])
    if any(c not in history.columns for c in columns):
        return batch
    past = past_cells(history, columns, group)
    return rows_with_fresh_cells(batch, past, row_id, columns, group, hot)


def novelty_rows(batch: DataFrame, history: DataFrame, excluded: Iterable[str] = ()) -> DataFrame:
    """Batch rows whose combination of values is not in history (NULL equals NULL).

    The stricter alternative to `novelty_cells`.  Batch and history meet as distinct combinations;
    the verdict returns to the rows by a join that is safe for rows with very many copies.
    """
    columns = compared_columns(batch, excluded)
    keys = [f"_k_{c}" for c in columns]
    ours = batch.withColumns({f"_k_{c}": _cell(batch, c) for c in columns})
    theirs = history.select(*[_cell(history, c).alias(f"_k_{c}") for c in columns])
    judged = unseen(ours.groupBy(*keys).agg(F.count("*").alias("n")), theirs, keys)
    return accepted_rows(ours, judged, keys).select(*batch.columns)


def novelty_sequential(
    batch: DataFrame, history: DataFrame, seq: str, group: Iterable[str] = (), excluded: Iterable[str] = ()
) -> DataFrame:
    """Novelty with history growing row after row: repeats inside the batch are not new again.

    `seq` (unique within `group`) gives the order.  A row is new when it is the first to hold some
    value that history does not have; the minimum per value is combined before the shuffle and the
    result is matched back on the unique (group, seq).
    """
    group = list(group)
    columns = compared_columns(batch, [seq, *group, *excluded])
    if any(c not in history.columns for c in columns):
        return batch
    key = [*group, "col", "val"]
    first = cells(batch, columns, [*group, seq]).groupBy(*key).agg(F.min(seq).alias(seq))
    judged = unseen(first, past_cells(history, columns, group), key)
    fresh = judged.filter("ok").select(*group, seq).distinct()
    return batch.join(fresh, [*group, seq], "left_semi")


def merge_newest_first(
    batch: DataFrame,
    history: DataFrame,
    seq: str,
    excluded: Iterable[str] = (),
    fill: int | None = None,
) -> DataFrame:
    """Batch rows on top of history without repeats; of equal rows the newest copy stays.

    `excluded` columns (and `seq`, the order inside each frame) do not take part in the
    comparison; their values come from the copy that stays.  Columns may differ between the
    frames.  `fill` replaces missing values afterwards, as in an export.
    """
    excluded = list(excluded)
    both = batch.withColumn("_side", F.lit(0)).unionByName(history.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_age", F.struct("_side", seq)).drop("_side")
    columns = [c for c in both.columns if c not in {seq, "_age", *excluded}]
    kept = both.groupBy(*columns).agg(*[F.min_by(c, "_age").alias(c) for c in [seq, *excluded]])
    kept = kept.select(*[c for c in both.columns if c != "_age"])
    return kept if fill is None else kept.fillna(fill, subset=columns)


def union_outer_schema(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both frames; a column one of them lacks is NULL there."""
    return first.unionByName(second, allowMissingColumns=True)


def union_flagged(featured: DataFrame, latest: DataFrame, flag: str = "pick_up") -> DataFrame:
    """Featured rows and latest rows, told apart by a flag; a row may appear in both."""
    return featured.withColumn(flag, F.lit(True)).unionByName(latest.withColumn(flag, F.lit(False)))


def map_union(first: Column, second: Column) -> Column:
    """Union of two maps in which the second one wins."""
    return F.map_concat(F.map_filter(first, lambda k, _: ~F.map_contains_key(second, k)), second)
