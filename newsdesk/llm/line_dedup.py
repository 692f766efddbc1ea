"""Line dedup by overlapping three-line windows, with DataFrame functions only.

Each run of three consecutive lines is hashed (128 bits). A window that occurs more than once keeps its
first occurrence, by (document id, position); the lines that any later occurrence covers are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsdesk.llm.common import shelter

LINES = 3


def _key(docs: DataFrame) -> list[Column]:
    """Names a document: id (NULL stays apart from numbers) and text."""
    return [F.coalesce(docs["doc_id"].cast("string"), F.lit("null")).alias("_id"), F.xxhash64(docs["text"]).alias("_hash")]


def _windows(docs: DataFrame) -> DataFrame:
    """_id, _hash, pos and the window's digest (w1, w2), for every window with a word in it."""
    split = docs.select(*_key(docs), docs["doc_id"].alias("_doc"), F.split(docs["text"], "\n", -1).alias("_lines"))
    split = split.filter(F.size("_lines") >= LINES)

    def digest(i: Column) -> Column:
        rows = [F.get(F.col("_lines"), i + k) for k in range(LINES)]
        return F.struct(i.alias("pos"), F.xxhash64(*rows).alias("w1"), F.xxhash64(F.lit(1), *reversed(rows)).alias("w2"), F.concat(*rows).rlike(r"[^\x20\x09-\x0D]").alias("some"))

    spots = F.transform(F.sequence(F.lit(0), F.size("_lines") - LINES), digest)
    return split.select("_id", "_hash", "_doc", F.explode(spots).alias("s")).select("_id", "_hash", "_doc", "s.*").filter("some").drop("some")


def removed_lines(docs: DataFrame) -> DataFrame:
    """_id, _hash and the sorted line numbers to remove, for documents that lose lines.

    First means the smallest (doc_id, id text, text hash, position); a NULL id comes first.
    """
    windows = _windows(docs)
    order = F.struct("_doc", "_id", "_hash", "pos")
    repeated = windows.groupBy("w1", "w2").agg(F.min(order).alias("first"), F.max(order).alias("last")).filter(~F.col("first").eqNullSafe(F.col("last")))
    later = windows.join(repeated.select("w1", "w2", "first"), ["w1", "w2"]).filter(~order.eqNullSafe(F.col("first")))
    spots = later.groupBy("_id", "_hash").agg(F.collect_set("pos").alias("_starts"))
    covered = F.array_distinct(F.flatten(F.transform("_starts", lambda p: F.sequence(p, p + (LINES - 1)))))
    return spots.select("_id", "_hash", F.array_sort(covered).alias("_removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`; `text` loses the covered lines and `n_removed_lines` follows.

    NULL and empty texts and texts under three lines stay as they are. Rows that repeat a whole
    document (same id, same text) are one document and get the same text. Windows without a word
    never count. The order of the kept lines is that of the input. The time a text takes grows in
    proportion to its lines.
    """
    inner, restore = shelter(docs.drop("n_removed_lines"), "doc_id", "text")
    both = inner.select("*", *_key(inner)).join(removed_lines(inner), ["_id", "_hash"], "left")

    def left(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_removed")  # by a hash set, in order
        return F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")

    # The text is split once, outside the lambda that reads its lines.
    kept = F.transform(F.array(F.split("text", "\n", -1)), left)[0]
    changed = both.withColumn("text", F.when(F.col("_removed").isNull(), F.col("text")).otherwise(kept))
    return changed.select(*restore(changed), F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed")).cast("bigint").alias("n_removed_lines"))
