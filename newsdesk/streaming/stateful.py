"""Polling with the seen cell values held as stream state instead of a table that is read again.

Every cell of an arriving row becomes a key: the digest of its group, column and value. The state of a
key says that it was seen before; the rows that show an unseen one are new, all of them if they arrive
in the same micro-batch. A snapshot of a stored history can be the initial state. Cells of a task are
first gathered per key into lists of at most LISTED row ids, so that a value that most rows share
reaches its key as few rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from newsdesk.operators.novelty import cells, compared_columns

#: Row ids in one list, and cells a task gathers before it hands its lists on.
LISTED, GATHERED = 4096, 200_000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def digest(key: Iterable[str]) -> Column:
    """One key for a group, column and value; the parts are kept apart by their lengths."""
    parts = [F.coalesce(F.col(k), F.lit("")) for k in key]
    return F.sha2(F.concat(*[x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)]), 256)


class Unseen(StatefulProcessor):
    """Gives the row ids of a key that was not seen in an earlier micro-batch or the initial state."""

    def init(self, handle) -> None:
        self.seen = handle.getValueState("seen", "seen boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if not self.seen.exists():
            self.seen.update((True,))
            for row in rows:
                yield Row(ids=row["ids"])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.seen.update((True,))


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list] = {}
    size = 0

    def lists():
        keys = [k for k, ids in held.items() for _ in range(0, len(ids), LISTED)]
        ids = [ids[i : i + LISTED] for ids in held.values() for i in range(0, len(ids), LISTED)]
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(ids, pa.list_(kind))], ["key", "ids"])

    for batch in batches:
        kind = batch.schema.field("id").type
        for key, row_id in zip(batch.column("key").to_pylist(), batch.column("id").to_pylist()):
            held.setdefault(key, []).append(row_id)
        size += batch.num_rows
        if size >= GATHERED:
            yield lists()
            held, size = {}, 0
    if size:
        yield lists()


def fresh_ids(stream: DataFrame, row_id: str, excluded: Iterable[str] = (), group: Iterable[str] = (),
              seen: DataFrame | None = None) -> DataFrame:
    """Ids of the rows of a stream that hold a value their column (of their group) has not shown before.

    An id comes once per unseen value.  `seen` holds the values known before the stream began, as
    `History.seen()` gives them. The stream's id must not be NULL.
    """
    group = list(group)
    key = [*group, "col", "val"]
    columns = compared_columns(stream, [row_id, *group, *excluded])
    kind = stream.schema[row_id].dataType.simpleString()
    long = cells(stream, columns, [row_id, *group]).select(digest(key).alias("key"), F.col(row_id).alias("id"))
    lists = long.mapInArrow(_gather, f"key string, ids array<{kind}>")
    known = None if seen is None else seen.select(digest(key).alias("key")).distinct().groupBy("key")
    found = lists.groupBy("key").transformWithState(Unseen(), f"ids array<{kind}>", "Append", "None", known)
    return found.select(F.explode("ids").alias(row_id))


def start(ids: DataFrame, folder: str) -> StreamingQuery:
    """Run over everything landed so far and stop; ids are written exactly once, also over restarts.

    The state lives in RocksDB below the checkpoint, so it does not fill the memory of the executors.
    """
    spark: SparkSession = ids.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = ids.writeStream.format("parquet").option("path", f"{folder}/fresh").option("checkpointLocation", f"{folder}/checkpoint")
    return writer.outputMode("append").trigger(availableNow=True).start()


def fresh_rows(landed: DataFrame, folder: str, row_id: str) -> DataFrame:
    """The landed rows that were new when they arrived."""
    ids = landed.sparkSession.read.schema(landed.select(row_id).schema).parquet(f"{folder}/fresh").distinct()
    return landed.join(ids, row_id, "left_semi")
