"""Every poll is a micro-batch: compare with history, publish what is new, store the batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from newsdesk.sources.history import History


def landing(spark: SparkSession, folder: str, schema: T.StructType | str, files_per_poll: int | None = None,
            fmt: str = "parquet") -> DataFrame:
    """Stream over the files that arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_poll is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_poll)
    return reader.load(folder)


def ingest(
    stream: DataFrame, history: History, checkpoint: str, publish: Callable[[DataFrame], dict[str, DataFrame]] | None = None
) -> StreamingQuery:
    """Start a run that handles everything landed so far and stops.

    The checkpoint gives every file to exactly one batch id. History and the tables that `publish` makes
    of the new rows change by one commit under that id, so a batch that is repeated after a failure
    either finds nothing of itself or all of it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            history.merge(batch, batch_id, publish)

    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
