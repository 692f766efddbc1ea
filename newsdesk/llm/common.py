"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of an Arrow batch: bounds the memory of a Python worker also where texts are long.
BATCH_ROWS = 1000


def map_batches(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`step` over each Arrow batch of `df`; batches hold at most BATCH_ROWS rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return df.mapInArrow(run, schema)


def text_of(df: DataFrame, text: str = "text") -> Column:
    return F.coalesce(df[text].cast("string"), F.lit(""))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def record_batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()], list(columns))


def shelter(docs: DataFrame, *own: str) -> tuple[DataFrame, Callable[[DataFrame], list[Column]]]:
    """`docs` with every column but `own` renamed, so that no column of the caller meets a working
    column; and a function that names the caller's columns again."""
    safe = {c: c if c in own else f"x__{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*safe.values()), lambda df: [df[s].alias(c) for c, s in safe.items()]


def row_key(docs: DataFrame) -> Column:
    """Names a document by id and text; rows that repeat both are one document."""
    return F.xxhash64(docs["doc_id"], docs["text"])
