"""Text, CSV and XML files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsdesk.functions import text as tx
from newsdesk.operators.novelty import merge_newest_first, novelty_cells
from newsdesk.operators.trends import accumulate_sum

XML_DOC = "struct<_title:string,_VALUE:string>"


def text_lines(spark: SparkSession, path: str, marker: str) -> DataFrame:
    """Content lines of text files as (file, stream)."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("stream"))
    kept = raw.filter(tx.is_content_line(F.col("stream"), marker))
    return kept.withColumn("stream", tx.rstrip(F.col("stream")))


def stopwords(spark: SparkSession, path: str) -> DataFrame:
    """Stopword list: one word per line, trimmed, empty lines dropped."""
    words = spark.read.text(path).select(tx.strip(F.col("value")).alias("word"))
    return words.filter("word <> ''")


def xml_docs(spark: SparkSession, path: str) -> DataFrame:
    """Documents of an XML file with their title and text; the file is split at `<doc` elements."""
    schema = "_title string, _VALUE string"
    return spark.read.format("xml").option("rowTag", "doc").schema(schema).load(path)


def xml_doc(markup: Column) -> Column:
    """One XML document held in a column as struct<_title, _VALUE>."""
    return F.from_xml(markup, XML_DOC.removeprefix("struct<").removesuffix(">").replace(":", " "))


def read_history_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("enforceSchema", "false").csv(path, header=True)


def _exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def csv_history_merge(
    batch: DataFrame, old: str, new: str, row_id: str, excluded: Iterable[str] = ()
) -> DataFrame:
    """Merge a batch into the CSV history at `old`, write the result to `new`, return what is new.

    Old and new are different folders: Spark reads the one while it writes the other, and readers
    switch when the job is through.  `row_id` orders the rows and is not compared.
    """
    spark, excluded = batch.sparkSession, list(excluded)
    if not _exists(spark, old):
        batch.write.mode("overwrite").csv(new, header=True)
        return batch
    history = read_history_csv(spark, old, batch.schema)
    merged = merge_newest_first(batch, history, row_id, excluded, fill=0)
    merged.write.mode("overwrite").csv(new, header=True)
    return novelty_cells(batch, history, row_id, excluded)


def csv_accumulate(batch: DataFrame, old: str, new: str, key: str) -> DataFrame:
    """Add a batch of numbers to the CSV table at `old` per key and write the sums to `new`."""
    spark = batch.sparkSession
    frames = [batch]
    if _exists(spark, old):
        # Columns the batch lacks are read as they were written: whole numbers or decimals.
        found = spark.read.options(header=True, inferSchema=True).csv(old).schema
        known = {f.name: f.dataType.simpleString() for f in batch.schema}
        schema = ", ".join(f"`{f.name}` {known.get(f.name) or ('bigint' if f.dataType.simpleString() in ('int', 'bigint') else 'double')}" for f in found)
        frames.insert(0, read_history_csv(spark, old, schema))
    total = accumulate_sum(frames, key)
    total.write.mode("overwrite").csv(new, header=True)
    return read_history_csv(spark, new, total.schema)
