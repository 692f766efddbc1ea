"""Published documents: pages by target database, blocks by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter
from pyspark.sql import functions as F


def page_rows(df: DataFrame, key: Column, database: Column, payload: Column, *fields: str) -> DataFrame:
    """One row per page to publish: its key, database, document text and flat fields."""
    return df.select(
        key.alias("page_key"), database.alias("database"), F.to_json(payload).alias("payload"), *fields
    )


def block_rows(df: DataFrame, key: Column, blocks: Column) -> DataFrame:
    """One row per block of a page, in order."""
    listed = df.select(key.alias("page_key"), F.posexplode(blocks).alias("block_pos", "block"))
    return listed.select("page_key", "block_pos", F.to_json("block").alias("payload"))


def _writer(df: DataFrame, run: str | int | None) -> tuple[DataFrameWriter, str]:
    """A named run replaces its own folder when it is repeated; without a name rows are appended."""
    return (df.write.mode("append"), "") if run is None else (df.write.mode("overwrite"), f"/run={run}")


def publish_pages(pages: DataFrame, folder: str, run: str | int | None = None, partition: str = "database") -> None:
    """Write page documents, one folder per database.

    Tasks write their own files for every database they hold, so a large database needs no shuffle.
    """
    writer, place = _writer(pages, run)
    writer.partitionBy(partition).json(folder + place)


def publish_blocks(blocks: DataFrame, folder: str, run: str | int | None = None) -> None:
    writer, place = _writer(blocks, run)
    writer.parquet(folder + place)


def write_targets(df: DataFrame, folder: str, run: str | int | None = None, target: str = "target") -> None:
    """One table per target value inside one partitioned folder.

    Rows are rebalanced by target: small targets are written by one task each, a large one is split.
    """
    writer, place = _writer(df.hint("rebalance", F.col(target)), run)
    writer.partitionBy(target).parquet(folder + place)
