"""Named tables and job parameters."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pruned(df: DataFrame) -> DataFrame:
    """Without rows that are all NULL, then without columns that are all NULL.

    One aggregate pass finds the empty columns; it brings one row of counts to the driver.
    """
    rows = df.dropna("all")
    filled = rows.agg(*[F.count(c).alias(c) for c in rows.columns]).first().asDict()
    return rows.select(*[c for c in rows.columns if filled[c]])


def read_table_pruned(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog, pruned; an unknown name raises `AnalysisException`."""
    return pruned(spark.table(name))


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, path: str | None = None) -> bool:
    """Make sure a table exists (at `path`, else in the warehouse); tells whether it did before."""
    existed = spark.catalog.tableExists(name)
    if not existed:
        spark.catalog.createTable(name, path=path, source="parquet", schema=schema)
    return existed


def spread(df: DataFrame) -> DataFrame:
    """Give every core a part of a table that arrives in too few pieces to be split by the scan.

    Costly per-row work (tokens, page trees) would otherwise run in as many tasks as there are row
    groups.  Tables with enough pieces are left alone, so nothing moves at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def filter_contains(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.filter(F.col(column).contains(part))


def lookup_cell(df: DataFrame, key: str, value, column: str) -> DataFrame:
    """The cell of one row and column, as a one-column frame."""
    return df.filter(F.col(key) == value).select(column)


def first_value(df: DataFrame, order: str, column: str) -> DataFrame:
    """A column's value in the first row by `order`."""
    return df.agg(F.min_by(column, order).alias(column))


def select_by_name(df: DataFrame, part: str) -> DataFrame:
    """Columns whose name contains a text."""
    return df.select(*[c for c in df.columns if part in c])


def relabel(df: DataFrame, labels: list[str], first: dict[str, Column] | None = None) -> DataFrame:
    """Rename all columns by position, after putting new ones in front."""
    front = [col.alias(name) for name, col in (first or {}).items()]
    return df.select(*front, "*").toDF(*labels)


def ids_to_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Id columns as text by way of 64-bit integers: no digit is lost, unreadable ids are NULL."""
    return df.withColumns({c: F.col(c).try_cast("bigint").cast("string") for c in columns})


def ids_to_long(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast("bigint") for c in columns})


def quarantine(df: DataFrame, column: str, marker: str) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a marker text that makes a page unusable."""
    marked = F.coalesce(F.col(column).contains(marker), F.lit(False))
    return df.filter(~marked), df.filter(marked)


def search_keyword(pages: DataFrame, title: str, keyword: str) -> DataFrame:
    """Pages whose title contains the keyword, whatever its case."""
    return pages.filter(F.lower(title).contains(keyword.lower()))


def with_target(df: DataFrame, *parts: str) -> DataFrame:
    """Name of the table each row belongs to, from the values of one or more columns."""
    return df.withColumn("target", F.concat_ws("_", *parts))


def landed_pages(urls: DataFrame, pages: DataFrame, url: str = "url") -> DataFrame:
    """The landed page of every wanted url, the newest where `pages` has a column landed_at; urls that were
    not collected drop out."""
    from newsdesk.operators.joins import landed_rows

    return landed_rows(urls, pages, url)
