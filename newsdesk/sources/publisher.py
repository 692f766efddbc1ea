"""Published documents as a data source: whole pages or none, blocks in order, a repeat changes nothing.

Every write task puts its rows into one file and reports it; when all tasks are through, the driver lists
the reported files in `run=<run>.json`, and only listed files are ever read. A task that fails removes
its file, a job that fails removes the files of its finished tasks; what a lost executor leaves behind
is listed nowhere. The list of a run that is written again is replaced in one step, then the files of
the one before go.

Rows carry `page_key` and `block_pos`. A page must reach one task, its blocks from 0 in order and none
missing: `write_documents` deals the rows out in this way, and the writer refuses any other order.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

NAME = "newsdesk_documents"


def _place(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder: a path, or any URI that Arrow can open (file, s3, gs, hdfs)."""
    return pa.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def _normal(folder: str) -> str:
    """Hadoop writes file:/x for file:///x."""
    return "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file://") else folder


@dataclass
class Written(WriterCommitMessage):
    name: str | None
    pages: int
    rows: int


class _Order:
    """Checks that pages come one after the other, each with its blocks from 0 on."""

    def __init__(self):
        self.page, self.next, self.done = None, 0, set()

    def check(self, keys: list, places: list) -> None:
        for key, place in zip(keys, places):
            if key is None or key != self.page:
                if key is None or key in self.done:
                    raise ValueError(f"blocks of page {key} do not come together")
                self.page, self.next = key, 0
                self.done.add(key)
            if place != self.next:
                raise ValueError(f"block {place} of page {key} where {self.next} was expected")
            self.next += 1


class DocumentWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, run: str, schema: str):
        self.folder, self.run, self.schema = folder, run, schema

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _place(self.folder)
        system.create_dir(root, recursive=True)
        name, order, rows, writer = f"part-{uuid.uuid4().hex}.parquet", _Order(), 0, None
        try:
            for batch in iterator:
                order.check(batch.column("page_key").to_pylist(), batch.column("block_pos").to_pylist())
                writer = writer or pa.parquet.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=system)
                writer.write_batch(batch)
                rows += batch.num_rows
        except Exception:
            if writer is not None:
                writer.close()
                system.delete_file(f"{root}/{name}")
            raise
        if writer is None:
            return Written(None, 0, 0)
        writer.close()
        return Written(name, len(order.done), rows)

    def _delete(self, names: list[str]) -> None:
        system, root = _place(self.folder)
        for name in names:
            if system.get_file_info(f"{root}/{name}").type == pa.fs.FileType.File:
                system.delete_file(f"{root}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _place(self.folder)
        system.create_dir(root, recursive=True)
        listed = f"{root}/run={self.run}.json"
        old = json.loads(system.open_input_file(listed).read())["files"] if system.get_file_info(listed).type == pa.fs.FileType.File else []
        made = [m for m in messages if m is not None and m.name is not None]
        text = {"run": self.run, "schema": self.schema, "files": sorted(m.name for m in made), "pages": sum(m.pages for m in made), "rows": sum(m.rows for m in made)}
        draft = f"{root}/.{uuid.uuid4().hex}"
        with system.open_output_stream(draft) as out:
            out.write(json.dumps(text).encode())
        system.move(draft, listed)
        self._delete(old)

    def abort(self, messages: list[Written | None]) -> None:
        self._delete([m.name for m in messages if m is not None and m.name is not None])


class Documents(DataSource):
    """`spark.write.format("newsdesk_documents")` with the options path and run."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def writer(self, schema: T.StructType, overwrite: bool) -> DocumentWriter:
        for column in ("page_key", "block_pos"):
            if column not in schema.names:
                raise ValueError(f"documents need a column {column}")
        return DocumentWriter(_normal(self.options["path"]), self.options["run"], schema.json())


def write_documents(rows: DataFrame, folder: str, run: str | int) -> dict:
    """Write the rows (page_key, block_pos and what belongs to them) of a run; gives its list.

    Pages are dealt out by their key and come whole: a page is as long as a document, so no task holds
    more than its share of them and the longest one.
    """
    spark = rows.sparkSession
    spark.dataSource.register(Documents)
    ordered = rows.repartition("page_key").sortWithinPartitions("page_key", "block_pos")
    ordered.write.format(NAME).option("path", folder).option("run", str(run)).mode("append").save()
    return [m for m in _lists(folder) if m["run"] == str(run)][0]


def _lists(folder: str) -> list[dict]:
    system, root = _place(_normal(folder))
    found = system.get_file_info(pa.fs.FileSelector(root, allow_not_found=True))
    names = sorted(f.base_name for f in found if f.base_name.startswith("run=") and f.base_name.endswith(".json"))
    return [json.loads(system.open_input_file(f"{root}/{name}").read()) for name in names]


def read_documents(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows of all finished runs with the column `run`; None before the first."""
    out = None
    for listed in _lists(folder):
        schema = T.StructType.fromJson(json.loads(listed["schema"]))
        paths = [f"{folder}/{name}" for name in listed["files"]]
        rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
        rows = rows.withColumn("run", F.lit(listed["run"]))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def orphans(folder: str) -> list[str]:
    """Files of tasks whose executor was lost: no run lists them."""
    system, root = _place(_normal(folder))
    listed = {name for m in _lists(folder) for name in m["files"]}
    found = system.get_file_info(pa.fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if f.base_name.startswith("part-") and f.base_name not in listed)
