"""Append-only history with an index of the cell values it has seen.

Tables of one folder, all changed by the same commit (see `runs`): `log` holds the rows of every batch,
`seen` the cell values and the batch that was the first to show each, per group, `fresh` the ids of the
rows that were new, and whatever the caller publishes with a batch.

`seen` is dealt into buckets by a hash of the value, more of them the larger a part is; a batch reads the
buckets its own values fall into and no others. Small parts are merged into larger ones as a tree with
`FANOUT` parts per level, so that the number of parts grows with the logarithm of the number of batches.
Merging keeps, of equal rows of the log, the newest copy.

Batch ids ascend. A committed batch is final: to merge it again changes nothing and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.operators.joins import accepted_rows
from newsdesk.operators.novelty import cells, compared_columns, unseen
from newsdesk.session import cut_lineage
from newsdesk.sources.runs import Run, Runs, merge_parts

FANOUT = 8
#: A part of `seen` has as many buckets, in powers of four, as keep them below so many values each.
BUCKET_VALUES = 250_000
BUCKETS_MOST = 1 << 14


def buckets_for(values: int) -> int:
    n = 1
    while n < BUCKETS_MOST and values > n * BUCKET_VALUES:
        n *= 4
    return n


class History:
    """`row_id` names the rows; it and `excluded` are not compared.  `group` columns (text) name
    the table a row belongs to, so that one folder serves all of them.  With `sequential`, rows are
    compared one after the other in the order of `row_id` and repeats inside a batch are not new again.
    `partitions` names partition columns of published tables."""

    def __init__(self, spark: SparkSession, folder: str, row_id: str, excluded: Iterable[str] = (),
                 group: Iterable[str] = (), sequential: bool = False, partitions: dict[str, list[str]] | None = None):
        self.spark, self.folder = spark, folder
        self.row_id, self.excluded, self.group, self.sequential = row_id, list(excluded), list(group), sequential
        self.partitions = partitions or {}
        self.key = [*self.group, "col", "val"]
        self.seen_schema = ", ".join(f"`{k}` string" for k in self.key) + ", batch_id bigint"
        self.runs = Runs(spark, folder)

    # ------------------------------------------------------------ reading

    def bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(count)).cast("int")

    def seen(self, keys: DataFrame | None = None) -> DataFrame:
        """Seen values with the first batch that showed them; with `keys`, only the buckets they fall into.

        The buckets of the keys are at most as many as a part has, whatever the number of keys.
        """
        parts = self.runs.parts("seen")
        counts = sorted({p["buckets"] for p in parts})
        wanted = {}
        if keys is not None and counts:
            row = keys.agg(*[F.collect_set(self.bucket(n)).alias(f"b{n}") for n in counts]).first()
            wanted = {n: row[f"b{n}"] for n in counts}
        keep = lambda part: F.col("bucket").isin(sorted(wanted[part["buckets"]])) if wanted else None
        rows = self.runs.read_parts(parts, keep)
        return self.spark.createDataFrame([], self.seen_schema) if rows is None else rows.drop("bucket")

    def log(self) -> DataFrame | None:
        return self.runs.read("log")

    def published(self, table: str) -> DataFrame | None:
        """All committed rows of a published table."""
        return self.runs.read(table)

    def _newest(self, log: DataFrame) -> DataFrame:
        """Of equal rows the newest copy."""
        columns = compared_columns(log, ["batch_id", self.row_id, *self.excluded])
        order = F.struct(-F.col("batch_id"), F.col(self.row_id))
        kept = [self.row_id, "batch_id", *[c for c in self.excluded if c in log.columns]]
        return log.groupBy(*columns).agg(*[F.min_by(c, order).alias(c) for c in kept]).select(*log.columns)

    def current(self) -> DataFrame:
        """All stored rows without repeats; of equal rows the newest copy stays."""
        return self._newest(self.log())

    # ------------------------------------------------------------ writing

    def _write_seen(self, run: Run, values: DataFrame, batches: tuple[int, int], level: int = 0) -> None:
        values = cut_lineage(values)
        count = buckets_for(values.count())
        rows = values.withColumn("bucket", self.bucket(count))
        rows = rows.repartition("bucket").sortWithinPartitions("bucket", "col", "val")
        run.write("seen", rows, batches, level, ["bucket"], count)

    def _stored(self, batch_id: int) -> DataFrame:
        """The new rows of a committed batch."""
        manifest = self.runs.manifest()["tables"]
        parts = {t: [p for p in manifest.get(t, []) if p["first"] == p["last"] == batch_id] for t in ("log", "fresh")}
        if not all(parts.values()):
            raise ValueError(f"batch {batch_id} is not the last one and not kept apart any more")
        log, fresh = (self.runs.read_parts(p).drop("batch_id") for p in parts.values())
        return log.join(fresh, fresh.columns, "left_semi")

    def merge(self, batch: DataFrame, batch_id: int,
              publish: Callable[[DataFrame], dict[str, DataFrame]] | None = None) -> DataFrame:
        """Store a batch and return its new rows.

        `publish` gets the new rows and gives tables to store with them. The batch, its new values and
        these tables become visible by one commit; if anything fails before, nothing has changed. Of
        history only the buckets of the batch's own values are read.
        """
        run = self.runs.begin()
        if run.base["last"] is not None and batch_id <= run.base["last"]:
            return self._stored(batch_id)
        columns = compared_columns(batch, [self.row_id, *self.group, *self.excluded])
        at, ids = (batch_id, batch_id), [*self.group, self.row_id]
        stored = run.write("log", batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")), at).drop("batch_id")
        rows = cells(stored, columns, ids)
        counted = F.min(self.row_id).alias(self.row_id) if self.sequential else F.count("*").alias("n")
        judged = unseen(rows.groupBy(*self.key).agg(counted), lambda tally: self.seen(tally).select(*self.key), self.key)
        self._write_seen(run, judged.filter("ok").select(*self.key, F.lit(batch_id).cast("bigint").alias("batch_id")), at)
        accepted = judged.filter("ok") if self.sequential else accepted_rows(rows, judged, self.key)
        fresh_ids = run.write("fresh", accepted.select(*ids).distinct().withColumn("batch_id", F.lit(batch_id).cast("bigint")), at)
        fresh = stored.join(fresh_ids.drop("batch_id"), ids, "left_semi")
        for table, frame in (publish(fresh) if publish else {}).items():
            run.write(table, frame.withColumn("batch_id", F.lit(batch_id).cast("bigint")), at, by=self.partitions.get(table, []))
        run.commit(batch_id)
        self.compact()
        return fresh

    def compact(self) -> None:
        """Merge small parts; the newest batch stays apart."""
        first = lambda rows: rows.groupBy(*self.key).agg(F.min("batch_id").alias("batch_id"))

        def write(run: Run, table: str, rows: DataFrame, batches: tuple[int, int], level: int) -> None:
            if table == "seen":
                self._write_seen(run, rows, batches, level)
            else:
                run.write(table, rows, batches, level, self.partitions.get(table, []))

        while merge_parts(self.runs, FANOUT, {"log": self._newest, "seen": first, "fresh": None}, write):
            pass
