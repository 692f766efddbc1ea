"""Sums that grow batch by batch, each batch counted once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.sources.runs import Run, Runs, merge_parts

FANOUT = 8


class Accumulated:
    """Sums of `value` per key. Batches are stored as sums of their own and merged as they grow in number;
    a batch id at or below the last one was counted before and changes nothing."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], value: str = "value"):
        self.keys, self.value = list(keys), value
        self.runs = Runs(spark, folder)

    def _sums(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.sum(self.value).alias(self.value))

    def add(self, batch: DataFrame, batch_id: int) -> bool:
        """Add the values of a batch (a missing one counts as nothing); whether it was new."""
        run = self.runs.begin()
        if run.base["last"] is not None and batch_id <= run.base["last"]:
            return False
        run.write("sums", self._sums(batch), (batch_id, batch_id))
        run.commit(batch_id)

        def write(run: Run, table: str, rows: DataFrame, batches: tuple[int, int], level: int) -> None:
            run.write(table, rows, batches, level)

        while merge_parts(self.runs, FANOUT, {"sums": self._sums}, write, spared=0):
            pass
        return True

    def total(self) -> DataFrame | None:
        """The sums over all batches; None before the first."""
        rows = self.runs.read("sums")
        return None if rows is None else self._sums(rows)
