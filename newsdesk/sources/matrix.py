"""The snapshot-by-word matrix of ranks in blocks of columns.

A vocabulary without a limit has no wide table. Words are numbered as they appear; every WIDTH of them
are a block, and the ranks of a snapshot are one row of WIDTH columns per block that it has words in. The
list of words says where each is found, so that a reader of a few words opens their blocks only.
Words, snapshots and blocks change by one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsdesk.operators.joins import join_unique
from newsdesk.operators.ranking import numbered
from newsdesk.session import store
from newsdesk.sources.runs import Runs, latest

WIDTH = 128
SNAPSHOT = ["source", "ts"]


class Matrix:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.runs = spark, Runs(spark, folder)

    def _columns(self) -> list[str]:
        return [f"c{i}" for i in range(WIDTH)]

    def words(self) -> DataFrame | None:
        """word, block and place inside the block (at) of every word ever seen."""
        return self.runs.read("words")

    def add(self, ranked: DataFrame, batch_id: int) -> bool:
        """Add snapshots (source, ts, word, rank), one rank per word; whether the batch was new.

        A snapshot that is there already is replaced as a whole.
        """
        run = self.runs.begin()
        if run.base["last"] is not None and batch_id <= run.base["last"]:
            return False
        batches, ranked = (batch_id, batch_id), store(ranked.select(*SNAPSHOT, "word", "rank"))
        known, fresh, many = self.words(), ranked.select("word").distinct(), 0
        if known is not None:
            fresh, many = fresh.join(known, "word", "left_anti"), known.count()
        placed = numbered(fresh, ["word"]).select("word", (F.col("number") + many).alias("number"))
        placed = placed.select("word", F.floor(F.col("number") / WIDTH).alias("block"), F.pmod("number", F.lit(WIDTH)).cast("int").alias("at"))
        listed = run.write("words", placed, batches)
        listed = listed if known is None else known.unionByName(listed)
        cells = join_unique(ranked, listed, "word", hot=0, narrow=True)
        wide = cells.groupBy(*SNAPSHOT, "block").pivot("at", list(range(WIDTH))).agg(F.max(F.col("rank").cast("bigint")))
        wide = wide.toDF(*SNAPSHOT, "block", *self._columns()).fillna(0).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        run.write("blocks", wide.repartition("block"), batches, by=["block"])
        run.write("snapshots", ranked.select(*SNAPSHOT).distinct().withColumn("batch_id", F.lit(batch_id).cast("bigint")), batches)
        run.commit(batch_id)
        return True

    def snapshots(self) -> DataFrame:
        return latest(self.runs.read("snapshots"), SNAPSHOT)

    def _blocks(self, words: DataFrame, blocks: list[int] | None = None) -> DataFrame:
        """(source, ts, word, rank) of the given words (word, block, at), 0 included where a block has a row."""
        rows = self.runs.read("blocks")
        rows = rows if blocks is None else rows.filter(F.col("block").isin(blocks))
        rows = join_unique(rows, self.snapshots(), [*SNAPSHOT, "batch_id"], "left_semi", hot=0, narrow=True)
        long = rows.select(*SNAPSHOT, "block", F.posexplode(F.array(*self._columns())).alias("at", "rank"))
        return join_unique(long, words, ["block", "at"], hot=0, narrow=True).select(*SNAPSHOT, "word", "rank")

    def cells(self) -> DataFrame:
        """The ranks of all words as rows; absent words give none."""
        return self._blocks(self.words()).filter("rank <> 0")

    def wide(self, words: list[str]) -> DataFrame:
        """One row per snapshot, one column per listed word, 0 where it is absent; reads their blocks only."""
        listed = [r for r in self.words().filter(F.col("word").isin(words)).collect()]  # as many as were asked for
        blocks = sorted({r["block"] for r in listed})
        places = {r["word"]: (r["block"], r["at"]) for r in listed}
        rows = self.snapshots()
        read = self.runs.read("blocks").filter(F.col("block").isin(blocks))
        for block in blocks:
            mine = [w for w in words if places.get(w, (None,))[0] == block]
            part = read.filter(F.col("block") == block).select(*SNAPSHOT, "batch_id", *[F.col(f"c{places[w][1]}").alias(w) for w in mine])
            rows = rows.join(part, [*SNAPSHOT, "batch_id"], "left")
        missing = {w: F.lit(0).cast("bigint") for w in words if w not in places}
        return rows.withColumns(missing).select(*SNAPSHOT, *words).fillna(0, subset=words)

    def dense(self) -> DataFrame:
        """(source, ts, word, rank) of every snapshot and word of its source, 0 where it is absent."""
        cells = self.cells()
        own = store(cells.select("source", "word").distinct())
        grid = self.snapshots().select(*SNAPSHOT).join(own, "source")
        return grid.join(cells, [*SNAPSHOT, "word"], "left").fillna(0, subset=["rank"])
