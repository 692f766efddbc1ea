"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    # Pinned so that zone-less timestamps format the same on every machine.
    "spark.sql.session.timeZone": "UTC",
    # Map unions are right-biased: a repeated key keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Re-plan joins and coalesce partitions from real sizes, and split skewed
    # join partitions even where that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows and bytes of an Arrow batch: bound a Python worker's memory, also where pages are long.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "newsdesk", master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; on a cluster leave `master` unset and let spark-submit choose it."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read, as named by `spark.checkpoint.dir`.

    Only a session with one local JVM may go without the setting; it then gets a folder below the
    warehouse.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir()
    if named is not None:
        return named
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint a narrow frame in the shared folder (survives executor loss).

    For verdicts, labels, pointers and vocabularies that loops and repeated joins start from.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame) -> DataFrame:
    """Write a frame of records as a columnar table in the shared folder and go on from there.

    For records that several results are made from: each reads only its columns, and joins are
    planned from the real size.
    """
    spark = df.sparkSession
    place = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
