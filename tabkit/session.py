"""Session defaults, and the ways rows are kept between passes."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side of a join is hinted for broadcast only when its measured row count
# times its estimated row width stays under this many bytes.
BROADCAST_BYTES = 64 * 1024 * 1024

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "tabkit", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{key.replace("__", "."): value for key, value in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the cluster's checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. A temporary folder is made
    only where that is unset and Spark runs inside this one process.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tabkit-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, so later readers start from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in the checkpoint folder, for rows that are read several times.

    Unlike a checkpoint it stays columnar, so later readers fetch only their columns.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(rows: int, columns: int) -> bool:
    """Whether ``rows`` x ``columns`` values, at 32 bytes each, are small enough to broadcast."""
    return rows * columns * 32 <= BROADCAST_BYTES


def spread(df: DataFrame) -> DataFrame:
    """``df`` persisted for an iterative reader, over at least one partition per core.

    Input that is already split finely enough is kept as it lies. Blocks lost
    with an executor are recomputed from ``df``.
    """
    kept = df.persist()
    cores = df.sparkSession.sparkContext.defaultParallelism
    filled = kept.select(F.spark_partition_id().alias("p")).agg(F.count_distinct("p")).first()[0]
    if filled >= cores:
        return kept
    wide = kept.repartition(cores).persist()
    wide.count()
    kept.unpersist()
    return wide
