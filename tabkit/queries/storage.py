"""Sources and sinks: what was written under the checkpoint folder, read back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir
from ..sources.drifting import read_drifting
from ..sources.tables import file_counts, read_columns, write_csv, write_table
from .fixtures import obs
from .oracle import using
from .registry import query

TEXTS = ("DATE", "LATITUDE", "WND", "TMP")


def _place(spark: SparkSession, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4()}"


@query(
    "csv_round_trip",
    using("obs", body="SELECT TMP, CAST(obs_id AS STRING) AS obs_id, WND FROM obs"),
)
def csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "csv")
    write_csv(obs(spark, folder).select("obs_id", *TEXTS), path)
    return read_columns(spark, path, ["TMP", "obs_id", "WND"])


@query("parquet_round_trip", using("obs", body=f"SELECT obs_id, {', '.join(TEXTS)} FROM obs"))
def parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = _place(spark, "parquet")
    write_table(obs(spark, folder).select("obs_id", *TEXTS), path)
    return spark.read.parquet(path)


@query(
    "drifting_union",
    using("obs", body="SELECT CAST(obs_id AS STRING) AS obs_id, CASE WHEN obs_id % 2 = 0 THEN WND END AS WND, TMP FROM obs"),
)
def drifting_union(spark: SparkSession, folder: str) -> DataFrame:
    """Two layouts in one folder: columns in another order, and one column absent."""
    path, rows = _place(spark, "drifting"), obs(spark, folder)
    write_csv(rows.filter("obs_id % 2 = 0").select("obs_id", "TMP", "WND"), f"{path}/even")
    write_csv(rows.filter("obs_id % 2 != 0").select("TMP", "DATE", "obs_id"), f"{path}/odd")
    return read_drifting(spark, [f"{path}/even/*.csv", f"{path}/odd/*.csv"], ["obs_id", "WND", "TMP"])


@query(
    "file_counts",
    using("obs", body="SELECT obs_id % 5 AS part, count(*) AS rows FROM obs GROUP BY 1"),
)
def counts_of_files(spark: SparkSession, folder: str) -> DataFrame:
    """One folder per remainder; the rows of its files are counted and summed."""
    path = _place(spark, "counted")
    obs(spark, folder).select("obs_id", "TMP", (F.col("obs_id") % 5).alias("part")).write.partitionBy("part").parquet(path)
    counts = file_counts(spark.read.parquet(path))
    part = F.regexp_extract("file_path", "part=([0-9]+)", 1).cast("bigint").alias("part")
    return counts.groupBy(part).agg(F.sum("rows").alias("rows"))
