"""Parquet and CSV tables. Any path Hadoop can reach works, object stores included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """CSV columns picked by header name; only these are parsed."""
    return spark.read.option("header", True).csv(path).select(*columns)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV part files, each with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in an explicit order; planned as a per-task top-n, not a full sort."""
    return df.orderBy(*order).limit(n)


def file_counts(df: DataFrame) -> DataFrame:
    """Rows per input file of a file-based frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("rows")
    )
