"""Missing values, value counts, label range, rows over a threshold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


def _long(row: DataFrame, key: str, value: str) -> DataFrame:
    """The single row of ``row`` as one ``(key, value)`` row per column."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias(key), F.col(f"`{c}`").alias(value)) for c in row.columns]
    )
    return row.select(F.inline(pairs))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls)`` for all columns in one pass."""
    names = columns or df.columns
    return _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names]), "column", "nulls")


def missing_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: the NULL share of each column."""
    names = columns or df.columns
    return df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in names])


def sparse_columns(df: DataFrame, limit: float = 0.5) -> list[str]:
    """Names of the columns whose NULL share exceeds ``limit``; one pass, one row to the driver."""
    shares = missing_fractions(df).first()
    return [c for c in df.columns if shares[c] is not None and shares[c] > limit]


def drop_sparse_columns(df: DataFrame, limit: float = 0.5) -> DataFrame:
    return df.drop(*sparse_columns(df, limit))


def missing_pct(
    df: DataFrame, sentinels: Mapping[str, Sequence], guards: Mapping[str, Column] | None = None
) -> DataFrame:
    """``(column, missing_pct)``: NULL or one of the column's sentinels, in percent of all rows.

    With a guard on a column its sentinels count only where the guard is true.
    """
    guards = guards or {}

    def share(column: str, codes: Sequence) -> Column:
        hit = F.col(column).isin(*codes) if codes else F.lit(False)
        if column in guards:
            hit = hit & guards[column]
        missing = F.when(F.col(column).isNull() | hit, 1).otherwise(0)
        return (F.avg(missing) * 100).alias(column)

    return _long(df.agg(*[share(c, codes) for c, codes in sentinels.items()]), "column", "missing_pct")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, NULL being a value, most frequent first."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), F.asc_nulls_last(column))
    )


def label_range(df: DataFrame, label: str) -> DataFrame:
    return df.agg(
        F.min(label).alias("label_min"),
        F.max(label).alias("label_max"),
        (F.max(label) - F.min(label)).alias("label_range"),
    )


def exceeding_rows(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Rows with any column above its threshold, and the names of those columns.

    The thresholds are plain numbers, so the test reaches the file scan. A
    column without a threshold (NULL) is never exceeded.
    """
    limits = {c: t for c, t in thresholds.items() if t is not None}
    over = {c: F.col(c) > F.lit(float(t)) for c, t in limits.items()}
    if not over:
        return df.filter(F.lit(False)).withColumn(
            "columns_exceeding", F.array().cast("array<string>")
        )
    names = F.array_compact(F.array(*[F.when(test, F.lit(c)) for c, test in over.items()]))
    return df.filter(reduce(or_, over.values())).withColumn("columns_exceeding", names)
