"""Standardisation of named columns with statistics from the training rows only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


def scaler_stats(df: DataFrame, columns: Sequence[str], ddof: int = 1) -> DataFrame:
    """``(column, mean, sd)``: all columns in one pass; ``ddof`` 1 is the sample sd, 0 the population sd."""
    if ddof not in (0, 1):
        raise ValueError("ddof must be 0 or 1")
    spread = F.stddev_samp if ddof else F.stddev_pop
    wide = df.agg(
        *[F.avg(c).alias(f"{c}|mean") for c in columns], *[spread(c).alias(f"{c}|sd") for c in columns]
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"), F.col(f"{c}|mean").alias("mean"), F.col(f"{c}|sd").alias("sd")
            )
            for c in columns
        ]
    )
    return wide.select(F.inline(entries))


@dataclass(frozen=True)
class ScalerModel:
    stats: Mapping[str, tuple[float | None, float | None]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``(value - mean) / sd``; a column without spread becomes 0.0."""

        def scaled(c: str):
            mean, sd = self.stats[c]
            if mean is None or not sd:
                return F.when(F.col(c).isNotNull(), F.lit(0.0))
            return (F.col(c) - F.lit(float(mean))) / F.lit(float(sd))

        return df.withColumns({c: scaled(c) for c in self.stats})


@dataclass(frozen=True)
class Scaler:
    columns: Sequence[str]
    ddof: int = 1

    def fit(self, df: DataFrame) -> ScalerModel:
        """One aggregate over ``df``; one row per column reaches the driver."""
        rows = scaler_stats(df, self.columns, self.ddof).collect()
        return ScalerModel({r["column"]: (r["mean"], r["sd"]) for r in rows})
