"""Flags, indicators and cyclic encodings; each is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import cyclic_pair, direction_pair, iso_timestamp


def flag(column: str, level: str) -> Column:
    return F.when(F.col(column) == level, 1).otherwise(0).alias(f"{column}_{level}")


def flags(df: DataFrame, levels: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns ``col_level``; a level that is not listed is the reference and gives zeros."""
    return df.select("*", *[flag(c, level) for c, names in levels.items() for level in names])


def indicator(df: DataFrame, column: str, sentinel: float, name: str) -> DataFrame:
    """1 where ``column`` holds the sentinel, else 0."""
    return df.withColumn(name, F.when(F.col(column) == sentinel, 1).otherwise(0))


def hour_month(df: DataFrame, column: str = "DATE") -> DataFrame:
    ts = iso_timestamp(F.col(column))
    return df.withColumns({"HOUR": F.hour(ts), "MONTH": F.month(ts)})


def cyclic(df: DataFrame, column: str, period: float) -> DataFrame:
    sine, cosine = cyclic_pair(F.col(column), period)
    return df.withColumns({f"{column}_SIN": sine, f"{column}_COS": cosine})


def cyclic_direction(df: DataFrame, column: str, sentinel: float = 999) -> DataFrame:
    sine, cosine = direction_pair(F.col(column), sentinel)
    return df.withColumns({f"{column}_SIN": sine, f"{column}_COS": cosine})


def observation_features(df: DataFrame) -> DataFrame:
    """Typed observations to model features, in one projection."""
    ts = iso_timestamp(F.col("DATE"))
    hour, month = F.hour(ts), F.month(ts)
    hour_sin, hour_cos = cyclic_pair(hour, 24)
    month_sin, month_cos = cyclic_pair(month, 12)
    wind_sin, wind_cos = direction_pair(F.col("WND_0"), 999)
    used = {"DATE", "CIG_3", "VIS_2", "WND_0"}
    return df.select(
        *[c for c in df.columns if c not in used],
        hour.alias("HOUR"),
        month.alias("MONTH"),
        flag("CIG_3", "Y"),
        flag("CIG_3", "9"),
        flag("VIS_2", "V"),
        flag("VIS_2", "9"),
        F.when(F.col("WND_0") == 999, 1).otherwise(0).alias("WND_0_UNDETERMINED"),
        hour_sin.alias("HOUR_SIN"),
        hour_cos.alias("HOUR_COS"),
        month_sin.alias("MONTH_SIN"),
        month_cos.alias("MONTH_COS"),
        wind_sin.alias("WND_0_SIN"),
        wind_cos.alias("WND_0_COS"),
    )
