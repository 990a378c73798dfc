"""Named queries over the supplied tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql)
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places, so that the order of a sum does not show."""
    return df.select(
        *[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]
    )


def rounded_rows(df: DataFrame) -> DataFrame:
    """``rounded`` for many rows of values below 1e12.

    ``round`` takes every value through a decimal object; this is plain
    arithmetic, half away from zero.
    """

    def six(c: str):
        x = F.col(c)
        return (F.signum(x) * F.floor(F.abs(x) * 1e6 + 0.5) / 1e6 + 0.0).alias(c)

    return df.select(*[six(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r6(expression: str) -> str:
    """SQL rounding to six places; adding 0.0 turns a negative zero into zero."""
    return f"round({expression}, 6) + 0.0"
