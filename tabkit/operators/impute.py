"""Missing values replaced by group means, then by the global mean.

The sentinel becomes NULL before any mean is taken, so it never leaks into the
statistics. Means come from the training rows alone; a test row whose group was
not seen in training, or whose key is NULL, gets the global mean.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import sentinel_to_null
from ..session import checkpointed, fits_broadcast
from .scale import ScalerModel


def _observed(column: str, sentinel: float | None) -> Column:
    value = F.col(column)
    return value if sentinel is None else sentinel_to_null(value, sentinel)


def group_means(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, float | None]
) -> DataFrame:
    """Mean of every column per group in one aggregate; the mapped sentinel is left out."""
    return df.groupBy(*keys).agg(
        *[F.avg(_observed(c, s)).alias(f"{c}_MEAN") for c, s in columns.items()]
    )


def global_means(df: DataFrame, columns: Mapping[str, float | None]) -> DataFrame:
    return df.agg(*[F.avg(_observed(c, s)).alias(f"{c}_MEAN") for c, s in columns.items()])


@dataclass(frozen=True)
class GroupMeanModel:
    keys: Sequence[str]
    columns: Mapping[str, float | None]
    groups: DataFrame  # keys, rows and, per column, count, mean and population variance
    group_count: int
    overall: Mapping[str, float | None]

    def transform(self, df: DataFrame) -> DataFrame:
        """Every row of ``df`` with the missing values filled; column order is kept.

        The group table is broadcast when its counted size allows it. Beyond
        that a plain left join is left to the adaptive planner, which splits
        the rows of an oversized group over several tasks.
        """
        means = self.groups.select(
            *self.keys, *[F.col(f"{c}|mean").alias(f"{c}|fill") for c in self.columns]
        )
        if fits_broadcast(self.group_count, len(means.columns)):
            means = F.broadcast(means)
        filled = df.join(means, list(self.keys), "left")
        return filled.select(
            *[
                F.coalesce(
                    _observed(c, self.columns[c]).cast("double"),
                    F.col(f"{c}|fill"),
                    F.lit(self.overall[c]).cast("double"),
                ).alias(c)
                if c in self.columns
                else F.col(c)
                for c in df.columns
            ]
        )

    def imputed_scaler(self, columns: Sequence[str], ddof: int = 1) -> ScalerModel:
        """The scaler of the imputed training rows, from the group table alone.

        A filled value sits at its group mean, so it adds nothing to the spread
        inside the group; no second pass over the training rows is needed.
        ``columns`` are imputed columns or numeric keys.
        """
        matched = F.lit(True)
        for key in self.keys:
            matched = matched & F.col(key).isNotNull()
        rows = F.col("rows").cast("double")
        centre, spread, weight = {}, {}, {}
        for c in columns:
            if c in self.columns:
                seen = F.col(f"{c}|count").cast("double")
                mean = F.coalesce(F.col(f"{c}|mean"), F.lit(0.0))
                overall = F.lit(self.overall[c]).cast("double")
                fill = F.when(matched & (seen > 0), mean).otherwise(overall)
                gap = rows - seen
                centre[c] = (seen * mean + gap * fill) / rows
                inside = F.coalesce(seen * F.col(f"{c}|var"), F.lit(0.0))
                spread[c] = inside + seen * gap / rows * (mean - fill) * (mean - fill)
                weight[c] = rows
            else:
                centre[c] = F.col(c).cast("double")
                spread[c] = F.lit(0.0)
                weight[c] = F.when(F.col(c).isNotNull(), rows)
        first = self.groups.agg(
            *[F.sum(weight[c]).alias(f"{c}|n") for c in columns],
            *[(F.sum(weight[c] * centre[c]) / F.sum(weight[c])).alias(f"{c}|mean") for c in columns],
        ).first()
        second = self.groups.agg(
            *[
                F.sum(
                    spread[c]
                    + weight[c] * F.pow(centre[c] - F.lit(first[f"{c}|mean"]).cast("double"), 2)
                ).alias(c)
                for c in columns
            ]
        ).first()
        stats = {}
        for c in columns:
            n, mean, squares = first[f"{c}|n"], first[f"{c}|mean"], second[c]
            known = squares is not None and n is not None and n > ddof
            stats[c] = (mean, math.sqrt(squares / (n - ddof)) if known else None)
        return ScalerModel(stats)


@dataclass(frozen=True)
class GroupMeanImputer:
    """``columns`` maps each column to the sentinel that marks it missing (None for NULL only)."""

    keys: Sequence[str]
    columns: Mapping[str, float | None]

    def fit(self, df: DataFrame) -> GroupMeanModel:
        """One pass over ``df``. The group table is kept in the checkpoint folder."""
        measures = []
        for c, s in self.columns.items():
            value = _observed(c, s)
            measures += [
                F.count(value).alias(f"{c}|count"),
                F.avg(value).alias(f"{c}|mean"),
                F.var_pop(value).alias(f"{c}|var"),
            ]
        groups = checkpointed(
            df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("rows"), *measures)
        )
        totals = groups.agg(
            F.count(F.lit(1)).alias("groups"),
            *[
                F.try_divide(
                    F.sum(F.col(f"{c}|mean") * F.col(f"{c}|count")), F.sum(f"{c}|count")
                ).alias(c)
                for c in self.columns
            ],
        ).first()
        overall = {c: totals[c] for c in self.columns}
        return GroupMeanModel(self.keys, self.columns, groups, totals["groups"], overall)


def impute_in_place(
    df: DataFrame, keys: Sequence[str], columns: Mapping[str, float | None]
) -> DataFrame:
    """Each missing value replaced by the mean of its group in the same table, if it has one.

    A window over the keys would send a whole group to one task. The means are
    aggregated before the shuffle and joined back instead; groups with a NULL
    key keep their missing values.
    """
    means = group_means(df, keys, columns)
    return df.join(means, list(keys), "left").select(
        *[
            F.coalesce(_observed(c, columns[c]).cast("double"), F.col(f"{c}_MEAN")).alias(c)
            if c in columns
            else F.col(c)
            for c in df.columns
        ]
    )
