"""Sums of numpy arrays over the rows of a DataFrame.

A task adds up its own batches and emits one row per group, Spark adds the
rows position by position, and the driver receives one array per group. What
travels depends on the array length and the number of tasks, not on the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column without NULLs as a (rows, width) matrix, without copying row by row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(
    df: DataFrame, length: int, part: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]]
) -> dict[int, np.ndarray]:
    """``{group: array}`` where ``part`` gives ``(group, array of that length)`` for a batch."""

    def partial(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for group, values in part(batch):
                if group in sums:
                    sums[group] += values
                else:
                    sums[group] = np.array(values, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_pydict(
                {
                    "grp": pa.array(list(sums), pa.int32()),
                    "vals": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64())),
                }
            )

    rows = (
        df.mapInArrow(partial, "grp int, vals array<double>")
        .select("grp", F.posexplode("vals").alias("pos", "val"))
        .groupBy("grp", "pos")
        .agg(F.sum("val").alias("val"))
        .collect()
    )
    totals: dict[int, np.ndarray] = {}
    for row in rows:
        totals.setdefault(row["grp"], np.zeros(length))[row["pos"]] = row["val"]
    return totals
