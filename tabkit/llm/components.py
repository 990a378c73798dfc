"""Connected components of an edge table, by hooking to smaller labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); ``root`` is the smallest node of its component.

    Every round each node takes the smallest label among its neighbours and then its label's label, so
    the number of rounds grows with the logarithm of the longest chain. Labels are written each round.
    An empty table gives an empty table; loops and repeated edges do not matter.
    """
    links = written(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct())
    labels = written(links.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
    while True:
        at = labels.select(F.col("node").alias("b"), "root")
        near = links.join(at, "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        jumped = written(hooked.join(above, "root").select("node", "old", F.col("top").alias("root")))
        labels = jumped.select("node", "root")
        if jumped.filter("root != old").isEmpty():
            return labels
