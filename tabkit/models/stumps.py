"""Boosted trees of one split each, with every midpoint between values tried.

Spark's trees try the thresholds between bins. Here a feature's values are counted once each, with the sum of their
labels, and running sums over the sorted values give the drop in variance of every split. The running sums are
made range by range: within a range by a window, across ranges from one total for each range and feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written

COLUMNS = "round int, feature string, threshold double, left_rows bigint, right_rows bigint, left_value double, right_value double, drop double"


def _running(counts: DataFrame) -> DataFrame:
    """``counts`` (feature, value, n, s) with the sums up to each value, of the whole feature, and the next value."""
    ranged = counts.repartitionByRange("feature", "value").withColumn("part", F.spark_partition_id())
    ranged = written(ranged)
    totals = ranged.groupBy("feature", "part").agg(F.sum("n").alias("pn"), F.sum("s").alias("ps"), F.min("value").alias("first"))
    order = Window.partitionBy("feature").orderBy("part")  # a row for each range
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("feature")
    ahead = totals.select(
        "feature", "part",
        F.coalesce(F.sum("pn").over(before), F.lit(0)).alias("n0"), F.coalesce(F.sum("ps").over(before), F.lit(0.0)).alias("s0"),
        F.sum("pn").over(whole).alias("n_all"), F.sum("ps").over(whole).alias("s_all"), F.lead("first").over(order).alias("after"),
    )
    inside = Window.partitionBy("feature", "part").orderBy("value")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(F.broadcast(ahead), ["feature", "part"]).select(
        "feature", "value", "n_all", "s_all",
        (F.col("n0") + F.sum("n").over(upto)).alias("ln"), (F.col("s0") + F.sum("s").over(upto)).alias("ls"),
        F.coalesce(F.lead("value").over(inside), F.col("after")).alias("next"),
    )


def best_split(df: DataFrame, features: Sequence[str], target: Column, least: int = 1):
    """The split with the largest drop in variance, of equal ones the first feature's lowest; None if no split lowers it."""
    values = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(c).cast("double").alias("value")) for i, c in enumerate(features)])
    each = df.select(target.cast("double").alias("t"), F.inline(values))
    counts = each.groupBy("feature", "value").agg(F.count("*").alias("n"), F.sum("t").alias("s"))
    ln, ls, rn, rs = F.col("ln"), F.col("ls"), F.col("n_all") - F.col("ln"), F.col("s_all") - F.col("ls")
    drop = (ls * ls / ln + rs * rs / rn - F.col("s_all") * F.col("s_all") / F.col("n_all")) / F.col("n_all")
    tried = _running(counts).filter(F.col("next").isNotNull() & (ln >= least) & (rn >= least)).select(
        "feature", "value", ((F.col("value") + F.col("next")) / 2).alias("threshold"), ln.alias("left_rows"), rn.alias("right_rows"),
        (ls / ln).alias("left_value"), (rs / rn).alias("right_value"), drop.alias("drop"),
    )
    return tried.filter("drop > 1e-12").orderBy(F.desc("drop"), "feature", "value").limit(1).first()


def boosted_stumps(df: DataFrame, features: Sequence[str], label: str, rounds: int = 2, step: float = 0.1, least: int = 1) -> DataFrame:
    """A row for each round with its split, the rows and values of its leaves, and the drop in variance.

    The first round is fitted to the label, the others to twice the residual and added with ``step``. Rows with a
    missing feature or label are left out.
    """
    rows = df.select(*features, F.col(label).cast("double").alias("__y")).na.drop()
    prediction, found = F.lit(0.0), []
    for k in range(rounds):
        split = best_split(rows, features, F.col("__y") if k == 0 else 2 * (F.col("__y") - prediction), least)
        if split is None:
            break
        name = features[split.feature]
        leaf = F.when(F.col(name) <= split.threshold, F.lit(split.left_value)).otherwise(F.lit(split.right_value))
        prediction = prediction + (leaf if k == 0 else step * leaf)
        found.append((k + 1, name, split.threshold, split.left_rows, split.right_rows, split.left_value, split.right_value, split["drop"]))
    return df.sparkSession.createDataFrame(found, COLUMNS)
