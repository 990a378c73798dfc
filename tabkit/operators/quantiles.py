"""Exact interpolated quantiles of groups of any size, several ranks at once.

A sketch of each group, which is a few kilobytes whatever the group holds, gives an interval of values that contains
the wanted ranks. Where an interval may still hold many values it is cut into cells, the cells are
counted, and the one with the wanted ranks is the next interval. At last the values inside the intervals are counted
one by one, and all values below an interval together. So only sketches, cell counts and the few values next to a rank are
shuffled, never the values themselves, and no task holds a group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import fits_broadcast, written

ACCURACY = 10_000  # a sketch is wrong by at most one in so many ranks
# Margins around a rank that hold for groups of at least so many values: three ranks beyond the sketch's error.
MARGINS = ((4 / ACCURACY, ACCURACY), (0.01, 300))
CELLS = 1_000  # of an interval, in a counting round
FEW_VALUES = 100_000  # that an interval may hold when its values are counted one by one
FIVE_NUMBERS = {"minimum": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1.0}


def _joined(rows: DataFrame, states: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """``rows`` with ``s``, the state of their group; without keys the single state is a literal."""
    if not keys:
        found = states.first()["s"]
        fields = states.schema["s"].dataType.elementType
        literal = F.array(*[F.struct(*[F.lit(item[f.name]).cast(f.dataType).alias(f.name) for f in fields]) for item in found])
        return rows.withColumn("s", literal)
    names = {k: f"__{k}" for k in keys}
    side = states.select(*[F.col(k).alias(n) for k, n in names.items()], "s")
    side = F.broadcast(side) if fits_broadcast(states.count(), width) else side
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return rows.join(side, same).drop(*names.values())


def _sketched(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Per group, ``s``: for every column and rank the number of values, and an interval that holds the rank.

    ``below`` is the number of values below the interval and ``inside`` that of those in it, at most.
    """
    wanted = sorted({min(1.0, max(0.0, q + side * margin)) for q in qs for margin, _ in MARGINS for side in (-1, 1)})
    shares = F.array(*map(F.lit, wanted))
    sketches = []
    for i, c in enumerate(columns):
        found = (F.count(c), F.min(c), F.max(c), F.percentile_approx(c, shares, F.lit(ACCURACY)))
        sketches += [x.alias(f"{name}_{i}") for name, x in zip(("n", "low", "high", "at"), found)]

    def interval(i: int, q: float) -> Column:
        n, low, high = F.col(f"n_{i}"), F.col(f"low_{i}"), F.col(f"high_{i}")
        ends = []
        for side, end in ((-1, low), (1, high)):
            for margin, least in reversed(MARGINS):
                at = wanted.index(min(1.0, max(0.0, q + side * margin)))
                end = F.when(n >= least, F.get(f"at_{i}", F.lit(at))).otherwise(end)
            ends.append(end)
        inside = F.when(n >= ACCURACY, F.ceil(n * (2 * MARGINS[0][0] + 2 / ACCURACY))).otherwise(n).alias("inside")
        return F.struct(F.lit(i).alias("i"), F.lit(q).alias("q"), n.alias("n"), ends[0].alias("low"), ends[1].alias("high"), inside)

    states = rows.groupBy(*keys).agg(*sketches)
    return states.select(*keys, F.array(*[interval(i, q) for i in range(len(columns)) for q in qs]).alias("s"))


def _places(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], place) -> DataFrame:
    """A row for each value and each interval it is in or below: ``i``, ``q`` and ``place(value, state)``, null for below."""
    values = F.array(*[F.col(c) for c in columns])

    def entry(state: Column) -> Column:
        value = F.get(F.col("__values"), state["i"])
        here = F.when(value < state["low"], F.lit(None)).otherwise(place(value, state))
        keep = value.isNotNull() & (value <= state["high"])
        return F.struct(state["i"].alias("i"), state["q"].alias("q"), here.alias("place"), value.alias("value"), keep.alias("keep"))

    each = rows.withColumn("__values", values).select(*keys, F.inline(F.transform("s", entry)))
    return each.filter("keep").drop("keep")


def _upto(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """``counts`` of places (few in a group) with ``upto``, the number of values up to the end of each place."""
    order = Window.partitionBy(*group).orderBy(F.col("place").asc_nulls_first())
    return counts.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def _narrowed(rows: DataFrame, states: DataFrame, keys: Sequence[str], columns: Sequence[str], few: int) -> DataFrame:
    """``states`` with each wide interval cut to the cell that holds its ranks, or to the gap between two cells.

    A cell is told by the value's share of the interval, on a plain and on a logarithmic scale, so that neither a long
    tail nor a narrow cluster stays in one cell.
    """
    half = F.lit(CELLS / 2)

    def scaled(x: Column) -> Column:
        return F.signum(x) * F.log1p(F.abs(x))

    def cell(value: Column, state: Column) -> Column:
        plain = F.try_divide(value - state["low"], state["high"] - state["low"])
        low = scaled(state["low"])
        logarithmic = F.try_divide(scaled(value) - low, scaled(state["high"]) - low)
        return sum((F.coalesce(F.floor(F.least(share * half, half)), F.lit(0).cast("bigint")) for share in (plain, logarithmic)), F.lit(0))

    group = [*keys, "i", "q"]
    wide = states.withColumn("s", F.filter("s", lambda x: (x["inside"] > few) & (x["high"] > x["low"]))).filter(F.size("s") > 0)
    counts = _places(_joined(rows, wide, keys, 6), keys, columns, cell).groupBy(*group, "place")
    counts = counts.agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))
    held = states.select(*keys, F.inline("s")).withColumnRenamed("n", "all")
    names = {k: f"__{k}" for k in group}
    placed = _upto(counts, group).select(*[F.col(k).alias(n) for k, n in names.items()], "place", "n", "upto", "least", "most")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    rank = F.col("q") * (F.col("all") - 1)
    hit = (F.col("upto") > F.floor(rank)) & (F.col("upto") - F.col("n") <= F.ceil(rank))
    cells = held.join(placed, same).filter(hit).groupBy(*group, "all", "low", "high").agg(
        F.count("*").alias("hits"), F.min("least").alias("l0"), F.max("least").alias("l1"),
        F.min("most").alias("m0"), F.max("most").alias("m1"), F.sum("n").alias("sum"),
    )
    # Ranks in two cells are the last value of the one and the first of the other.
    low = F.when(F.col("hits") == 1, F.col("l0")).otherwise(F.col("m0")).alias("low")
    high = F.when(F.col("hits") == 1, F.col("m1")).otherwise(F.col("l1")).alias("high")
    cells = cells.select(*group, "all", "hits", "sum", F.col("low").alias("low0"), F.col("high").alias("high0"), low, high)
    stuck = (F.col("hits") > 1) | ((F.col("low") == F.col("low0")) & (F.col("high") == F.col("high0")))
    inside = F.when(stuck, F.lit(0).cast("bigint")).otherwise(F.col("sum")).alias("inside")
    new = cells.select(*[F.col(k).alias(n) for k, n in names.items()], F.struct("i", "q", F.col("all").alias("n"), "low", "high", inside).alias("new"))
    old = F.struct("i", "q", F.col("all").alias("n"), "low", "high", "inside")
    found = held.join(new, same, "left").select(*keys, F.coalesce("new", old).alias("one"))
    return found.groupBy(*keys).agg(F.sort_array(F.collect_list("one")).alias("s"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], qs: Sequence[float], keys: Sequence[str] = (), few: int = FEW_VALUES
) -> DataFrame:
    """``(*keys, column, q, quantile)``: the linearly interpolated quantiles per group.

    NULLs are left out, also as keys of no group of their own: a NULL key is a group. A column without values gives a NULL.
    """
    rows = df.select(*keys, *[F.col(c).cast("double").alias(f"__v{i}") for i, c in enumerate(columns)])
    values = [f"__v{i}" for i in range(len(columns))]
    states = written(_sketched(rows, keys, values, qs))

    def too_many() -> bool:
        wide = F.exists("s", lambda x: (x["inside"] > few) & (x["high"] > x["low"]))
        return not states.filter(wide).isEmpty()

    while too_many():
        states = written(_narrowed(rows, states, keys, values, few))
    group = [*keys, "i", "q"]
    counts = _places(_joined(rows, states, keys, 6 * len(values) * len(qs)), keys, values, lambda value, state: value)
    counts = _upto(counts.groupBy(*group, "place").agg(F.count("*").alias("n")), group)
    names = {k: f"__{k}" for k in group}
    totals = states.select(*keys, F.inline("s")).select(*[F.col(k).alias(n) for k, n in names.items()], F.col("n").alias("all"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    rank = F.col("__q") * (F.col("all") - 1)

    def at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") > position, F.col("place")))

    low, high = at(F.floor(rank)), at(F.ceil(rank))
    share = F.first(rank - F.floor(rank))
    found = totals.join(counts, same, "left").groupBy(*names.values()).agg((low + (high - low) * share).alias("quantile"))
    listed = F.array(*[F.lit(c) for c in columns])
    return found.select(
        *[F.col(names[k]).alias(k) for k in keys], F.get(listed, F.col("__i")).alias("column"), F.col("__q").alias("q"), "quantile"
    )


def _wide(long: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == c, F.col("quantile"))).alias(c) for c in columns])


def chunk_quantiles(df: DataFrame, columns: Sequence[str], q: float, chunk: Column, name: str = "chunk", few: int = FEW_VALUES) -> DataFrame:
    """One row per chunk with the ``q`` quantile of each column, NULL where the chunk has no value.

    ``chunk`` is a key expression, as rows of a distributed table have no position of their own.
    """
    return _wide(exact_quantiles(df.select(chunk.alias(name), *columns), columns, [q], [name], few), columns, [name])


def max_quantiles(quantiles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the largest chunk quantile of each column."""
    return quantiles.agg(*[F.max(c).alias(c) for c in columns])


def global_quantiles(df: DataFrame, columns: Sequence[str], q: float, few: int = FEW_VALUES) -> DataFrame:
    """One row: the quantile over the whole table."""
    return _wide(exact_quantiles(df, columns, [q], few=few), columns, [])


def five_number(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Minimum, quartiles and maximum of a column, from one sketch and one count."""
    long = exact_quantiles(df, [column], list(FIVE_NUMBERS.values()), by)
    return long.groupBy(*by).agg(*[F.max(F.when(F.col("q") == q, F.col("quantile"))).alias(name) for name, q in FIVE_NUMBERS.items()])
