"""Exact quantiles against numpy, with and without counting rounds."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.operators import quantiles


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    values = []
    for chunk, n in ((0, 4000), (1, 7), (2, 1), (None, 50)):
        for i in range(n):
            a = float(rng.lognormal(0, 3)) if i % 5 else 2.5
            b = None if i % 3 == 0 else float(rng.integers(0, 4))
            values.append((chunk, a, b))
    values += [(3, None, None)] * 4
    return values


def expected(rows, q):
    out = {}
    for chunk in {r[0] for r in rows}:
        cols = []
        for i in (1, 2):
            seen = [r[i] for r in rows if r[0] == chunk and r[i] is not None]
            cols.append(float(np.quantile(seen, q)) if seen else None)
        out[chunk] = cols
    return out


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.999, 1.0])
@pytest.mark.parametrize("few", [2, 60, quantiles.FEW_VALUES])
def test_chunk_quantiles(spark, rows, q, few):
    df = spark.createDataFrame(rows, "k int, a double, b double")
    found = quantiles.chunk_quantiles(df, ["a", "b"], q, F.col("k"), few=few).collect()
    want = expected(rows, q)
    assert len(found) == len(want)
    for row in found:
        for got, value in zip((row.a, row.b), want[row.chunk]):
            assert (got is None) == (value is None)
            if value is not None:
                assert got == pytest.approx(value, rel=1e-12)


@pytest.mark.parametrize("q", [0.01, 0.5, 0.999])
@pytest.mark.parametrize("few", [3, quantiles.FEW_VALUES])
def test_global_quantiles_with_a_dominant_value(spark, q, few):
    values = [5.0] * 3000 + [float(i) / 7 for i in range(6000)] + [1e300, -1e300]
    df = spark.createDataFrame([(v,) for v in values], "a double")
    row = quantiles.global_quantiles(df, ["a"], q, few).first()
    assert row.a == pytest.approx(float(np.quantile(values, q)), rel=1e-12)


def test_sketched_intervals_of_many_values(spark):
    """Enough values that the sketch is not exact, of several distributions, at ranks between two values."""
    rng = np.random.default_rng(3)
    columns = {"a": rng.normal(size=60_000), "b": rng.lognormal(0, 4, 60_000), "c": rng.integers(0, 50, 60_000).astype(float)}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], "a double, b double, c double").repartition(7)
    qs = [0.0, 0.00001, 0.123456, 0.5, 0.99, 0.9999, 1.0]
    for r in quantiles.exact_quantiles(df, list(columns), qs).collect():
        assert r.quantile == pytest.approx(float(np.quantile(columns[r.column], r.q)), rel=1e-12)


def test_values_are_not_shuffled(spark):
    """What meets a shuffle are sketches and counts: far fewer rows than values."""
    df = spark.range(200_000).select(F.expr("cast(hash(id) as double)").alias("a"), (F.col("id") % 3).alias("k"))
    quantiles.exact_quantiles(df, ["a"], [0.999], ["k"]).collect()
    counts = quantiles._places(quantiles._joined(df.withColumnRenamed("a", "__v0"), quantiles._sketched(df.withColumnRenamed("a", "__v0"), ["k"], ["__v0"], [0.999]), ["k"], 6), ["k"], ["__v0"], lambda v, s: v)
    assert counts.groupBy("k", "i", "q", "place").count().count() < 1_000


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, a double")
    assert quantiles.chunk_quantiles(df, ["a"], 0.5, F.col("k")).count() == 0
    assert quantiles.global_quantiles(df, ["a"], 0.5).first().a is None


def test_five_number(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 10)], "s double")
    row = quantiles.five_number(df, "s").first()
    assert tuple(row) == (1.0, 2.0, 3.0, 4.0, 10.0)


def test_max_quantiles_ignores_missing_chunks(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 9.0)], "chunk int, a double")
    assert quantiles.max_quantiles(df, ["a"]).first().a == 9.0
