"""Imputation, scaling, splits and the whole preparation on literal rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkit.functions.hashing import row_hash
from tabkit.operators import impute, splits
from tabkit.operators.scale import Scaler
from tabkit.plans import observations as plan
from tabkit.session import fits_broadcast

TRAIN = [
    ("a", 1, 10), ("a", 1, 20), ("a", 1, 9999), ("a", 2, 30), ("b", 1, 9999), ("b", 1, 9999), (None, 1, 50),
    (None, 1, 9999),
]


@pytest.fixture
def model(spark):
    df = spark.createDataFrame(TRAIN, "place string, month int, v int")
    return impute.GroupMeanImputer(["place", "month"], {"v": 9999}).fit(df)


def test_sentinels_never_enter_the_means(model):
    assert model.overall["v"] == pytest.approx((10 + 20 + 30 + 50) / 4)
    assert model.group_count == 4


def test_unseen_groups_and_missing_keys_get_the_global_mean(spark, model):
    test = spark.createDataFrame(
        [("a", 1, 9999), ("z", 1, 9999), ("b", 1, 9999), (None, 1, 9999), ("a", 2, None), ("q", 9, 3)],
        "place string, month int, v int",
    )
    got = [r.v for r in model.transform(test).collect()]
    assert got == pytest.approx([15.0, 27.5, 27.5, 27.5, 30.0, 3.0])
    assert model.transform(test).columns == test.columns


def test_large_group_tables_are_joined_without_broadcast(spark, model):
    assert fits_broadcast(1000, 5) and not fits_broadcast(10**9, 5)
    wide = impute.GroupMeanModel(model.keys, model.columns, model.groups, 10**9, model.overall)
    df = spark.createDataFrame(TRAIN, "place string, month int, v int")
    hinted, plain = (m.transform(df)._jdf.queryExecution().analyzed().toString() for m in (model, wide))
    assert "broadcast" in hinted and "broadcast" not in plain
    rows = [sorted(map(str, m.transform(df).collect())) for m in (model, wide)]
    assert rows[0] == rows[1]


@pytest.mark.parametrize("ddof", [0, 1])
def test_scaler_from_the_group_table_equals_the_direct_one(spark, ddof):
    rng = np.random.default_rng(3)
    rows = [
        (
            None if i % 31 == 0 else float(i % 7),
            int(i % 3),
            9999 if i % 4 == 0 or i % 7 == 5 else int(rng.integers(0, 400)),
        )
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "place double, month int, v int")
    model = impute.GroupMeanImputer(["place", "month"], {"v": 9999}).fit(df)
    quick = model.imputed_scaler(["v", "place"], ddof).stats
    direct = Scaler(["v", "place"], ddof).fit(model.transform(df)).stats
    for c in direct:
        assert quick[c] == pytest.approx(direct[c], rel=1e-9)


def test_imputation_in_place(spark):
    df = spark.createDataFrame(TRAIN, "place string, month int, v int")
    got = impute.impute_in_place(df, ["place", "month"], {"v": 9999}).collect()
    assert sorted((str(r.place), r.month, -1 if r.v is None else r.v) for r in got) == sorted(
        [("a", 1, 10), ("a", 1, 20), ("a", 1, 15), ("a", 2, 30), ("b", 1, -1), ("b", 1, -1), ("None", 1, 50), ("None", 1, -1)]
    )


def test_a_column_without_spread_becomes_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, None)], "a double, b double")
    model = Scaler(["a", "b"]).fit(df)
    got = [tuple(r) for r in model.transform(df).collect()]
    assert got[0] == (0.0, pytest.approx(-1 / math.sqrt(2)))
    assert got[2] == (None, None)


def test_split_is_the_same_in_any_partitioning(spark):
    df = spark.range(5000)
    a = {r.id for r in splits.hash_split(df.repartition(3), "id")[0].collect()}
    train, test = splits.hash_split(df.repartition(11), "id")
    assert a == {r.id for r in train.collect()}
    assert train.count() + test.count() == 5000
    assert abs(len(a) / 5000 - 0.7) < 0.03


@pytest.mark.parametrize("n", [0, 1, 4, 5, 10, 1001])
def test_exact_split_sizes(spark, n):
    train, test = splits.exact_split(spark.range(n), "id", 0.2)
    assert (train.count(), test.count()) == (n - math.ceil(0.2 * n), math.ceil(0.2 * n))
    assert train.join(test, "id").count() == 0


def test_exact_split_narrows_level_by_level(spark, monkeypatch):
    monkeypatch.setattr(splits, "LEVEL_DIGITS", 1)
    train, test = splits.exact_split(spark.range(3000), "id", 0.25)
    assert (train.count(), test.count()) == (2250, 750)


def test_sample_n(spark):
    df = spark.range(2000)
    assert splits.sample_n(df, "id", 150).distinct().count() == 150
    assert splits.sample_n(df, "id", 5000).count() == 2000
    assert splits.sample_n(df, "id", 0).count() == 0


def test_exact_sizes_with_shared_keys_and_equal_rows(spark):
    df = spark.range(40).selectExpr("id % 3 as k", "id div 8 as v").union(spark.range(30).selectExpr("7L", "7L"))
    whole = sorted(map(tuple, df.collect()))
    for n in (1, 10, 33, 69, 70):
        assert splits.sample_n(df, "k", n).count() == n
    for share in (0.1, 0.37, 0.5, 0.93):
        train, test = splits.exact_split(df, "k", share)
        assert test.count() == math.ceil(share * 70)
        assert sorted(map(tuple, train.union(test).collect())) == whole


def test_different_keys_have_different_hashes(spark):
    rows = [("a", None), (None, "a"), ("a|b", None), ("a", "b"), ("", None), (None, None), (None, ""), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_hash(["x", "y"], "split")).distinct().count() == len(rows)


def test_samples_and_folds_are_independent_of_the_split(spark):
    train, _ = splits.hash_split(spark.range(20000), "id", 0.5)
    assert abs(splits.sample_fraction(train, "id", 0.1).count() / train.count() - 0.1) < 0.015
    sizes = [r["count"] for r in splits.folds(train, "id", 5).groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) < 0.15 * max(sizes)
    assert splits.sample_fraction(train, "id", 1.0).count() == train.count()
    assert splits.sample_fraction(train, "id", 0.0).count() == 0


RAW = "obs_id bigint, DATE string, LATITUDE string, LONGITUDE string, ELEVATION string, WND string, CIG string, VIS string, DEW string, TMP string"


def raw_rows():
    rows = []
    for i in range(400):
        place = i % 3
        rows.append(
            (
                i, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}T{i % 24:02d}:53:00", str(place * 10), str(place * 5),
                "100", f"{(i * 31) % 360:03d},1,N,{'9999' if i % 9 == 0 else f'{i % 50:04d}'},1",
                "22000,1,9," + "NY9"[i % 3], "016000,1," + "NV9"[i % 3] + ",1",
                "+9999,1" if i % 7 == 0 else f"+{i % 30:04d},1", f"+{i % 300:04d},1",
            )
        )
    rows.append((400, *rows[0][1:9], None))
    rows.append((401, *rows[0][1:9], "+0700,1"))
    return rows


def test_prepared_rows(spark):
    prepared = plan.prepare_observations(spark.createDataFrame(raw_rows(), RAW), "obs_id")
    rows = prepared.rows.toPandas()
    assert len(rows) == 400 and not rows.isna().any().any()
    assert set(plan.FEATURES) <= set(rows.columns)
    train = rows[rows.split == "train"]
    for c in ("LATITUDE", "LONGITUDE", "WND_3", "DEW_0"):
        assert train[c].mean() == pytest.approx(0, abs=1e-9)
        assert train[c].std(ddof=1) == pytest.approx(1, rel=1e-9)
    assert (rows.ELEVATION == 0.0).all()  # a single elevation has no spread
    assert sorted(prepared.train.columns) == sorted(set(rows.columns) - {"split"})


def test_prepared_rows_on_disk(spark, tmp_path):
    prepared = plan.prepare_observations(spark.createDataFrame(raw_rows(), RAW), "obs_id")
    prepared.write(str(tmp_path / "prepared"))
    back = spark.read.parquet(str(tmp_path / "prepared"))
    assert back.filter(F.col("split") == "test").count() == prepared.test.count()


def test_observations_with_absent_and_extra_columns(spark):
    df = spark.createDataFrame(raw_rows(), RAW).drop("CIG").withColumn("REM", F.lit("x"))
    fields = plan.observation_fields(df, "obs_id")
    assert "REM" not in fields.columns and fields.select("CIG_3").distinct().collect() == [(None,)]


def test_any_columns_can_be_the_key(spark):
    df = spark.createDataFrame(raw_rows(), RAW).drop("obs_id")
    table = plan.feature_table(df, ["DATE", "LATITUDE", "LONGITUDE"])
    assert {r.split for r in table.select("split").distinct().collect()} == {"train", "test"}
