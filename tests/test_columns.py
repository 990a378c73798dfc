import datetime

from pyspark.sql import functions as F

from tabkit.functions import scalar
from tabkit.operators import columns, features, profiling
import pytest


def test_conform(spark):
    df = spark.createDataFrame([("x", 1, 2.5)], "b string, extra int, a double")
    out = columns.conform(df, {"a": "double", "missing": "int", "b": "string"})
    assert out.dtypes == [("a", "double"), ("missing", "int"), ("b", "string")]
    assert tuple(out.first()) == (2.5, None, "x")


def test_casts_coerce(spark):
    df = spark.createDataFrame([("+0125", "1.5"), ("x", ""), (None, "-7")], "i string, d string")
    out = columns.cast_columns(df, {"i": "int", "d": "double"})
    assert [tuple(r) for r in out.collect()] == [(125, 1.5), (None, None), (None, -7.0)]


def test_split_with_first_row_missing_and_short_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, "a,b,c"), (4, "")], "id int, p string")
    declared = columns.split_fields(df, {"p": 2}).orderBy("id").collect()
    assert [tuple(r) for r in declared] == [(1, None, None), (2, "a", None), (3, "a", "b"), (4, "", None)]
    widest = columns.split_fields(df, ["p"]).orderBy("id").collect()
    assert [len(r) for r in widest] == [4] * 4 and widest[2].p_2 == "c"
    typed = columns.split_fields(df, {"p": 2}, keep=["p_0"], types={"p_0": "int"})
    assert typed.dtypes == [("id", "int"), ("p_0", "int")]


def test_split_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id int, p string")
    assert columns.split_fields(df, ["p"]).columns == ["id"]
    assert columns.split_fields(df, {"p": 2}).count() == 0


def test_split_is_done_once_for_many_filters(spark):
    df = spark.createDataFrame([("1,2",)], "p string")
    parts = columns.split_fields(df, {"p": 2}).filter((F.col("p_0") > "0") & (F.col("p_1") > "0") & (F.col("p_0") < "9"))
    plan = parts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_assemble_skips_incomplete_rows(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 1.0), (3, 4.0, 5.0)], "y int, a double, b double")
    assert [r.y for r in columns.assemble(df, "y").orderBy("y").collect()] == [1, 3]


def test_features_and_label(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, y int, flag int, b int")
    left, right = columns.features_label(df, "y", ["flag"])
    assert left.columns == ["a", "b"] and right.columns == ["y"]
    assert columns.with_bias(left).first().bias == 1.0


def test_union_outer(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    rows = {tuple(r) for r in columns.union_outer([a, b]).select("id", "a", "b").collect()}
    assert rows == {(1, "x", None), (2, None, "y")}


def test_profile_of_a_frame(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, s string")
    found = [tuple(r) for r in columns.profile(df).orderBy("position").collect()]
    assert found == [("id", "int", 0, 2), ("s", "string", 1, 2)]


def test_us_timestamp_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("01/02/2022 12:05:00 AM",), ("07/04/2022 01:00:30 PM",), ("2022-01-01",), (None,)], "t string")
    want = [
        int(datetime.datetime(2022, 1, 2, 0, 5, tzinfo=datetime.timezone.utc).timestamp()),
        int(datetime.datetime(2022, 7, 4, 13, 0, 30, tzinfo=datetime.timezone.utc).timestamp()),
        None,
        None,
    ]
    for zone in ("UTC", "Asia/Singapore"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = [r[0] for r in df.select(scalar.parse_us_timestamp(F.col("t"))).collect()]
            hours = features.hour_month(spark.createDataFrame([("2024-03-05T23:53:00",), ("bad",)], "DATE string")).collect()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == want
        assert [(r.HOUR, r.MONTH) for r in hours] == [(23, 3), (None, None)]


def test_unknown_activation_is_an_error(spark):
    with pytest.raises(ValueError):
        scalar.activation(F.lit(1.0), "softsign")
    slope = spark.range(1).select(scalar.activation_slope(F.lit(0.0), "relu")).first()[0]
    assert slope == 0.0


def test_sparse_columns(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (2, None, None), (3, 1, None), (4, 2, "b")], "id int, half int, also string"
    )
    assert profiling.sparse_columns(df, 0.5) == []
    assert profiling.sparse_columns(df, 0.49) == ["half", "also"]
    assert profiling.drop_sparse_columns(df, 0.49).columns == ["id"]


def test_value_counts_has_a_row_for_missing(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), (None,)], "s string")
    assert [tuple(r) for r in profiling.value_counts(df, "s").collect()] == [(None, 3), ("a", 2)]


def test_exceeding_rows(spark):
    df = spark.createDataFrame([(1.0, 9.0), (5.0, 9.0), (5.0, 1.0), (None, 1.0)], "a double, b double")
    found = profiling.exceeding_rows(df, {"a": 4.0, "b": 8.0}).collect()
    assert [r.columns_exceeding for r in found] == [["b"], ["a", "b"], ["a"]]
    nothing = profiling.exceeding_rows(df, {"a": 100.0, "b": None})
    assert nothing.count() == 0 and nothing.dtypes[-1] == ("columns_exceeding", "array<string>")
    assert profiling.exceeding_rows(df, {"a": None}).count() == 0


def test_missing_pct_with_guard(spark):
    df = spark.createDataFrame([(999, "V"), (999, "N"), (None, "N"), (5, "N")], "d int, t string")
    plain = profiling.missing_pct(df, {"d": [999]}).first().missing_pct
    guarded = profiling.missing_pct(df, {"d": [999]}, {"d": F.col("t") != "V"}).first().missing_pct
    assert (plain, guarded) == (75.0, 50.0)
