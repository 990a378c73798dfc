"""Files of a folder whose headers drift, sinks, reports and saved models."""

import json

import pytest

from tabkit.sources import drifting, reports, tables


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.csv").write_text("TMP,WND\n1,x\n2,y\n")
    (tmp_path / "b.csv").write_text("WND,TMP\nz,3\n")
    (tmp_path / "c.csv").write_text('TMP,EXTRA\n4,"p,q"\n5,\n')
    (tmp_path / "d e%.csv").write_text("WND\nw\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header_only.csv").write_text("TMP,WND\n")
    return tmp_path


def test_columns_are_matched_by_name(spark, folder):
    df = drifting.read_drifting(spark, f"{folder}/*.csv")
    rows = {(r.TMP, r.WND, r.EXTRA) for r in df.collect()}
    assert rows == {("1", "x", None), ("2", "y", None), ("3", "z", None), ("4", None, "p,q"), ("5", None, None), (None, "w", None)}


def test_chosen_columns_only(spark, folder):
    df = drifting.read_folder(spark, f"{folder}/*.csv", ["TMP", "ABSENT", "WND"])
    assert df.columns == ["TMP", "ABSENT", "WND"]
    assert {r.TMP for r in df.collect()} == {"1", "2", "3", "4", "5", None}
    assert {r.ABSENT for r in df.collect()} == {None}


def test_files_agreeing_on_the_chosen_columns_share_a_scan(spark, folder):
    df = drifting.read_drifting(spark, f"{folder}/*.csv", ["TMP"])
    assert sorted(str(r.TMP) for r in df.collect()) == ["1", "2", "3", "4", "5", "None"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 3  # TMP first, TMP second, no TMP


def test_longer_rows_and_quoted_text_keep_their_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text('A,A,,B\n1,2,3,"x,y"\n4\n5,6,7,8,9\n')
    df = drifting.read_drifting(spark, str(tmp_path))
    assert df.columns == ["A", "A_1", "_c2", "B"]
    assert {tuple(r) for r in df.collect()} == {
        ("1", "2", "3", "x,y"), ("4", None, None, None), ("5", "6", "7", "8")
    }
    assert {r.A for r in drifting.read_drifting(spark, str(tmp_path), ["A"]).collect()} == {"1", "4", "5"}


def test_skipped_files_are_reported(spark, folder):
    report = {r.file_path.rsplit("/", 1)[1]: r.columns for r in drifting.drift_report(spark, f"{folder}/*.csv").collect()}
    assert report["empty.csv"] is None
    assert report["b.csv"] == ["WND", "TMP"] and report["header_only.csv"] == ["TMP", "WND"]
    assert report["d e%.csv"] == ["WND"]
    assert len(report) == 6


def test_a_folder_of_empty_files(spark, tmp_path):
    (tmp_path / "e.csv").write_text("")
    df = drifting.read_folder(spark, str(tmp_path), ["TMP"])
    assert df.columns == ["TMP"] and df.count() == 0


def test_header_pass_reads_one_line_of_large_files(spark, tmp_path):
    body = "".join(f"{i},{i}\n" for i in range(200_000))
    (tmp_path / "big.csv").write_text("A,B\n" + body)
    (tmp_path / "gz.csv").write_text("B,A\n7,8\n")
    lines = {r.header for r in drifting.header_lines(spark, str(tmp_path)).collect()}
    assert lines == {"A,B", "B,A"}
    df = drifting.read_drifting(spark, str(tmp_path))
    assert df.count() == 200_001
    assert df.filter("A = '8' and B = '7'").count() == 1


def test_rows_per_file(spark, folder):
    df = spark.read.option("header", True).csv([f"{folder}/a.csv", f"{folder}/b.csv"])
    counts = {r.file_path.rsplit("/", 1)[1]: r.rows for r in tables.file_counts(df).collect()}
    assert counts == {"a.csv": 2, "b.csv": 1}


def test_csv_round_trip_by_header_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "x,1", None), (2, 'say "hi"', 2.5)], "id int, s string, d double")
    tables.write_csv(df, str(tmp_path / "out"))
    back = tables.read_columns(spark, str(tmp_path / "out"), ["s", "id"])
    assert {tuple(r) for r in back.collect()} == {("x,1", "1"), ('say "hi"', "2")}


def test_csv_scan_parses_only_the_chosen_columns(spark, folder):
    df = tables.read_columns(spark, f"{folder}/a.csv", ["WND"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<WND:string>" in plan


def test_parquet_round_trip_overwrites(spark, tmp_path):
    for n in (3, 2):
        tables.write_table(spark.range(n), str(tmp_path / "t.parquet"))
    assert tables.read_table(spark, str(tmp_path), "t").count() == 2


def test_first_rows_is_a_top_n_plan(spark):
    df = tables.first_rows(spark.range(1000), 3, ["id"])
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert [r.id for r in df.collect()] == [0, 1, 2]


def test_reports_as_json(spark, tmp_path):
    metrics = reports.metrics_frame(spark, [("ridge", "test", "rmse", 1.5), ("ridge", "test", "r2", None)])
    reports.write_json(metrics, str(tmp_path / "m"))
    lines = [json.loads(x) for f in (tmp_path / "m").glob("*.json") for x in f.read_text().splitlines()]
    assert {"model": "ridge", "split": "test", "metric": "rmse", "value": 1.5} in lines
    losses = reports.loss_history_frame(spark, [(1, 0.5), (2, 0.25)])
    assert [tuple(r) for r in losses.collect()] == [(1, 0.5), (2, 0.25)]


def test_a_file_that_breaks_off_is_noticed(spark, tmp_path):
    import gzip
    import random

    from tabkit.sources.drifting import read_drifting

    rnd = random.Random(1)
    data = gzip.compress(("a,b\n" + "".join(f"{rnd.random()},{k}\n" for k in range(200_000))).encode())
    (tmp_path / "cut.csv.gz").write_bytes(data[: len(data) // 2])
    (tmp_path / "whole.csv.gz").write_bytes(gzip.compress(b"a,b\n1,2\n") + gzip.compress(b"3,4\n"))
    (tmp_path / "plain.csv").write_text("b,a\n5,6\n")
    wrong = bytearray(gzip.compress(b"a,b\n" + b"7,8\n" * 1000))
    wrong[-6] ^= 255
    (tmp_path / "wrong.csv.gz").write_bytes(bytes(wrong))
    with pytest.raises(Exception):
        read_drifting(spark, str(tmp_path)).count()
    assert sorted(map(tuple, read_drifting(spark, str(tmp_path), ["a", "b"], skip_damaged=True).collect())) == [("1", "2"), ("3", "4"), ("6", "5")]
    reasons = {r.file_path.rsplit("/", 1)[1]: r.reason for r in drifting.drift_report(spark, str(tmp_path)).collect()}
    assert reasons["cut.csv.gz"] == "it breaks off" and reasons["wrong.csv.gz"] and reasons["whole.csv.gz"] is reasons["plain.csv"] is None


def test_a_folder_of_many_small_files(spark, tmp_path):
    import bz2
    import gzip

    for k in range(300):
        data = gzip.compress(b"a\n%d\n" % k)
        (tmp_path / f"f{k}.csv.gz").write_bytes(data[:-9] if k % 100 == 0 else data)
    (tmp_path / "x.csv.bz2").write_bytes(bz2.compress(b"a\n1000\n"))
    found = {int(r.a) for r in drifting.read_folder(spark, str(tmp_path), ["a"], skip_damaged=True).collect()}
    assert found == {k for k in range(300) if k % 100} | {1000}
