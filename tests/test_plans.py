"""Whole runs from CSV text to models."""

import math

import pytest
from pyspark.sql import functions as F

from tabkit.plans import exploration, observations as plan, training, trips
from tabkit.sources.drifting import read_folder
from tabkit.sources.reports import load_model
from tabkit.sources.tables import read_columns, write_csv

from test_preparation import raw_rows


@pytest.fixture(scope="module")
def observation_folder(tmp_path_factory):
    """Two CSV files with the columns in different orders, one with an extra column."""
    folder = tmp_path_factory.mktemp("observations")
    names = ["obs_id", *plan.RAW_COLUMNS]
    rows = [dict(zip(names, map(lambda v: "" if v is None else str(v), r))) for r in raw_rows()]

    def dump(name, columns, part):
        lines = [",".join(columns)]
        lines += [",".join(f'"{row.get(c, "x")}"' if row.get(c, "x") else "" for c in columns) for row in part]
        (folder / name).write_text("\n".join(lines) + "\n")

    dump("a.csv", names, rows[:200])
    dump("b.csv", ["REM", *reversed(names)], rows[200:])
    return str(folder)


def test_observations_from_drifting_csv(spark, observation_folder):
    raw = read_folder(spark, observation_folder, ["obs_id", *plan.RAW_COLUMNS])
    prepared = plan.prepare_observations(raw, "obs_id")
    assert prepared.rows.count() == 400
    assert prepared.rows.na.drop().count() == 400


def test_ridge_and_tree_runs(spark, observation_folder):
    raw = read_folder(spark, observation_folder, ["obs_id", *plan.RAW_COLUMNS])
    prepared = plan.prepare_observations(raw, "obs_id").kept()
    train, test = prepared.train, prepared.test

    def error(run, split="train"):
        return run.metrics.filter(f"split = '{split}' and metric = 'rmse'").first().value

    naive = training.naive_report(train, test).filter("split = 'train' and metric = 'rmse'").first().value
    ridge = training.run_ridge(train, test, "obs_id")
    assert error(ridge) < naive and ridge.ranking.count() == len(plan.FEATURES)
    grid = {"maxDepth": (2,), "maxIter": (5,), "stepSize": (0.2,)}
    trees = training.run_gbt(train, test, "obs_id", grid=grid, fraction=0.5)
    assert error(trees) < naive
    assert {r.parameter for r in trees.report.collect()} >= {"maxDepth", "numTrees", "totalNodes"}
    assert ridge.metrics.count() == trees.metrics.count() == 10


def test_documented_flow_with_a_key_of_input_columns(spark, observation_folder, tmp_path):
    raw = read_folder(spark, observation_folder, plan.RAW_COLUMNS)
    key = ["DATE", "LATITUDE", "LONGITUDE", "ELEVATION"]
    prepared = plan.prepare_observations(raw, key).kept()
    run = training.run_ridge(prepared.train, prepared.test)
    assert run.metrics.count() == 10
    run.write(str(tmp_path / "ridge"))
    explored = exploration.explore_observations(raw.withColumns({c: F.lit(None).cast("string") for c in ("SLP", "GA1", "GF1", "MA1")}), key)
    assert "row_key" in explored.train.columns


def test_unreadable_times_and_numbers_are_dropped(spark):
    good = ["01/02/2022 03:05:00 AM"] * 2 + ["1"] * 8
    rows = [tuple(good)] + [tuple("?" if j == k else v for j, v in enumerate(good)) for k in range(10)]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in trips.TRIP_COLUMNS))
    assert trips.typed_trips(raw).count() == 1


def test_trips_from_csv_text(spark, tmp_path):
    rows = [
        (
            i, f"01/{1 + i % 28:02d}/2022 {1 + i % 12:02d}:05:00 AM", f"01/{1 + i % 28:02d}/2022 {1 + i % 12:02d}:25:00 PM",
            *(None if v is None else float(v) for v in (
                None if i == 7 else i % 5, 51 if i == 8 else (i % 40) / 2, 1 + i % 6, 1 + i % 200,
                1 + i % 150, 1 + i % 4, (i % 9) / 2, 3 + (i % 40) * 1.5,
            )),
        )
        for i in range(600)
    ]
    schema = "id int, tpep_pickup_datetime string, tpep_dropoff_datetime string, passenger_count double, trip_distance double, RatecodeID double, PULocationID double, DOLocationID double, payment_type double, extra double, total_amount double"
    write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "trips"))
    raw = read_columns(spark, str(tmp_path / "trips"), ["id", *trips.TRIP_COLUMNS])
    assert trips.typed_trips(raw).count() == 598
    run = trips.train_trips(
        raw, "id", kind="tanh", batch_rows=10**6, rate=0.2, max_steps=60, check_every=20, hidden=8
    )
    losses = [v for _, v in run.model.losses]
    assert losses == sorted(losses, reverse=True)
    assert run.test_rmse < 20
    report = {(r.split, r.metric): r.value for r in run.report(spark).collect()}
    assert report["train", "steps"] == 60 and report["test", "rmse"] == run.test_rmse


def test_exploration(spark, observation_folder, tmp_path):
    raw = read_folder(spark, observation_folder, ["obs_id", *plan.RAW_COLUMNS, "SLP"])
    raw = raw.withColumn("SLP", F.when(F.col("obs_id") == "3", "11000,1").otherwise("10100,1"))
    # A temperature that follows the dew point, so that a linear model has something to find.
    raw = raw.withColumn("TMP", F.when(F.col("DEW") == "+9999,1", "+0015,1").otherwise(F.col("DEW")))
    found = exploration.explore_observations(raw, "obs_id")
    errors = {r.rule: r.rows for r in found.errors.collect()}
    assert errors["SLP_0"] == 1 and errors["VIS_2"] > 0
    train, test = found.train.count(), found.test.count()
    assert test == math.ceil(0.2 * (train + test))
    assert set(plan.FEATURES) <= set(found.train.columns)
    scores = exploration.compare_by_fold(found.train, "obs_id")
    assert scores.count() == 10
    spread = {r.model: r for r in exploration.fold_spread(scores).collect()}
    assert spread["ridge"].median < spread["naive"].median
    assert {r.column for r in found.missing.collect()} == set(exploration.SENTINELS)


def test_fold_scores_read_the_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(200).select(F.col("id").alias("obs_id"), *[(F.rand(i) * 9).alias(c) for i, c in enumerate((*plan.FEATURES, plan.LABEL))])
    scores = exploration.compare_by_fold(rows.mapInArrow(count, rows.schema), "obs_id")
    assert exploration.fold_spread(scores).count() == 2
    assert seen.value == 200


def test_a_run_is_written(spark, observation_folder, tmp_path):
    raw = read_folder(spark, observation_folder, ["obs_id", *plan.RAW_COLUMNS])
    prepared = plan.prepare_observations(raw, "obs_id").kept()
    run = training.run_ridge(prepared.train, prepared.test, "obs_id", grid=(0.1,), k=2)
    run.write(str(tmp_path / "run"))
    assert spark.read.json(str(tmp_path / "run" / "metrics")).count() == 10
    again = load_model(str(tmp_path / "run" / "model")).transform(prepared.test)
    assert again.select("prediction").count() == prepared.test.count()
