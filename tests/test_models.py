"""Properties of the models that SQL cannot check."""

from itertools import product

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from tabkit.models import boosting, evaluate, linear, mlp, stages, stumps, trees
from tabkit.operators.splits import folds
from tabkit.plans import training
from tabkit.queries import modelling
from tabkit.sources.reports import load_model, save_model


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1200, 3))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.1 * rng.normal(size=1200) + 7
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double").cache()


NAMES = ["a", "b", "c"]


@pytest.mark.parametrize("kind", mlp.ACTIVATIONS)
def test_gradient_matches_finite_differences(spark, data, kind):
    net = mlp.Network(*mlp.init_weights(3, 4, seed=1), kind)
    packed = mlp.packed(data.limit(200), NAMES, "y").cache()
    x = np.array([r.x for r in packed.collect()])
    y = np.array([r.y for r in packed.collect()])
    got = mlp.gradient(packed, net)

    def loss(flat):
        moved = mlp.Network(flat[:16].reshape(4, 4), flat[16:].reshape(5, 1), kind)
        return 0.5 * np.mean((moved.predict(x) - y) ** 2)

    flat = np.concatenate([net.w1.ravel(), net.w2.ravel()])
    for i in range(len(flat)):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert got[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-5)


def test_start_weights():
    w1, w2 = mlp.init_weights(9, 16, seed=3)
    assert w1.shape == (10, 16) and w2.shape == (17, 1)
    assert np.abs(w1).max() <= 0.1 and np.abs(w2).max() <= 0.1
    again = mlp.init_weights(9, 16, seed=3)
    assert (w1 == again[0]).all() and (w2 == again[1]).all()


def test_sigmoid_does_not_overflow():
    net = mlp.Network(np.array([[1e4], [0.0]]), np.array([[1.0], [0.0]]), "sigmoid")
    assert net.predict(np.array([[-1.0], [1.0]])).tolist() == [0.0, 1.0]


def test_unknown_activation():
    with pytest.raises(ValueError):
        mlp.Network(np.zeros((2, 1)), np.zeros((2, 1)), "softsign")


def test_full_batch_training_follows_numpy(data):
    model = mlp.MLPRegressor(
        NAMES, "y", "id", kind="tanh", hidden=3, batch_rows=10**9, rate=0.05, max_steps=4, check_every=1, tolerance=0.0, seed=2
    ).fit(data)
    rows = data.select(*NAMES, "y").toPandas().to_numpy()
    x, y = rows[:, :3], rows[:, 3]
    net, losses = mlp.Network(*mlp.init_weights(3, 3, seed=2), "tanh"), []
    for _ in range(4):
        net = net.moved(net.gradient_sum(x, y) / len(y), 0.05)
        losses.append(0.5 * np.mean((net.predict(x) - y) ** 2))
    assert [s for s, _ in model.losses] == [1, 2, 3, 4]
    assert [v for _, v in model.losses] == pytest.approx(losses, rel=1e-9)
    np.testing.assert_allclose(model.net.w1, net.w1, rtol=1e-9)


def test_mini_batches_learn_and_repeat(data):
    trainer = mlp.MLPRegressor(
        NAMES, "y", "id", kind="tanh", hidden=8, batch_rows=300, rate=0.1, max_steps=60, check_every=10
    )
    first, second = trainer.fit(data), trainer.fit(data)
    losses = [v for _, v in first.losses]
    assert losses[-1] < 0.3 * losses[0]
    np.testing.assert_allclose(first.net.w1, second.net.w1, rtol=1e-9)
    predicted = first.transform(data)
    assert predicted.columns == [*data.columns, "prediction"]
    rmse = evaluate.regression_metrics(predicted, "y", "prediction").first().rmse
    assert rmse == pytest.approx(first.rmse(data), rel=1e-9)


def test_training_stops_when_the_loss_stands_still(data):
    model = mlp.MLPRegressor(NAMES, "y", "id", rate=1e-12, max_steps=50, check_every=1, tolerance=1e-5).fit(data)
    assert model.converged and model.losses[-1][0] == 1


def test_rows_with_a_missing_feature(spark):
    """Left out of training, and without a prediction."""
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0)], "id int, a double, y double")
    net = mlp.Network(np.array([[1.0], [0.0]]), np.array([[1.0], [0.0]]), "relu")
    assert mlp.sse(mlp.packed(df, ["a"], "y"), net) == (1.0, 1.0)
    found = mlp.MLPModel(net, ["a"], "y").transform(df).collect()
    assert {r.id: r.prediction for r in found} == {1: 1.0, 2: None}


def test_one_pass_ridge_search_equals_the_cross_validator(data):
    marked = folds(data, "id", 4)
    grid = (0.01, 0.3, 3.0)
    best, scores = linear.tune_ridge(marked, NAMES, "y", grid)
    reference, averages = linear.cross_validate_ridge(marked, NAMES, "y", grid, k=4)
    found = {r.regParam: r.rmse for r in scores.collect()}
    assert [found[r] for r in grid] == pytest.approx(averages, rel=1e-6)
    np.testing.assert_allclose(
        best.stages[-1].coefficients.toArray(), reference.stages[-1].coefficients.toArray(), rtol=1e-9
    )
    assert scores.first().rmse == min(found.values())


def test_ridge_search_with_a_constant_feature(data):
    marked = folds(data.withColumn("k", F.lit(2.0)), "id", 3)
    _, scores = linear.tune_ridge(marked, [*NAMES, "k"], "y", (0.1, 1.0))
    assert all(np.isfinite(r.rmse) for r in scores.collect())


def test_ridge_scores_at_large_means(data):
    """Moments around the mean keep their digits when a feature is far from zero."""
    marked = folds(data, "id", 3)
    far = marked.withColumn("a", F.col("a") + 1e8)
    near, moved = ({(r.regParam, r.fold): r.rmse for r in linear.ridge_fold_scores(df, NAMES, "y", (0.1, 1.0)).collect()} for df in (marked, far))
    assert moved == pytest.approx(near, rel=1e-6)


def test_absolute_penalty(data):
    x = data.select(*NAMES, "y").toPandas().to_numpy()
    around = x - x.mean(axis=0)
    found = {(r.penalty, r.feature): r.weight for r in linear.ridge_weights(data, NAMES, "y", (0.0, 7.0), absolute=True).collect()}
    for penalty in (0.0, 7.0):
        slopes = np.linalg.solve(around[:, :3].T @ around[:, :3] + penalty * np.eye(3), around[:, :3].T @ around[:, 3])
        assert [found[penalty, n] for n in NAMES] == pytest.approx(slopes, rel=1e-9)
        assert found[penalty, "intercept"] == pytest.approx(x[:, 3].mean() - x[:, :3].mean(axis=0) @ slopes, rel=1e-9)


def test_saved_ridge_predicts_the_same(data, tmp_path):
    model = linear.fit_ridge(data, NAMES, "y", 0.1)
    save_model(model, str(tmp_path / "ridge"))
    save_model(model, str(tmp_path / "ridge"))
    again = load_model(str(tmp_path / "ridge"))
    left, right = (m.transform(data).orderBy("id").toPandas().prediction for m in (model, again))
    assert (left == right).all()


def test_saved_network_predicts_the_same(data, tmp_path):
    trainer = stages.NetworkRegressor(NAMES, "y", "id", kind="tanh", units=4, rate=0.05, maxSteps=6, checkEvery=3)
    trainer.write().overwrite().save(str(tmp_path / "trainer"))
    model = Pipeline(stages=[stages.NetworkRegressor.load(str(tmp_path / "trainer"))]).fit(data)
    save_model(model, str(tmp_path / "network"))
    again = load_model(str(tmp_path / "network"))
    left, right = (m.transform(data).orderBy("id").toPandas().prediction for m in (model, again))
    assert (left == right).all() and again.stages[0].net.kind == "tanh"


def test_rankings(data):
    model = linear.fit_ridge(data, NAMES, "y", 0.01)
    ranked = [r.feature for r in evaluate.coefficient_ranking(model.stages[-1], NAMES).collect()]
    assert ranked == ["a", "b", "c"]
    report = {r.parameter: r.value for r in evaluate.model_report(model.stages[-1], NAMES).collect()}
    assert report["regParam"] == 0.01 and report["coefficient a"] == pytest.approx(3, abs=0.1)


def test_trees_beat_the_mean_and_repeat(data):
    setting = {"maxDepth": 3, "maxIter": 5, "stepSize": 0.3}
    model = trees.fit_gbt(data, NAMES, "y", setting)
    predicted = model.transform(data)
    got = evaluate.regression_metrics(predicted, "y", "prediction").first()
    naive = evaluate.naive_predictions(data, evaluate.naive_mean(data, "y"))
    assert got.rmse < 0.7 * evaluate.regression_metrics(naive, "y", "prediction").first().rmse
    again = trees.fit_gbt(data, NAMES, "y", setting).transform(data)
    assert evaluate.regression_metrics(again, "y", "prediction").first().rmse == pytest.approx(got.rmse, rel=1e-9)
    ranked = evaluate.importance_ranking(model.stages[-1], NAMES).collect()
    assert ranked[0].feature == "a" and sum(r.weight for r in ranked) == pytest.approx(1.0)
    report = {r.parameter: r.value for r in evaluate.model_report(model.stages[-1], NAMES).collect()}
    assert report["numTrees"] == 5 and report["maxDepth"] == 3


def test_tree_search_refits_the_best_setting(data):
    grid = {"maxDepth": (1, 3), "maxIter": (3,)}
    model, tried = trees.tune_gbt(data, NAMES, "y", "id", grid, fraction=0.5)
    best = min(tried, key=lambda pair: pair[1])[0]
    assert model.stages[-1].getMaxDepth() == best["maxDepth"] == 3
    assert len(tried) == 2


def test_registered_search_tries_the_whole_grid(spark):
    rows = modelling.gbt_cv(spark, "/root/testdata/sf0.001").collect()
    assert {tuple(r)[:5] for r in rows} == set(product(*trees.TREE_GRID.values())) and len(rows) == 72
    assert [r.rmse for r in rows if r.chosen] == [min(r.rmse for r in rows)]


@pytest.fixture(scope="module")
def twice(spark, data):
    """Every row in fold 0 and in fold 1, so that a model of one fold has the same cuts as one of all rows."""
    coarse = data.withColumn("c", F.round("c")).withColumn("y", F.col("y") + F.pow("b", 2) + F.col("c") * F.col("a"))
    return coarse.withColumn("fold", F.explode(F.array(F.lit(0), F.lit(1)))).cache()


@pytest.mark.parametrize("setting", [
    {"maxDepth": 1, "maxIter": 1},
    {"maxDepth": 3, "maxIter": 6, "stepSize": 0.2},
    {"maxDepth": 5, "maxIter": 10, "minInstancesPerNode": 5},
])
@pytest.mark.parametrize("sent_rows", [0, 10_000])
def test_searched_trees_are_those_of_spark(twice, setting, sent_rows):
    ((_, found),) = boosting.search(twice, NAMES, "y", ["id"], {k: (v,) for k, v in setting.items()}, 2, sent_rows=sent_rows)
    model = trees.fit_gbt(twice.filter("fold = 0"), NAMES, "y", setting)
    want = evaluate.regression_metrics(model.transform(twice.filter("fold = 1")), "y", "prediction").first().rmse
    assert found == pytest.approx(want, rel=1e-6)


def test_sums_of_joined_features_and_of_siblings():
    """Trees from sums of smaller children over joined features are those from the sums of all rows over each feature."""
    rnd = np.random.default_rng(3)
    bins = np.array([rnd.integers(0, n, 3000) for n in (9, 9, 32, 2, 32, 24)], np.uint8)
    bins[1] = bins[0]
    y, fold, mark = np.rint(rnd.normal(bins[2], 9)), rnd.integers(0, 3, 3000).astype(np.int32), rnd.integers(0, 1 << 62, 3000).astype(np.uint64)
    one = boosting.Growth([boosting.Sequence_(8, 0.1, 0.8, 2, 1)], len(bins), 7, 2.0**20)
    trees = one.started()
    for level in range(8):
        owner, place, least = one.opened(trees)
        one.split(trees, level, owner, place, one.best(*one.entries(trees, level, 0, (bins, y, fold, mark, np.zeros((1, 3000)))), least))
    row = np.flatnonzero((fold != 1) & one.drawn(mark, 0, [0])[0])
    bundles = boosting.Bundles(bins)
    assert [held[0] for held in bundles.held] == [[0, 1, 2], [3, 4], [5]]
    found = boosting._tree(one, bundles, row, np.rint(y[row] * one.scale))
    assert found.tolist() == one.moved(trees, 0, bins, np.zeros((1, 3000)))[0].tolist()


def test_a_search_over_many_rows_is_one_job(spark, data, monkeypatch):
    """Beyond 100,000 rows a level of a tree was a job."""
    monkeypatch.setattr(boosting, "Boosting", None)
    many = data.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(100_001 // data.count() + 1)))).withColumn("fold", F.col("copy") % 2)
    assert len(boosting.search(many, NAMES, "y", ["id", "copy"], {"maxDepth": (2,), "maxIter": (1, 2)}, 2)) == 2


def test_search_does_not_depend_on_the_partitioning(data):
    marked = folds(data.withColumn("b", F.when(F.col("id") % 50 != 0, F.col("b"))), "id", 3)
    grid = {"maxDepth": (2, 4), "maxIter": (2, 12), "subsamplingRate": (0.7, 1.0)}
    one = boosting.search(marked.coalesce(1), NAMES, "y", ["id"], grid)
    assert one == boosting.search(marked.repartition(7), NAMES, "y", ["id"], grid)
    spread = boosting.search(marked.repartition(5), NAMES, "y", ["id"], grid, sent_rows=0)
    assert [s for s, _ in spread] == [s for s, _ in one] == [dict(zip(grid, v)) for v in product(*grid.values())]
    assert [e for _, e in spread] == pytest.approx([e for _, e in one], rel=1e-12)


def test_stumps_are_those_of_spark(data):
    """On features of few values, where every midpoint is a threshold of Spark's too."""
    coarse = data.withColumn("a", F.round("a")).withColumn("b", F.round(F.col("b") * 2))
    found = stumps.boosted_stumps(coarse.repartition(5), ["a", "b"], "y", rounds=3, step=0.3)
    model = trees.fit_gbt(coarse, ["a", "b"], "y", {"maxDepth": 1, "maxIter": 3, "stepSize": 0.3, "minInstancesPerNode": 1}).stages[-1]
    for row, tree in zip(found.orderBy("round").collect(), model.trees):
        text = tree.toDebugString
        assert f"feature {['a', 'b'].index(row.feature)} <= {row.threshold}" in text
        values = [float(line.split("Predict:")[1]) for line in text.splitlines() if "Predict:" in line]
        assert values == pytest.approx([row.left_value, row.right_value], rel=1e-6)


def test_stumps_without_a_split(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "a double, y double")
    assert stumps.boosted_stumps(df, ["a"], "y").count() == 0
    assert stumps.boosted_stumps(df.limit(0), ["a"], "y").count() == 0


def test_thresholds():
    assert boosting.thresholds(np.array([3.0, 1.0, 2.0, 2.0])).tolist() == [1.5, 2.5]
    assert boosting.thresholds(np.array([5.0, 5.0])).tolist() == []
    cuts = boosting.thresholds(np.arange(1000.0))
    assert len(cuts) == 31 and np.allclose(np.diff(cuts), 31.25, atol=1)


def test_search_without_rows(data):
    with pytest.raises(ValueError):
        boosting.search(folds(data.limit(0), "id", 2), NAMES, "y", ["id"], {"maxDepth": (1,)}, 2)


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 3.0), (None, 1.0)], "y double, p double")
    m = evaluate.regression_metrics(df, "y", "p").first()
    assert m.rows == 3
    assert m.rmse == pytest.approx(np.sqrt(5 / 3)) and m.mae == pytest.approx(1.0)
    assert m.r2 == pytest.approx(1 - 5 / 8) and m.nrmse == pytest.approx(np.sqrt(5 / 3) / 4)
    assert m.mape == pytest.approx((1 + 0 + 0.4) / 3)
    flat = spark.createDataFrame([(2.0, 1.0), (2.0, 2.0)], "y double, p double")
    assert evaluate.regression_metrics(flat, "y", "p").first().nrmse is None


def test_fold_scores_of_the_mean(data):
    marked = folds(data, "id", 3)
    got = {r.fold: r.nrmse for r in evaluate.fold_naive_nrmse(marked, "y").collect()}
    pdf = marked.select("fold", "y").toPandas()
    for fold, part in pdf.groupby("fold"):
        rest = pdf[pdf.fold != fold].y.mean()
        want = np.sqrt(((part.y - rest) ** 2).mean()) / (part.y.max() - part.y.min())
        assert got[fold] == pytest.approx(want, rel=1e-9)


def test_residuals(data):
    df = data.withColumn("prediction", F.col("y") - 1)
    sample = evaluate.residuals(df, "id", "y", "prediction", 50).collect()
    assert len(sample) == 50 and all(r.residual == pytest.approx(1.0) for r in sample)


def test_split_metrics(data):
    df = data.withColumn("prediction", F.col("y"))
    found = training.split_metrics(df, df.limit(10), "perfect", "y").collect()
    assert len(found) == 10 and {r.split for r in found} == {"train", "test"}
    assert {r.value for r in found if r.metric in ("rmse", "mae", "mape")} == {0.0}
