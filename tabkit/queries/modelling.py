"""Network, ridge, trees and their evaluation."""

from __future__ import annotations

from uuid import uuid4

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..models import evaluate, linear, mlp, stages, trees
from ..models.stumps import boosted_stumps
from ..operators import quantiles, splits
from ..plans import exploration, observations as plan, training
from ..plans.trips import typed_trips, train_trips
from ..session import ensure_checkpoint_dir
from ..sources import reports
from .fixtures import OBS_KEY, TRIP_KEY, obs, timed_trips
from .oracle import OBS_ID, TRIP_ID, digest, hex4, using
from .registry import query, r6, rounded, rounded_rows

# A small network with written-out weights, so that SQL can follow every step.
LITERAL_NET = mlp.Network(
    np.array([[0.02, -0.03], [0.1, 0.05], [-0.4, 0.2]]), np.array([[1.5], [-2.0], [0.25]]), "tanh"
)
NET_INPUTS = ["trip_distance", "extra"]
_FORWARD = """
SELECT *, tanh(z1) AS a1, tanh(z2) AS a2, 1.5 * tanh(z1) - 2.0 * tanh(z2) + 0.25 AS p FROM (
  SELECT *, 0.02 * trip_distance + 0.1 * extra - 0.4 AS z1, -0.03 * trip_distance + 0.05 * extra + 0.2 AS z2
  FROM typed_trips)"""


def _prepared(spark: SparkSession, folder: str) -> plan.Prepared:
    return plan.prepare_observations(obs(spark, folder), OBS_KEY).kept()


@query(
    "mlp_forward",
    using("typed_trips", body=f"SELECT l_orderkey, l_linenumber, trip_distance, extra, {r6('p')} AS prediction FROM ({_FORWARD})"),
)
def mlp_forward(spark: SparkSession, folder: str) -> DataFrame:
    df = typed_trips(timed_trips(spark, folder)).select("l_orderkey", "l_linenumber", *NET_INPUTS)
    return rounded_rows(mlp.MLPModel(LITERAL_NET, NET_INPUTS, "total_amount").transform(df))


@query(
    "mlp_forward_columns",
    using("typed_trips", body=f"SELECT l_orderkey, l_linenumber, {r6('p')} AS prediction FROM ({_FORWARD})"),
)
def mlp_forward_columns(spark: SparkSession, folder: str) -> DataFrame:
    df = typed_trips(timed_trips(spark, folder))
    out = mlp.forward_columns([F.col(c) for c in NET_INPUTS], LITERAL_NET)
    return rounded_rows(df.select("l_orderkey", "l_linenumber", out.alias("prediction")))


@query(
    "mlp_sse",
    using(
        "typed_trips",
        body=f"""
SELECT {r6('sqrt(avg((p - total_amount) ** 2))')} AS rmse,
  {r6('avg((p - total_amount) ** 2) / 2')} AS loss, count(*) AS rows FROM ({_FORWARD})""",
    ),
)
def mlp_sse(spark: SparkSession, folder: str) -> DataFrame:
    data = mlp.packed(typed_trips(timed_trips(spark, folder)), NET_INPUTS, "total_amount")
    squares, rows = mlp.sse(data, LITERAL_NET)
    found = [(float(np.sqrt(squares / rows)), 0.5 * squares / rows, int(rows))]
    return rounded(spark.createDataFrame(found, "rmse double, loss double, rows bigint"))


@query(
    "mlp_gradient",
    using(
        "typed_trips",
        body=f"""
, f AS (SELECT *, p - total_amount AS e FROM ({_FORWARD}))
"""
        + " UNION ALL ".join(
            f"SELECT '{name}' AS weight, {r6(f'avg({value})')} AS gradient FROM f"
            for name, value in {
                "hidden[0,0]": "trip_distance * e * 1.5 * (1 - a1 * a1)",
                "hidden[0,1]": "trip_distance * e * -2.0 * (1 - a2 * a2)",
                "hidden[1,0]": "extra * e * 1.5 * (1 - a1 * a1)",
                "hidden[1,1]": "extra * e * -2.0 * (1 - a2 * a2)",
                "hidden[2,0]": "e * 1.5 * (1 - a1 * a1)",
                "hidden[2,1]": "e * -2.0 * (1 - a2 * a2)",
                "output[0]": "a1 * e",
                "output[1]": "a2 * e",
                "output[2]": "e",
            }.items()
        ),
    ),
)
def mlp_gradient(spark: SparkSession, folder: str) -> DataFrame:
    data = mlp.packed(typed_trips(timed_trips(spark, folder)), NET_INPUTS, "total_amount")
    names = [f"hidden[{i},{j}]" for i in range(3) for j in range(2)] + [f"output[{i}]" for i in range(3)]
    pairs = zip(names, mlp.gradient(data, LITERAL_NET).tolist())
    return rounded(spark.createDataFrame(list(pairs), "weight string, gradient double"))


_NET_NAMES = [f"hidden[{i},{j}]" for i in range(3) for j in range(2)] + [f"output[{i}]" for i in range(3)]
_NET_COLUMNS = "h00 h01 h10 h11 h20 h21 o0 o1 o2".split()
_NET_SLOPES = [f"{x}e * o{j} * (1 - a{j} * a{j})" for x in ("trip_distance * ", "extra * ", "") for j in range(2)] + ["a0 * e", "a1 * e", "e"]
_STEP_RATE = 0.001


def _steps_sql(steps: int) -> str:
    """The weights ``w0`` of the literal network, and those after each step of gradient descent over all rows."""
    first = [*LITERAL_NET.w1.ravel().tolist(), *LITERAL_NET.w2.ravel().tolist()]
    parts = ["w0 AS (SELECT " + ", ".join(f"CAST({v!r} AS DOUBLE) AS {c}" for v, c in zip(first, _NET_COLUMNS)) + ")"]
    for k in range(steps):
        moved = ", ".join(f"{c} - {_STEP_RATE} * avg({g}) AS {c}" for c, g in zip(_NET_COLUMNS, _NET_SLOPES))
        parts.append(f"""f{k} AS (SELECT *, a0 * o0 + a1 * o1 + o2 - total_amount AS e FROM (SELECT *,
  tanh(trip_distance * h00 + extra * h10 + h20) AS a0, tanh(trip_distance * h01 + extra * h11 + h21) AS a1
  FROM typed_trips, w{k} WHERE trip_distance IS NOT NULL AND extra IS NOT NULL AND total_amount IS NOT NULL))""")
        parts.append(f"w{k + 1} AS (SELECT {moved} FROM f{k} GROUP BY {', '.join(_NET_COLUMNS)})")
    return ", " + ", ".join(parts)


@query(
    "mlp_two_steps",
    using(
        "typed_trips",
        body=_steps_sql(2) + " UNION ALL ".join(f" SELECT '{n}' AS weight, {r6(c)} AS after FROM w2" for n, c in zip(_NET_NAMES, _NET_COLUMNS)),
    ),
)
def mlp_two_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Weights after two steps of training over all trips, from given ones."""
    trainer = mlp.MLPRegressor(
        NET_INPUTS, "total_amount", TRIP_KEY, batch_rows=1 << 62, rate=_STEP_RATE, max_steps=2, check_every=100, start=LITERAL_NET
    )
    net = trainer.fit(typed_trips(timed_trips(spark, folder))).net
    found = zip(_NET_NAMES, [*net.w1.ravel().tolist(), *net.w2.ravel().tolist()])
    return rounded(spark.createDataFrame(list(found), "weight string, after double"))


@query("mlp_train")
def mlp_train(spark: SparkSession, folder: str) -> DataFrame:
    """Training and test errors after 20 steps, each over all training trips."""
    run = train_trips(
        timed_trips(spark, folder), TRIP_KEY, kind="relu", batch_rows=1 << 62, rate=0.01, max_steps=20, check_every=5
    )
    return run.report(spark).filter(F.col("metric") != "seconds")


_RIDGE_MOMENTS = """
SELECT regr_slope(total_amount, trip_distance) AS plain, var_pop(trip_distance) AS vx,
  stddev_pop(total_amount) AS sy, covar_pop(total_amount, trip_distance) AS cxy,
  avg(trip_distance) AS mx, avg(total_amount) AS my FROM typed_trips"""


@query(
    "ridge_single_feature",
    using(
        "typed_trips",
        body=f"""
SELECT {r6('slope')} AS slope, {r6('my - slope * mx')} AS intercept
FROM (SELECT *, cxy / (vx * (1 + 0.3 / sy)) AS slope FROM ({_RIDGE_MOMENTS}))""",
    ),
)
def ridge_single_feature(spark: SparkSession, folder: str) -> DataFrame:
    model = linear.fit_ridge(typed_trips(timed_trips(spark, folder)), ["trip_distance"], "total_amount", 0.3)
    stage = linear.fitted(model)
    found = [(float(stage.coefficients[0]), float(stage.intercept))]
    return rounded(spark.createDataFrame(found, "slope double, intercept double"))


@query(
    "ridge_two_features",
    using(
        "typed_trips",
        body=f"""
, m AS (SELECT var_pop(trip_distance) * (1 + 0.5 / stddev_pop(total_amount)) AS a,
    covar_pop(trip_distance, extra) AS b, var_pop(extra) * (1 + 0.5 / stddev_pop(total_amount)) AS d,
    covar_pop(trip_distance, total_amount) AS p, covar_pop(extra, total_amount) AS q,
    avg(trip_distance) AS m1, avg(extra) AS m2, avg(total_amount) AS my FROM typed_trips),
s AS (SELECT *, (d * p - b * q) / (a * d - b * b) AS s1, (a * q - b * p) / (a * d - b * b) AS s2 FROM m)
SELECT {r6('s1')} AS distance_slope, {r6('s2')} AS extra_slope, {r6('my - s1 * m1 - s2 * m2')} AS intercept
FROM s""",
    ),
)
def ridge_two_features(spark: SparkSession, folder: str) -> DataFrame:
    model = linear.fit_ridge(typed_trips(timed_trips(spark, folder)), NET_INPUTS, "total_amount", 0.5)
    stage = linear.fitted(model)
    found = [(*[float(c) for c in stage.coefficients], float(stage.intercept))]
    schema = "distance_slope double, extra_slope double, intercept double"
    return rounded(spark.createDataFrame(found, schema))


@query(
    "model_round_trip",
    using(
        "typed_trips",
        body=f"""
, net AS ({_FORWARD}), line AS (SELECT *, cxy / (vx * (1 + 0.3 / sy)) AS slope FROM ({_RIDGE_MOMENTS}))
SELECT l_orderkey, l_linenumber, {r6('my + slope * (trip_distance - mx)')} AS ridge, {r6('p')} AS network FROM net, line""",
    ),
)
def model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of a ridge pipeline and of a network after both were saved and loaded."""
    df = typed_trips(timed_trips(spark, folder)).select("l_orderkey", "l_linenumber", *NET_INPUTS, "total_amount")
    ridge = linear.fit_ridge(df, ["trip_distance"], "total_amount", 0.3)
    network = PipelineModel([stages.NetworkModel.of(mlp.MLPModel(LITERAL_NET, NET_INPUTS, "total_amount"), "network")])
    ensure_checkpoint_dir(spark)
    for name, model in (("ridge", ridge), ("network", network)):
        path = f"{spark.sparkContext.getCheckpointDir()}/model-{uuid4()}"
        reports.save_model(model, path)
        df = reports.load_model(path).transform(df)
        df = df.withColumnRenamed("prediction", name).drop("features")
    return rounded_rows(df.select("l_orderkey", "l_linenumber", "ridge", "network"))


@query(
    "ridge_absolute_single",
    using(
        "typed_trips",
        body=f"""
, a AS (SELECT unnest([0.0, 1.0, 5000.0])::DOUBLE AS penalty),
s AS (SELECT penalty, (SELECT covar_pop(total_amount, trip_distance) * count(*) / (var_pop(trip_distance) * count(*) + penalty) FROM typed_trips) AS slope,
  (SELECT avg(trip_distance) FROM typed_trips) AS mx, (SELECT avg(total_amount) FROM typed_trips) AS my FROM a)
SELECT penalty, 'trip_distance' AS feature, {r6('slope')} AS weight FROM s
UNION ALL SELECT penalty, 'intercept', {r6('my - slope * mx')} FROM s""",
    ),
)
def ridge_absolute_single(spark: SparkSession, folder: str) -> DataFrame:
    df = typed_trips(timed_trips(spark, folder))
    return rounded(linear.ridge_weights(df, ["trip_distance"], "total_amount", [0.0, 1.0, 5000.0], absolute=True))


_MOMENT_NAMES = [*NET_INPUTS, "passenger_count", "total_amount"]


@query(
    "ridge_moments",
    using(
        "typed_trips",
        body=" UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'covar_pop({a}, {b})')} AS covariance, {r6(f'avg({a})')} AS mean FROM typed_trips"
            for a in _MOMENT_NAMES
            for b in _MOMENT_NAMES
        ),
    ),
)
def ridge_moments(spark: SparkSession, folder: str) -> DataFrame:
    m = linear.moments(typed_trips(timed_trips(spark, folder)), _MOMENT_NAMES[:-1], _MOMENT_NAMES[-1])[0]
    rows = [
        (a, b, float(m.products[i, j] / m.n), float(m.mean[i])) for i, a in enumerate(_MOMENT_NAMES) for j, b in enumerate(_MOMENT_NAMES)
    ]
    return rounded(spark.createDataFrame(rows, "a string, b string, covariance double, mean double"))


# Ridge on one feature for every fold and penalty, from the moments of each fold.
_CV_SQL = f"""
, d AS (SELECT {hex4(digest('fold', TRIP_ID))} % 5 AS fold, trip_distance AS x, total_amount AS y FROM typed_trips),
grid AS (SELECT unnest([0.001, 0.01, 0.1, 0.3, 1.0, 3.0, 10.0])::DOUBLE AS r),
folds AS (SELECT DISTINCT fold FROM d),
m AS (SELECT folds.fold, var_pop(x) AS vx, stddev_pop(y) AS sy, covar_pop(x, y) AS cxy,
    avg(x) AS mx, avg(y) AS my FROM folds JOIN d ON d.fold <> folds.fold GROUP BY folds.fold),
w AS (SELECT r, fold, cxy / (vx * (1 + r / sy)) AS slope, mx, my FROM m, grid),
e AS (SELECT w.r, w.fold, sqrt(avg((y - my - slope * (x - mx)) ** 2)) AS rmse, max(y) - min(y) AS spread
    FROM w JOIN d USING (fold) GROUP BY w.r, w.fold)
"""


def _folded_trips(spark: SparkSession, folder: str) -> DataFrame:
    df = splits.folds(typed_trips(timed_trips(spark, folder)), TRIP_KEY, 5)
    return df.select("fold", "trip_distance", "total_amount")


@query(
    "ridge_cv_single",
    using(
        "typed_trips",
        body=_CV_SQL + f"SELECT r AS \"regParam\", {r6('avg(rmse)')} AS rmse FROM e GROUP BY r",
    ),
)
def ridge_cv_single(spark: SparkSession, folder: str) -> DataFrame:
    df = _folded_trips(spark, folder)
    scores = linear.ridge_fold_scores(df, ["trip_distance"], "total_amount")
    return rounded(scores.groupBy("regParam").agg(F.avg("rmse").alias("rmse")))


@query(
    "fold_ridge_nrmse_single",
    using(
        "typed_trips",
        body=_CV_SQL + f"SELECT fold, {r6('rmse / spread')} AS nrmse FROM e WHERE r = 0.1",
    ),
)
def fold_ridge_nrmse_single(spark: SparkSession, folder: str) -> DataFrame:
    df = _folded_trips(spark, folder)
    return rounded(linear.fold_ridge_nrmse(df, ["trip_distance"], "total_amount", 0.1))


@query("ridge_fit")
def ridge_fit(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    model = linear.fit_ridge(prepared.train, plan.FEATURES, plan.LABEL, 0.1)
    return training.split_metrics(
        model.transform(prepared.train), model.transform(prepared.test), "ridge"
    )


@query("ridge_cv")
def ridge_cv(spark: SparkSession, folder: str) -> DataFrame:
    """Mean held-out RMSE per penalty over five folds, all features."""
    train = splits.folds(_prepared(spark, folder).train, OBS_KEY, 5)
    _, scores = linear.tune_ridge(train, plan.FEATURES, plan.LABEL)
    return scores


@query("fold_ridge_nrmse")
def fold_ridge_nrmse(spark: SparkSession, folder: str) -> DataFrame:
    train = splits.folds(_prepared(spark, folder).train, OBS_KEY, 5)
    return linear.fold_ridge_nrmse(train, plan.FEATURES, plan.LABEL, 0.1)


@query("coefficient_ranking")
def coefficient_ranking(spark: SparkSession, folder: str) -> DataFrame:
    model = linear.fit_ridge(_prepared(spark, folder).train, plan.FEATURES, plan.LABEL, 0.1)
    return evaluate.coefficient_ranking(linear.fitted(model), plan.FEATURES)


@query("fold_comparison")
def fold_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Five-number summaries of the fold scores of ridge and of the mean."""
    train = exploration.explore_observations(obs(spark, folder), OBS_KEY).train
    return exploration.fold_spread(exploration.compare_by_fold(train, OBS_KEY))


# A setting of the searched grid.
SHALLOW_TREES = {"maxDepth": 2, "maxIter": 20, "stepSize": 0.2, "subsamplingRate": 1.0, "minInstancesPerNode": 2}


@query("gbt_fit")
def gbt_fit(spark: SparkSession, folder: str) -> DataFrame:
    prepared = _prepared(spark, folder)
    model = trees.fit_gbt(prepared.train, plan.FEATURES, plan.LABEL, SHALLOW_TREES)
    return training.split_metrics(model.transform(prepared.train), model.transform(prepared.test), "gbt")


@query("gbt_cv")
def gbt_cv(spark: SparkSession, folder: str) -> DataFrame:
    """The whole grid searched on a sample; the best setting refitted on all rows."""
    train = _prepared(spark, folder).train
    model, tried = trees.tune_gbt(train, plan.FEATURES, plan.LABEL, OBS_KEY, fraction=0.2)
    stage = trees.fitted(model)
    found = [
        (int(s["maxDepth"]), int(s["maxIter"]), float(s["stepSize"]), float(s["subsamplingRate"]),
         int(s["minInstancesPerNode"]), float(rmse), all(v == stage.getOrDefault(name) for name, v in s.items()))
        for s, rmse in tried
    ]
    schema = (
        "max_depth int, max_iter int, step_size double, subsampling_rate double, min_instances int,"
        " rmse double, chosen boolean"
    )
    return spark.createDataFrame(found, schema)


STUMP_INPUTS = ["trip_distance", "extra", "passenger_count", "payment_type"]


def _stump_sql(name: str, target: str) -> str:
    """One round over ``typed_trips``: the best of all midpoints of all features."""
    each = " UNION ALL ".join(f"SELECT {i} AS i, '{c}' AS feature, {c} AS v, t FROM {name}_t" for i, c in enumerate(STUMP_INPUTS))
    return f"""
{name}_t AS (SELECT *, {target} AS t FROM typed_trips),
{name}_g AS (SELECT i, feature, v, count(*) AS n, sum(t) AS s FROM ({each}) GROUP BY ALL),
{name}_c AS (SELECT *, sum(n) OVER w AS ln, sum(s) OVER w AS ls, sum(n) OVER (PARTITION BY i) AS na, sum(s) OVER (PARTITION BY i) AS sa,
  lead(v) OVER (PARTITION BY i ORDER BY v) AS nv FROM {name}_g WINDOW w AS (PARTITION BY i ORDER BY v)),
{name} AS (SELECT feature, (v + nv) / 2 AS threshold, ln::BIGINT AS left_rows, (na - ln)::BIGINT AS right_rows, ls / ln AS left_value,
    (sa - ls) / (na - ln) AS right_value, (ls * ls / ln + (sa - ls) * (sa - ls) / (na - ln) - sa * sa / na) / na AS gain
  FROM {name}_c WHERE nv IS NOT NULL AND ln >= 2 AND na - ln >= 2 ORDER BY gain DESC, i, v LIMIT 1)"""


def _stump_row(name: str, k: int) -> str:
    return (
        f"SELECT {k}::INT AS round, feature, threshold, left_rows, right_rows, {r6('left_value')} AS left_value, "
        f"{r6('right_value')} AS right_value, {r6('gain')} AS \"drop\" FROM {name}"
    )


_SPLIT_VALUE = "CASE (SELECT feature FROM a) " + " ".join(f"WHEN '{c}' THEN {c}" for c in STUMP_INPUTS) + " END"
_RESIDUAL = f"2 * (total_amount - (SELECT CASE WHEN {_SPLIT_VALUE} <= threshold THEN left_value ELSE right_value END FROM a))"


@query("gbt_stump", using("typed_trips", body="," + _stump_sql("a", "total_amount") + _stump_row("a", 1)))
def gbt_stump(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(boosted_stumps(typed_trips(timed_trips(spark, folder)), STUMP_INPUTS, "total_amount", rounds=1, least=2))


@query(
    "gbt_two_rounds",
    using(
        "typed_trips",
        body="," + _stump_sql("a", "total_amount") + "," + _stump_sql("b", _RESIDUAL) + _stump_row("a", 1) + " UNION ALL " + _stump_row("b", 2),
    ),
)
def gbt_two_rounds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(boosted_stumps(typed_trips(timed_trips(spark, folder)), STUMP_INPUTS, "total_amount", rounds=2, least=2))


@query("importance_ranking")
def importance_ranking(spark: SparkSession, folder: str) -> DataFrame:
    model = trees.fit_gbt(_prepared(spark, folder).train, plan.FEATURES, plan.LABEL, SHALLOW_TREES)
    return evaluate.importance_ranking(trees.fitted(model), plan.FEATURES)


@query("model_report")
def model_report(spark: SparkSession, folder: str) -> DataFrame:
    train = _prepared(spark, folder).train
    model = trees.fit_gbt(train, plan.FEATURES, plan.LABEL, SHALLOW_TREES)
    return evaluate.model_report(trees.fitted(model), plan.FEATURES)


def _naive(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    table = plan.feature_table(obs(spark, folder), OBS_KEY).select("obs_id", "split", "TMP_0")
    mean = evaluate.naive_mean(table.filter(F.col("split") == "train"), "TMP_0")
    predicted = evaluate.naive_predictions(table, mean)
    return predicted, predicted.filter(F.col("split") == "test")


_NAIVE_SQL = """
, n AS (SELECT obs_id, split, TMP_0, (SELECT avg(TMP_0) FROM feats WHERE split = 'train') AS prediction
  FROM feats)
"""
_METRIC_SQL = {
    "rmse": "sqrt(avg((TMP_0 - prediction) ** 2))",
    "mae": "avg(abs(TMP_0 - prediction))",
    "r2": "1 - sum((TMP_0 - prediction) ** 2) / (var_pop(TMP_0) * count(*))",
    "nrmse": "sqrt(avg((TMP_0 - prediction) ** 2)) / (max(TMP_0) - min(TMP_0))",
}
_MAPE = "avg(abs(TMP_0 - prediction) / greatest(abs(TMP_0), 2.22e-16))"


@query(
    "naive_baseline",
    using("feats", body=_NAIVE_SQL + f"SELECT obs_id, split, TMP_0, {r6('prediction')} AS prediction FROM n"),
)
def naive_baseline(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_rows(_naive(spark, folder)[0])


@query(
    "regression_metrics",
    using(
        "feats",
        body=_NAIVE_SQL
        + "SELECT split, count(*) AS rows, "
        + ", ".join(f"{r6(sql)} AS {name}" for name, sql in _METRIC_SQL.items())
        + f", {r6('log10(' + _MAPE + ')')} AS log10_mape FROM n GROUP BY split",
    ),
)
def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """MAPE is shown as a logarithm: a label of zero makes it about 1e17."""
    found = evaluate.regression_metrics(_naive(spark, folder)[0], "TMP_0", "prediction", ["split"])
    return rounded(found.withColumn("log10_mape", F.log10("mape")).drop("mape"))


@query(
    "metrics_report",
    using(
        "feats",
        body=_NAIVE_SQL
        + " UNION ALL ".join(
            f"SELECT 'naive' AS model, split, '{name}' AS metric, {r6(sql)} AS value FROM n GROUP BY split"
            for name, sql in _METRIC_SQL.items()
        ),
    ),
)
def metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    table = plan.feature_table(obs(spark, folder), OBS_KEY).select("obs_id", "split", "TMP_0")
    sides = [table.filter(F.col("split") == side) for side in ("train", "test")]
    return rounded(training.naive_report(*sides).filter(F.col("metric") != "mape"))


@query("ridge_report")
def ridge_report(spark: SparkSession, folder: str) -> DataFrame:
    """Penalty, intercept and coefficients of the tuned ridge model."""
    train = splits.folds(_prepared(spark, folder).train, OBS_KEY, 5)
    model, _ = linear.tune_ridge(train, plan.FEATURES, plan.LABEL)
    return evaluate.model_report(linear.fitted(model), plan.FEATURES)


_FOLD_SQL = f"""
, d AS (SELECT {hex4(digest('fold', OBS_ID))} % 5 AS fold, TMP_0 AS y FROM feats WHERE split = 'train'),
p AS (SELECT f.fold, (SELECT avg(y) FROM d WHERE d.fold <> f.fold) AS mean FROM (SELECT DISTINCT fold FROM d) f),
s AS (SELECT fold, count(*) AS rows, sqrt(avg((y - mean) ** 2)) / (max(y) - min(y)) AS nrmse
  FROM d JOIN p USING (fold) GROUP BY fold)
"""


def _fold_scores(spark: SparkSession, folder: str) -> DataFrame:
    table = plan.feature_table(obs(spark, folder), OBS_KEY).filter(F.col("split") == "train")
    return evaluate.fold_naive_nrmse(splits.folds(table.select("obs_id", "TMP_0"), OBS_KEY, 5), "TMP_0")


@query("fold_naive_nrmse", using("feats", body=_FOLD_SQL + f"SELECT fold, rows, {r6('nrmse')} AS nrmse FROM s"))
def fold_naive_nrmse(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_fold_scores(spark, folder))


@query(
    "five_number",
    using(
        "feats",
        body=_FOLD_SQL
        + "SELECT "
        + ", ".join(
            f"{r6(f'quantile_cont(nrmse, {q})')} AS {name}"
            for name, q in {"minimum": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "maximum": 1}.items()
        )
        + " FROM s",
    ),
)
def five_number(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.five_number(_fold_scores(spark, folder), "nrmse"))


@query(
    "residual_sample",
    using(
        "feats",
        body=_NAIVE_SQL
        + f"""
SELECT obs_id, TMP_0, {r6('prediction')} AS prediction, {r6('TMP_0 - prediction')} AS residual
FROM n WHERE split = 'test' ORDER BY {digest('rows', OBS_ID)} LIMIT 1000""",
    ),
)
def residual_sample(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.residuals(_naive(spark, folder)[1], OBS_KEY, "TMP_0", "prediction", 1000))
