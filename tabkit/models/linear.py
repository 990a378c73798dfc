"""Ridge regression and its cross-validated grid search.

The penalty follows Spark's scale: with ``regParam`` r and n rows, coefficient
j is penalised by ``n * r / sigma(y) * var(x_j)``, population moments, the
label spread entering because Spark solves in standardised units. An absolute penalty is added to the
summed squares of each feature as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..operators.columns import assembler
from ..session import spread
from .partials import as_matrix

# The searched penalties.
RIDGE_GRID = (0.001, 0.01, 0.1, 0.3, 1.0, 3.0, 10.0)


def _estimator(label: str, reg: float = 0.0) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label, regParam=reg, elasticNetParam=0.0)


def fit_ridge(df: DataFrame, features: Sequence[str], label: str, reg: float) -> PipelineModel:
    """Assembler and ridge model; the normal equations take one pass over the rows."""
    stage = assembler(features)
    model = _estimator(label, reg).fit(stage.transform(df).select(label, "features"))
    return PipelineModel([stage, model])


def fitted(model: PipelineModel) -> LinearRegressionModel:
    return model.stages[-1]


@dataclass(frozen=True)
class Moments:
    """Rows, means, and summed products around the means, of the features and, last, the label.

    Two of them merge into those of all rows without large sums that cancel.
    """

    n: float
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        around = rows - mean
        return cls(float(len(rows)), mean, around.T @ around)

    def merged(self, other: Moments) -> Moments:
        n, apart = self.n + other.n, other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products)

    def mean_square(self, weights: np.ndarray) -> float:
        """Mean squared error of predicting with ``weights``, intercept first."""
        direction = np.append(weights[1:], -1.0)
        offset = weights[0] + self.mean @ direction
        return max(direction @ self.products @ direction, 0.0) / self.n + offset * offset


_PARTIAL = "grp int, n double, mean array<double>, products array<double>"


def _merged(rows: Iterable[tuple[int, float, list, list]]) -> dict[int, Moments]:
    found: dict[int, Moments] = {}
    for group, n, mean, products in rows:
        one = Moments(n, np.array(mean), np.array(products).reshape(len(mean), -1))
        found[group] = found[group].merged(one) if group in found else one
    return found


def _batch_of(found: dict[int, Moments]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
    rows = [(group, m.n, m.mean.tolist(), m.products.ravel().tolist()) for group, m in found.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["grp", "n", "mean", "products"])


def moments(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, Moments]:
    """Per fold, or for all rows as fold 0, the moments of complete rows; a task sends one row a fold."""
    width = len(features) + 1
    values = F.array(*[F.col(c).cast("double") for c in [*features, label]])
    group = F.col(fold).cast("int") if fold else F.lit(0)

    def partial(batches):
        found: dict[int, Moments] = {}
        for batch in batches:
            rows, groups = as_matrix(batch.column("v"), width), batch.column("f").to_numpy(zero_copy_only=False)
            for g in np.unique(groups):
                one = Moments.of(rows[groups == g])
                found[int(g)] = found[int(g)].merged(one) if int(g) in found else one
        if found:
            yield _batch_of(found)

    def whole(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (tuple(row.values()) for batch in batches for row in batch.to_pylist())
        yield _batch_of(_merged(rows))

    complete = df.na.drop(subset=[*features, label]).select(group.alias("f"), values.alias("v"))
    sums = complete.mapInArrow(partial, _PARTIAL).groupBy("grp").applyInArrow(whole, _PARTIAL)
    return _merged(map(tuple, sums.collect()))


def _solver(m: Moments, absolute: bool) -> Callable[[float], np.ndarray]:
    """Intercept and coefficients for any penalty, from one decomposition.

    On Spark's scale the features are standardised first; ``absolute`` adds the penalty to the summed squares of each.
    """
    xx, xy, yy = m.products[:-1, :-1], m.products[:-1, -1], m.products[-1, -1]
    used = np.diag(xx) > 0.0
    size = np.ones(used.sum()) if absolute else np.sqrt(np.diag(xx)[used])
    values, vectors = np.linalg.eigh(xx[np.ix_(used, used)] / np.outer(size, size))
    turned = vectors.T @ (xy[used] / size)
    sigma = np.sqrt(max(yy, 0.0) / m.n)

    def solve(penalty: float) -> np.ndarray:
        slopes = np.zeros(len(xy))
        if sigma > 0.0:
            below = values + (penalty if absolute else penalty / sigma)
            some = below > 1e-12 * max(1.0, values.max(initial=0.0))
            slopes[used] = vectors @ np.where(some, turned / np.where(some, below, 1.0), 0.0) / size
        return np.append(m.mean[-1] - m.mean[:-1] @ slopes, slopes)

    return solve


def ridge_weights(df: DataFrame, features: Sequence[str], label: str, penalties: Sequence[float], absolute: bool = False) -> DataFrame:
    """``(penalty, feature, weight)`` for every penalty from one pass; the intercept is a feature of that name."""
    found = moments(df, features, label)
    if not found:
        raise ValueError("no complete row to fit")
    solve = _solver(found[0], absolute)
    rows = [(float(p), name, float(w)) for p in penalties for name, w in zip(["intercept", *features], solve(p))]
    return df.sparkSession.createDataFrame(rows, "penalty double, feature string, weight double")


def ridge_fold_scores(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Sequence[float] = RIDGE_GRID,
    fold: str = "fold",
    absolute: bool = False,
) -> DataFrame:
    """``(regParam, fold, rmse)`` for every penalty and fold from a single pass.

    The moments of each fold are enough for all fits and all held-out errors: the training side of a fold are the
    other folds merged.
    """
    found = moments(df, features, label, fold)
    rows = []
    for group, held in sorted(found.items()):
        others = [m for g, m in sorted(found.items()) if g != group]
        if others:
            solve = _solver(reduce(Moments.merged, others), absolute)
            rows += [(float(reg), group, float(np.sqrt(held.mean_square(solve(reg))))) for reg in grid]
    return df.sparkSession.createDataFrame(rows, "regParam double, fold int, rmse double")


def tune_ridge(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Sequence[float] = RIDGE_GRID,
    fold: str = "fold",
) -> tuple[PipelineModel, DataFrame]:
    """The model refitted with the best penalty, and ``(regParam, rmse)`` averaged over the folds."""
    scores = (
        ridge_fold_scores(df, features, label, grid, fold)
        .groupBy("regParam")
        .agg(F.avg("rmse").alias("rmse"))
        .orderBy("rmse", "regParam")
    )
    return fit_ridge(df, features, label, scores.first()["regParam"]), scores


def cross_validate_ridge(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Sequence[float] = RIDGE_GRID,
    fold: str = "fold",
    k: int = 5,
    parallelism: int = 4,
) -> tuple[PipelineModel, list[float]]:
    """The same search with Spark's own cross validator: one fit per penalty and fold."""
    stage = assembler(features)
    data = spread(stage.transform(df).select(label, "features", F.col(fold).cast("int").alias("fold")))
    estimator = _estimator(label)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=ParamGridBuilder().addGrid(estimator.regParam, list(grid)).build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    )
    try:
        result = search.fit(data)
    finally:
        data.unpersist()
    return PipelineModel([stage, result.bestModel]), list(result.avgMetrics)


def fold_ridge_nrmse(
    df: DataFrame, features: Sequence[str], label: str, reg: float, fold: str = "fold", absolute: bool = False
) -> DataFrame:
    """``(fold, nrmse)`` of ridge on each held-out fold, by that fold's label range."""
    complete = df.na.drop(subset=[*features, label])
    spreads = complete.groupBy(fold).agg((F.max(label) - F.min(label)).alias("spread"))
    scores = ridge_fold_scores(complete, features, label, [reg], fold, absolute)
    return scores.join(spreads, scores["fold"] == spreads[fold]).select(
        scores["fold"], F.try_divide(F.col("rmse"), F.col("spread")).alias("nrmse")
    )
