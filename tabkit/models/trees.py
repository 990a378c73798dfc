"""Boosted-tree regression and its grid search on a sample: fitted by Spark, searched by ``boosting``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame

from ..operators.columns import assembler
from ..operators.splits import Key, folds, sample_fraction
from ..session import ensure_checkpoint_dir, spread
from .boosting import search

# The searched settings.
TREE_GRID = {
    "maxDepth": (2, 5, 10),
    "maxIter": (20, 100),
    "stepSize": (0.05, 0.1, 0.2),
    "subsamplingRate": (0.8, 1.0),
    "minInstancesPerNode": (2, 5),
}


def _estimator(label: str, seed: int, params: Mapping[str, float] | None = None) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol=label, seed=seed).setParams(**(params or {}))


def fit_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    params: Mapping[str, float] | None = None,
    seed: int = 42,
) -> PipelineModel:
    """Assembler and boosted trees. Rows are assembled and kept once, as every tree reads them.

    Every tenth tree the running residuals go to the checkpoint folder, so that
    a lost executor does not replay the whole ensemble.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stage = assembler(features)
    data = spread(stage.transform(df).select(label, "features"))
    try:
        model = _estimator(label, seed, params).fit(data)
    finally:
        data.unpersist()
    return PipelineModel([stage, model])


def fitted(model: PipelineModel) -> GBTRegressionModel:
    return model.stages[-1]


def tune_gbt(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    key: Key,
    grid: Mapping[str, Sequence[float]] = TREE_GRID,
    fraction: float = 0.01,
    k: int = 3,
    seed: int = 42,
) -> tuple[PipelineModel, list[tuple[dict[str, float], float]]]:
    """Search on a sample, refit on all rows.

    Returns the model refitted with the best setting, the first of equal ones, and ``(setting, rmse)``
    for every setting tried. The search gives the same scores on any number of cores.
    """
    sample = folds(sample_fraction(df, key, fraction, seed), key, k, seed)
    names = [key] if isinstance(key, str) else list(key)
    tried = search(sample, features, label, names, grid, k, seed=seed)
    best = min(tried, key=lambda pair: pair[1])[0]
    return fit_gbt(df, features, label, best, seed), tried
