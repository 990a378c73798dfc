"""Ridge and boosted trees on prepared observations, tuned, refitted and compared."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..functions.hashing import ROW_KEY
from ..models.evaluate import (
    METRICS,
    coefficient_ranking,
    importance_ranking,
    model_report,
    naive_mean,
    naive_predictions,
    regression_metrics,
    residuals as residual_sample,
)
from ..models.linear import RIDGE_GRID, tune_ridge
from ..models.trees import TREE_GRID, tune_gbt
from ..operators.columns import union_outer
from ..operators.splits import Key, folds
from ..sources.reports import metrics_long, save_model, write_json
from .observations import FEATURES, LABEL


def split_metrics(train: DataFrame, test: DataFrame, model: str, label: str = LABEL) -> DataFrame:
    """``(model, split, metric, value)`` of predictions on both parts."""
    return union_outer(
        [
            metrics_long(
                regression_metrics(part, label, "prediction").select(*METRICS), model, name
            )
            for name, part in (("train", train), ("test", test))
        ]
    )


def naive_report(train: DataFrame, test: DataFrame, label: str = LABEL) -> DataFrame:
    mean = naive_mean(train, label)
    return split_metrics(naive_predictions(train, mean), naive_predictions(test, mean), "naive", label)


@dataclass(frozen=True)
class ModelRun:
    model: PipelineModel
    metrics: DataFrame
    ranking: DataFrame
    report: DataFrame
    residuals: DataFrame  # label, prediction and residual of a sample of the test rows
    scores: list  # what the search found: per penalty of ridge, per setting of the trees

    def write(self, path: str) -> None:
        """The fitted pipeline and, as JSON, its metrics, ranking and parameters."""
        save_model(self.model, f"{path}/model")
        for name in ("metrics", "ranking", "report", "residuals"):
            write_json(getattr(self, name), f"{path}/{name}")


def run_ridge(
    train: DataFrame,
    test: DataFrame,
    key: Key = ROW_KEY,
    features: Sequence[str] = FEATURES,
    grid: Sequence[float] = RIDGE_GRID,
    k: int = 5,
) -> ModelRun:
    model, scores = tune_ridge(folds(train, key, k), features, LABEL, grid)
    return ModelRun(
        model,
        split_metrics(model.transform(train), model.transform(test), "ridge"),
        coefficient_ranking(model.stages[-1], features),
        model_report(model.stages[-1], features),
        residual_sample(model.transform(test), key, LABEL, "prediction"),
        list(zip(grid, scores)),
    )


def run_gbt(
    train: DataFrame,
    test: DataFrame,
    key: Key = ROW_KEY,
    features: Sequence[str] = FEATURES,
    grid: Mapping[str, Sequence[float]] = TREE_GRID,
    fraction: float = 0.01,
    k: int = 3,
) -> ModelRun:
    model, scores = tune_gbt(train, features, LABEL, key, grid, fraction, k)
    return ModelRun(
        model,
        split_metrics(model.transform(train), model.transform(test), "gbt"),
        importance_ranking(model.stages[-1], features),
        model_report(model.stages[-1], features),
        residual_sample(model.transform(test), key, LABEL, "prediction"),
        scores,
    )
