"""Run reports as small tables, and fitted models on disk."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

METRICS_SCHEMA = "model string, split string, metric string, value double"


def metrics_frame(spark: SparkSession, rows: Iterable[tuple[str, str, str, float]]) -> DataFrame:
    """Metrics already known to the driver (a few per model) as a frame."""
    return spark.createDataFrame(
        [(m, s, k, None if v is None else float(v)) for m, s, k, v in rows], METRICS_SCHEMA
    )


def metrics_long(wide: DataFrame, model: str, split: str) -> DataFrame:
    """One row of metric columns turned into ``(model, split, metric, value)`` rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in wide.columns]
    )
    return wide.select(F.lit(model).alias("model"), F.lit(split).alias("split"), F.inline(pairs))


def loss_history_frame(spark: SparkSession, losses: Iterable[tuple[int, float]]) -> DataFrame:
    return spark.createDataFrame([(int(s), float(v)) for s, v in losses], "step int, loss double")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_model(model: PipelineModel, path: str) -> None:
    """The whole pipeline, so the feature list travels with the model; a network is a stage of it (``models.stages``)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
