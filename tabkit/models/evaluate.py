"""Metrics, the naive baseline, residual samples and model reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..operators.splits import Key, sample_n

# Fixed value: the smallest magnitude a percentage error is divided by.
MAPE_FLOOR = 2.22e-16

METRICS = ("rmse", "mae", "r2", "nrmse", "mape")


def regression_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()
) -> DataFrame:
    """Row count, RMSE, MAE, R2, NRMSE (by the label range) and MAPE in one aggregate."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    error = y - p
    pairs = df.filter(y.isNotNull() & p.isNotNull())
    sse, n = F.sum(error * error), F.count(F.lit(1))
    rmse = F.sqrt(F.avg(error * error))
    total = F.var_pop(y) * n
    return pairs.groupBy(*by).agg(
        n.alias("rows"),
        rmse.alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(sse, total)).alias("r2"),
        F.try_divide(rmse, F.max(y) - F.min(y)).alias("nrmse"),
        F.avg(F.abs(error) / F.greatest(F.abs(y), F.lit(MAPE_FLOOR))).alias("mape"),
    )


def naive_mean(train: DataFrame, label: str) -> float | None:
    return train.agg(F.avg(label)).first()[0]


def naive_predictions(df: DataFrame, mean: float | None) -> DataFrame:
    """The training mean as the prediction for every row."""
    return df.withColumn("prediction", F.lit(mean).cast("double"))


def fold_naive_nrmse(df: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """``(fold, rows, nrmse)`` of predicting the mean of the other folds.

    Everything follows from the moments per fold: the squared error around any
    constant is the fold's variance plus the squared distance of its mean.
    """
    y = F.col(label).cast("double")
    per_fold = df.groupBy(fold).agg(
        F.count(y).alias("rows"),
        F.sum(y).alias("total"),
        F.avg(y).alias("mean"),
        F.var_pop(y).alias("variance"),
        (F.max(y) - F.min(y)).alias("spread"),
    )
    everything = Window.partitionBy(F.lit(0))  # as many rows as there are folds
    others = F.try_divide(
        F.sum("total").over(everything) - F.col("total"),
        F.sum("rows").over(everything) - F.col("rows"),
    )
    rmse = F.sqrt(F.col("variance") + F.pow(F.col("mean") - others, 2))
    return per_fold.select(fold, "rows", F.try_divide(rmse, F.col("spread")).alias("nrmse"))


def residuals(
    df: DataFrame, key: Key, label: str, prediction: str, n: int = 1000, seed: int = 42
) -> DataFrame:
    """Key, actual, predicted and residual for a fixed-size sample of rows."""
    names = [key] if isinstance(key, str) else list(key)
    sample = sample_n(df.select(*names, label, prediction), key, n, seed)
    return sample.withColumn("residual", F.col(label) - F.col(prediction))


def ranking(spark: SparkSession, names: Sequence[str], weights: Sequence[float], magnitude: bool) -> DataFrame:
    """``(feature, weight)`` by decreasing weight, or by decreasing absolute weight."""
    df = spark.createDataFrame(
        [(name, float(w)) for name, w in zip(names, weights)], "feature string, weight double"
    )
    size: Column = F.abs("weight") if magnitude else F.col("weight")
    return df.orderBy(size.desc(), F.col("feature"))


def coefficient_ranking(model, names: Sequence[str]) -> DataFrame:
    spark = SparkSession.active()
    return ranking(spark, names, model.coefficients.toArray(), magnitude=True)


def importance_ranking(model, names: Sequence[str]) -> DataFrame:
    spark = SparkSession.active()
    return ranking(spark, names, model.featureImportances.toArray(), magnitude=False)


def model_report(model, names: Sequence[str]) -> DataFrame:
    """``(parameter, value)``: chosen parameters and the size or coefficients of a fitted stage."""
    if hasattr(model, "coefficients"):
        rows = [("regParam", model.getRegParam()), ("intercept", model.intercept)]
        rows += [(f"coefficient {n}", c) for n, c in zip(names, model.coefficients.toArray())]
    else:
        rows = [
            ("maxDepth", model.getMaxDepth()),
            ("maxIter", model.getMaxIter()),
            ("stepSize", model.getStepSize()),
            ("subsamplingRate", model.getSubsamplingRate()),
            ("minInstancesPerNode", model.getMinInstancesPerNode()),
            ("numTrees", model.getNumTrees),
            ("totalNodes", model.totalNumNodes),
        ]
    return SparkSession.active().createDataFrame(
        [(name, float(value)) for name, value in rows], "parameter string, value double"
    )
