"""Taxi trips: text columns to a trained network and its errors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.scalar import parse_us_timestamp
from ..models.mlp import MLPModel, MLPRegressor
from ..operators.columns import computed_once
from ..operators.rules import clean_trips
from ..operators.scale import Scaler, ScalerModel
from ..operators.splits import Key, hash_split
from ..session import written
from ..sources.reports import loss_history_frame, metrics_frame

# The used columns, the label last.
TRIP_COLUMNS = (
    "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "PULocationID", "DOLocationID", "payment_type", "extra", "total_amount",
)
TIME_COLUMNS = TRIP_COLUMNS[:2]
FEATURES = TRIP_COLUMNS[:-1]
LABEL = TRIP_COLUMNS[-1]


def typed_trips(raw: DataFrame) -> DataFrame:
    """Cleaned trips with the times as epoch seconds and every other used column a double.

    Text is parsed first, once a row, and the parsed values are tested, so a time or number that cannot be read drops
    its row. Limits on columns that are numbers already still reach a Parquet scan.
    """
    kinds = dict(raw.dtypes)
    parsed = {c: parse_us_timestamp(F.col(c)).cast("double") for c in TIME_COLUMNS if kinds[c] == "string"}
    parsed |= {c: F.col(c).try_cast("double") for c in TRIP_COLUMNS if c not in TIME_COLUMNS and kinds[c] == "string"}
    if parsed:
        columns = [value.alias(c) for c, value in parsed.items()]
        raw = computed_once(raw, columns, [c for c in raw.columns if c not in parsed])
    return clean_trips(raw, TRIP_COLUMNS)


@dataclass(frozen=True)
class TripRun:
    model: MLPModel
    scaler: ScalerModel
    train_rmse: float
    test_rmse: float

    def history(self, spark: SparkSession) -> DataFrame:
        """``(step, loss)`` for every checked step."""
        return loss_history_frame(spark, self.model.losses)

    def report(self, spark: SparkSession) -> DataFrame:
        """RMSE of both parts, the final loss, step count and training time."""
        losses = self.model.losses
        return metrics_frame(
            spark,
            [
                ("network", "train", "rmse", self.train_rmse),
                ("network", "test", "rmse", self.test_rmse),
                ("network", "train", "loss", losses[-1][1] if losses else None),
                ("network", "train", "steps", losses[-1][0] if losses else 0),
                ("network", "train", "seconds", self.model.seconds),
            ],
        )


def train_trips(raw: DataFrame, key: Key, fraction: float = 0.7, seed: int = 42, **network) -> TripRun:
    """Clean, split, normalise with training statistics (population sd), train, evaluate.

    The cleaned rows are written once; every later pass reads numbers, not text.
    """
    keys = [key] if isinstance(key, str) else list(key)
    columns = dict.fromkeys([*keys, *TRIP_COLUMNS])
    train, test = hash_split(written(typed_trips(raw).select(*columns)), key, fraction, seed)
    scaler = Scaler(FEATURES, ddof=0).fit(train)
    train, test = scaler.transform(train), scaler.transform(test)
    model = MLPRegressor(FEATURES, LABEL, key, seed=seed, **network).fit(train)
    return TripRun(model, scaler, model.rmse(train), model.rmse(test))
