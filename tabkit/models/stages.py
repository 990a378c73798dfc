"""The network as stages of an ML pipeline, which can be saved and loaded like Spark's own."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from .mlp import MLPModel, MLPRegressor, Network


class _Columns(Params):
    features = Param(Params._dummy(), "features", "names of the input columns", TypeConverters.toListString)
    label = Param(Params._dummy(), "label", "name of the label column", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "name of the prediction column", TypeConverters.toString)
    kind = Param(Params._dummy(), "kind", "activation of the hidden units", TypeConverters.toString)

    def _put(self, values: dict):
        self._set(**{name: value for name, value in values.items() if value is not None})
        return self


class NetworkModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """A trained network. Its weights are parameters, so that they are written with the pipeline."""

    hidden = Param(Params._dummy(), "hidden", "weights into the hidden units, a row a feature, the bias last", TypeConverters.identity)
    outer = Param(Params._dummy(), "outer", "weights out of the hidden units, the bias last", TypeConverters.identity)

    def __init__(self):
        super().__init__()
        self._setDefault(output="prediction", kind="relu")

    @classmethod
    def of(cls, model: MLPModel, output: str = "prediction") -> NetworkModel:
        net = model.net
        return cls()._put(
            {"features": list(model.features), "label": model.label, "output": output, "kind": net.kind, "hidden": net.w1.tolist(), "outer": net.w2.tolist()}
        )

    @property
    def net(self) -> Network:
        return Network(np.array(self.getOrDefault("hidden")), np.array(self.getOrDefault("outer")), self.getOrDefault("kind"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = MLPModel(self.net, self.getOrDefault("features"), self.getOrDefault("label"))
        return model.transform(dataset, self.getOrDefault("output"))


class NetworkRegressor(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """``MLPRegressor`` with its settings as parameters."""

    key = Param(Params._dummy(), "key", "names of the columns that identify a row", TypeConverters.toListString)
    units = Param(Params._dummy(), "units", "hidden units", TypeConverters.toInt)
    batchRows = Param(Params._dummy(), "batchRows", "rows of a step, about", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", TypeConverters.toFloat)
    tolerance = Param(Params._dummy(), "tolerance", "change of the loss at which training ends", TypeConverters.toFloat)
    maxSteps = Param(Params._dummy(), "maxSteps", "steps at most", TypeConverters.toInt)
    checkEvery = Param(Params._dummy(), "checkEvery", "steps between looks at the loss", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the start weights and batches", TypeConverters.toInt)

    def __init__(self, features=None, label=None, key=None, **settings):
        super().__init__()
        self._setDefault(
            output="prediction", kind="relu", units=16, batchRows=10_000, rate=0.01, tolerance=1e-5, maxSteps=100_000, checkEvery=10, seed=42
        )
        self._put({"features": features, "label": label, "key": [key] if isinstance(key, str) else key, **settings})

    def _fit(self, dataset: DataFrame) -> NetworkModel:
        of = self.getOrDefault
        trainer = MLPRegressor(
            of("features"), of("label"), of("key"), kind=of("kind"), hidden=of("units"), batch_rows=of("batchRows"), rate=of("rate"),
            tolerance=of("tolerance"), max_steps=of("maxSteps"), check_every=of("checkEvery"), seed=of("seed"),
        )
        return NetworkModel.of(trainer.fit(dataset), of("output"))
