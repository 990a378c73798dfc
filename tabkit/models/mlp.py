"""A one-hidden-layer regression network trained by mini-batch gradient descent.

Rows stay in Spark; the two small weight matrices travel with the task closure.
One job per step returns the summed batch gradient, and on checked steps the
squared error of all rows as well.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import HASH_DIGITS, HASH_SPACE, hash_number
from ..functions.scalar import activation
from ..operators.splits import Key
from .partials import as_matrix, summed

ACTIVATIONS = ("relu", "sigmoid", "tanh")


def _activate(z: np.ndarray, kind: str) -> np.ndarray:
    if kind == "relu":
        return np.maximum(z, 0.0)
    if kind == "sigmoid":
        return 0.5 * (1.0 + np.tanh(0.5 * z))  # the logistic function without overflow
    if kind == "tanh":
        return np.tanh(z)
    raise ValueError(f"unknown activation {kind!r}")


def _slope(z: np.ndarray, a: np.ndarray, kind: str) -> np.ndarray:
    if kind == "relu":
        return (z > 0.0).astype(np.float64)
    return a * (1.0 - a) if kind == "sigmoid" else 1.0 - a * a


def init_weights(features: int, hidden: int = 16, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Uniform(-0.1, 0.1) starts of shapes (features + 1, hidden) and (hidden + 1, 1)."""
    rng = np.random.default_rng(seed)
    return rng.uniform(-0.1, 0.1, (features + 1, hidden)), rng.uniform(-0.1, 0.1, (hidden + 1, 1))


@dataclass(frozen=True)
class Network:
    """Weights and activation; the last row of each matrix holds the bias."""

    w1: np.ndarray
    w2: np.ndarray
    kind: str = "relu"

    def __post_init__(self):
        if self.kind not in ACTIVATIONS:
            raise ValueError(f"unknown activation {self.kind!r}")

    @property
    def size(self) -> int:
        return self.w1.size + self.w2.size

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = x @ self.w1[:-1] + self.w1[-1]
        return z, _activate(z, self.kind)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x)[1] @ self.w2[:-1, 0] + self.w2[-1, 0]

    def gradient_sum(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Gradient of half the squared error, summed over rows, both matrices in one array."""
        z, a = self.hidden(x)
        error = a @ self.w2[:-1, 0] + self.w2[-1, 0] - y
        back = np.outer(error, self.w2[:-1, 0]) * _slope(z, a, self.kind)
        g1 = np.vstack([x.T @ back, back.sum(axis=0)])
        g2 = np.append(a.T @ error, error.sum())
        return np.concatenate([g1.ravel(), g2])

    def moved(self, gradient: np.ndarray, rate: float) -> Network:
        cut = self.w1.size
        return Network(
            self.w1 - rate * gradient[:cut].reshape(self.w1.shape),
            self.w2 - rate * gradient[cut:].reshape(self.w2.shape),
            self.kind,
        )


def packed(df: DataFrame, features: Sequence[str], label: str, *extra: Column) -> DataFrame:
    """``x`` as one double array and ``y``; rows with a missing value are left out."""
    complete = df.na.drop(subset=[*features, label])
    return complete.select(
        F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        F.col(label).cast("double").alias("y"),
        *extra,
    )


def _xy(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    return as_matrix(batch.column("x"), width), batch.column("y").to_numpy(zero_copy_only=False)


def sse(data: DataFrame, net: Network) -> tuple[float, float]:
    """Squared error and row count over a packed frame."""
    width = net.w1.shape[0] - 1

    def part(batch):
        x, y = _xy(batch, width)
        error = net.predict(x) - y
        yield 0, np.array([error @ error, len(y)])

    total = summed(data, 2, part).get(0, np.zeros(2))
    return float(total[0]), float(total[1])


def rmse(data: DataFrame, net: Network) -> float:
    squares, rows = sse(data, net)
    return float(np.sqrt(squares / rows)) if rows else float("nan")


def gradient(data: DataFrame, net: Network) -> np.ndarray:
    """Mean gradient over all rows of a packed frame."""
    width = net.w1.shape[0] - 1

    def part(batch):
        x, y = _xy(batch, width)
        yield 0, np.append(net.gradient_sum(x, y), len(y))

    total = summed(data, net.size + 1, part).get(0, np.zeros(net.size + 1))
    return total[:-1] / max(total[-1], 1.0)


def _step(data: DataFrame, net: Network, low: int, high: int, with_loss: bool):
    """Batch gradient sum and row count and, over all rows, squared error and row count."""
    width = net.w1.shape[0] - 1

    def in_batch(slot):
        return (slot >= low) & (slot < high) if low <= high else (slot >= low) | (slot < high)

    def part(batch):
        x, y = _xy(batch, width)
        mine = in_batch(batch.column("slot").to_numpy(zero_copy_only=False))
        found = np.append(net.gradient_sum(x[mine], y[mine]), [mine.sum(), 0.0, 0.0])
        if with_loss:
            error = net.predict(x) - y
            found[-2:] = error @ error, len(y)
        yield 0, found

    # Without a loss check only the batch rows leave the JVM.
    rows = data if with_loss else data.filter(in_batch(F.col("slot")))
    return summed(rows, net.size + 3, part).get(0, np.zeros(net.size + 3))


@dataclass
class MLPModel:
    net: Network
    features: Sequence[str]
    label: str
    losses: list[tuple[int, float]] = field(default_factory=list)
    seconds: float = 0.0
    converged: bool = False

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with the network's output, computed batch by batch in the tasks; NULL where a feature is missing."""
        net, width = self.net, len(self.features)
        values = [F.col(c).cast("double") for c in self.features]
        present = reduce(lambda a, b: a & b, [v.isNotNull() & ~F.isnan(v) for v in values])
        marked = df.withColumn("__x", F.array(*[F.coalesce(v, F.lit(0.0)) for v in values])).withColumn("__present", present)
        schema = ", ".join(f"`{n}` {t}" for n, t in [*df.dtypes, (output, "double")])

        def run(batches):
            for batch in batches:
                x, known = as_matrix(batch.column("__x"), width), batch.column("__present").to_numpy(zero_copy_only=False)
                out = pa.array(net.predict(x), pa.float64(), mask=~known)
                kept = [i for i, n in enumerate(batch.schema.names) if n not in ("__x", "__present")]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], out], names=[*[batch.schema.names[i] for i in kept], output])

        return marked.mapInArrow(run, schema)

    def rmse(self, df: DataFrame) -> float:
        return rmse(packed(df, self.features, self.label), self.net)


@dataclass(frozen=True)
class MLPRegressor:
    """Training stops when a checked loss moves by at most ``tolerance``, or at ``max_steps``.

    A step uses about ``batch_rows`` rows: each row has a fixed hash slot, and
    consecutive steps take consecutive slot ranges, so all rows are visited in
    turn. Rows are kept sorted by slot, so that a step skips the blocks outside its
    range; only a checked step reads all of them. The gradient is divided by the
    rows actually used. With ``start`` training goes on from these weights, and ``kind``,
    ``hidden`` and ``seed`` do not choose them.
    """

    features: Sequence[str]
    label: str
    key: Key
    kind: str = "relu"
    hidden: int = 16
    batch_rows: int = 10_000
    rate: float = 0.01
    tolerance: float = 1e-5
    max_steps: int = 100_000
    check_every: int = 10
    seed: int = 42
    start: Network | None = None

    def fit(self, df: DataFrame) -> MLPModel:
        """``df`` is packed, laid out by slot and persisted once; lost blocks are recomputed from ``df``."""
        slot = hash_number(self.key, "batch", self.seed, HASH_DIGITS).alias("slot")
        data = packed(df, self.features, self.label, slot)
        data = data.repartitionByRange("slot").sortWithinPartitions("slot").persist()
        try:
            return self._descend(data)
        finally:
            data.unpersist()

    def _descend(self, data: DataFrame) -> MLPModel:
        net = self.start or Network(*init_weights(len(self.features), self.hidden, self.seed), self.kind)
        started = time.monotonic()
        squares, rows = sse(data, net)
        if not rows:
            raise ValueError("no complete row to train on")
        losses: list[tuple[int, float]] = []
        previous, converged = 0.5 * squares / rows, False
        width = min(HASH_SPACE, max(1, round(HASH_SPACE * self.batch_rows / rows)))
        low, step, pending = 0, 0, False
        while step < self.max_steps:
            # The pass that computes this step's gradient also gives the loss
            # of the weights reached by the step before it.
            high = low + width
            if high > HASH_SPACE:
                high -= HASH_SPACE
            got = _step(data, net, low, high, pending)
            if pending:
                loss = float(0.5 * got[-2] / got[-1])
                losses.append((step, loss))
                if abs(previous - loss) <= self.tolerance:
                    converged = True
                    break
                if not np.isfinite(loss):
                    break  # the rate is too high; the history shows it
                previous = loss
            if got[-3]:
                net = net.moved(got[:-3] / got[-3], self.rate)
            low = high % HASH_SPACE
            step += 1
            pending = step % self.check_every == 0
        if pending and (not losses or losses[-1][0] < step):
            squares, rows = sse(data, net)
            loss = 0.5 * squares / rows
            losses.append((step, loss))
            converged = abs(previous - loss) <= self.tolerance
        return MLPModel(
            net, list(self.features), self.label, losses, time.monotonic() - started, converged
        )


def forward_columns(inputs: Sequence[Column], net: Network) -> Column:
    """The network's output as one expression, for small networks inside a larger query."""
    hidden = []
    for j in range(net.w1.shape[1]):
        z = F.lit(float(net.w1[-1, j]))
        for i, x in enumerate(inputs):
            z = z + x * F.lit(float(net.w1[i, j]))
        hidden.append(activation(z, net.kind))
    out = F.lit(float(net.w2[-1, 0]))
    for j, a in enumerate(hidden):
        out = out + a * F.lit(float(net.w2[j, 0]))
    return out

