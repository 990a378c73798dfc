"""Column expressions: parsing, calendar parts, cyclic encodings, activations."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

US_TIMESTAMP = "MM/dd/yyyy hh:mm:ss a"


def parse_us_timestamp(text: Column) -> Column:
    """Epoch seconds of ``MM/dd/yyyy hh:mm:ss AM|PM`` text read as UTC; NULL if unparsable.

    The offset is part of what is parsed, so the session zone plays no part and the text is read once.
    """
    return F.unix_seconds(F.try_to_timestamp(F.concat(text, F.lit(" Z")), F.lit(US_TIMESTAMP + " X")))


def iso_timestamp(text: Column) -> Column:
    """ISO text to a timestamp without time zone, so the session zone cannot shift the hour."""
    return text.try_cast("timestamp_ntz")


def sentinel_to_null(value: Column, *sentinels) -> Column:
    return F.when(~value.isin(*sentinels), value)


def cyclic_pair(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of ``value`` on a circle of length ``period``."""
    angle = value * F.lit(2 * math.pi / period)
    return F.sin(angle), F.cos(angle)


def direction_pair(degrees: Column, sentinel: float) -> tuple[Column, Column]:
    """Sine and cosine of a direction in degrees; the sentinel lies at the origin (0, 0)."""
    angle = F.radians(degrees)
    undetermined = degrees == F.lit(sentinel)
    return (
        F.when(undetermined, F.lit(0.0)).otherwise(F.sin(angle)),
        F.when(undetermined, F.lit(0.0)).otherwise(F.cos(angle)),
    )


def activation(x: Column, kind: str) -> Column:
    if kind == "relu":
        return F.greatest(F.lit(0.0), x)
    if kind == "sigmoid":
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))
    if kind == "tanh":
        return F.tanh(x)
    raise ValueError(f"unknown activation {kind!r}")


def activation_slope(x: Column, kind: str) -> Column:
    """Derivative of ``activation``; the ReLU slope at zero is 0."""
    if kind == "relu":
        return F.when(x > 0, F.lit(1.0)).otherwise(F.lit(0.0))
    y = activation(x, kind)
    return y * (F.lit(1.0) - y) if kind == "sigmoid" else F.lit(1.0) - y * y
