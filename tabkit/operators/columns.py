"""Column-level preparation: conform, cast, split, assemble, profile, unite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns of ``schema``, in its order; absent ones become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(name) if name in present else F.lit(None)).cast(kind).alias(name)
            for name, kind in schema.items()
        ]
    )


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without ``names``; names that do not occur are ignored."""
    return df.drop(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Named columns cast in place; text that does not parse becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def field_arity(df: DataFrame, columns: Sequence[str], delimiter: str = ",") -> DataFrame:
    """One row: the largest field count of each packed column."""
    return df.agg(*[F.max(F.size(F.split(c, delimiter))).alias(c) for c in columns])


def computed_once(df: DataFrame, columns: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """``keep`` and the new ``columns``, each worked out once per row.

    A later filter on an ordinary computed column is rewritten in terms of its
    inputs and repeats the work for every comparison. Columns of a generated
    row stay as they are.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*columns))))


def split_fields(
    df: DataFrame,
    arity: Mapping[str, int] | Sequence[str],
    delimiter: str = ",",
    keep: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Packed text columns replaced by ``col_0 ... col_{k-1}``; short rows give NULL.

    A mapping declares the field counts. A plain list of columns takes the
    largest count found in the data, which costs one pass. ``keep`` limits the
    fields that are produced, ``types`` casts some of them on the way, with
    NULL for text that does not parse.

    Later filters read the fields; the text is split once, not per comparison.
    """
    if not isinstance(arity, Mapping):
        counts = field_arity(df, list(arity), delimiter).first()
        arity = {c: counts[c] or 0 for c in arity}
    types = types or {}

    def field(column: str, i: int) -> Column:
        value = F.get(F.col(column), F.lit(i))
        name = f"{column}_{i}"
        return (value.try_cast(types[name]) if name in types else value).alias(name)

    parts = df.select(
        *[F.split(c, delimiter).alias(c) if c in arity else F.col(c) for c in df.columns]
    )
    fields = [
        field(c, i)
        for c, k in arity.items()
        for i in range(k)
        if keep is None or f"{c}_{i}" in keep
    ]
    others = [c for c in df.columns if c not in arity]
    return computed_once(parts, fields, others) if fields else df.select(*others)


def with_bias(df: DataFrame, name: str = "bias") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def features_label(
    df: DataFrame, label: str | Sequence[str], drop: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Two projections of the same rows: all features, and the label column or columns."""
    labels = [label] if isinstance(label, str) else list(label)
    out = {*labels, *drop}
    return df.select(*[c for c in df.columns if c not in out]), df.select(*labels)


def feature_names(df: DataFrame, label: str, drop: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c != label and c not in drop]


def assembler(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def assemble(df: DataFrame, label: str, drop: Sequence[str] = ()) -> DataFrame:
    """Label and feature vector; rows with a missing feature are skipped."""
    return assembler(feature_names(df, label, drop)).transform(df).select(label, "features")


def profile(df: DataFrame) -> DataFrame:
    """``(column, type, position, rows)`` per column: the schema and the shape in one frame."""
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("column"), F.lit(kind).alias("type"), F.lit(i).alias("position")
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(entries), "rows")


def union_outer(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
