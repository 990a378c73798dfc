"""A first look at observations: profile, clean with the wider rules, compare models by fold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import ROW_KEY, with_row_key
from ..models.evaluate import fold_naive_nrmse
from ..models.linear import fold_ridge_nrmse
from ..operators import profiling
from ..operators.columns import cast_columns, conform, drop_columns, split_fields
from ..operators.features import observation_features
from ..operators.impute import GroupMeanImputer
from ..operators.quantiles import five_number
from ..operators.rules import EXPLORE_RULES, clean_observations, clean_target, error_counts
from ..operators.splits import Key, exact_split, folds
from ..session import written
from .observations import (
    FEATURES,
    GROUP_KEYS,
    IMPUTED,
    LABEL,
    PLACE_TYPES,
    RAW_COLUMNS,
    STANDARDISED,
)

# Packed fields of the wider table, and those that only serve the rules.
WIDE_ARITY = {"WND": 5, "CIG": 4, "VIS": 4, "DEW": 2, "TMP": 2, "SLP": 2}
WIDE_TYPES = {
    "WND_0": "int", "WND_3": "int", "CIG_0": "int", "VIS_0": "int", "DEW_0": "int", "TMP_0": "int",
    "SLP_0": "int",
}
RULE_ONLY = (
    "TMP_1", "CIG_2", "WND_1", "WND_4", "CIG_1", "VIS_1", "VIS_3", "DEW_1", "SLP_1", "WND_2", "CIG_0",
    "VIS_0", "SLP_0",
)
# Sentinels of missing values, and the wind types for which a direction is truly missing.
SENTINELS = {
    "LATITUDE": [99999], "LONGITUDE": [999999], "ELEVATION": [9999], "WND_0": [999], "WND_3": [9999],
    "CIG_0": [99999], "VIS_0": [999999], "DEW_0": [9999], "SLP_0": [99999],
}


def wide_fields(raw: DataFrame, key: Key) -> DataFrame:
    """Raw rows with every field the wider rules test."""
    names = [key] if isinstance(key, str) else list(key)
    kinds = dict(raw.dtypes)
    schema = {**{k: kinds[k] for k in names}, **{c: "string" for c in (*RAW_COLUMNS, "SLP")}}
    return split_fields(cast_columns(conform(raw, schema), PLACE_TYPES), WIDE_ARITY, types=WIDE_TYPES)


def missing_shares(fields: DataFrame) -> DataFrame:
    """Percent missing per column; a direction of 999 counts unless the wind is variable."""
    return profiling.missing_pct(fields, SENTINELS, {"WND_0": F.col("WND_2") != "V"})


@dataclass(frozen=True)
class Explored:
    errors: DataFrame  # rows breaking each rule, before they are dropped
    missing: DataFrame  # percent missing per column of the training rows
    train: DataFrame  # model features and label of the training rows
    test: DataFrame  # fields of the held-out rows


def explore_observations(raw: DataFrame, key: Key, test_fraction: float = 0.2) -> Explored:
    """Cleaned rows are written once; the split, the shares and the features read that table. The features are written too."""
    target = clean_target(wide_fields(raw, key))
    clean = written(with_row_key(clean_observations(target, EXPLORE_RULES), key))
    train, test = exact_split(clean, key, test_fraction)
    features = written(observation_features(drop_columns(train, RULE_ONLY)))
    imputer = GroupMeanImputer(GROUP_KEYS, IMPUTED).fit(features)
    scaler = imputer.imputed_scaler(STANDARDISED, ddof=0)
    return Explored(
        error_counts(target, EXPLORE_RULES),
        missing_shares(train),
        scaler.transform(imputer.transform(features)).drop("HOUR", "MONTH"),
        test,
    )


def compare_by_fold(
    train: DataFrame, key: Key = ROW_KEY, penalty: float = 1.0, k: int = 5, features: Sequence[str] = FEATURES
) -> DataFrame:
    """``(model, fold, nrmse)`` of ridge with an absolute penalty and of the mean, each on every held-out fold.

    The rows are written once, and so are the few scores, as every reader of either would work out ``train`` again.
    """
    marked = written(folds(train, key, k).select("fold", *features, LABEL))
    naive = fold_naive_nrmse(marked, LABEL).select(F.lit("naive").alias("model"), "fold", "nrmse")
    ridge = fold_ridge_nrmse(marked, features, LABEL, penalty, absolute=True).select(
        F.lit("ridge").alias("model"), "fold", "nrmse"
    )
    return written(ridge.unionByName(naive))


def fold_spread(scores: DataFrame) -> DataFrame:
    """Five-number summary of the fold scores of each model."""
    return five_number(scores, "nrmse", by=["model"])
