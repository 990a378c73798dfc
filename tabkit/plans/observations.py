"""Weather observations: packed CSV text to standardised training and test rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from ..functions.hashing import with_row_key
from ..operators.columns import cast_columns, conform, split_fields
from ..operators.features import observation_features
from ..operators.impute import GroupMeanImputer, GroupMeanModel
from ..operators.rules import OBSERVATION_RULES, Rule, clean_observations
from ..operators.scale import ScalerModel
from ..operators.splits import split_tag
from ..session import written

# The input columns, their packed fields and types, and the model columns.
RAW_COLUMNS = ("DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "WND", "CIG", "VIS", "DEW", "TMP")
ARITY = {"WND": 5, "CIG": 4, "VIS": 4, "DEW": 2, "TMP": 2}
USED_FIELDS = (
    "WND_0", "WND_1", "WND_3", "WND_4", "CIG_3", "VIS_2", "VIS_3", "DEW_0", "TMP_0", "TMP_1",
)
PLACE_TYPES = {"LATITUDE": "double", "LONGITUDE": "double", "ELEVATION": "double"}
FIELD_TYPES = {"WND_0": "int", "WND_3": "int", "DEW_0": "int", "TMP_0": "int"}
QUALITY_FLAGS = ("TMP_1", "WND_1", "WND_4", "VIS_3")
GROUP_KEYS = ("LONGITUDE", "LATITUDE", "ELEVATION", "MONTH")
IMPUTED = {"WND_3": 9999, "DEW_0": 9999}
STANDARDISED = ("LATITUDE", "LONGITUDE", "ELEVATION", "WND_3", "DEW_0")
LABEL = "TMP_0"
FEATURES = (
    "LONGITUDE", "LATITUDE", "ELEVATION", "WND_3", "DEW_0", "CIG_3_Y", "CIG_3_9", "VIS_2_V",
    "VIS_2_9", "WND_0_UNDETERMINED", "HOUR_SIN", "HOUR_COS", "MONTH_SIN", "MONTH_COS",
    "WND_0_SIN", "WND_0_COS",
)


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def observation_fields(raw: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Raw rows conformed, split into the used fields and cast. ``key`` columns are carried along."""
    kinds = dict(raw.dtypes)
    carried = {k: kinds[k] for k in _names(key) if k not in RAW_COLUMNS}
    flat = conform(raw, {**carried, **{c: "string" for c in RAW_COLUMNS}})
    return split_fields(cast_columns(flat, PLACE_TYPES), ARITY, keep=USED_FIELDS, types=FIELD_TYPES)


def cleaned_observations(
    raw: DataFrame, key: str | Sequence[str], rules: Sequence[Rule] = OBSERVATION_RULES
) -> DataFrame:
    """Rows that satisfy every rule, without the quality flags."""
    return clean_observations(observation_fields(raw, key), rules).drop(*QUALITY_FLAGS)


def feature_table(
    raw: DataFrame, key: str | Sequence[str], fraction: float = 0.7, seed: int = 42
) -> DataFrame:
    """Cleaned rows with model features and the ``split`` they belong to; no shuffle.

    ``key`` is hashed before any of its columns is dropped or scaled; ``row_key`` carries it from there on.
    """
    tagged = split_tag(cleaned_observations(raw, key), _names(key), fraction, seed)
    return observation_features(with_row_key(tagged, _names(key)))


@dataclass(frozen=True)
class Prepared:
    rows: DataFrame  # training and test rows, told apart by ``split``
    imputer: GroupMeanModel
    scaler: ScalerModel

    @property
    def train(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "train").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.rows.filter(F.col("split") == "test").drop("split")

    def kept(self) -> Prepared:
        """The same rows written once, for readers that pass over them often."""
        return replace(self, rows=written(self.rows))

    def write(self, path: str) -> None:
        """Both parts in one pass, as Parquet partitioned by ``split``."""
        self.rows.write.mode("overwrite").partitionBy("split").parquet(path)


def prepare_observations(
    raw: DataFrame, key: str | Sequence[str], fraction: float = 0.7, seed: int = 42
) -> Prepared:
    """Imputation and scaling learned from the training rows, applied to all rows.

    One pass over the training rows builds the group table, from which both the
    fill values and the scaler follow; the returned rows are a second pass.
    """
    table = feature_table(raw, key, fraction, seed)
    imputer = GroupMeanImputer(GROUP_KEYS, IMPUTED).fit(table.filter(F.col("split") == "train"))
    scaler = imputer.imputed_scaler(STANDARDISED)
    return Prepared(scaler.transform(imputer.transform(table)), imputer, scaler)
