"""Row hashes that mean the same in any partitioning and in any SQL engine.

Splits, samples and folds are decided per row from ``md5(purpose-seed:key)``.
The purpose keeps them independent of one another: a fold of a split, or a
sample of a split, is not correlated with the split itself. ``key`` must
identify a row; rows sharing a key always fall on the same side. In the text of a key every value carries its
length and NULL has a mark of its own, so that different keys have different texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

HASH_DIGITS = 8  # leading hex digits used where a hash is compared or turned into a number
HASH_SPACE = 16**HASH_DIGITS


# The name of the column that carries a row's key once its columns are gone.
ROW_KEY = "row_key"


def _part(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def with_row_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """``df`` with the hash of ``key`` as ``row_key``, for steps that come after the key's columns are dropped."""
    return df.withColumn(ROW_KEY, row_hash(key, "row"))


def row_hash(key: str | list[str], purpose: str, seed: int = 42) -> Column:
    """The 32 hex digits for a row."""
    names = [key] if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{purpose}-{seed}:"), *map(_part, names)))


def hash_prefix(key: str | list[str], purpose: str, seed: int = 42) -> Column:
    return F.substring(row_hash(key, purpose, seed), 1, HASH_DIGITS)


def fraction_bound(fraction: float) -> str:
    """The hash prefix below which ``fraction`` of all prefixes lie."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie in [0, 1]")
    if fraction == 1.0:
        return "g"  # sorts after every hex digit
    return format(int(fraction * HASH_SPACE), f"0{HASH_DIGITS}x")


def hash_number(key: str | list[str], purpose: str, seed: int = 42, digits: int = 4) -> Column:
    """The leading ``digits`` (at most 8) hex digits as a number."""
    return F.conv(F.substring(row_hash(key, purpose, seed), 1, digits), 16, 10).cast("bigint")
