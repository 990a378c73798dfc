"""Reproducible splits, samples and folds, decided per row from a hash of its key."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import fraction_bound, hash_number, hash_prefix, row_hash
from .columns import computed_once

Key = str | list[str]

KEY_DIGITS = 32  # of the digest of a key; that of its ties has as many
LEVEL_DIGITS = 4  # one counting level distinguishes 16**4 hash buckets


def in_fraction(key: Key, fraction: float, purpose: str, seed: int = 42) -> Column:
    return hash_prefix(key, purpose, seed) < fraction_bound(fraction)


def split_tag(df: DataFrame, key: Key, fraction: float = 0.7, seed: int = 42) -> DataFrame:
    """``df`` with a column ``split`` holding ``train`` or ``test``."""
    side = F.when(in_fraction(key, fraction, "split", seed), "train").otherwise("test")
    return df.withColumn("split", side)


def hash_split(
    df: DataFrame, key: Key, fraction: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Each row goes to the first part with probability ``fraction``; two narrow filters."""
    first = in_fraction(key, fraction, "split", seed)
    return df.filter(first), df.filter(~first)


def sample_fraction(df: DataFrame, key: Key, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, without replacement."""
    return df.filter(in_fraction(key, fraction, "sample", seed))


def _order(df: DataFrame, key: Key, ties: Key | None, purpose: str, seed: int, digits: int) -> Column:
    """At least the first ``digits`` of the digest that rows are taken by: of the key, then of ``ties`` (all columns), for rows that share a key."""
    first = row_hash(key, purpose, seed)
    return first if digits <= KEY_DIGITS else F.concat(first, row_hash(df.columns if ties is None else ties, "ties", seed))


def _cut(hashed: Callable[[int], DataFrame], wanted) -> tuple[str, int, int]:
    """``(prefix, taken, held)``: to take exactly ``wanted(total)`` rows by digest, take all rows below
    ``prefix`` and ``taken`` of the ``held`` rows that begin with it.

    ``hashed(digits)`` has so many digits of each row's digest as ``h``. Rows are counted per leading hex digits, at most
    65,536 counts a level, and only the bucket holding the cut is looked at further, so no task and no driver ever ranks
    the table. A bucket that is taken whole ends the search; so do all digits, when the rows left are equal in key and ties.
    """
    prefix, left = "", None
    while True:
        at = len(prefix) + 1
        held = hashed(len(prefix) + LEVEL_DIGITS)
        inside = held.filter(F.col("h").startswith(prefix)) if prefix else held
        bucket = F.substring("h", at, LEVEL_DIGITS).alias("b")
        counts = sorted((row.b, row.n) for row in inside.groupBy(bucket).agg(F.count("*").alias("n")).collect())
        if left is None:
            left = wanted(sum(n for _, n in counts))
            if left <= 0:
                return "", 0, 0
        for digits, n in counts:
            if left <= n:
                break
            left -= n
        else:
            return "g", 0, 0  # more rows wanted than exist: all of them
        prefix += digits
        if left == n or len(prefix) == 2 * KEY_DIGITS:
            return prefix, left, n


def _parted(df: DataFrame, key: Key, ties: Key | None, purpose: str, seed: int, wanted) -> tuple[DataFrame, DataFrame]:
    """The first ``wanted(total)`` rows by digest, and the others.

    Rows of the same key and ties that the cut runs through are told apart by nothing: with the default
    ties they are equal, and the counted number of them is made from one. The digest of the ties is worked out only where
    that of the key does not decide, and each digest once a row.
    """

    def hashed(digits: int, keep: Sequence[str] = ()) -> DataFrame:
        return computed_once(df, [_order(df, key, ties, purpose, seed, digits).alias("__h" if keep else "h")], keep)

    prefix, taken, held = _cut(hashed, wanted)
    rows = hashed(len(prefix), df.columns)
    order = F.col("__h")
    below, above = order < prefix, order >= prefix

    def where(test: Column) -> DataFrame:
        return rows.filter(test).drop("__h")

    if not held:
        return where(below), where(above)
    at = order.startswith(prefix)
    if taken == held:
        return where(below | at), where(above & ~at)

    def copies(n: int) -> DataFrame:
        counted = where(at).limit(1).withColumn("__copy", F.explode(F.sequence(F.lit(1), F.lit(n))))
        return counted.drop("__copy")

    return where(below).unionByName(copies(taken)), where(above & ~at).unionByName(copies(held - taken))


def exact_split(
    df: DataFrame, key: Key, test_fraction: float = 0.2, seed: int = 42, ties: Key | None = None
) -> tuple[DataFrame, DataFrame]:
    """Train and test parts of exact size: the test part has ``ceil(test_fraction * rows)`` rows.

    Rows that share a key are told apart by ``ties``, all columns by default; together with the key, named ties must
    identify a row up to equal rows. A few counting passes fix the cut; the parts are narrow filters.
    """
    return _parted(df, key, ties, "exact", seed, lambda total: total - math.ceil(test_fraction * total))


def sample_n(df: DataFrame, key: Key, n: int, seed: int = 42, ties: Key | None = None) -> DataFrame:
    """Exactly ``n`` rows without replacement, or all rows if there are fewer; ``ties`` as in ``exact_split``."""
    return _parted(df, key, ties, "rows", seed, lambda total: n)[0]


def folds(df: DataFrame, key: Key, k: int, seed: int = 42) -> DataFrame:
    """``df`` with a column ``fold`` from 0 to k - 1."""
    return df.withColumn("fold", F.pmod(hash_number(key, "fold", seed), F.lit(k)).cast("int"))
