"""Quality rules as data, folded into one filter.

Every rule says when a row is erroneous. A rule on a NULL value is undecided,
and, as in SQL, a row is kept only when every rule is decidedly satisfied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Range:
    """A number outside its limits, unless it is the sentinel for a missing value."""

    column: str
    below: float | None = None  # erroneous when value < below
    above: float | None = None  # erroneous when value > above
    at_most: float | None = None  # erroneous when value <= at_most
    at_least: float | None = None  # erroneous when value >= at_least
    sentinel: float | None = None

    def broken(self) -> Column:
        value = F.col(self.column)
        low = [value < self.below] if self.below is not None else []
        low += [value <= self.at_most] if self.at_most is not None else []
        high = [value > self.above] if self.above is not None else []
        high += [value >= self.at_least] if self.at_least is not None else []
        if self.sentinel is not None:
            high = [test & (value != self.sentinel) for test in high]
        return reduce(or_, low + high)


@dataclass(frozen=True)
class BadCodes:
    """A flag carrying one of the codes that mark suspect or erroneous data."""

    column: str
    codes: tuple[str, ...]

    def broken(self) -> Column:
        return F.col(self.column).isin(*self.codes)


@dataclass(frozen=True)
class AllowedCodes:
    """A code outside its domain."""

    column: str
    codes: tuple[str, ...]

    def broken(self) -> Column:
        return ~F.col(self.column).isin(*self.codes)


Rule = Range | BadCodes | AllowedCodes

# The limits and codes below decide which rows count as valid.
TARGET_RULES = (
    Range("TMP_0", below=-932, above=618),
    BadCodes("TMP_1", ("2", "3", "6", "7")),
)
OBSERVATION_RULES = (
    Range("TMP_0", at_most=-932, at_least=618),
    BadCodes("TMP_1", ("2", "3", "6", "7")),
    Range("WND_0", below=0, above=360, sentinel=999),
    BadCodes("WND_1", ("3", "7")),
    Range("WND_3", below=0, above=900, sentinel=9999),
    BadCodes("WND_4", ("3", "7")),
    AllowedCodes("CIG_3", ("N", "Y", "9")),
    AllowedCodes("VIS_2", ("N", "V", "9")),
    BadCodes("VIS_3", ("3", "7")),
    Range("DEW_0", at_most=-932, at_least=368, sentinel=9999),
)
EXPLORE_RULES = (
    Range("WND_0", below=1, above=360, sentinel=999),
    BadCodes("WND_1", ("3", "7")),
    Range("WND_3", below=0, above=900, sentinel=9999),
    BadCodes("WND_4", ("3", "7")),
    Range("CIG_0", below=0, above=22000, sentinel=99999),
    BadCodes("CIG_1", ("3", "7")),
    AllowedCodes("CIG_3", ("N", "Y", "9")),
    Range("VIS_0", below=0, above=160000, sentinel=999999),
    BadCodes("VIS_1", ("3", "7")),
    AllowedCodes("VIS_2", ("N", "Y", "9")),
    BadCodes("VIS_3", ("3", "7")),
    Range("DEW_0", below=-982, above=368, sentinel=9999),
    BadCodes("DEW_1", ("3", "7")),
    Range("SLP_0", below=8600, above=10900, sentinel=99999),
    BadCodes("SLP_1", ("3", "7")),
)
TRIP_LIMITS = {
    "passenger_count": 10.0,
    "trip_distance": 50.0,
    "extra": 10.0,
    "total_amount": 200.0,
}


def broken_mask(rules: Sequence[Rule]) -> Column:
    return reduce(or_, [rule.broken() for rule in rules])


def clean_observations(df: DataFrame, rules: Sequence[Rule] = OBSERVATION_RULES) -> DataFrame:
    """Rows on which every rule holds; one narrow filter."""
    return df.filter(~broken_mask(rules))


def clean_target(df: DataFrame) -> DataFrame:
    """Rows with a temperature inside its range and an unsuspicious flag."""
    return clean_observations(df, TARGET_RULES)


def rule_names(rules: Sequence[Rule]) -> list[str]:
    """The column of each rule; from the second rule of a column on, with the rule's kind and number."""
    names: list[str] = []
    for k, rule in enumerate(rules):
        names.append(rule.column if rule.column not in names else f"{rule.column} {type(rule).__name__} {k}")
    return names


def error_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, rows)`` in one pass: erroneous rows per rule and, as ``any``, by all rules.

    ``undecided`` counts rows that break no rule but that some rule cannot decide, as its value is NULL; the filter
    drops them too, so that kept rows, ``any`` and ``undecided`` are all rows. Rules are named by ``rule_names``.
    """
    mask = broken_mask(rules)
    tests = {"any": F.coalesce(mask, F.lit(False)), "undecided": mask.isNull()}
    named = [*tests.items(), *zip(rule_names(rules), [rule.broken() for rule in rules])]
    counts = df.agg(*[F.count_if(test).alias(f"c{k}") for k, (_, test) in enumerate(named)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"c{k}").alias("rows")) for k, (name, _) in enumerate(named)]
    return counts.select(F.inline(F.array(*pairs)))


def clean_trips(
    df: DataFrame, required: Sequence[str], limits: Mapping[str, float] = TRIP_LIMITS
) -> DataFrame:
    """Trips with all ``required`` values present and none above its upper limit.

    Empty text counts as missing. Values below zero stay.
    """
    kinds = dict(df.dtypes)
    tests = [
        F.col(c).isNotNull() & (F.col(c) != "") if kinds[c] == "string" else F.col(c).isNotNull()
        for c in required
    ]
    tests += [F.col(c) <= limit for c, limit in limits.items()]
    return df.filter(reduce(lambda a, b: a & b, tests))
