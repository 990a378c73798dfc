"""Rules at, below and above every bound, and with every tested column missing."""

import pytest

from tabkit.operators import rules

GOOD = {
    "id": "good", "TMP_0": 100, "TMP_1": "1", "WND_0": 90, "WND_1": "1", "WND_3": 30, "WND_4": "1",
    "CIG_3": "N", "VIS_2": "N", "VIS_3": "1", "DEW_0": 50, "CIG_0": 22000, "CIG_1": "1", "VIS_0": 16000,
    "VIS_1": "1", "DEW_1": "1", "SLP_0": 10000, "SLP_1": "1",
}
SCHEMA = ", ".join(f"{c} {'int' if isinstance(v, int) else 'string'}" for c, v in GOOD.items())

# (column, value, kept)
PIPELINE = [
    ("TMP_0", -932, False), ("TMP_0", -931, True), ("TMP_0", 617, True), ("TMP_0", 618, False),
    ("TMP_1", "2", False), ("TMP_1", "3", False), ("TMP_1", "6", False), ("TMP_1", "7", False),
    ("TMP_1", "9", True),
    ("WND_0", -1, False), ("WND_0", 0, True), ("WND_0", 360, True), ("WND_0", 361, False),
    ("WND_0", 999, True), ("WND_1", "3", False), ("WND_1", "7", False),
    ("WND_3", -1, False), ("WND_3", 0, True), ("WND_3", 900, True), ("WND_3", 901, False),
    ("WND_3", 9999, True), ("WND_4", "3", False), ("WND_4", "7", False),
    ("CIG_3", "Y", True), ("CIG_3", "9", True), ("CIG_3", "X", False),
    ("VIS_2", "V", True), ("VIS_2", "9", True), ("VIS_2", "Y", False), ("VIS_3", "7", False),
    ("DEW_0", -932, False), ("DEW_0", -931, True), ("DEW_0", 367, True), ("DEW_0", 368, False),
    ("DEW_0", 9999, True),
]
EXPLORE = [
    ("WND_0", 0, False), ("WND_0", 1, True), ("WND_0", 361, False), ("WND_0", 999, True),
    ("CIG_0", -1, False), ("CIG_0", 22000, True), ("CIG_0", 22001, False), ("CIG_0", 99999, True),
    ("CIG_1", "3", False), ("VIS_0", 160000, True), ("VIS_0", 160001, False), ("VIS_0", 999999, True),
    ("VIS_1", "7", False), ("VIS_2", "V", False), ("VIS_2", "Y", True),
    ("DEW_0", -983, False), ("DEW_0", -982, True), ("DEW_0", 368, True), ("DEW_0", 369, False),
    ("DEW_1", "3", False), ("SLP_0", 8599, False), ("SLP_0", 8600, True), ("SLP_0", 10900, True),
    ("SLP_0", 10901, False), ("SLP_0", 99999, True), ("SLP_1", "7", False),
]


def frame(spark, cases):
    rows = [tuple(GOOD.values())]
    for column, value, _ in cases:
        row = {**GOOD, column: value, "id": f"{column}={value}"}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize(
    "cases, chosen", [(PIPELINE, rules.OBSERVATION_RULES), (EXPLORE, rules.EXPLORE_RULES)]
)
def test_bounds(spark, cases, chosen):
    kept = {r.id for r in rules.clean_observations(frame(spark, cases), chosen).collect()}
    assert kept == {"good"} | {f"{c}={v}" for c, v, ok in cases if ok}


def test_a_missing_tested_value_drops_the_row(spark):
    tested = {r.column for r in rules.OBSERVATION_RULES}
    df = frame(spark, [(c, None, c not in tested) for c in GOOD if c != "id"])
    kept = {r.id for r in rules.clean_observations(df).collect()}
    assert kept == {"good"} | {f"{c}=None" for c in GOOD if c != "id" and c not in tested}


def test_filter_is_idempotent(spark):
    once = rules.clean_observations(frame(spark, EXPLORE), rules.EXPLORE_RULES)
    assert rules.clean_observations(once, rules.EXPLORE_RULES).count() == once.count()


def test_error_counts(spark):
    counts = {r.rule: r.rows for r in rules.error_counts(frame(spark, PIPELINE), rules.OBSERVATION_RULES).collect()}
    assert counts["any"] == sum(not ok for _, _, ok in PIPELINE)
    for column in counts.keys() - {"any", "undecided"}:
        assert counts[column] == sum(not ok for c, _, ok in PIPELINE if c == column)


def test_error_counts_close(spark):
    df = spark.createDataFrame([(-950, "1"), (None, "1"), (None, "2"), (5, None), (700, "1"), (5, "1")], "TMP_0 int, TMP_1 string")
    several = (*rules.TARGET_RULES, rules.Range("TMP_0", at_most=-900))
    counts = {r.rule: r.rows for r in rules.error_counts(df, several).collect()}
    assert counts == {"any": 3, "undecided": 2, "TMP_0": 2, "TMP_1": 1, "TMP_0 Range 2": 1}
    assert counts["any"] + counts["undecided"] + rules.clean_observations(df, several).count() == 6


def test_trip_limits(spark):
    rows = [
        ("a", 10.0, 50.0, 10.0, 200.0), ("a", 10.5, 1.0, 1.0, 1.0), ("a", 1.0, 50.1, 1.0, 1.0),
        ("a", 1.0, 1.0, 10.5, 1.0), ("a", 1.0, 1.0, 1.0, 200.01), ("", 1.0, 1.0, 1.0, 1.0),
        (None, 1.0, 1.0, 1.0, 1.0), ("a", None, 1.0, 1.0, 1.0), ("a", -5.0, -1.0, -1.0, -300.0),
    ]
    names = ["t", "passenger_count", "trip_distance", "extra", "total_amount"]
    df = spark.createDataFrame(rows, "t string, " + ", ".join(f"{n} double" for n in names[1:]))
    kept = rules.clean_trips(df, names).collect()
    assert [tuple(r) for r in kept] == [rows[0], rows[-1]]
