"""Quality filters, missing values, counts, quantiles and thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import profiling, quantiles, rules
from ..operators.scale import scaler_stats
from ..plans.exploration import missing_shares
from ..plans.observations import LABEL, cleaned_observations, feature_table
from ..plans.trips import TRIP_COLUMNS, typed_trips
from .fixtures import OBS_KEY, obs, timed_trips, trips
from .oracle import TARGET_SQL, WIDE_SQL, using
from .registry import query, r6, rounded
from .tables import wide_fields

TAILS = ["passenger_count", "trip_distance", "extra", "total_amount"]
CHUNK_ORDERS = 2500  # orders per chunk of trips


@query("clean_trips", using("good_trips", body="SELECT * FROM good_trips"))
def clean_trips(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean_trips(timed_trips(spark, folder), TRIP_COLUMNS)


@query(
    "clean_observations",
    using("clean", body="SELECT obs_id, WND_0, WND_3, CIG_3, VIS_2, DEW_0, TMP_0 FROM clean"),
)
def clean_observations(spark: SparkSession, folder: str) -> DataFrame:
    return cleaned_observations(obs(spark, folder), OBS_KEY).select(
        "obs_id", "WND_0", "WND_3", "CIG_3", "VIS_2", "DEW_0", "TMP_0"
    )


@query(
    "clean_target",
    using("fields", body=f"SELECT obs_id, TMP_0, TMP_1 FROM fields WHERE {TARGET_SQL}"),
)
def clean_target(spark: SparkSession, folder: str) -> DataFrame:
    return rules.clean_target(wide_fields(spark, folder)).select("obs_id", "TMP_0", "TMP_1")


@query(
    "clean_observations_wide",
    using(
        "fields",
        body=f"""
SELECT obs_id, WND_0, WND_3, CIG_0, VIS_0, DEW_0, SLP_0, TMP_0 FROM fields
WHERE {TARGET_SQL} AND {WIDE_SQL}""",
    ),
)
def clean_observations_wide(spark: SparkSession, folder: str) -> DataFrame:
    target = rules.clean_target(wide_fields(spark, folder))
    return rules.clean_observations(target, rules.EXPLORE_RULES).select(
        "obs_id", "WND_0", "WND_3", "CIG_0", "VIS_0", "DEW_0", "SLP_0", "TMP_0"
    )


@query(
    "error_counts",
    using(
        "fields",
        body=f"""
, t AS (SELECT * FROM fields WHERE {TARGET_SQL})
SELECT 'any' AS rule, count(*) FILTER (NOT ({WIDE_SQL})) AS rows FROM t
UNION ALL SELECT 'undecided', count(*) FILTER (({WIDE_SQL}) IS NULL) FROM t
UNION ALL SELECT 'WND_0', count(*) FILTER (WND_0 < 1 OR (WND_0 > 360 AND WND_0 <> 999)) FROM t
UNION ALL SELECT 'WND_1', count(*) FILTER (WND_1 IN ('3', '7')) FROM t
UNION ALL SELECT 'WND_3', count(*) FILTER (WND_3 < 0 OR (WND_3 > 900 AND WND_3 <> 9999)) FROM t
UNION ALL SELECT 'WND_4', count(*) FILTER (WND_4 IN ('3', '7')) FROM t
UNION ALL SELECT 'CIG_0', count(*) FILTER (CIG_0 < 0 OR (CIG_0 > 22000 AND CIG_0 <> 99999)) FROM t
UNION ALL SELECT 'CIG_1', count(*) FILTER (CIG_1 IN ('3', '7')) FROM t
UNION ALL SELECT 'CIG_3', count(*) FILTER (CIG_3 NOT IN ('N', 'Y', '9')) FROM t
UNION ALL SELECT 'VIS_0', count(*) FILTER (VIS_0 < 0 OR (VIS_0 > 160000 AND VIS_0 <> 999999)) FROM t
UNION ALL SELECT 'VIS_1', count(*) FILTER (VIS_1 IN ('3', '7')) FROM t
UNION ALL SELECT 'VIS_2', count(*) FILTER (VIS_2 NOT IN ('N', 'Y', '9')) FROM t
UNION ALL SELECT 'VIS_3', count(*) FILTER (VIS_3 IN ('3', '7')) FROM t
UNION ALL SELECT 'DEW_0', count(*) FILTER (DEW_0 < -982 OR (DEW_0 > 368 AND DEW_0 <> 9999)) FROM t
UNION ALL SELECT 'DEW_1', count(*) FILTER (DEW_1 IN ('3', '7')) FROM t
UNION ALL SELECT 'SLP_0', count(*) FILTER (SLP_0 < 8600 OR (SLP_0 > 10900 AND SLP_0 <> 99999)) FROM t
UNION ALL SELECT 'SLP_1', count(*) FILTER (SLP_1 IN ('3', '7')) FROM t""",
    ),
)
def error_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rules.error_counts(rules.clean_target(wide_fields(spark, folder)), rules.EXPLORE_RULES)


@query(
    "error_counts_target",
    using(
        "fields",
        body="""
SELECT 'any' AS rule, count(*) FILTER (TMP_0 < -932 OR TMP_0 > 618 OR TMP_0 <= -900 OR TMP_1 IN ('2', '3', '6', '7')) AS rows FROM fields
UNION ALL SELECT 'undecided', count(*) FILTER ((TMP_0 < -932 OR TMP_0 > 618 OR TMP_0 <= -900 OR TMP_1 IN ('2', '3', '6', '7')) IS NULL) FROM fields
UNION ALL SELECT 'TMP_0', count(*) FILTER (TMP_0 < -932 OR TMP_0 > 618) FROM fields
UNION ALL SELECT 'TMP_1', count(*) FILTER (TMP_1 IN ('2', '3', '6', '7')) FROM fields
UNION ALL SELECT 'TMP_0 Range 2', count(*) FILTER (TMP_0 <= -900) FROM fields""",
    ),
)
def error_counts_target(spark: SparkSession, folder: str) -> DataFrame:
    several = (*rules.TARGET_RULES, rules.Range("TMP_0", at_most=-900))
    return rules.error_counts(wide_fields(spark, folder), several)


OBS_COLUMNS = (
    "obs_id", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "WND", "CIG", "VIS", "DEW", "TMP", "SLP",
    "GA1", "SOURCE",
)


@query(
    "sparse_columns",
    using(
        "obs",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) > 0.5 AS dropped FROM obs"
            for c in OBS_COLUMNS
        ),
    ),
)
def sparse_columns(spark: SparkSession, folder: str) -> DataFrame:
    shares = profiling.missing_fractions(obs(spark, folder))
    pairs = [F.struct(F.lit(c).alias("column"), (F.col(c) > 0.5).alias("dropped")) for c in shares.columns]
    return shares.select(F.inline(F.array(*pairs)))


@query("drop_sparse_columns", using("obs", body="SELECT * EXCLUDE (GA1) FROM obs"))
def drop_sparse_columns(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.drop_sparse_columns(obs(spark, folder), 0.5)


@query(
    "null_counts",
    using(
        "obs",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM obs"
            for c in OBS_COLUMNS
        ),
    ),
)
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.null_counts(obs(spark, folder))


def _missing_sql(tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r6(f'100 * avg(CASE WHEN {t} THEN 1 ELSE 0 END)')} AS missing_pct FROM fields"
        for c, t in tests.items()
    )


@query(
    "missing_pct",
    using(
        "fields",
        body=_missing_sql(
            {
                "GA1_0": "GA1_0 IS NULL OR GA1_0 IN ('99')",
                "GA1_2": "GA1_2 IS NULL OR GA1_2 IN ('+99999')",
                "GA1_4": "GA1_4 IS NULL OR GA1_4 IN ('99')",
            }
        ),
    ),
)
def missing_pct(spark: SparkSession, folder: str) -> DataFrame:
    sentinels = {"GA1_0": ["99"], "GA1_2": ["+99999"], "GA1_4": ["99"]}
    return rounded(profiling.missing_pct(wide_fields(spark, folder), sentinels))


@query(
    "missing_pct_guarded",
    using(
        "fields",
        body=_missing_sql(
            {
                "LATITUDE": "LATITUDE IS NULL OR LATITUDE = 99999",
                "LONGITUDE": "LONGITUDE IS NULL OR LONGITUDE = 999999",
                "ELEVATION": "ELEVATION IS NULL OR ELEVATION = 9999",
                "WND_0": "WND_0 IS NULL OR (WND_0 = 999 AND WND_2 <> 'V')",
                "WND_3": "WND_3 IS NULL OR WND_3 = 9999",
                "CIG_0": "CIG_0 IS NULL OR CIG_0 = 99999",
                "VIS_0": "VIS_0 IS NULL OR VIS_0 = 999999",
                "DEW_0": "DEW_0 IS NULL OR DEW_0 = 9999",
                "SLP_0": "SLP_0 IS NULL OR SLP_0 = 99999",
            }
        ),
    ),
)
def missing_pct_guarded(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(missing_shares(wide_fields(spark, folder)))


@query("value_counts", using("obs", body="SELECT SOURCE, count(*) AS rows FROM obs GROUP BY SOURCE"))
def value_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.value_counts(obs(spark, folder), "SOURCE")


@query(
    "label_range",
    using(
        "clean",
        body="""
SELECT min(TMP_0) AS label_min, max(TMP_0) AS label_max, max(TMP_0) - min(TMP_0) AS label_range
FROM clean""",
    ),
)
def label_range(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.label_range(cleaned_observations(obs(spark, folder), OBS_KEY), LABEL)


def _chunked(spark: SparkSession, folder: str) -> DataFrame:
    chunk = F.floor(F.col("l_orderkey") / CHUNK_ORDERS)
    return quantiles.chunk_quantiles(trips(spark, folder), TAILS, 0.999, chunk)


_TAILS_SQL = ", ".join(f"{r6(c)} AS {c}" for c in TAILS)


@query("chunk_quantiles", using("chunked", body=f"SELECT chunk, {_TAILS_SQL} FROM chunked"))
def chunk_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_chunked(spark, folder))


@query("max_quantiles", using("limits", body=f"SELECT {_TAILS_SQL} FROM limits"))
def max_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.max_quantiles(_chunked(spark, folder), TAILS))


@query(
    "global_quantiles",
    using(
        "trips",
        body="SELECT " + ", ".join(f"{r6(f'quantile_cont({c}, 0.999)')} AS {c}" for c in TAILS) + " FROM trips",
    ),
)
def global_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(quantiles.global_quantiles(trips(spark, folder), TAILS, 0.999))


def _exceeding(spark: SparkSession, folder: str) -> DataFrame:
    limits = quantiles.max_quantiles(_chunked(spark, folder), TAILS).first().asDict()
    return profiling.exceeding_rows(trips(spark, folder).select("l_orderkey", "l_linenumber", *TAILS), limits)


_OVER = " OR ".join(f"t.{c} > m.{c}" for c in TAILS)
_NAMES = "concat_ws(',', " + ", ".join(f"CASE WHEN t.{c} > m.{c} THEN '{c}' END" for c in TAILS) + ")"
_T = ", ".join(f"t.{c}" for c in ("l_orderkey", "l_linenumber", *TAILS))


@query("exceeding_rows", using("limits", body=f"SELECT {_T} FROM trips t, limits m WHERE {_OVER}"))
def exceeding_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _exceeding(spark, folder).drop("columns_exceeding")


@query(
    "exceeding_columns",
    using(
        "limits",
        body=f"SELECT t.l_orderkey, t.l_linenumber, {_NAMES} AS columns_exceeding FROM trips t, limits m WHERE {_OVER}",
    ),
)
def exceeding_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _exceeding(spark, folder).select(
        "l_orderkey", "l_linenumber", F.array_join("columns_exceeding", ",").alias("columns_exceeding")
    )


STAT_COLUMNS = ["LATITUDE", "LONGITUDE", "ELEVATION", "TMP_0", "HOUR"]


@query(
    "scaler_stats",
    using(
        "feats",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r6(f'avg({c})')} AS mean, {r6(f'stddev_samp({c})')} AS sd "
            "FROM feats WHERE split = 'train'"
            for c in STAT_COLUMNS
        ),
    ),
)
def scaler_stats_sample(spark: SparkSession, folder: str) -> DataFrame:
    train = feature_table(obs(spark, folder), OBS_KEY).filter(F.col("split") == "train")
    return rounded(scaler_stats(train, STAT_COLUMNS, ddof=1))


@query(
    "scaler_stats_pop",
    using(
        "typed_trips",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {r6(f'avg({c})')} AS mean, {r6(f'stddev_pop({c})')} AS sd FROM typed_trips"
            for c in TRIP_COLUMNS[2:]
        ),
    ),
)
def scaler_stats_pop(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(scaler_stats(typed_trips(timed_trips(spark, folder)), TRIP_COLUMNS[2:], ddof=0))
