"""Scans, projections, casts, splits of packed text, unions and scalar functions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalar
from ..operators import columns, features
from ..plans.exploration import WIDE_ARITY, WIDE_TYPES
from ..plans.observations import PLACE_TYPES, RAW_COLUMNS, cleaned_observations, observation_fields
from ..plans.trips import TRIP_COLUMNS
from ..sources.tables import first_rows
from .fixtures import OBS_KEY, obs, trips
from .oracle import using
from .registry import query, r6, rounded, rounded_rows

ALL_FIELDS = {**WIDE_ARITY, "GA1": 6}


def wide_fields(spark: SparkSession, folder: str) -> DataFrame:
    """All packed columns split, numbers cast."""
    placed = columns.cast_columns(obs(spark, folder), PLACE_TYPES)
    return columns.split_fields(placed, ALL_FIELDS, types=WIDE_TYPES)


@query(
    "scan_columns",
    using("trips", body=f"SELECT {', '.join(TRIP_COLUMNS)} FROM trips"),
)
def scan_columns(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select(*TRIP_COLUMNS)


@query(
    "first_rows",
    using("obs", body="SELECT obs_id, DATE, WND, TMP FROM obs ORDER BY obs_id LIMIT 1000"),
)
def first_thousand(spark: SparkSession, folder: str) -> DataFrame:
    return first_rows(obs(spark, folder).select("obs_id", "DATE", "WND", "TMP"), 1000, ["obs_id"])


@query(
    "conform_schema",
    using(
        "obs",
        body=f"SELECT obs_id, {', '.join(RAW_COLUMNS)}, CAST(NULL AS STRING) AS QUALITY_CONTROL FROM obs",
    ),
)
def conform_schema(spark: SparkSession, folder: str) -> DataFrame:
    schema = {"obs_id": "bigint", **{c: "string" for c in (*RAW_COLUMNS, "QUALITY_CONTROL")}}
    return columns.conform(obs(spark, folder), schema)


@query(
    "drop_columns",
    using("obs", body="SELECT obs_id, DATE, WND, CIG, VIS, DEW, TMP, SLP, GA1 FROM obs"),
)
def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    gone = ["SOURCE", "LATITUDE", "LONGITUDE", "ELEVATION", "REPORT_TYPE", "REM"]
    return columns.drop_columns(obs(spark, folder), gone)


@query(
    "cast_columns",
    using(
        "fields",
        body="SELECT obs_id, LATITUDE, LONGITUDE, ELEVATION, WND_0, WND_3, DEW_0, TMP_0 FROM fields",
    ),
)
def cast_columns(spark: SparkSession, folder: str) -> DataFrame:
    return observation_fields(obs(spark, folder), OBS_KEY).select(
        "obs_id", "LATITUDE", "LONGITUDE", "ELEVATION", "WND_0", "WND_3", "DEW_0", "TMP_0"
    )


@query(
    "coerce_cast",
    using(
        "fields",
        body="""
SELECT f.obs_id, TRY_CAST(f.CIG_3 AS INTEGER) AS ceiling_code, TRY_CAST(f.TMP_1 AS DOUBLE) AS flag,
  TRY_CAST(CASE WHEN f.WND_2 = 'V' THEN concat('on ', f.DATE) ELSE f.DATE END AS TIMESTAMP) AS observed
FROM fields f""",
    ),
)
def coerce_cast(spark: SparkSession, folder: str) -> DataFrame:
    marked = columns.split_fields(obs(spark, folder), {"CIG": 4, "TMP": 2, "WND": 5}).select(
        "obs_id",
        F.col("CIG_3").alias("ceiling_code"),
        F.col("TMP_1").alias("flag"),
        F.when(F.col("WND_2") == "V", F.concat(F.lit("on "), "DATE")).otherwise(F.col("DATE")).alias("observed"),
    )
    return columns.cast_columns(
        marked, {"ceiling_code": "int", "flag": "double", "observed": "timestamp_ntz"}
    )


def _split_sql(arity: dict[str, int]) -> str:
    return ", ".join(f"str_split({c}, ',')[{i + 1}] AS {c}_{i}" for c, k in arity.items() for i in range(k))


@query(
    "split_fields",
    using(
        "obs",
        body=f"SELECT obs_id, {_split_sql({'WND': 5, 'CIG': 4, 'VIS': 4, 'DEW': 2, 'TMP': 2})} FROM obs",
    ),
)
def split_fields(spark: SparkSession, folder: str) -> DataFrame:
    packed = obs(spark, folder).select("obs_id", "WND", "CIG", "VIS", "DEW", "TMP")
    return columns.split_fields(packed, {"WND": 5, "CIG": 4, "VIS": 4, "DEW": 2, "TMP": 2})


@query(
    "split_fields_max",
    using("obs", body=f"SELECT obs_id, {_split_sql({'TMP': 2, 'SLP': 2, 'GA1': 6})} FROM obs"),
)
def split_fields_max(spark: SparkSession, folder: str) -> DataFrame:
    packed = obs(spark, folder).select("obs_id", "TMP", "SLP", "GA1")
    return columns.split_fields(packed, ["TMP", "SLP", "GA1"])


@query(
    "field_arity",
    using(
        "obs",
        body="SELECT "
        + ", ".join(f"CAST(max(len(str_split({c}, ','))) AS INTEGER) AS {c}" for c in ALL_FIELDS)
        + " FROM obs",
    ),
)
def field_arity(spark: SparkSession, folder: str) -> DataFrame:
    return columns.field_arity(obs(spark, folder), list(ALL_FIELDS))


@query(
    "assemble_complete_rows",
    using(
        "fields",
        body=f"""
SELECT count(*) AS complete_rows, {r6('sum(CAST(TMP_0 AS DOUBLE))')} AS label_sum,
  {r6('sum(CAST(NULLIF(WND_3, 9999) AS DOUBLE))')} AS wind_sum,
  {r6('sum(CAST(NULLIF(SLP_0, 99999) AS DOUBLE))')} AS pressure_sum,
  {r6('sum(CAST(TRY_CAST(GA1_2 AS INTEGER) AS DOUBLE))')} AS rain_sum
FROM fields
WHERE NULLIF(WND_3, 9999) IS NOT NULL AND NULLIF(SLP_0, 99999) IS NOT NULL
  AND TRY_CAST(GA1_2 AS INTEGER) IS NOT NULL""",
    ),
)
def assemble_complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    df = wide_fields(spark, folder).select(
        "TMP_0",
        scalar.sentinel_to_null(F.col("WND_3"), 9999).alias("WND_3"),
        scalar.sentinel_to_null(F.col("SLP_0"), 99999).alias("SLP_0"),
        F.col("GA1_2").try_cast("int").alias("GA1_2"),
    )
    parts = vector_to_array("features")
    return rounded(
        columns.assemble(df, "TMP_0").agg(
            F.count(F.lit(1)).alias("complete_rows"),
            F.sum(F.col("TMP_0").cast("double")).alias("label_sum"),
            F.sum(parts[0]).alias("wind_sum"),
            F.sum(parts[1]).alias("pressure_sum"),
            F.sum(parts[2]).alias("rain_sum"),
        )
    )


@query(
    "profile_shape",
    using(
        "obs",
        body="""
SELECT v.c AS "column", v.t AS type, v.p AS position, n.n AS rows
FROM (VALUES ('obs_id', 'bigint', 0), ('DATE', 'string', 1), ('LATITUDE', 'string', 2),
  ('LONGITUDE', 'string', 3), ('ELEVATION', 'string', 4), ('WND', 'string', 5), ('CIG', 'string', 6),
  ('VIS', 'string', 7), ('DEW', 'string', 8), ('TMP', 'string', 9), ('SLP', 'string', 10),
  ('GA1', 'string', 11), ('SOURCE', 'string', 12)) v(c, t, p), (SELECT count(*) AS n FROM obs) n""",
    ),
)
def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    return columns.profile(obs(spark, folder))


@query(
    "union_outer",
    using(
        "obs",
        body="""
SELECT obs_id, DATE, TMP, SLP, CAST(NULL AS STRING) AS GA1 FROM obs WHERE SOURCE IS NULL
UNION ALL SELECT obs_id, DATE, TMP, NULL, GA1 FROM obs WHERE SOURCE IS NOT NULL""",
    ),
)
def union_outer(spark: SparkSession, folder: str) -> DataFrame:
    df = obs(spark, folder)
    return columns.union_outer(
        [
            df.filter(F.col("SOURCE").isNull()).select("obs_id", "DATE", "TMP", "SLP"),
            df.filter(F.col("SOURCE").isNotNull()).select("GA1", "TMP", "obs_id", "DATE"),
        ]
    )


@query(
    "parse_us_timestamp",
    using(
        "trips",
        body="""
SELECT l_orderkey, l_linenumber,
  CAST(epoch(strptime(tpep_pickup_datetime, '%m/%d/%Y %I:%M:%S %p')) AS BIGINT) AS pickup,
  CAST(epoch(strptime(tpep_dropoff_datetime, '%m/%d/%Y %I:%M:%S %p')) AS BIGINT) AS dropoff
FROM trips""",
    ),
)
def parse_us_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    return trips(spark, folder).select(
        "l_orderkey",
        "l_linenumber",
        scalar.parse_us_timestamp(F.col("tpep_pickup_datetime")).alias("pickup"),
        scalar.parse_us_timestamp(F.col("tpep_dropoff_datetime")).alias("dropoff"),
    )


@query(
    "hour_month",
    using(
        "obs",
        body="""
SELECT obs_id, CAST(hour(CAST(DATE AS TIMESTAMP)) AS INTEGER) AS HOUR,
  CAST(month(CAST(DATE AS TIMESTAMP)) AS INTEGER) AS MONTH FROM obs""",
    ),
)
def hour_month(spark: SparkSession, folder: str) -> DataFrame:
    return features.hour_month(obs(spark, folder)).select("obs_id", "HOUR", "MONTH")


@query(
    "sentinel_to_null",
    using(
        "fields",
        body="""
SELECT obs_id, NULLIF(WND_3, 9999) AS WND_3, NULLIF(DEW_0, 9999) AS DEW_0, NULLIF(SLP_0, 99999) AS SLP_0,
  NULLIF(VIS_0, 999999) AS VIS_0 FROM fields""",
    ),
)
def sentinel_to_null(spark: SparkSession, folder: str) -> DataFrame:
    marks = {"WND_3": 9999, "DEW_0": 9999, "SLP_0": 99999, "VIS_0": 999999}
    return wide_fields(spark, folder).select(
        "obs_id", *[scalar.sentinel_to_null(F.col(c), s).alias(c) for c, s in marks.items()]
    )


@query(
    "activations",
    f"""
WITH x AS (SELECT event_id, (value - 40) / 20 AS x FROM events)
SELECT event_id, {r6('greatest(0.0, x)')} AS relu, {r6('1 / (1 + exp(-x))')} AS sigmoid,
  {r6('tanh(x)')} AS tanh, CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS relu_slope,
  {r6('(1 / (1 + exp(-x))) * (1 - 1 / (1 + exp(-x)))')} AS sigmoid_slope,
  {r6('1 - tanh(x) * tanh(x)')} AS tanh_slope
FROM x""",
)
def activations(spark: SparkSession, folder: str) -> DataFrame:
    events = spark.read.parquet(f"{folder}/events.parquet")
    x = (F.col("value") - 40) / 20
    kinds = ("relu", "sigmoid", "tanh")
    return rounded_rows(
        events.select(
            "event_id",
            *[scalar.activation(x, k).alias(k) for k in kinds],
            *[scalar.activation_slope(x, k).alias(f"{k}_slope") for k in kinds],
        )
    )


@query(
    "flag_features",
    using(
        "feats",
        body="SELECT obs_id, CIG_3_Y, CIG_3_9, VIS_2_V, VIS_2_9, WND_0_UNDETERMINED FROM feats",
    ),
)
def flag_features(spark: SparkSession, folder: str) -> DataFrame:
    df = cleaned_observations(obs(spark, folder), OBS_KEY)
    flagged = features.flags(df, {"CIG_3": ("Y", "9"), "VIS_2": ("V", "9")})
    return features.indicator(flagged, "WND_0", 999, "WND_0_UNDETERMINED").select(
        "obs_id", "CIG_3_Y", "CIG_3_9", "VIS_2_V", "VIS_2_9", "WND_0_UNDETERMINED"
    )


@query(
    "cyclic_features",
    using(
        "feats",
        body=f"""
SELECT obs_id, {r6('HOUR_SIN')} AS HOUR_SIN, {r6('HOUR_COS')} AS HOUR_COS,
  {r6('MONTH_SIN')} AS MONTH_SIN, {r6('MONTH_COS')} AS MONTH_COS FROM feats""",
    ),
)
def cyclic_features(spark: SparkSession, folder: str) -> DataFrame:
    df = features.hour_month(cleaned_observations(obs(spark, folder), OBS_KEY))
    turned = features.cyclic(features.cyclic(df, "HOUR", 24), "MONTH", 12)
    return rounded_rows(turned.select("obs_id", "HOUR_SIN", "HOUR_COS", "MONTH_SIN", "MONTH_COS"))


@query(
    "cyclic_direction",
    using(
        "feats",
        body=f"SELECT obs_id, {r6('WND_0_SIN')} AS WND_0_SIN, {r6('WND_0_COS')} AS WND_0_COS FROM feats",
    ),
)
def cyclic_direction(spark: SparkSession, folder: str) -> DataFrame:
    df = features.cyclic_direction(cleaned_observations(obs(spark, folder), OBS_KEY), "WND_0")
    return rounded_rows(df.select("obs_id", "WND_0_SIN", "WND_0_COS"))
