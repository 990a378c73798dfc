"""Imputation, scaling, splits, samples, folds and the whole preparation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import impute, splits
from ..operators.scale import Scaler
from ..plans import exploration, observations as plan
from ..plans.trips import FEATURES as TRIP_FEATURES, typed_trips
from .fixtures import OBS_KEY, TRIP_KEY, obs, timed_trips
from .oracle import OBS_ID, TRIP_ID, digest, hex4, key_text, using
from .registry import query, r6, rounded, rounded_rows

KEYS = plan.GROUP_KEYS


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return plan.feature_table(obs(spark, folder), OBS_KEY)


def _train(df: DataFrame) -> DataFrame:
    return df.filter(F.col("split") == "train")


@query(
    "group_means",
    using(
        "means",
        body=f"""
SELECT LONGITUDE, LATITUDE, ELEVATION, MONTH, {r6('WND_3_MEAN')} AS WND_3_MEAN,
  {r6('DEW_0_MEAN')} AS DEW_0_MEAN FROM means""",
    ),
)
def group_means(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(impute.group_means(_train(_features(spark, folder)), KEYS, plan.IMPUTED))


@query(
    "global_means",
    using("overall", body=f"SELECT {r6('WND_3_ALL')} AS WND_3_MEAN, {r6('DEW_0_ALL')} AS DEW_0_MEAN FROM overall"),
)
def global_means(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(impute.global_means(_train(_features(spark, folder)), plan.IMPUTED))


_IMPUTED_SQL = f"""
SELECT obs_id, LONGITUDE, LATITUDE, ELEVATION, MONTH, {r6('WND_3')} AS WND_3, {r6('DEW_0')} AS DEW_0
FROM imputed WHERE split = """


def _imputed(spark: SparkSession, folder: str, side: str) -> DataFrame:
    table = _features(spark, folder).select("obs_id", *KEYS, "WND_3", "DEW_0", "split")
    model = impute.GroupMeanImputer(KEYS, plan.IMPUTED).fit(_train(table))
    return rounded_rows(model.transform(table.filter(F.col("split") == side)).drop("split"))


@query("impute_train", using("imputed", body=_IMPUTED_SQL + "'train'"))
def impute_train(spark: SparkSession, folder: str) -> DataFrame:
    return _imputed(spark, folder, "train")


@query("impute_test", using("imputed", body=_IMPUTED_SQL + "'test'"))
def impute_test(spark: SparkSession, folder: str) -> DataFrame:
    return _imputed(spark, folder, "test")


@query(
    "impute_window",
    using(
        "feats",
        body=f"""
SELECT obs_id,
  {r6('coalesce(NULLIF(WND_3, 9999), avg(NULLIF(WND_3, 9999)) OVER g)')} AS WND_3,
  {r6('coalesce(NULLIF(DEW_0, 9999), avg(NULLIF(DEW_0, 9999)) OVER g)')} AS DEW_0
FROM feats WINDOW g AS (PARTITION BY LONGITUDE, LATITUDE, ELEVATION, MONTH)""",
    ),
)
def impute_window(spark: SparkSession, folder: str) -> DataFrame:
    table = _features(spark, folder).select("obs_id", *KEYS, "WND_3", "DEW_0")
    return rounded_rows(impute.impute_in_place(table, KEYS, plan.IMPUTED).select("obs_id", "WND_3", "DEW_0"))


@query(
    "standardise",
    using(
        "prepared",
        body="SELECT obs_id, split, " + ", ".join(f"{r6(c)} AS {c}" for c in plan.STANDARDISED) + " FROM prepared",
    ),
)
def standardise(spark: SparkSession, folder: str) -> DataFrame:
    table = _features(spark, folder).select("obs_id", "split", *KEYS, "WND_3", "DEW_0")
    imputer = impute.GroupMeanImputer(KEYS, plan.IMPUTED).fit(_train(table))
    scaler = imputer.imputed_scaler(plan.STANDARDISED, ddof=1)
    return rounded_rows(scaler.transform(imputer.transform(table)).select("obs_id", "split", *plan.STANDARDISED))


@query(
    "normalise_pop",
    using(
        "typed_trips",
        body=f"""
, tagged AS (SELECT *, CASE WHEN substr({digest('split', TRIP_ID)}, 1, 8) < 'b3333333'
    THEN 'train' ELSE 'test' END AS split FROM typed_trips),
s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in TRIP_FEATURES)}
  FROM tagged WHERE split = 'train')
SELECT l_orderkey, l_linenumber, split, {r6('total_amount')} AS total_amount,
  {', '.join(f"{r6(f'({c} - {c}_m) / {c}_s')} AS {c}" for c in TRIP_FEATURES)}
FROM tagged, s""",
    ),
)
def normalise_pop(spark: SparkSession, folder: str) -> DataFrame:
    tagged = splits.split_tag(typed_trips(timed_trips(spark, folder)), TRIP_KEY)
    scaler = Scaler(TRIP_FEATURES, ddof=0).fit(_train(tagged))
    kept = ("l_orderkey", "l_linenumber", "split", "total_amount", *TRIP_FEATURES)
    return rounded_rows(scaler.transform(tagged).select(*kept))


@query("hash_split", using("feats", body="SELECT obs_id, split FROM feats"))
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    clean = plan.cleaned_observations(obs(spark, folder), OBS_KEY)
    train, test = splits.hash_split(clean, OBS_KEY, 0.7)
    return (
        train.select("obs_id", F.lit("train").alias("split"))
        .unionByName(test.select("obs_id", F.lit("test").alias("split")))
    )


@query(
    "exact_split",
    using(
        "obs",
        body=f"""
, ranked AS (SELECT obs_id, row_number() OVER (ORDER BY {digest('exact', OBS_ID)}) AS r,
    count(*) OVER () AS n FROM obs)
SELECT obs_id, CASE WHEN r <= n - ceil(0.2 * n) THEN 'train' ELSE 'test' END AS split FROM ranked""",
    ),
)
def exact_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = splits.exact_split(obs(spark, folder).select("obs_id"), OBS_KEY, 0.2)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query(
    "sample_fraction",
    using(
        "obs",
        body=f"SELECT obs_id, TMP FROM obs WHERE substr({digest('sample', OBS_ID)}, 1, 8) < '19999999'",
    ),
)
def sample_fraction(spark: SparkSession, folder: str) -> DataFrame:
    return splits.sample_fraction(obs(spark, folder).select("obs_id", "TMP"), OBS_KEY, 0.1)


@query(
    "sample_n",
    using("obs", body=f"SELECT obs_id, TMP FROM obs ORDER BY {digest('rows', OBS_ID)} LIMIT 500"),
)
def sample_n(spark: SparkSession, folder: str) -> DataFrame:
    return splits.sample_n(obs(spark, folder).select("obs_id", "TMP"), OBS_KEY, 500)


# Keys that many rows share: the order goes on by the row's id.
_TIED = f"{digest('%s', key_text('LATITUDE', 'LONGITUDE'))}, {digest('ties', OBS_ID)}"


@query(
    "exact_split_ties",
    using(
        "obs",
        body=f"""
, ranked AS (SELECT obs_id, row_number() OVER (ORDER BY {_TIED % 'exact'}) AS r, count(*) OVER () AS n FROM obs)
SELECT obs_id, CASE WHEN r <= n - ceil(0.3 * n) THEN 'train' ELSE 'test' END AS split FROM ranked""",
    ),
)
def exact_split_ties(spark: SparkSession, folder: str) -> DataFrame:
    rows = obs(spark, folder).select("obs_id", "LATITUDE", "LONGITUDE")
    train, test = splits.exact_split(rows, ["LATITUDE", "LONGITUDE"], 0.3, ties=OBS_KEY)
    return train.select("obs_id", F.lit("train").alias("split")).unionByName(test.select("obs_id", F.lit("test").alias("split")))


@query(
    "sample_n_ties",
    using("obs", body=f"SELECT obs_id, LATITUDE, LONGITUDE FROM obs ORDER BY {_TIED % 'rows'} LIMIT 777"),
)
def sample_n_ties(spark: SparkSession, folder: str) -> DataFrame:
    rows = obs(spark, folder).select("obs_id", "LATITUDE", "LONGITUDE")
    return splits.sample_n(rows, ["LATITUDE", "LONGITUDE"], 777, ties=OBS_KEY)


@query(
    "kfold_counts",
    using(
        "obs",
        body=f"""
SELECT {hex4('h')} % 5 AS fold, count(*) AS rows
FROM (SELECT {digest('fold', OBS_ID)} AS h FROM obs) GROUP BY 1""",
    ),
)
def kfold_counts(spark: SparkSession, folder: str) -> DataFrame:
    marked = splits.folds(obs(spark, folder).select("obs_id"), OBS_KEY, 5)
    return marked.groupBy("fold").agg(F.count(F.lit(1)).alias("rows"))


_DOUBLES = ("HOUR_SIN", "HOUR_COS", "MONTH_SIN", "MONTH_COS", "WND_0_SIN", "WND_0_COS", *plan.STANDARDISED)


@query(
    "prepare_observations",
    using(
        "prepared",
        body="SELECT p.* REPLACE (" + ", ".join(f"{r6(c)} AS {c}" for c in _DOUBLES) + f"), {digest('row', OBS_ID)} AS row_key FROM prepared p",
    ),
)
def prepare_observations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_rows(plan.prepare_observations(obs(spark, folder), OBS_KEY).rows)


_EXPLORED = ("WND_3", "DEW_0", "LATITUDE", "LONGITUDE", "ELEVATION")


@query(
    "explore_observations",
    using(
        "wide_clean",
        body=f"""
, ranked AS (SELECT *, row_number() OVER (ORDER BY {digest('exact', OBS_ID)}) AS r, count(*) OVER () AS n
  FROM wide_clean),
f AS (SELECT *, hour(CAST(DATE AS TIMESTAMP)) AS h, month(CAST(DATE AS TIMESTAMP)) AS m
  FROM ranked WHERE r <= n - ceil(0.2 * n)),
g AS (SELECT LATITUDE, LONGITUDE, ELEVATION, m, avg(NULLIF(WND_3, 9999)) AS w, avg(NULLIF(DEW_0, 9999)) AS d
  FROM f GROUP BY ALL),
a AS (SELECT avg(NULLIF(WND_3, 9999)) AS wa, avg(NULLIF(DEW_0, 9999)) AS da FROM f),
i AS (SELECT f.* REPLACE (coalesce(CAST(NULLIF(WND_3, 9999) AS DOUBLE), w, wa) AS WND_3,
    coalesce(CAST(NULLIF(DEW_0, 9999) AS DOUBLE), d, da) AS DEW_0)
  FROM f LEFT JOIN g USING (LATITUDE, LONGITUDE, ELEVATION, m), a),
s AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in _EXPLORED)} FROM i)
SELECT obs_id, {digest('row', OBS_ID)} AS row_key, TMP_0, {', '.join(f"{r6(f'({c} - {c}_m) / {c}_s')} AS {c}" for c in _EXPLORED)},
  CASE WHEN CIG_3 = 'Y' THEN 1 ELSE 0 END AS CIG_3_Y, CASE WHEN CIG_3 = '9' THEN 1 ELSE 0 END AS CIG_3_9,
  CASE WHEN VIS_2 = 'V' THEN 1 ELSE 0 END AS VIS_2_V, CASE WHEN VIS_2 = '9' THEN 1 ELSE 0 END AS VIS_2_9,
  CASE WHEN WND_0 = 999 THEN 1 ELSE 0 END AS WND_0_UNDETERMINED,
  {r6('CASE WHEN WND_0 = 999 THEN 0.0 ELSE sin(WND_0 * pi() / 180) END')} AS WND_0_SIN,
  {r6('CASE WHEN WND_0 = 999 THEN 0.0 ELSE cos(WND_0 * pi() / 180) END')} AS WND_0_COS,
  {r6('sin(2 * pi() * h / 24)')} AS HOUR_SIN, {r6('cos(2 * pi() * h / 24)')} AS HOUR_COS,
  {r6('sin(2 * pi() * m / 12)')} AS MONTH_SIN, {r6('cos(2 * pi() * m / 12)')} AS MONTH_COS
FROM i, s""",
    ),
)
def explore_observations(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_rows(exploration.explore_observations(obs(spark, folder), OBS_KEY).train)
