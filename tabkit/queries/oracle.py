"""Common table expressions of the checking SQL, written out independently of the library."""

from __future__ import annotations

from .fixtures import OBS, TRIPS

_STEPS: dict[str, str] = {
    "trips": TRIPS.format(lineitem="lineitem"),
    "obs": OBS.format(events="events"),
}
_NEEDS: dict[str, tuple[str, ...]] = {"trips": (), "obs": ()}


def step(name: str, needs: tuple[str, ...], sql: str) -> None:
    _STEPS[name], _NEEDS[name] = sql, needs


def using(*names: str, body: str) -> str:
    """``body`` with the named steps, and what they rest on, as common table expressions."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in _NEEDS[name]:
                visit(other)
            order.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({_STEPS[n]})" for n in order) + "\n" + body


def digest(purpose: str, key: str, seed: int = 42) -> str:
    return f"md5(concat('{purpose}-{seed}:', {key}))"


def key_text(*columns: str) -> str:
    """The text of a key: of each column its length and value, ``-`` for NULL."""
    text = "CAST({c} AS STRING)"
    parts = [f"coalesce(CAST(length({text}) AS STRING) || ':' || {text}, '-')".format(c=c) for c in columns]
    return " || ".join(parts)


OBS_ID = key_text("obs_id")
TRIP_ID = key_text("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def hex4(text: str) -> str:
    """The first four hex digits of ``text`` as a number."""
    digit = "(instr('0123456789abcdef', substr({t}, {i}, 1)) - 1)"
    parts = [digit.format(t=text, i=i + 1) + f" * {16 ** (3 - i)}" for i in range(4)]
    return "CAST(" + " + ".join(parts) + " AS INTEGER)"


step(
    "fields",
    ("obs",),
    """
SELECT obs_id, DATE,
  TRY_CAST(LATITUDE AS DOUBLE) AS LATITUDE, TRY_CAST(LONGITUDE AS DOUBLE) AS LONGITUDE,
  TRY_CAST(ELEVATION AS DOUBLE) AS ELEVATION,
  TRY_CAST(str_split(WND, ',')[1] AS INTEGER) AS WND_0, str_split(WND, ',')[2] AS WND_1,
  str_split(WND, ',')[3] AS WND_2, TRY_CAST(str_split(WND, ',')[4] AS INTEGER) AS WND_3,
  str_split(WND, ',')[5] AS WND_4,
  TRY_CAST(str_split(CIG, ',')[1] AS INTEGER) AS CIG_0, str_split(CIG, ',')[2] AS CIG_1,
  str_split(CIG, ',')[4] AS CIG_3,
  TRY_CAST(str_split(VIS, ',')[1] AS INTEGER) AS VIS_0, str_split(VIS, ',')[2] AS VIS_1,
  str_split(VIS, ',')[3] AS VIS_2, str_split(VIS, ',')[4] AS VIS_3,
  TRY_CAST(str_split(DEW, ',')[1] AS INTEGER) AS DEW_0, str_split(DEW, ',')[2] AS DEW_1,
  TRY_CAST(str_split(TMP, ',')[1] AS INTEGER) AS TMP_0, str_split(TMP, ',')[2] AS TMP_1,
  TRY_CAST(str_split(SLP, ',')[1] AS INTEGER) AS SLP_0, str_split(SLP, ',')[2] AS SLP_1,
  str_split(GA1, ',')[1] AS GA1_0, str_split(GA1, ',')[3] AS GA1_2, str_split(GA1, ',')[5] AS GA1_4
FROM obs
""",
)
step(
    "clean",
    ("fields",),
    """
SELECT * FROM fields
WHERE TMP_0 > -932 AND TMP_0 < 618 AND TMP_1 NOT IN ('2', '3', '6', '7')
  AND WND_0 >= 0 AND (WND_0 <= 360 OR WND_0 = 999) AND WND_1 NOT IN ('3', '7')
  AND WND_3 >= 0 AND (WND_3 <= 900 OR WND_3 = 9999) AND WND_4 NOT IN ('3', '7')
  AND CIG_3 IN ('N', 'Y', '9') AND VIS_2 IN ('N', 'V', '9') AND VIS_3 NOT IN ('3', '7')
  AND DEW_0 > -932 AND (DEW_0 < 368 OR DEW_0 = 9999)
""",
)
TARGET_SQL = "TMP_0 BETWEEN -932 AND 618 AND TMP_1 NOT IN ('2', '3', '6', '7')"
WIDE_SQL = """
  WND_0 >= 1 AND (WND_0 <= 360 OR WND_0 = 999) AND WND_1 NOT IN ('3', '7')
  AND WND_3 >= 0 AND (WND_3 <= 900 OR WND_3 = 9999) AND WND_4 NOT IN ('3', '7')
  AND CIG_0 >= 0 AND (CIG_0 <= 22000 OR CIG_0 = 99999) AND CIG_1 NOT IN ('3', '7')
  AND CIG_3 IN ('N', 'Y', '9')
  AND VIS_0 >= 0 AND (VIS_0 <= 160000 OR VIS_0 = 999999) AND VIS_1 NOT IN ('3', '7')
  AND VIS_2 IN ('N', 'Y', '9') AND VIS_3 NOT IN ('3', '7')
  AND DEW_0 >= -982 AND (DEW_0 <= 368 OR DEW_0 = 9999) AND DEW_1 NOT IN ('3', '7')
  AND SLP_0 >= 8600 AND (SLP_0 <= 10900 OR SLP_0 = 99999) AND SLP_1 NOT IN ('3', '7')
"""
step("wide_clean", ("fields",), f"SELECT * FROM fields WHERE {TARGET_SQL} AND {WIDE_SQL}")
# 'b3333333' is seven tenths of the range of eight hex digits.
step(
    "feats",
    ("clean",),
    f"""
SELECT obs_id, LATITUDE, LONGITUDE, ELEVATION, WND_3, DEW_0, TMP_0,
  CASE WHEN substr({digest('split', OBS_ID)}, 1, 8) < 'b3333333' THEN 'train' ELSE 'test' END AS split,
  CAST(hour(CAST(DATE AS TIMESTAMP)) AS INTEGER) AS HOUR,
  CAST(month(CAST(DATE AS TIMESTAMP)) AS INTEGER) AS MONTH,
  CASE WHEN CIG_3 = 'Y' THEN 1 ELSE 0 END AS CIG_3_Y, CASE WHEN CIG_3 = '9' THEN 1 ELSE 0 END AS CIG_3_9,
  CASE WHEN VIS_2 = 'V' THEN 1 ELSE 0 END AS VIS_2_V, CASE WHEN VIS_2 = '9' THEN 1 ELSE 0 END AS VIS_2_9,
  CASE WHEN WND_0 = 999 THEN 1 ELSE 0 END AS WND_0_UNDETERMINED,
  sin(2 * pi() * hour(CAST(DATE AS TIMESTAMP)) / 24) AS HOUR_SIN,
  cos(2 * pi() * hour(CAST(DATE AS TIMESTAMP)) / 24) AS HOUR_COS,
  sin(2 * pi() * month(CAST(DATE AS TIMESTAMP)) / 12) AS MONTH_SIN,
  cos(2 * pi() * month(CAST(DATE AS TIMESTAMP)) / 12) AS MONTH_COS,
  CASE WHEN WND_0 = 999 THEN 0.0 ELSE sin(WND_0 * pi() / 180) END AS WND_0_SIN,
  CASE WHEN WND_0 = 999 THEN 0.0 ELSE cos(WND_0 * pi() / 180) END AS WND_0_COS
FROM clean
""",
)
step(
    "means",
    ("feats",),
    """
SELECT LONGITUDE, LATITUDE, ELEVATION, MONTH,
  avg(NULLIF(WND_3, 9999)) AS WND_3_MEAN, avg(NULLIF(DEW_0, 9999)) AS DEW_0_MEAN
FROM feats WHERE split = 'train' GROUP BY LONGITUDE, LATITUDE, ELEVATION, MONTH
""",
)
step(
    "overall",
    ("feats",),
    """
SELECT avg(NULLIF(WND_3, 9999)) AS WND_3_ALL, avg(NULLIF(DEW_0, 9999)) AS DEW_0_ALL
FROM feats WHERE split = 'train'
""",
)
step(
    "imputed",
    ("means", "overall"),
    """
SELECT f.* REPLACE (
  coalesce(CAST(NULLIF(WND_3, 9999) AS DOUBLE), WND_3_MEAN, WND_3_ALL) AS WND_3,
  coalesce(CAST(NULLIF(DEW_0, 9999) AS DOUBLE), DEW_0_MEAN, DEW_0_ALL) AS DEW_0)
FROM feats f LEFT JOIN means USING (LONGITUDE, LATITUDE, ELEVATION, MONTH), overall
""",
)
step(
    "scale_stats",
    ("imputed",),
    "SELECT "
    + ", ".join(
        f"avg({c}) AS {c}_M, stddev_samp({c}) AS {c}_S"
        for c in ("LATITUDE", "LONGITUDE", "ELEVATION", "WND_3", "DEW_0")
    )
    + " FROM imputed WHERE split = 'train'",
)
step(
    "prepared",
    ("imputed", "scale_stats"),
    "SELECT i.* REPLACE ("
    + ", ".join(
        f"({c} - {c}_M) / {c}_S AS {c}"
        for c in ("LATITUDE", "LONGITUDE", "ELEVATION", "WND_3", "DEW_0")
    )
    + ") FROM imputed i, scale_stats",
)
step(
    "good_trips",
    ("trips",),
    """
SELECT * FROM trips
WHERE tpep_pickup_datetime <> '' AND tpep_dropoff_datetime <> ''
  AND passenger_count IS NOT NULL AND trip_distance IS NOT NULL AND RatecodeID IS NOT NULL
  AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND payment_type IS NOT NULL
  AND extra IS NOT NULL AND total_amount IS NOT NULL
  AND passenger_count <= 10 AND trip_distance <= 50 AND extra <= 10 AND total_amount <= 200
""",
)
step(
    "typed_trips",
    ("good_trips",),
    """
SELECT * REPLACE (
  epoch(strptime(tpep_pickup_datetime, '%m/%d/%Y %I:%M:%S %p')) AS tpep_pickup_datetime,
  epoch(strptime(tpep_dropoff_datetime, '%m/%d/%Y %I:%M:%S %p')) AS tpep_dropoff_datetime)
FROM good_trips
""",
)
step(
    "chunked",
    ("trips",),
    """
SELECT CAST(floor(l_orderkey / 2500) AS BIGINT) AS chunk,
  quantile_cont(passenger_count, 0.999) AS passenger_count,
  quantile_cont(trip_distance, 0.999) AS trip_distance,
  quantile_cont(extra, 0.999) AS extra,
  quantile_cont(total_amount, 0.999) AS total_amount
FROM trips GROUP BY 1
""",
)
step(
    "limits",
    ("chunked",),
    """
SELECT max(passenger_count) AS passenger_count, max(trip_distance) AS trip_distance,
  max(extra) AS extra, max(total_amount) AS total_amount
FROM chunked
""",
)
