"""Taxi-shaped and weather-shaped views of the supplied tables.

The text runs unchanged in Spark, which fills in the scanned table, and as a
common table expression in the checking SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.columns import computed_once
from ..sources.tables import read_table

TRIPS = """
SELECT t.*, replace(tpep_pickup_datetime, ':00 ', ':50 ') AS tpep_dropoff_datetime FROM (
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  concat(lpad(CAST(1 + l_partkey % 12 AS STRING),2,'0'),'/',lpad(CAST(1 + l_orderkey % 28 AS STRING),2,'0'),'/2022 ',
         lpad(CAST(1 + l_suppkey % 12 AS STRING),2,'0'),':',lpad(CAST(l_partkey % 60 AS STRING),2,'0'),':00 ',
         CASE WHEN l_linenumber % 2 = 0 THEN 'AM' ELSE 'PM' END) AS tpep_pickup_datetime,
  CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_linenumber * 2 AS DOUBLE) END AS passenger_count,
  l_quantity * 1.25 AS trip_distance,
  CAST(1 + l_linenumber % 6 AS DOUBLE) AS RatecodeID,
  CAST(1 + l_partkey % 265 AS DOUBLE) AS PULocationID,
  CAST(1 + l_suppkey % 265 AS DOUBLE) AS DOLocationID,
  CAST(1 + l_orderkey % 4 AS DOUBLE) AS payment_type,
  l_tax * 150 AS extra,
  l_extendedprice / 400 AS total_amount
FROM {lineitem}) t
"""

OBS = """
SELECT event_id AS obs_id,
  concat('2024-',lpad(CAST(1 + event_id % 12 AS STRING),2,'0'),'-',lpad(CAST(1 + event_id % 28 AS STRING),2,'0'),'T',
         lpad(CAST((event_id * 7) % 24 AS STRING),2,'0'),':53:00') AS DATE,
  CAST((user_id % 9) * 5 - 20 AS STRING) AS LATITUDE,
  CAST((user_id % 9) * 7 - 30 AS STRING) AS LONGITUDE,
  CAST((user_id % 9) * 100 AS STRING) AS ELEVATION,
  concat(CASE WHEN event_id % 11 = 0 THEN '999' ELSE lpad(CAST((event_id * 37) % 371 AS STRING),3,'0') END, ',',
         CASE WHEN event_type = 'error' AND event_id % 5 = 0 THEN '3' ELSE '1' END, CASE WHEN event_id % 22 = 0 THEN ',V,' ELSE ',N,' END,
         CASE WHEN event_id % 10 = 0 OR (user_id % 9 = 4 AND event_id % 12 = 3) THEN '9999' ELSE lpad(CAST(CAST(floor(value * 2) AS INT) AS STRING),4,'0') END, ',1') AS WND,
  concat(CASE WHEN event_id % 23 = 0 THEN '30000' WHEN event_id % 9 = 0 THEN '99999' ELSE '22000' END, ',1,9,', CASE event_id % 7 WHEN 0 THEN 'Y' WHEN 1 THEN '9' WHEN 2 THEN 'X' ELSE 'N' END) AS CIG,
  concat(CASE WHEN event_id % 29 = 0 THEN '170000' WHEN event_id % 14 = 0 THEN '999999' ELSE '016000' END, ',1,', CASE event_id % 8 WHEN 0 THEN 'V' WHEN 1 THEN '9' ELSE 'N' END, ',1') AS VIS,
  concat(CASE WHEN event_id % 13 = 0 THEN '+9999' ELSE concat(CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END, lpad(CAST(CAST(floor(value) AS INT) AS STRING),4,'0')) END, ',1') AS DEW,
  CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '+9999,9'
       ELSE concat(CASE WHEN event_id % 4 = 0 THEN '-' ELSE '+' END, lpad(CAST(CAST(floor(value * 1.5) AS INT) AS STRING),4,'0'), ',', CASE WHEN event_id % 19 = 0 THEN '2' ELSE '1' END) END AS TMP,
  CASE WHEN event_id % 6 = 0 THEN '99999,9' ELSE concat(lpad(CAST(9000 + event_id % 2200 AS STRING),5,'0'), ',1') END AS SLP,
  CASE WHEN event_id % 3 = 0 THEN concat(CASE WHEN event_id % 5 = 0 THEN '99' ELSE '02' END, ',1,+00100,1,05,1') ELSE NULL END AS GA1,
  CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS SOURCE
FROM {events}
"""

TRIP_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
OBS_KEY = "obs_id"


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(TRIPS, lineitem=read_table(spark, folder, "lineitem"))


def timed_trips(spark: SparkSession, folder: str) -> DataFrame:
    """``trips`` for queries that read the time texts: these are put together once per row."""
    df = trips(spark, folder)
    texts = ["tpep_pickup_datetime", "tpep_dropoff_datetime"]
    return computed_once(df, [F.col(c) for c in texts], [c for c in df.columns if c not in texts])


def obs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(OBS, events=read_table(spark, folder, "events"))
