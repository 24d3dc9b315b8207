"""Weather tables derived from the `customer` and `events` tables.

Each customer is a postal-code centroid, each event user a station, each event a reading. The
text runs unchanged on Spark and DuckDB (but for `{thrice}`, which repeats each event);
`{customer}` and `{events}` stand for the two tables.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_PLACE = """CAST(10000 + c_custkey AS STRING) AS plz, '' AS note,
  51.0E0 + ((c_custkey*6101+17) % 10037) / 10037.0E0 * 3.0E0 AS centroid_lat,
  11.0E0 + ((c_custkey*86243+5) % 10039) / 10039.0E0 * 4.5E0 AS centroid_lon,
  TIMESTAMP '2024-01-01 00:00:00' AS ingested_at"""

POSTAL_CODES = f"SELECT {_PLACE} FROM {{customer}}"

WEATHER_STATIONS = """
WITH base AS (
  SELECT c_custkey AS id, lpad(CAST(c_custkey AS STRING), 5, '0') AS dwd_station_id,
    CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST(10000 + c_custkey AS STRING) END AS wmo_station_id,
    c_name AS station_name,
    CASE WHEN c_custkey % 3 = 2 THEN 'forecast' ELSE 'synop' END AS observation_type,
    51.0E0 + ((c_custkey*7919) % 10007) / 10007.0E0 * 3.0E0 AS lat,
    11.0E0 + ((c_custkey*104729) % 10009) / 10009.0E0 * 4.5E0 AS lon,
    CAST(c_custkey % 500 AS DOUBLE) AS height, CAST(NULL AS DOUBLE) AS distance,
    TIMESTAMP '2020-01-01 00:00:00' AS first_record,
    CASE c_custkey % 4 WHEN 0 THEN TIMESTAMP '2023-12-31 12:00:00'
      WHEN 1 THEN TIMESTAMP '2024-01-31 06:00:00'
      WHEN 2 THEN TIMESTAMP '2024-02-08 00:00:00'
      ELSE TIMESTAMP '2024-02-10 00:00:00' END AS last_record,
    TIMESTAMP '2024-01-01 00:00:00' AS ingested_at
  FROM {customer} WHERE c_custkey IN (SELECT DISTINCT user_id FROM {events}))
SELECT * FROM base
UNION ALL
SELECT id, dwd_station_id, wmo_station_id, concat(station_name, ' v2') AS station_name,
  observation_type, lat, lon, height, distance, first_record, last_record,
  TIMESTAMP '2024-01-02 00:00:00' AS ingested_at
FROM base WHERE id % 7 = 0"""

OBSERVATIONS_SYNOP = """
WITH base AS (
  SELECT user_id AS source_id, date_trunc('second', CAST(ts AS TIMESTAMP)) AS timestamp, event_id,
    CAST((event_id*7) % 101 AS DOUBLE) AS cloud_cover,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_type END AS condition,
    CASE WHEN event_id % 101 = 0 THEN 700.0E0 ELSE 980.0E0 + event_id % 50 END AS pressure_msl,
    30.0E0 + (event_id*37) % 80 AS relative_humidity,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE value/5.0E0 - 10.0E0 END AS temperature,
    CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 97 = 0 THEN -1.0E0
      ELSE (event_id % 7)*0.4E0 END AS precipitation_60,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(event_id % 61 AS DOUBLE) END AS sunshine_60,
    CAST((event_id*17) % 360 AS DOUBLE) AS wind_direction_60,
    CAST((event_id*13) % 215 AS DOUBLE) AS wind_speed_60,
    date_trunc('second', CAST(ts AS TIMESTAMP)) + INTERVAL '1' HOUR AS ingested_at
  FROM {events})
SELECT * FROM base
UNION ALL
SELECT source_id, timestamp, event_id, cloud_cover, condition, pressure_msl, relative_humidity,
  temperature + 1.0E0, precipitation_60, sunshine_60, wind_direction_60, wind_speed_60,
  ingested_at + INTERVAL '6' HOUR
FROM base WHERE event_id % 10 = 0"""

FORECASTS = """
SELECT e.user_id AS source_id, date_trunc('hour', CAST(e.ts AS TIMESTAMP)) AS timestamp, e.event_id,
  CAST((e.event_id*7 + k.i) % 101 AS DOUBLE) AS cloud_cover,
  CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE e.event_type END AS condition,
  (e.event_id % 6)*0.5E0 AS precipitation,
  CASE WHEN e.event_id % 19 = 0 THEN 120.0E0 WHEN e.event_id % 23 = 0 THEN NULL
    ELSE CAST((e.event_id*3 + k.i) % 101 AS DOUBLE) END AS precipitation_probability,
  980.0E0 + e.event_id % 50 AS pressure_msl, 30.0E0 + (e.event_id*37) % 80 AS relative_humidity,
  CAST(e.event_id % 61 AS DOUBLE) AS sunshine,
  CASE WHEN e.event_id % 11 = 0 THEN NULL ELSE e.value/5.0E0 - 10.0E0 + k.i END AS temperature,
  CAST((e.event_id*17) % 360 AS DOUBLE) AS wind_direction,
  CAST((e.event_id*13) % 215 AS DOUBLE) AS wind_speed,
  CASE k.i WHEN 0 THEN date_trunc('hour', CAST(e.ts AS TIMESTAMP))
    WHEN 1 THEN date_trunc('hour', CAST(e.ts AS TIMESTAMP)) - INTERVAL '6' HOUR
    ELSE date_trunc('hour', CAST(e.ts AS TIMESTAMP)) - INTERVAL '12' HOUR END AS forecast_created_at,
  date_trunc('second', CAST(e.ts AS TIMESTAMP)) AS ingested_at
FROM {thrice}"""

# Every event in three copies, i = 0, 1, 2.
THRICE_SPARK = "{events} e LATERAL VIEW explode(array(0, 1, 2)) k AS i"
THRICE_DUCKDB = "{events} e, (SELECT unnest([0, 1, 2]) AS i) k"

POSTAL_SQUARES = f"""
SELECT plz, centroid_lon - 0.02E0 AS lon0, centroid_lon + 0.02E0 AS lon1,
  centroid_lat - 0.02E0 AS lat0, centroid_lat + 0.02E0 AS lat1,
  CAST(plz AS BIGINT) % 5 = 0 AS has_hole
FROM (SELECT {_PLACE} FROM {{customer}}) t"""

# Every fortieth shape spans degrees; slants and tilts turn the sides.
POSTAL_SHAPES = f"""
SELECT plz, centroid_lon AS lon, centroid_lat AS lat, CAST(plz AS BIGINT) % 3 = 0 AS has_hole,
  CASE WHEN CAST(plz AS BIGINT) % 40 = 0 THEN 6.0E0 ELSE 0.01E0 + (CAST(plz AS BIGINT) % 7) * 0.02E0 END AS half_width,
  CASE WHEN CAST(plz AS BIGINT) % 40 = 0 THEN 4.0E0 ELSE 0.01E0 + (CAST(plz AS BIGINT) % 11) * 0.01E0 END AS half_height,
  (CAST(plz AS BIGINT) % 5) * 0.2E0 AS slant, (CAST(plz AS BIGINT) % 9) * 0.05E0 AS tilt
FROM (SELECT {_PLACE} FROM {{customer}}) t"""

FIXTURES = {
    "postal_codes": POSTAL_CODES,
    "weather_stations": WEATHER_STATIONS,
    "weather_observations_synop": OBSERVATIONS_SYNOP,
    "weather_forecasts": FORECASTS,
    "postal_squares": POSTAL_SQUARES,
    "postal_shapes": POSTAL_SHAPES,
}


@lru_cache
def _schema(path: str) -> StructType:
    """Read from the file once; later reads of the same table plan without a look at it."""
    return SparkSession.active().read.parquet(path).schema


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table; the session time zone is set to UTC, which the text relies on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = FIXTURES[name].replace("{thrice}", THRICE_SPARK)
    paths = {
        t: f"{sf_dir}/{t}.parquet" for t in ("customer", "events") if "{" + t + "}" in text
    }
    return spark.sql(
        text, **{t: spark.read.schema(_schema(p)).parquet(p) for t, p in paths.items()}
    )


def duckdb_text(name: str) -> str:
    text = FIXTURES[name].replace("{thrice}", THRICE_DUCKDB)
    return text.replace("{customer}", "customer").replace("{events}", "events")
