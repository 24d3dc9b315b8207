"""Scans over landed GeoJSON and JSON responses.

A scan gives the good rows and, beside them, the rejected records with file and reason; a broken
response never stops a run. Responses are read in parallel, one row per response, and a response
is one station's answer, so no row grows with the number of stations.
"""

from __future__ import annotations

from datetime import datetime
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import ArrayType, StringType, StructField, StructType, TimestampType

from stationfield import schemas
from stationfield.functions import temporal
from stationfield.functions.quality import nan_to_null
from stationfield.operators.conform import conform
from stationfield.operators.versions import first_seen
from stationfield.session import materialize

ISSUE = "forecast_created_at"


class Landed(NamedTuple):
    rows: DataFrame
    rejected: DataFrame  # file, reason, record


def _wire(payload: StructType, without: tuple[str, ...] = ()) -> StructType:
    """Shape of a record on the wire: timestamps are text, everything may be missing."""
    return StructType(
        [
            StructField(
                f.name, StringType() if isinstance(f.dataType, TimestampType) else f.dataType, True
            )
            for f in payload.fields
            if f.name not in without
        ]
    )


STATION_WIRE = _wire(schemas.WEATHER_STATIONS.payload)
CURRENT_WIRE = _wire(schemas.OBSERVATIONS_SYNOP.payload)
FORECAST_WIRE = _wire(schemas.FORECASTS.payload, (ISSUE,))
_FIRST_RECORD = StructType([StructField("first_record", StringType(), True)])


def responses(
    source: DataFrameReader | DataStreamReader, path: str, whole_files: bool,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Responses as text with their file, one per file or one per line; batch or stream, a
    stream by so many files at a time."""
    if files_per_batch is not None:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    text = source.text(path, wholetext=whole_files)
    return text.where(F.length(F.trim("value")) > 0).select(
        F.col("_metadata.file_path").alias("file"), F.col("value").alias("record")
    )


def _parsed(
    text: DataFrame, body: list[StructField], once: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Parsed responses (file, record, body columns) and the ones that are not valid JSON. Parsed `once`,
    they are written as typed columns, from which both are read."""
    corrupt = StructField("_corrupt_record", StringType(), True)
    parsed = F.from_json(
        "record", StructType([*body, corrupt]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"},
    )
    read = text.select("file", "record", parsed.alias("parsed"))
    if once:
        read = materialize(read, "parsed")
    broken = F.col("parsed").isNull() | F.col("parsed._corrupt_record").isNotNull()
    good = read.where(~broken).select("file", "record", *[f"parsed.{f.name}" for f in body])
    return good, read.where(broken).select("file", F.lit("not valid JSON").alias("reason"), "record")


def _split(rows: DataFrame, rejected: DataFrame, reason: Column) -> Landed:
    """Rows with a reason go to the rejected ones."""
    judged = rows.withColumn("reason", reason)
    bad = judged.where("reason IS NOT NULL").select("file", "reason", "record")
    return Landed(
        judged.where("reason IS NULL").drop("reason", "file", "record"), rejected.unionByName(bad)
    )


def _unparsed(text: Column, parsed: Column) -> Column:
    return text.isNotNull() & parsed.isNull()


def read_features(spark: SparkSession, path: str, by_line: bool = False) -> Landed:
    """Features as (postcode, geometry); the geometry stays raw JSON text.

    A FeatureCollection is one JSON document, parsed by one task per file, and its features are
    then dealt out; one feature per line (`by_line`) splits anywhere. Text that is no JSON and
    features with a postcode but no geometry are rejected.
    """
    properties = "STRUCT<postcode: STRING, properties: STRUCT<postcode: STRING>>"
    feature = StructType.fromDDL(f"properties {properties}, geometry STRING")
    body = feature.fields if by_line else [StructField("features", ArrayType(feature), True)]
    good, broken = _parsed(responses(spark.read, path, not by_line), body)
    if not by_line:  # of a collection, the broken feature is told and not the whole file again
        good = good.select("file", F.explode("features").alias("feature"))
        good = good.select("file", F.to_json("feature").alias("record"), "feature.*")
    postcode = F.coalesce("properties.postcode", "properties.properties.postcode", F.lit(""))
    rows = good.select("file", "record", postcode.alias("postcode"), "geometry")
    lacking = (F.col("postcode") != "") & F.col("geometry").isNull()
    landed = _split(rows, broken, F.when(lacking, F.lit("no geometry")))
    return landed if by_line else Landed(landed.rows.repartition("postcode"), landed.rejected)


def read_geojson(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """The good features of `read_features`."""
    return read_features(spark, path, by_line).rows


def read_stations(spark: SparkSession, path: str, whole_files: bool = True) -> Landed:
    """Station records of `{"sources": [...]}` responses; a response without sources has none."""
    body = [StructField("sources", ArrayType(STATION_WIRE), True)]
    good, broken = _parsed(responses(spark.read, path, whole_files), body)
    rows = good.select("file", "record", F.inline("sources"))
    return parse_stations(rows, broken)


def parse_stations(rows: DataFrame, broken: DataFrame) -> Landed:
    first, last = (temporal.parse_utc(F.col(c)) for c in ("first_record", "last_record"))
    reason = (
        F.when(F.col("id").isNull() | (F.col("id") < 0), F.lit("no station id"))
        .when(_unparsed(F.col("first_record"), first), F.lit("bad timestamp"))
        .when(_unparsed(F.col("last_record"), last), F.lit("bad timestamp"))
    )
    landed = _split(rows, broken, reason)
    timed = landed.rows.withColumns({"first_record": first, "last_record": last})
    return Landed(nan_to_null(conform(timed, schemas.WEATHER_STATIONS.payload)), landed.rejected)


def _reading_reason(ts: Column) -> Column:
    return (
        F.when(F.col("source_id").isNull() | (F.col("source_id") < 0), F.lit("no station id"))
        .when(F.col("timestamp").isNull() | ts.isNull(), F.lit("bad timestamp"))
    )


def read_current_weather(
    spark: SparkSession, path: str, stations: DataFrame | None = None, whole_files: bool = True
) -> Landed:
    """One reading per `{"weather": {...}}` response, none for an empty one; once per station and
    time. `stations` (column id) limits the readings to theirs."""
    return current_weather(responses(spark.read, path, whole_files), stations)


def current_weather(
    text: DataFrame, stations: DataFrame | None = None, once: bool = False
) -> Landed:
    body = [StructField("weather", CURRENT_WIRE, True)]
    good, broken = _parsed(text, body, once)
    # One comparison of the parsed record: a test of each field would parse it for each.
    nothing = F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in CURRENT_WIRE.fields])
    told = F.col("weather").isNotNull() & ~F.col("weather").eqNullSafe(nothing)
    rows = good.where(told).select("file", "record", "weather.*")
    return parse_readings(rows, broken, schemas.OBSERVATIONS_SYNOP, stations)


def read_forecasts(
    spark: SparkSession,
    path: str,
    as_of: datetime,
    days_ahead: int | None = 7,
    stations: DataFrame | None = None,
    whole_files: bool = True,
) -> Landed:
    """Forecast rows of `{"weather": [...], "sources": [{"first_record": ...}]}` responses.

    The issue time is the first source's first record, or `as_of` where it has none. Rows outside
    the days asked for are left out; `days_ahead=None` keeps all.
    """
    text = responses(spark.read, path, whole_files)
    return forecasts(text, as_of, days_ahead, stations)


def forecasts(
    text: DataFrame,
    as_of: datetime,
    days_ahead: int | None = 7,
    stations: DataFrame | None = None,
    once: bool = False,
) -> Landed:
    body = [
        StructField("weather", ArrayType(FORECAST_WIRE), True),
        StructField("sources", ArrayType(_FIRST_RECORD), True),
    ]
    good, broken = _parsed(text, body, once)
    stated = F.get("sources", 0)["first_record"]
    issued = temporal.parse_utc(stated)
    dated = good.withColumn(
        "reason", F.when(_unparsed(stated, issued), F.lit("bad issue time"))
    ).withColumn(ISSUE, F.coalesce(issued, temporal.utc(as_of)))
    broken = broken.unionByName(
        dated.where("reason IS NOT NULL").select("file", "reason", "record")
    )
    rows = dated.where("reason IS NULL").select("file", "record", ISSUE, F.inline("weather"))
    landed = parse_readings(rows, broken, schemas.FORECASTS, stations)
    if days_ahead is None:
        return landed
    wanted = temporal.between(F.col("timestamp"), temporal.calendar_horizon(as_of, days_ahead))
    return Landed(landed.rows.where(wanted), landed.rejected)


def parse_readings(
    rows: DataFrame, broken: DataFrame, table: schemas.Table, stations: DataFrame | None = None
) -> Landed:
    """Parse times, set bad records aside, fit to the table, keep each key once."""
    ts = temporal.parse_utc(F.col("timestamp"))
    landed = _split(rows, broken, _reading_reason(ts))
    readings = landed.rows.withColumn("timestamp", ts)
    if stations is not None:
        readings = readings.join(
            stations.select(F.col("id").alias("source_id")), "source_id", "left_semi"
        )
    fitted = nan_to_null(conform(readings, table.payload))
    return Landed(first_seen(fitted, table.key, []), landed.rejected)
