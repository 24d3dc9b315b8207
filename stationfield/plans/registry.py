"""Every operator as a query over the given tables (`name -> callable(spark, sf_dir)`).

The queries run over whole tables. Numbers are rounded to six places for comparison. The
landing, warehouse and streaming queries first write the derived tables, as JSON responses or
Parquet, to a new folder under the shared one, and then run the scan, sink or stream on them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stationfield import schemas
from stationfield.functions import geo, quality, temporal
from stationfield.operators import radius, versions
from stationfield.operators.conform import conform
from stationfield.operators.idw import (
    condition_vocabulary,
    interpolate,
    most_frequent,
    reading_profile,
)
from stationfield.plans import ingest, monitor, reads, transforms
from stationfield.plans.transforms import FORECAST, OBSERVATION
from stationfield.session import materialize, scratch_path
from stationfield.sources import landing
from stationfield.sources.fixtures import derive
from stationfield.sources.warehouse import Warehouse
from stationfield.streaming import hourly

AS_OF = datetime(2024, 1, 31)
MID_MONTH = datetime(2024, 1, 15, 6, 30)
TIEBREAK = ["event_id"]
DAY_FIELDS = ["temperature", "wind_speed", "sunshine"]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six places, without negative zero."""
    return df.select(
        *[
            (F.rint(F.col(f.name) * F.lit(1e6)) / F.lit(1e6) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _places(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, "postal_codes")


def _stations(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, "weather_stations")


def _synop(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, "weather_observations_synop")


def _forecasts(spark: SparkSession, d: str) -> DataFrame:
    return derive(spark, d, "weather_forecasts")


def _transformed(spark: SparkSession, d: str, spec: transforms.Spec, **options) -> DataFrame:
    raw = _forecasts(spark, d) if spec.is_forecast else _synop(spark, d)
    return transforms.transform_tables(
        _places(spark, d), _stations(spark, d), raw, spec, tiebreak=TIEBREAK, **options
    )


# -- transforms --------------------------------------------------------------------------------


@query
def obs_by_postal_code(spark, d):
    return rounded(_transformed(spark, d, OBSERVATION))


@query
def fc_by_postal_code(spark, d):
    return rounded(_transformed(spark, d, FORECAST))


@query
def obs_lookback_run(spark, d):
    """One scheduled run: three prefixes, trailing 24 hours, at least two readings."""
    return rounded(
        _transformed(
            spark, d, OBSERVATION, prefixes=["10", "11", "12"], as_of=MID_MONTH, span=24,
            options=transforms.Options(min_stations=2),
        )
    )


@query
def obs_valid_readings_only(spark, d):
    """Invalid readings removed before aggregation, missing values counted as invalid."""
    strict = transforms.Options(
        ranges=quality.Ranges(missing_is_invalid=True), drop_invalid=True
    )
    return rounded(_transformed(spark, d, OBSERVATION, options=strict))


@query
def forecast_horizon_refresh(spark, d):
    """The hours of the next seven days, newest issue of each."""
    return rounded(_transformed(spark, d, FORECAST, as_of=MID_MONTH, span=7))


@query
def current_forecast(spark, d):
    """Two runs, the second with a newer issue; the newest issue per postal code and hour."""
    raw = _forecasts(spark, d)
    spot = transforms.station_ground(_places(spark, d), _stations(spark, d), "forecast")
    older = raw.where("forecast_created_at < timestamp")
    return rounded(reads.current_forecast_of_runs([older, raw], spot, TIEBREAK))


# -- spatial -----------------------------------------------------------------------------------


@query
def nearby_stations(spark, d):
    stations = transforms.current_stations(_stations(spark, d)).select(
        F.col("id").alias("source_id"), "station_name", "observation_type", "lat", "lon"
    )
    places = transforms.current_places(_places(spark, d))
    pairs = radius.radius_join(places.select("plz", "centroid_lat", "centroid_lon"), stations)
    return pairs.select(
        "plz", "source_id", "station_name", "observation_type",
        F.round("distance_km", 5).alias("distance_km"),
    )


@query
def nearest_station_rank(spark, d):
    ranked = radius.rank_on_ground(transforms.station_ground(_places(spark, d), _stations(spark, d), "synop"))
    return ranked.select("plz", "source_id", F.col("distance_rank").cast("bigint"))


@query
def station_discovery(spark, d):
    catalogue = transforms.current_stations(_stations(spark, d))
    found = radius.discover_stations(transforms.current_places(_places(spark, d)), catalogue)
    return found.select(
        "id", "station_name", "observation_type", F.round("distance", 2).alias("distance")
    )


@query
def great_circle_sql(spark, d):
    """The SQL-registered distance and weight, from each station to a fixed point."""
    geo.register_sql_functions(spark)
    return spark.sql(
        "SELECT id, round(great_circle_km(lat, lon, :lat, :lon), 6) AS distance_km, "
        "round(idw_weight(great_circle_km(lat, lon, :lat, :lon)), 6) AS weight FROM {stations}",
        args={"lat": 52.52, "lon": 13.40},
        stations=transforms.current_stations(_stations(spark, d)),
    )


@query
def postal_centroids(spark, d):
    path = scratch_path(spark, "features")
    _features(derive(spark, d, "postal_squares")).write.text(path)
    features = landing.read_geojson(spark, path, by_line=True)
    rows = ingest.parse_postal_codes(features, figure=geo.SPHERE)
    return rounded(rows.select("plz", "note", "centroid_lon", "centroid_lat"))


@query
def centroid_ellipsoid(spark, d):
    """Slanted quadrilaterals, small ones and ones of many degrees, some with a hole, on WGS 84: with
    edges straight in the equal-area plane, and with edges straight in longitude and latitude."""
    shapes = derive(spark, d, "postal_shapes")

    def ring(size: float) -> Column:
        def corner(across: int, up: int) -> Column:
            x, y = F.lit(across * size), F.lit(up * size)
            lon = F.col("lon") + F.col("half_width") * x + F.col("slant") * F.col("half_height") * y
            return F.array(lon, F.col("lat") + F.col("half_height") * y + F.col("tilt") * F.col("half_width") * x)

        return F.array(*[corner(*c) for c in [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]])

    rings = F.when(F.col("has_hole"), F.array(ring(1.0), ring(0.5))).otherwise(F.array(ring(1.0)))
    shape = F.to_json(F.struct(F.lit("Polygon").alias("type"), rings.alias("coordinates")))
    features = materialize(shapes.select(F.col("plz").alias("postcode"), shape.alias("geometry")), "shapes")
    plain = ingest.parse_postal_codes(features).select("plz", "centroid_lon", "centroid_lat")
    smooth = ingest.parse_postal_codes(features, max_edge_degrees=0.25).select(
        "plz", F.col("centroid_lon").alias("edges_lon"), F.col("centroid_lat").alias("edges_lat")
    )
    return rounded(plain.join(smooth, "plz"))


def _features(squares: DataFrame) -> DataFrame:
    """GeoJSON features: some as MultiPolygon, some drawn the other way round, some with a hole,
    some with nested properties."""
    key = F.col("plz").cast("bigint")

    def box(west: Column, east: Column) -> Column:
        corners = [(west, "lat0"), (east, "lat0"), (east, "lat1"), (west, "lat1"), (west, "lat0")]
        ring = F.array(*[F.array(x, F.col(y)) for x, y in corners])
        return F.when(key % 3 == 0, F.reverse(ring)).otherwise(ring)

    outer = box(F.col("lon0"), F.col("lon1"))
    hole = box((F.col("lon0") + F.col("lon1")) / 2.0, F.col("lon1"))
    rings = F.when(F.col("has_hole"), F.array(outer, hole)).otherwise(F.array(outer))

    def geometry(kind: str, coordinates: Column) -> Column:
        return F.to_json(F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates")))

    shape = F.when(key % 2 == 0, geometry("Polygon", rings)).otherwise(
        geometry("MultiPolygon", F.array(rings))
    )
    flat = F.to_json(F.struct(F.col("plz").alias("postcode")))
    nested = F.format_string('{"properties":%s}', flat)
    properties = F.when(key % 7 == 0, nested).otherwise(flat)
    return squares.select(
        F.format_string('{"type":"Feature","properties":%s,"geometry":%s}', properties, shape)
        .alias("value")
    )


# -- aggregation and quality -------------------------------------------------------------------


@query
def idw_mean(spark, d):
    """Weighted means per postal code and day."""
    raw = _synop(spark, d)
    daily = transforms.prepare_readings(raw, OBSERVATION, tiebreak=TIEBREAK).withColumn(
        "timestamp", F.date_trunc("day", "timestamp")
    )
    pairs = transforms.station_ground(_places(spark, d), _stations(spark, d), "synop")
    profile = reading_profile(raw)
    means = interpolate(
        daily, pairs, DAY_FIELDS, vocabulary=condition_vocabulary(profile), profile=profile
    )
    return rounded(means.select("plz", F.col("timestamp").alias("day"), *DAY_FIELDS))


@query
def idw_many_pairs(spark, d):
    """Hourly means within 25 km, some six times as many pairs as within 10, with the number of stations
    that each rests on."""
    raw = _synop(spark, d)
    pairs = transforms.station_ground(_places(spark, d), _stations(spark, d), "synop", radius_km=25.0)
    wide = transforms.Options(radius_km=25.0, distinct_stations=True)
    means = transforms.transform(raw, pairs, OBSERVATION, tiebreak=TIEBREAK, options=wide)
    return rounded(
        means.select("plz", "timestamp", "temperature", "pressure_msl", "condition", "num_stations", "distinct_stations")
    )


@query
def condition_mode(spark, d):
    """Most frequent condition per station and day."""
    day = F.date_trunc("day", "timestamp").alias("day")
    return _synop(spark, d).groupBy("source_id", day).agg(
        most_frequent(F.col("condition")).alias("condition")
    )


def _clean_synop(spark: SparkSession, d: str) -> DataFrame:
    """All readings with their quality, in all versions."""
    fields = [F.col(OBSERVATION.renamed.get(f, f)).alias(f) for f in OBSERVATION.fields]
    rows = _synop(spark, d).select("source_id", "timestamp", "event_id", "ingested_at", *fields)
    return quality.add_quality(quality.nan_to_null(rows))


@query
def quality_score(spark, d):
    return rounded(
        _clean_synop(spark, d).select("event_id", "ingested_at", "quality_score")
    )


@query
def row_validity(spark, d):
    return _clean_synop(spark, d).select("event_id", "ingested_at", "is_valid")


@query
def valid_rows_only(spark, d):
    return rounded(
        quality.keep_valid(_clean_synop(spark, d)).select(
            "event_id", "ingested_at", "temperature", "precipitation", "pressure_msl"
        )
    )


@query
def forecast_validity(spark, d):
    rows = quality.add_quality(quality.nan_to_null(_forecasts(spark, d)))
    return rounded(
        rows.select("event_id", "forecast_created_at", "is_valid", "quality_score")
    )


@query
def quality_score_sql(spark, d):
    """The SQL-registered score."""
    quality.register_sql_functions(spark)
    return spark.sql(
        "SELECT event_id, ingested_at, round(quality_score(temperature, precipitation_60, "
        "relative_humidity, wind_speed_60, pressure_msl), 6) AS quality_score FROM {obs}",
        obs=_synop(spark, d),
    )


# -- versions and sinks ------------------------------------------------------------------------


@query
def latest_version_stations(spark, d):
    table = schemas.WEATHER_STATIONS
    return versions.latest(_stations(spark, d), table.key, table.version)


@query
def latest_version_obs(spark, d):
    table = schemas.OBSERVATIONS_SYNOP
    return rounded(versions.latest(_synop(spark, d), table.key, table.version, TIEBREAK))


@query
def latest_forecast_issue(spark, d):
    return rounded(versions.latest_issue(_forecasts(spark, d), tiebreak=TIEBREAK))


def _stored_stations(spark: SparkSession, d: str) -> Warehouse:
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    stations = _stations(spark, d)
    newer = F.col("ingested_at") > temporal.utc(datetime(2024, 1, 1))
    warehouse.append(stations.where(newer), schemas.WEATHER_STATIONS, AS_OF)
    warehouse.append(stations.where(~newer), schemas.WEATHER_STATIONS, AS_OF)
    return warehouse


@query
def upsert_result(spark, d):
    """Newer versions arrive first, older ones after them; compaction keeps the newer."""
    warehouse = _stored_stations(spark, d)
    warehouse.compact(schemas.WEATHER_STATIONS)
    return warehouse.scan(schemas.WEATHER_STATIONS)


@query
def delete_by_key(spark, d):
    """All versions of the forecast stations removed."""
    warehouse = _stored_stations(spark, d)
    doomed = _stations(spark, d).where("observation_type = 'forecast'")
    warehouse.delete(schemas.WEATHER_STATIONS, doomed)
    return warehouse.scan(schemas.WEATHER_STATIONS)


# -- reads -------------------------------------------------------------------------------------


@query
def postal_prefix(spark, d):
    return rounded(reads.postal_codes(_places(spark, d), "10"))


@query
def stations_by_type(spark, d):
    return reads.weather_stations(_stations(spark, d), "synop")


@query
def stations_near_prefix(spark, d):
    near = transforms.current_places(_places(spark, d), ["10", "12"])
    return reads.weather_stations(_stations(spark, d), near=near).select("id", "observation_type")


@query
def source_filter(spark, d):
    """The newest readings of one station."""
    return rounded(
        reads.latest_observations_synop(
            _synop(spark, d), source_id=3, limit=1000, tiebreak=TIEBREAK
        )
    )


@query
def active_synop(spark, d):
    return reads.active_synop_stations(_stations(spark, d), AS_OF)


@query
def active_synop_readings(spark, d):
    """Latest readings of the active stations only."""
    active = reads.active_synop_stations(_stations(spark, d), AS_OF)
    table = schemas.OBSERVATIONS_SYNOP
    kept = _synop(spark, d).join(
        active.select(F.col("id").alias("source_id")), "source_id", "left_semi"
    )
    newest = versions.latest(kept, table.key, table.version, TIEBREAK)
    return newest.select("source_id", "timestamp", "event_id", "ingested_at")


@query
def forecast_horizon_stations(spark, d):
    return reads.forecast_stations(_stations(spark, d), AS_OF)


@query
def latest_obs(spark, d):
    return rounded(reads.latest_observations_synop(_synop(spark, d), tiebreak=TIEBREAK))


@query
def latest_forecasts(spark, d):
    return rounded(reads.latest_forecasts(_forecasts(spark, d), tiebreak=TIEBREAK))


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    """The readings under the names of the hourly table."""
    raw = _synop(spark, d)
    return raw.withColumnsRenamed({c: c.removesuffix("_60") for c in raw.columns})


@query
def latest_hourly_obs(spark, d):
    rows = reads.latest_observations(_hourly(spark, d), limit=250, tiebreak=TIEBREAK)
    return rounded(rows)


@query
def one_postal_code(spark, d):
    """Each postal code of a prefix looked up by itself, of the places and of the stored results."""
    place = reads.postal_code(_places(spark, d), "10042")
    staged = _transformed(spark, d, OBSERVATION, prefixes="10042").where("plz = '10042'")
    return rounded(
        place.select("plz", "centroid_lat", "centroid_lon").join(
            staged.groupBy("plz").agg(F.count(F.lit(1)).alias("hours"), F.max("timestamp").alias("last_hour")), "plz", "left"
        )
    )


@query
def head_sample(spark, d):
    """The first hundred current readings in order of station and time."""
    table = schemas.OBSERVATIONS_SYNOP
    current = versions.latest(_synop(spark, d), table.key, table.version, TIEBREAK)
    return rounded(reads.head(current.select("source_id", "timestamp", "temperature"), table, 100))


def _stored_readings(spark: SparkSession, d: str) -> Warehouse:
    """All versions of all readings, a folder for each day."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.append(_synop(spark, d), schemas.OBSERVATIONS_SYNOP, AS_OF)
    return warehouse


@query
def sql_with_parameters(spark, d):
    """SQL text over the stored readings of ten days, which alone are opened."""
    return rounded(
        _stored_readings(spark, d).query(
            "SELECT source_id, count(*) AS hours, count(DISTINCT _date) AS days, avg(temperature) AS temperature "
            "FROM raw_weather_observations_synop WHERE timestamp >= :since AND timestamp < :until "
            "AND temperature > :low GROUP BY source_id",
            since=datetime(2024, 1, 5, 6), until=datetime(2024, 1, 15, 12), low=0.0,
        )
    )


@query
def delete_readings_by_key(spark, d):
    """All versions of every reading of the even stations on three days removed; other days stay as they are."""
    warehouse = _stored_readings(spark, d)
    days = F.to_date("timestamp").isin("2024-01-03", "2024-01-10", "2024-01-20")
    doomed = _synop(spark, d).where(days & (F.col("source_id") % 2 == 0))
    warehouse.delete(schemas.OBSERVATIONS_SYNOP, doomed)
    left = warehouse.scan(schemas.OBSERVATIONS_SYNOP)
    return left.groupBy("source_id", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count("temperature").alias("temperatures")
    )


@query
def typed_rows(spark, d):
    """Whole tables of rows without names, their values in the order of the columns, into each of the seven tables."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    places = _places(spark, d)
    spot = transforms.station_ground(places, _stations(spark, d), "synop")
    given = {
        schemas.POSTAL_CODES: places.withColumn("geometry", F.lit("")),
        schemas.WEATHER_STATIONS: _stations(spark, d),
        schemas.OBSERVATIONS_SYNOP: _synop(spark, d),
        schemas.OBSERVATIONS_HOURLY: _hourly(spark, d),
        schemas.FORECASTS: _forecasts(spark, d),
        schemas.OBSERVATIONS_BY_POSTAL_CODE: transforms.transform(
            _synop(spark, d), spot, OBSERVATION, tiebreak=TIEBREAK, few_days=True
        ),
    }
    written = {}
    for table, df in given.items():
        payload = conform(df, table.payload)
        nameless = payload.toDF(*[f"_{i}" for i in range(len(payload.columns))])
        dealt = table is schemas.OBSERVATIONS_BY_POSTAL_CODE
        written[table.name] = warehouse.append_positional(nameless, table, AS_OF, dealt)
    counts = monitor.table_counts(monitor.warehouse_tables(warehouse))
    returned = F.coalesce(*[F.when(F.col("table") == name, F.lit(n)) for name, n in written.items()], F.lit(0))
    return counts.select("table", "rows", returned.cast("bigint").alias("returned"))


@query
def schema_check(spark, d):
    """Which columns the stored tables have: places and stations written, all others not."""
    warehouse = _stored_stations(spark, d)
    warehouse.append(
        _places(spark, d).withColumn("geometry", F.lit("")), schemas.POSTAL_CODES, AS_OF
    )
    return monitor.schema_report(warehouse)


# -- ingest jobs -------------------------------------------------------------------------------


def _report(report: ingest.Report, stored: DataFrame) -> dict[str, Column]:
    """What a job reported beside what its table holds."""
    held = stored.agg(F.count(F.lit(1)), F.count_distinct("ingested_at")).first()
    told = {
        "written": report.written, "verified": report.verified,
        "rejected": report.rejected.count() if report.rejected is not None else 0,
        "stored": held[0], "versions": held[1],
    }
    return {k: F.lit(v).cast("bigint") for k, v in told.items()}


@query
def ingest_codes_job(spark, d):
    """FeatureCollections, one document for each hundred codes, one of them broken off and one feature without geometry: written,
    read back, and the codes that arrived."""
    features = _features(derive(spark, d, "postal_squares")).withColumn(
        "part", F.floor(F.get_json_object("value", "$.properties.postcode").cast("bigint") / 100)
    )
    parts = features.groupBy("part").agg(F.array_sort(F.collect_list("value")).alias("features"))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", "features"), F.lit("]}"))
    bare = F.lit('{"features":[{"type":"Feature","properties":{"postcode":"99999"},"geometry":null}]}')
    documents = parts.select(text.alias("value")).unionByName(
        spark.range(1).select(F.explode(F.array(bare, F.lit('{"features": [{"type":'))).alias("value"))
    )
    path = scratch_path(spark, "codes")
    documents.repartition(F.col("value")).write.option("maxRecordsPerFile", 1).text(path)
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    report = ingest.ingest_postal_codes(warehouse, path, AS_OF)
    stored = warehouse.read(schemas.POSTAL_CODES)
    return stored.groupBy(F.substring("plz", 1, 3).alias("prefix")).agg(F.count(F.lit(1)).alias("codes")).withColumns(
        _report(report, stored)
    )


def _with_codes(spark: SparkSession, d: str) -> Warehouse:
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    places = _places(spark, d).withColumn("geometry", F.lit(""))
    warehouse.append(places, schemas.POSTAL_CODES, AS_OF)
    return warehouse


def _station_responses(df: DataFrame) -> str:
    fields = [
        _iso(c) if c in ("first_record", "last_record") else F.col(c)
        for c in df.columns if c not in ("ingested_at", "distance")
    ]
    return _land(df, F.struct(F.array(F.struct(*fields)).alias("sources")))


@query
def ingest_stations_job(spark, d):
    """The landed catalogue, kept where it is near one of the codes with two prefixes; verified on reading back."""
    warehouse = _with_codes(spark, d)
    path = _station_responses(transforms.current_stations(_stations(spark, d)))
    report = ingest.ingest_weather_stations(warehouse, path, AS_OF, ["10", "11"], whole_files=False)
    stored = warehouse.read(schemas.WEATHER_STATIONS)
    return stored.select("id", "observation_type", F.round("distance", 2).alias("distance")).withColumns(
        _report(report, stored)
    )


def _with_stations(spark: SparkSession, d: str) -> Warehouse:
    warehouse = _with_codes(spark, d)
    warehouse.append(_stations(spark, d), schemas.WEATHER_STATIONS, AS_OF)
    return warehouse


@query
def ingest_obs_job(spark, d):
    """Landed current weather of the active stations, with broken responses among it, ingested twice: the second run
    is a new version of the same readings."""
    raw = _synop(spark, d)
    fields = [_iso(c) if c == "timestamp" else F.col(c) for c in raw.columns if c != "ingested_at"]
    path = _land(raw, F.struct(F.struct(*fields).alias("weather")))
    spark.range(3).select(F.lit("{ broken").alias("value")).write.mode("append").text(path)
    warehouse = _with_stations(spark, d)
    ingest.ingest_observations(warehouse, path, AS_OF, whole_files=False)
    report = ingest.ingest_observations(warehouse, path, AS_OF + timedelta(hours=1), whole_files=False)
    table = schemas.OBSERVATIONS_SYNOP
    current = warehouse.read(table)
    per_day = current.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("readings"), F.count_distinct("source_id").alias("stations")
    )
    return per_day.withColumns(_report(report, warehouse.scan(table)))


@query
def ingest_forecasts_job(spark, d):
    """Landed forecasts of the stations that reach far enough ahead, a week from the middle of the month."""
    warehouse = _with_stations(spark, d)
    report = ingest.ingest_forecasts(
        warehouse, _land_forecasts(spark, d), MID_MONTH, whole_files=False
    )
    stored = warehouse.scan(schemas.FORECASTS)
    per_day = stored.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("forecasts"), F.count_distinct("forecast_created_at").alias("issues")
    )
    return per_day.withColumns(_report(report, stored))


@query
def staged_forecasts_saved(spark, d):
    """The forecast transform as a job on stored tables, run twice; what it returned and what is stored."""
    warehouse = _with_stations(spark, d)
    warehouse.append(_forecasts(spark, d), schemas.FORECASTS, AS_OF)
    first = ingest.transform_forecasts(warehouse, MID_MONTH)
    second = ingest.transform_forecasts(warehouse, MID_MONTH + timedelta(minutes=10))
    empty = ingest.transform_forecasts(warehouse, datetime(2030, 1, 1))
    table = schemas.FORECASTS_BY_POSTAL_CODE
    return warehouse.read(table).groupBy("plz").agg(F.count(F.lit(1)).alias("hours")).withColumns(
        {
            "first": F.lit(first).cast("bigint"), "second": F.lit(second).cast("bigint"),
            "empty": F.lit(empty).cast("bigint"), "stored": F.lit(warehouse.scan(table).count()).cast("bigint"),
        }
    )


@query
def stations_by_range(spark, d):
    """Stations of overlapping ranges from stored daily sketches; whether each estimate is within three standard errors of the count."""
    raw = _synop(spark, d)
    sketches = materialize(monitor.daily_sketches(raw), "sketches")
    ranges = spark.sql(
        "SELECT * FROM VALUES ('first week', DATE'2024-01-01', DATE'2024-01-08'), ('month', DATE'2024-01-01', DATE'2024-02-01'), "
        "('day', DATE'2024-01-10', DATE'2024-01-11'), ('ahead', DATE'2030-01-01', DATE'2030-02-01') AS r(name, start, stop)"
    )
    told = monitor.sketch_statistics(sketches, ranges)
    day = F.to_date("timestamp")
    exact = raw.join(F.broadcast(ranges), (day >= F.col("start")) & (day < F.col("stop"))).groupBy("name").agg(
        F.count_distinct("source_id").alias("exact")
    )
    error = F.abs(F.col("stations") - F.coalesce("exact", F.lit(0)))
    bound = F.greatest(F.lit(1.0), F.coalesce("exact", F.lit(0)) * (3 * 1.04 / 2 ** (monitor.SKETCH_BITS / 2)))
    return told.join(exact, "name", "left").select(
        "name", "rows", "first_timestamp", "last_timestamp", (error <= bound).alias("within_bound")
    )


# -- landing -----------------------------------------------------------------------------------


def _iso(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ssxxx").alias(column)


def _land(df: DataFrame, response: Column) -> str:
    path = scratch_path(df.sparkSession, "landing")
    df.select(F.to_json(response).alias("value")).write.text(path)
    return path


@query
def conform_stations(spark, d):
    path = _station_responses(_stations(spark, d))
    return landing.read_stations(spark, path, whole_files=False).rows


@query
def conform_obs(spark, d):
    raw = _synop(spark, d)
    fields = [
        _iso(c) if c == "timestamp" else F.col(c)
        for c in raw.columns if c != "ingested_at"
    ]
    response = F.struct(F.struct(*fields).alias("weather"))
    path = _land(raw, response)
    return rounded(landing.read_current_weather(spark, path, whole_files=False).rows)


def _land_forecasts(spark: SparkSession, d: str) -> str:
    """One response per reading; every 29th event tells no issue time."""
    raw = _forecasts(spark, d)
    fields = [
        _iso(c) if c == "timestamp" else F.col(c)
        for c in raw.columns if c not in ("ingested_at", "forecast_created_at")
    ]
    issue = F.struct(_iso("forecast_created_at").alias("first_record"))
    known = F.when(F.col("event_id") % 29 != 0, F.array(issue))
    response = F.struct(F.array(F.struct(*fields)).alias("weather"), known.alias("sources"))
    return _land(raw, response)


@query
def conform_forecasts(spark, d):
    """Readings of the stations that reach far enough ahead, all days."""
    landed = landing.read_forecasts(
        spark, _land_forecasts(spark, d), AS_OF, None,
        reads.forecast_stations(_stations(spark, d), AS_OF), whole_files=False,
    )
    return rounded(landed.rows)


@query
def forecast_issue_time(spark, d):
    """Issue times of the rows in a seven-day request."""
    landed = landing.read_forecasts(
        spark, _land_forecasts(spark, d), MID_MONTH, 7, whole_files=False
    )
    return landed.rows.select("source_id", "timestamp", "forecast_created_at")


# -- monitoring --------------------------------------------------------------------------------


def _raw_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "raw.postal_codes": _places(spark, d),
        "raw.weather_stations": _stations(spark, d),
        "raw.weather_observations_synop": _synop(spark, d),
        "raw.weather_observations": spark.createDataFrame([], schemas.OBSERVATIONS_HOURLY.schema),
        "raw.weather_forecasts": _forecasts(spark, d),
    }


@query
def table_counts(spark, d):
    staged = _transformed(spark, d, OBSERVATION)
    return monitor.table_counts(
        {**_raw_tables(spark, d), "staging.observations_by_postal_code": staged}
    )


@query
def db_status(spark, d):
    return monitor.database_status(_raw_tables(spark, d))


@query
def ingest_stats(spark, d):
    return monitor.ingest_statistics(_synop(spark, d))


@query
def type_frequency(spark, d):
    return monitor.type_frequency(transforms.current_stations(_stations(spark, d)))


@query
def non_null_counts(spark, d):
    return monitor.non_null_counts(
        _synop(spark, d), ["temperature", "precipitation_60", "sunshine_60", "condition"]
    )


@query
def coverage(spark, d):
    start, stop = temporal.lookback(MID_MONTH, 24 * 7)
    staged = _transformed(spark, d, OBSERVATION, as_of=MID_MONTH, span=24 * 7)
    return monitor.coverage(transforms.current_places(_places(spark, d)), staged, start, stop)


@query
def missing_hours(spark, d):
    """The hours of the last day without a result."""
    start, stop = temporal.lookback(MID_MONTH, 24)
    staged = _transformed(spark, d, OBSERVATION, as_of=MID_MONTH, span=24)
    return monitor.missing_hours(
        transforms.current_places(_places(spark, d)), staged, start, stop
    )


@query
def prefix_run_totals(spark, d):
    return monitor.prefix_totals(_transformed(spark, d, OBSERVATION))


# -- streaming ---------------------------------------------------------------------------------


def _landed_stream(df: DataFrame) -> tuple[DataFrame, str]:
    """The table landed as files and read as a stream, and the lateness for it."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream")
    df.write.parquet(path)
    lateness = hourly.whole_span(spark.read.schema(df.schema).parquet(path))
    return hourly.read_landing(spark, path, df.schema), lateness


def _run(stream: DataFrame, mode: str, key: list[str]) -> DataFrame:
    """Run to the end of the landed files and return the last result of each key."""
    spark = stream.sparkSession
    sink = scratch_path(spark, "sink")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").option("compression", "zstd").parquet(sink)

    started = (
        stream.writeStream.outputMode(mode).foreachBatch(keep)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    results = spark.read.parquet(sink)
    # A batch gives a key once, so the results of a single batch are not moved.
    low, high = results.agg(F.min("_batch"), F.max("_batch")).first()
    if low == high:
        return results.drop("_batch")
    return versions.latest(results, key, "_batch", []).drop("_batch")


@query
def hourly_window(spark, d):
    stream, lateness = _landed_stream(_synop(spark, d))
    vocabulary = condition_vocabulary(_synop(spark, d))
    hours = hourly.station_hours(stream, ["temperature", "sunshine_60"], lateness, vocabulary)
    return rounded(_run(hours, "update", ["source_id", "timestamp"]))


@query
def stream_dedup(spark, d):
    """Every reading once, although a tenth is delivered twice."""
    stream, lateness = _landed_stream(_synop(spark, d).select("source_id", "timestamp"))
    once = hourly.drop_redelivered(stream, lateness)
    sink = scratch_path(spark, "sink")
    started = (
        once.writeStream.outputMode("append").format("parquet").option("path", sink)
        .option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True).start()
    )
    started.awaitTermination()
    return spark.read.schema(once.schema).parquet(sink)


@query
def stream_interpolated(spark, d):
    """Stream joined to the static pairs and aggregated in the stream, in update mode."""
    table = schemas.OBSERVATIONS_SYNOP
    newest = versions.latest(_synop(spark, d), table.key, table.version, TIEBREAK)
    pairs = materialize(
        transforms.station_pairs(_places(spark, d), _stations(spark, d), "synop"), "pairs"
    )
    stream, lateness = _landed_stream(newest)
    vocabulary = condition_vocabulary(newest)
    result = hourly.interpolate_stream(stream, pairs, OBSERVATION, lateness, vocabulary=vocabulary)
    return _run(rounded(result), "update", ["plz", "timestamp"])  # rounded, it takes less room in the sink


@query
def stream_fc_by_postal_code(spark, d):
    """Forecasts as they are delivered, the oldest issue of an hour in the first batch and the newest in the last,
    through chained aggregates in append mode; a last reading of no station, long after all others, closes the hours."""
    raw = _forecasts(spark, d).drop("ingested_at")
    pairs = materialize(
        transforms.station_pairs(_places(spark, d), _stations(spark, d), "forecast"), "pairs"
    )
    path = scratch_path(spark, "stream")
    age = (F.unix_timestamp("timestamp") - F.unix_timestamp("forecast_created_at")) / 21600
    for delivery in (2, 1, 0):
        raw.where(age == delivery).coalesce(1).write.mode("append").parquet(path)
    landed = spark.read.schema(raw.schema).parquet(path)
    lateness = hourly.whole_span(landed)
    nothing = {c: F.lit(None).cast(raw.schema[c].dataType) for c in raw.columns}
    last = landed.agg(F.max("timestamp").alias("_last"), F.min("timestamp").alias("_first")).select(
        *[
            {
                "timestamp": F.date_trunc("hour", F.timestamp_seconds(
                    3 * F.unix_timestamp("_last") - 2 * F.unix_timestamp("_first") + 86400)),
                "source_id": F.lit(-1).cast("bigint"),
            }.get(c, nothing[c]).alias(c)
            for c in raw.columns
        ]
    )
    last.where("timestamp IS NOT NULL").coalesce(1).write.mode("append").parquet(path)
    result = hourly.interpolate_stream(
        hourly.read_landing(spark, path, raw.schema, 1), pairs, FORECAST, lateness,
        vocabulary=condition_vocabulary(raw), tiebreak=TIEBREAK,
    )
    return _run(rounded(result), "append", ["plz", "timestamp"])


@query
def stream_landed_obs(spark, d):
    """Landed responses taken in by bounded batches, broken ones among them; the last batch is then
    taken in once more, as after a driver that was lost before it could commit."""
    warehouse = _with_stations(spark, d)
    table = schemas.OBSERVATIONS_SYNOP
    newest = versions.latest(_synop(spark, d), table.key, table.version, TIEBREAK)
    fields = [_iso(c) if c == "timestamp" else F.col(c) for c in newest.columns if c != "ingested_at"]
    path, progress = _land(newest, F.struct(F.struct(*fields).alias("weather"))), scratch_path(spark, "progress")
    spark.range(3).select(F.lit("{ broken").alias("value")).coalesce(1).write.mode("append").text(path)
    ticks = count()

    def run() -> None:
        hourly.landing_readings(
            warehouse, path, OBSERVATION, lambda: AS_OF + timedelta(minutes=next(ticks)), progress,
            whole_files=False, files_per_batch=2,
        ).start().awaitTermination()

    run()
    hourly.forget_last_commit(spark, progress)
    run()
    rejected = spark.read.json(f"{warehouse.root}/rejected/{table.name}").count()
    return rounded(
        warehouse.scan(table).select("source_id", "timestamp", "temperature", "condition", F.lit(rejected).cast("bigint").alias("rejected"))
    )


@query
def stream_obs_by_postal_code(spark, d):
    """Two scheduled runs of the refresh: the readings, then their late corrections."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    warehouse.append(
        _places(spark, d).withColumn("geometry", F.lit("")), schemas.POSTAL_CODES, AS_OF
    )
    warehouse.append(_stations(spark, d), schemas.WEATHER_STATIONS, AS_OF)
    raw = _synop(spark, d)
    corrected = F.col("ingested_at") > F.col("timestamp") + F.expr("INTERVAL 1 HOUR")
    landed, progress = scratch_path(spark, "stream"), scratch_path(spark, "progress")
    ticks = count()

    def clock() -> datetime:
        return AS_OF + timedelta(minutes=next(ticks))

    for part in (raw.where(~corrected), raw.where(corrected)):
        part.write.mode("append").parquet(landed)
        stream = hourly.read_landing(spark, landed, raw.schema)
        run = hourly.refreshing(warehouse, stream, OBSERVATION, clock, progress).start()
        run.awaitTermination()
    return rounded(warehouse.read(schemas.OBSERVATIONS_BY_POSTAL_CODE).drop("created_at"))
