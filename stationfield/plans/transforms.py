"""Observations and forecasts per postal code."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield import schemas
from stationfield.functions import temporal
from stationfield.functions.quality import (
    DEFAULT_RANGES,
    Ranges,
    add_quality,
    keep_valid,
    nan_to_null,
)
from stationfield.operators import versions
from stationfield.operators.idw import (
    condition_vocabulary,
    count_days,
    interpolate,
    interpolate_runs,
    reading_profile,
)
from stationfield.operators.radius import Ground, ground, radius_join
from stationfield.session import fits, materialize


@dataclass(frozen=True)
class Spec:
    """What tells the observation transform from the forecast transform."""

    station_type: str
    fields: tuple[str, ...]
    renamed: dict[str, str]
    raw: schemas.Table
    staging: schemas.Table
    is_forecast: bool

    def window(self, as_of: datetime, span: int | None = None) -> tuple[datetime, datetime]:
        """Run window: hours back for observations, days ahead for forecasts."""
        if self.is_forecast:
            return temporal.horizon(as_of, 7 if span is None else span)
        return temporal.lookback(as_of, 24 if span is None else span)


_FIELDS = (
    "temperature", "precipitation", "relative_humidity", "wind_speed", "wind_direction",
    "pressure_msl", "cloud_cover", "sunshine",
)

OBSERVATION = Spec(
    "synop", _FIELDS,
    {f: f"{f}_60" for f in ("precipitation", "wind_speed", "wind_direction", "sunshine")},
    schemas.OBSERVATIONS_SYNOP, schemas.OBSERVATIONS_BY_POSTAL_CODE, False,
)

FORECAST = Spec(
    "forecast", (*_FIELDS[:2], "precipitation_probability", *_FIELDS[2:]), {},
    schemas.FORECASTS, schemas.FORECASTS_BY_POSTAL_CODE, True,
)


@dataclass(frozen=True)
class Options:
    radius_km: float = 10.0
    min_stations: int = 1
    ranges: Ranges = DEFAULT_RANGES
    drop_invalid: bool = False
    distinct_stations: bool = False


DEFAULT_OPTIONS = Options()


def current_stations(stations: DataFrame, station_type: str | None = None) -> DataFrame:
    """Latest version per station. The type is part of the key, so it is filtered first."""
    if station_type is not None:
        stations = stations.where(F.col("observation_type") == station_type)
    table = schemas.WEATHER_STATIONS
    return versions.latest(stations, table.key, table.version)


def current_places(postal_codes: DataFrame, prefixes: Sequence[str] | str | None = None) -> DataFrame:
    """Latest version per postal code, of the given prefixes; none or an empty one means all."""
    table = schemas.POSTAL_CODES
    return versions.latest(with_prefix(postal_codes, prefixes), table.key, table.version)


def every_place(prefixes: Sequence[str] | str | None) -> bool:
    return not prefixes or "" in ([prefixes] if isinstance(prefixes, str) else prefixes)


def with_prefix(df: DataFrame, prefixes: Sequence[str] | str | None) -> DataFrame:
    wanted = [prefixes] if isinstance(prefixes, str) else list(prefixes or [])
    if not wanted or "" in wanted:
        return df
    matches = F.lit(False)
    for prefix in wanted:
        matches = matches | F.col("plz").startswith(prefix)
    return df.where(matches)


def station_pairs(
    postal_codes: DataFrame,
    stations: DataFrame,
    station_type: str,
    prefixes: Sequence[str] | str | None = None,
    radius_km: float = 10.0,
) -> DataFrame:
    """plz, source_id, distance_km and the centroid, for the current places and stations."""
    places, located = _located(postal_codes, stations, station_type, prefixes)
    # Written, so that their number is known from the files and the ranking runs once.
    located = materialize(located, "located")
    return radius_join(places, located, radius_km).select(
        "plz", "source_id", "distance_km", "centroid_lat", "centroid_lon"
    )


def _located(
    postal_codes: DataFrame, stations: DataFrame, station_type: str, prefixes: Sequence[str] | str | None
) -> tuple[DataFrame, DataFrame]:
    places = current_places(
        postal_codes.select("plz", "centroid_lat", "centroid_lon", "ingested_at"), prefixes
    ).select("plz", "centroid_lat", "centroid_lon")
    stored = stations.select("id", "observation_type", "lat", "lon", "ingested_at")
    located = current_stations(stored, station_type).select(
        F.col("id").alias("source_id"), "lat", "lon"
    )
    return places, located


def station_ground(
    postal_codes: DataFrame,
    stations: DataFrame,
    station_type: str,
    prefixes: Sequence[str] | str | None = None,
    radius_km: float = 10.0,
) -> Ground:
    """The current places and stations by blocks of ground, for whoever finds their pairs in its tasks."""
    return ground(*_located(postal_codes, stations, station_type, prefixes), radius_km)


def _in_window(raw: DataFrame, spec: Spec, as_of: datetime | None, span: int | None) -> DataFrame:
    ts = F.col("timestamp")
    if as_of is not None:
        raw = raw.where(temporal.between(ts, spec.window(as_of, span)))
    return raw.where(temporal.on_the_hour(ts)) if spec.is_forecast else raw


def run_profile(
    raw: DataFrame, spec: Spec, as_of: datetime | None = None, span: int | None = None
) -> DataFrame:
    """What `interpolate` wants to know of the readings of a run, written once."""
    return reading_profile(_in_window(raw, spec, as_of, span))


def prepare_readings(
    raw: DataFrame,
    spec: Spec,
    as_of: datetime | None = None,
    span: int | None = None,
    tiebreak: Sequence[str] | None = None,
    options: Options = DEFAULT_OPTIONS,
) -> DataFrame:
    """Project, keep the run window, take the latest version (or issue), clean and align to hours.

    `span` is hours back for observations and days ahead for forecasts. Without `as_of` the whole
    table is taken.
    """
    kept = [*spec.raw.key, spec.raw.version, *(tiebreak or [])]
    fields = [F.col(spec.renamed.get(f, f)).alias(f) for f in spec.fields]
    readings = _in_window(raw, spec, as_of, span).select(
        *dict.fromkeys(kept), *fields, "condition"
    )
    if spec.is_forecast:
        readings = versions.latest_issue(readings, tiebreak=tiebreak)
    else:
        readings = versions.latest(readings, spec.raw.key, spec.raw.version, tiebreak)
    cleaned = add_quality(nan_to_null(readings), options.ranges)
    if options.drop_invalid:
        cleaned = keep_valid(cleaned)
    if spec.is_forecast:  # on the hour already; truncated again, its rows would be dealt out again
        return cleaned
    return cleaned.withColumn("timestamp", temporal.hour_of(F.col("timestamp")))


def transform(
    raw: DataFrame,
    pairs: DataFrame | Ground,
    spec: Spec,
    as_of: datetime | None = None,
    span: int | None = None,
    tiebreak: Sequence[str] | None = None,
    options: Options = DEFAULT_OPTIONS,
    profile: DataFrame | None = None,
    few_days: bool = False,
) -> DataFrame:
    """Staging rows without the version column, in the staging column order.

    Readings of stations near no place are left out in the scan stage where the list of the
    others is small enough for it. `profile` is `run_profile` of the same run. `few_days`: see `interpolate`.
    """
    if profile is None:
        profile = run_profile(raw, spec, as_of, span)
    vocabulary = condition_vocabulary(profile)
    listed = pairs.stations if isinstance(pairs, Ground) else pairs
    days = count_days(_in_window(raw, spec, as_of, span)) if isinstance(pairs, Ground) else None
    if fits(listed):
        raw = raw.join(F.broadcast(listed.select("source_id").distinct()), "source_id", "left_semi")
    readings = prepare_readings(raw, spec, as_of, span, tiebreak, options)
    result = interpolate(
        readings, pairs, spec.fields, options.min_stations, options.ranges, vocabulary, profile,
        options.distinct_stations, days, few_days,
    )
    extra = ["distinct_stations"] if options.distinct_stations else []
    return result.select(*spec.staging.payload.fieldNames(), *extra)


def newest_of_runs(
    runs: Sequence[DataFrame],
    spot: Ground,
    spec: Spec = FORECAST,
    tiebreak: Sequence[str] | None = None,
    options: Options = DEFAULT_OPTIONS,
) -> DataFrame | None:
    """The rows of `transform` of each run of forecasts, of which the newest issue of a postal code and hour stays, of equal
    issues the last run's. All runs meet the places in the same parts, where the issue is chosen, so that no result is moved. None
    where conditions are too many for a vocabulary."""
    every = reduce(DataFrame.unionByName, runs)
    profile = run_profile(every, spec)
    vocabulary = condition_vocabulary(profile)
    if vocabulary is None:
        return None
    days = count_days(_in_window(every, spec, None, None))
    if fits(spot.stations):
        near = F.broadcast(spot.stations.select("source_id").distinct())
        runs = [r.join(near, "source_id", "left_semi") for r in runs]
    readings = [prepare_readings(r, spec, tiebreak=tiebreak, options=options) for r in runs]
    result = interpolate_runs(
        readings, spot, spec.fields, options.min_stations, options.ranges, vocabulary, profile, days
    )
    return result.select(*spec.staging.payload.fieldNames())


def transform_tables(
    postal_codes: DataFrame,
    stations: DataFrame,
    raw: DataFrame,
    spec: Spec,
    prefixes: Sequence[str] | str | None = None,
    as_of: datetime | None = None,
    span: int | None = None,
    tiebreak: Sequence[str] | None = None,
    options: Options = DEFAULT_OPTIONS,
    few_days: bool = False,
) -> DataFrame:
    """The whole transform from the three raw tables.

    The places and stations by blocks and the profile of the readings have nothing in common, so their jobs run beside
    each other; both are written once and reread. Places of prefixes alone are few: their pairs are written.
    """
    with ThreadPoolExecutor(1) as beside:
        profile = beside.submit(run_profile, raw, spec, as_of, span)
        if every_place(prefixes):
            near = station_ground(postal_codes, stations, spec.station_type, None, options.radius_km)
        else:
            near = materialize(
                station_pairs(postal_codes, stations, spec.station_type, prefixes, options.radius_km), "pairs"
            )
    return transform(raw, near, spec, as_of, span, tiebreak, options, profile.result(), few_days)
