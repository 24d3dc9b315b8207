"""The seven tables: columns, business keys, version columns, partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES = {
    "string": StringType(),
    "double": DoubleType(),
    "bigint": LongType(),
    "boolean": BooleanType(),
    "timestamp": TimestampType(),
}


def _columns(names: str, kind: str, nullable: bool = True) -> list[StructField]:
    return [StructField(n, _TYPES[kind], nullable) for n in names.split()]


@dataclass(frozen=True)
class Table:
    """A versioned table. Rows with equal `key` are versions of each other; the newest one counts."""

    name: str
    key: tuple[str, ...]
    version: str
    schema: StructType
    event_time: str | None = None  # partitioned by its date; otherwise by a bucket of the key

    @property
    def payload(self) -> StructType:
        """The columns a producer delivers; the writer adds the version column."""
        return StructType([f for f in self.schema.fields if f.name != self.version])

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _synop_fields() -> list[StructField]:
    # Fixed column order of the SYNOP table.
    leading = (
        _columns("cloud_cover", "double") + _columns("condition", "string")
        + _columns("dew_point", "double") + _columns("icon", "string")
        + _columns("pressure_msl relative_humidity temperature visibility", "double")
    )
    spans = {
        "precipitation": (10, 30, 60),
        "solar": (10, 30, 60),
        "sunshine": (30, 60),
        "wind_direction": (10, 30, 60),
        "wind_speed": (10, 30, 60),
        "wind_gust_direction": (10, 30, 60),
        "wind_gust_speed": (10, 30, 60),
    }
    return leading + [
        StructField(f"{name}_{minutes}", DoubleType(), True)
        for name, windows in spans.items()
        for minutes in windows
    ]


def _hourly_fields() -> list[StructField]:
    return (
        _columns("cloud_cover", "double") + _columns("condition", "string")
        + _columns("dew_point", "double") + _columns("icon", "string")
        + _columns(
            "precipitation precipitation_probability precipitation_probability_6h pressure_msl "
            "relative_humidity sunshine temperature visibility wind_direction wind_speed "
            "wind_gust_direction wind_gust_speed",
            "double",
        )
    )


_READING_KEY = _columns("source_id", "bigint", False) + _columns("timestamp", "timestamp", False)
_INGESTED = _columns("ingested_at", "timestamp", False)
_CREATED = _columns("created_at", "timestamp", False)
_SUMMARY = (
    _columns("condition", "string")
    + _columns("num_stations", "bigint", False)
    + _columns("data_quality_score", "double", False)
    + _columns("is_validated", "boolean", False)
)

POSTAL_CODES = Table(
    "raw.postal_codes", ("plz",), "ingested_at",
    StructType(
        _columns("plz note geometry", "string", False)
        + _columns("centroid_lon centroid_lat", "double", False)
        + _INGESTED
    ),
)

WEATHER_STATIONS = Table(
    "raw.weather_stations", ("id", "observation_type"), "ingested_at",
    StructType(
        _columns("id", "bigint", False)
        + _columns("dwd_station_id wmo_station_id", "string")
        + _columns("station_name observation_type", "string", False)
        + _columns("lat lon height", "double", False)
        + _columns("distance", "double")
        + _columns("first_record last_record", "timestamp", False)
        + _INGESTED
    ),
)

OBSERVATIONS_SYNOP = Table(
    "raw.weather_observations_synop", ("source_id", "timestamp"), "ingested_at",
    StructType(_READING_KEY + _synop_fields() + _INGESTED), "timestamp",
)

OBSERVATIONS_HOURLY = Table(
    "raw.weather_observations", ("source_id", "timestamp"), "ingested_at",
    StructType(_READING_KEY + _hourly_fields() + _INGESTED), "timestamp",
)

FORECASTS = Table(
    "raw.weather_forecasts", ("source_id", "timestamp", "forecast_created_at"), "ingested_at",
    StructType(
        _READING_KEY + _hourly_fields()
        + _columns("forecast_created_at", "timestamp", False) + _INGESTED
    ),
    "timestamp",
)

OBSERVATIONS_BY_POSTAL_CODE = Table(
    "staging.observations_by_postal_code", ("plz", "timestamp"), "created_at",
    StructType(
        _columns("plz", "string", False) + _columns("timestamp", "timestamp", False)
        + _columns(
            "temperature precipitation relative_humidity wind_speed wind_direction pressure_msl "
            "cloud_cover sunshine",
            "double",
        )
        + _SUMMARY + _CREATED
    ),
    "timestamp",
)

FORECASTS_BY_POSTAL_CODE = Table(
    "staging.forecasts_by_postal_code", ("plz", "timestamp", "forecast_created_at"), "created_at",
    StructType(
        _columns("plz", "string", False)
        + _columns("timestamp forecast_created_at", "timestamp", False)
        + _columns(
            "temperature precipitation precipitation_probability relative_humidity wind_speed "
            "wind_direction pressure_msl cloud_cover sunshine",
            "double",
        )
        + _SUMMARY + _CREATED
    ),
    "timestamp",
)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        POSTAL_CODES, WEATHER_STATIONS, OBSERVATIONS_SYNOP, OBSERVATIONS_HOURLY, FORECASTS,
        OBSERVATIONS_BY_POSTAL_CODE, FORECASTS_BY_POSTAL_CODE,
    )
}
