"""The registered queries as plain SQL over the given tables, for comparison in DuckDB.

The SQL is written from the definitions, without cells, sums or codes: brute-force joins, direct
weighted means, and ranks.
"""

from __future__ import annotations

from stationfield import schemas
from stationfield.sources.fixtures import duckdb_text

ORACLE: dict[str, str] = {}

FIELDS = [
    "temperature", "precipitation", "relative_humidity", "wind_speed", "wind_direction",
    "pressure_msl", "cloud_cover", "sunshine",
]
FC_FIELDS = [*FIELDS[:2], "precipitation_probability", *FIELDS[2:]]
SIXTY = {"precipitation", "wind_speed", "wind_direction", "sunshine"}


def _ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _r(expr: str, name: str) -> str:
    return f"round_even(({expr}) * 1.0E6, 0) / 1.0E6 + 0.0E0 AS {name}"


PLACES = f"pc AS ({duckdb_text('postal_codes')})"
STATIONS = f"all_stations AS ({duckdb_text('weather_stations')})"
SYNOP = f"synop AS ({duckdb_text('weather_observations_synop')})"
FORECASTS = f"fc AS ({duckdb_text('weather_forecasts')})"
CURRENT = """st AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY id, observation_type ORDER BY ingested_at DESC) AS rn FROM all_stations) WHERE rn = 1)"""


def _distance(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"6371.0E0 * acos(least(1.0E0, greatest(-1.0E0, "
        f"cos(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2}) - radians({lon1})) "
        f"+ sin(radians({lat1})) * sin(radians({lat2})))))"
    )


def _pairs(kind: str | None, where: str = "TRUE", radius: str = "10.0E0") -> str:
    typed = f"s.observation_type = '{kind}'" if kind else "TRUE"
    distance = _distance("p.centroid_lat", "p.centroid_lon", "s.lat", "s.lon")
    return f"""pairs AS (SELECT * FROM (
  SELECT p.plz, s.id AS source_id, s.station_name, s.observation_type, {distance} AS distance_km
  FROM pc p, st s WHERE {typed} AND {where}) WHERE distance_km <= {radius})"""


PENALTY = {
    "temperature": (-30, 50, 0.5), "precipitation": (0, 200, 0.5),
    "relative_humidity": (0, 100, 0.7), "wind_speed": (0, 200, 0.7),
    "pressure_msl": (800, 1100, 0.7),
}


def _ok(field: str, missing: str = "TRUE", slack: str = "") -> str:
    low, high, _ = PENALTY[field]
    bounds = f"{low}.0E0 - {slack} AND {high}.0E0 + {slack}" if slack else f"{low}.0E0 AND {high}.0E0"
    return f"coalesce({field} BETWEEN {bounds}, {missing})"


def _valid(missing: str = "TRUE") -> str:
    return "(" + " AND ".join(_ok(f, missing) for f in PENALTY) + ")"


def _score(missing: str = "TRUE") -> str:
    factors = [
        f"(CASE WHEN {_ok(f, missing)} THEN 1.0E0 ELSE {p}E0 END)" for f, (_, _, p) in PENALTY.items()
    ]
    absent = " + ".join(
        f"(CASE WHEN {f} IS NULL THEN 1.0E0 ELSE 0.0E0 END)"
        for f in ("temperature", "precipitation", "relative_humidity")
    )
    return " * ".join(factors) + f" * (0.7E0 + 0.3E0 * (1.0E0 - ({absent}) / 3.0E0))"


PROBABLE = "coalesce(precipitation_probability BETWEEN 0.0E0 AND 100.0E0, TRUE)"


def _renamed() -> str:
    return ", ".join(f"{f}_60 AS {f}" if f in SIXTY else f for f in FIELDS)


def _readings(
    spec: str, where: str = "TRUE", tie: str = "event_id DESC", missing: str = "TRUE",
    keep: str = "TRUE",
) -> str:
    """Latest version (or issue) of each reading with its quality, aligned to the hour."""
    if spec == "obs":
        source = f"""SELECT source_id, timestamp, event_id, ingested_at, {_renamed()}, condition
          FROM synop WHERE {where}"""
        order, hour, valid = "ingested_at DESC", "date_trunc('hour', timestamp)", _valid(missing)
        issue = ""
    else:
        source = f"SELECT * FROM fc WHERE timestamp = date_trunc('hour', timestamp) AND {where}"
        order, hour = "forecast_created_at DESC, ingested_at DESC", "timestamp"
        valid, issue = f"{_valid(missing)} AND {PROBABLE}", "forecast_created_at,"
    fields = ", ".join(FIELDS if spec == "obs" else FC_FIELDS)
    return f"""readings AS (SELECT * FROM (
  SELECT source_id, {hour} AS timestamp, {issue} {fields}, condition,
    {_score(missing)} AS quality_score, {valid} AS is_valid
  FROM (SELECT *, row_number() OVER (PARTITION BY source_id, timestamp ORDER BY {order}, {tie}) AS rn
        FROM ({source})) WHERE rn = 1) WHERE {keep})"""


def _interpolated(
    spec: str, minimum: int = 1, missing: str = "TRUE", fields: list[str] | None = None,
    name: str = "result",
) -> str:
    fields = fields or (FIELDS if spec == "obs" else FC_FIELDS)
    means = ",\n    ".join(
        f"sum({f} * w) / sum(CASE WHEN {f} IS NOT NULL THEN w END) AS {f}" for f in fields
    )
    issue = "max(forecast_created_at) AS forecast_created_at," if spec == "fc" else ""
    carried = "forecast_created_at," if spec == "fc" else ""
    checked = " AND ".join(
        _ok(f, missing, "1.0E-9") for f in PENALTY if f in fields
    )
    return f"""joined AS (SELECT r.*, p.plz, 1.0E0 / (p.distance_km + 0.1E0) AS w
  FROM readings r JOIN pairs p ON r.source_id = p.source_id),
means AS (SELECT plz, timestamp, {issue}
    {means},
    count(*) AS num_stations, avg(quality_score) * least(count(*) / 3.0E0, 1.0E0) AS data_quality_score
  FROM joined GROUP BY plz, timestamp HAVING count(*) >= {minimum}),
votes AS (SELECT plz, timestamp, condition, row_number() OVER (
    PARTITION BY plz, timestamp ORDER BY count(*) DESC, condition) AS place
  FROM joined WHERE condition IS NOT NULL GROUP BY plz, timestamp, condition),
{name} AS (SELECT m.plz, m.timestamp, {carried} {", ".join(fields)}, v.condition,
    num_stations, data_quality_score, ({checked}) AS is_validated
  FROM means m LEFT JOIN votes v ON v.plz = m.plz AND v.timestamp = m.timestamp AND v.place = 1)"""


def _shown(spec: str) -> str:
    fields = FIELDS if spec == "obs" else FC_FIELDS
    issue = "forecast_created_at, " if spec == "fc" else ""
    return (
        f"SELECT plz, timestamp, {issue}" + ", ".join(_r(f, f) for f in fields)
        + ", condition, num_stations, " + _r("data_quality_score", "data_quality_score")
        + ", is_validated FROM result"
    )


def _staged(spec: str, pairs_where: str = "TRUE", minimum: int = 1, **readings: str) -> str:
    raw = SYNOP if spec == "obs" else FORECASTS
    kind = "synop" if spec == "obs" else "forecast"
    return _ctes(
        PLACES, STATIONS, CURRENT, raw, _pairs(kind, pairs_where), _readings(spec, **readings),
        _interpolated(spec, minimum, readings.get("missing", "TRUE")),
    )


PREFIXED = "(p.plz LIKE '10%' OR p.plz LIKE '11%' OR p.plz LIKE '12%')"


def _range(start: str, stop: str) -> str:
    return f"timestamp >= TIMESTAMP '{start}' AND timestamp < TIMESTAMP '{stop}'"


# Windows of a run at 2024-01-15 06:30.
DAY_BACK = _range("2024-01-14 07:00:00", "2024-01-15 07:00:00")
WEEK_BACK = _range("2024-01-08 07:00:00", "2024-01-15 07:00:00")
WEEK_AHEAD = _range("2024-01-15 06:00:00", "2024-01-22 06:00:00")
WEEK_OF_DAYS = _range("2024-01-15 00:00:00", "2024-01-22 00:00:00")

ORACLE["obs_by_postal_code"] = _staged("obs") + _shown("obs")
ORACLE["fc_by_postal_code"] = _staged("fc") + _shown("fc")
ORACLE["obs_lookback_run"] = _staged("obs", PREFIXED, 2, where=DAY_BACK) + _shown("obs")
ORACLE["obs_valid_readings_only"] = (
    _staged("obs", missing="FALSE", keep="is_valid") + _shown("obs")
)
ORACLE["forecast_horizon_refresh"] = _staged("fc", where=WEEK_AHEAD) + _shown("fc")
# The second run holds the newest issue of every key of the first.
ORACLE["current_forecast"] = ORACLE["fc_by_postal_code"]

ORACLE["nearby_stations"] = _ctes(PLACES, STATIONS, CURRENT, _pairs(None)) + (
    "SELECT plz, source_id, station_name, observation_type, round(distance_km, 5) AS distance_km "
    "FROM pairs"
)
ORACLE["nearest_station_rank"] = _ctes(PLACES, STATIONS, CURRENT, _pairs("synop")) + (
    "SELECT plz, source_id, row_number() OVER (PARTITION BY plz ORDER BY distance_km, source_id) "
    "AS distance_rank FROM pairs"
)
ORACLE["station_discovery"] = _ctes(PLACES, STATIONS, CURRENT, _pairs(None)) + (
    "SELECT source_id AS id, station_name, observation_type, "
    "round(distance_km * 1000.0E0, 2) AS distance FROM (SELECT *, row_number() OVER ("
    "PARTITION BY source_id ORDER BY plz) AS rn FROM pairs) WHERE rn = 1"
)
_POINT = _distance("lat", "lon", "52.52E0", "13.40E0")
ORACLE["great_circle_sql"] = _ctes(STATIONS, CURRENT) + (
    f"SELECT id, round({_POINT}, 6) AS distance_km, "
    f"round(1.0E0 / ({_POINT} + 0.1E0), 6) AS weight FROM st"
)
ORACLE["postal_centroids"] = (
    "SELECT plz, '' AS note, "
    + _r("CASE WHEN has_hole THEN lon0 + (lon1 - lon0) / 4.0E0 ELSE (lon0 + lon1) / 2.0E0 END",
         "centroid_lon")
    + ", "
    + _r("degrees(asin((sin(radians(lat0)) + sin(radians(lat1))) / 2.0E0))", "centroid_lat")
    + f" FROM ({duckdb_text('postal_squares')})"
)

E2 = "0.00669437999014132E0"


def _height(lat: str) -> str:
    """The cylindrical equal-area plane of the ellipsoid."""
    sine, e = f"sin(radians({lat}))", f"sqrt({E2})"
    return (
        f"((1.0E0 - {E2}) / 2.0E0 * ({sine} / (1.0E0 - {E2} * {sine} * {sine}) "
        f"- ln((1.0E0 - {e} * {sine}) / (1.0E0 + {e} * {sine})) / (2.0E0 * {e})))"
    )


def _ellipsoid_centroid(points: str, name: str, lon: str, lat: str) -> str:
    """Shoelace sums in the plane; the latitude is found by Newton's steps from the height."""
    step = (
        f"lat + degrees((h - {_height('lat')}) * power(1.0E0 - {E2} * power(sin(radians(lat)), 2), 2) "
        f"/ ((1.0E0 - {E2}) * cos(radians(lat))))"
    )
    return f"""{name}_plane AS (SELECT *, radians(x - lon) AS px, {_height('y')} - {_height('lat')} AS py FROM {points}),
{name}_edges AS (SELECT *, lead(px) OVER w AS qx, lead(py) OVER w AS qy FROM {name}_plane
  WINDOW w AS (PARTITION BY plz, hole ORDER BY corner, piece)),
{name}_rings AS (SELECT plz, hole, lon, lat, sum(px * qy - qx * py) AS a, sum((px + qx) * (px * qy - qx * py)) AS mx,
  sum((py + qy) * (px * qy - qx * py)) AS my FROM {name}_edges WHERE qx IS NOT NULL GROUP BY ALL),
{name}_sums AS (SELECT plz, lon, lat, sum(sign(a) * CASE WHEN hole THEN -a ELSE a END) AS a,
  sum(sign(a) * CASE WHEN hole THEN -mx ELSE mx END) AS mx, sum(sign(a) * CASE WHEN hole THEN -my ELSE my END) AS my
  FROM {name}_rings GROUP BY ALL),
{name}_0 AS (SELECT plz, lon + degrees(mx / a / 3.0E0) AS {lon}, {_height('lat')} + my / a / 3.0E0 AS h, lat FROM {name}_sums),
{name}_1 AS (SELECT plz, {lon}, h, {step} AS lat FROM {name}_0),
{name}_2 AS (SELECT plz, {lon}, h, {step} AS lat FROM {name}_1),
{name}_3 AS (SELECT plz, {lon}, h, {step} AS lat FROM {name}_2),
{name} AS (SELECT plz, {lon}, {step} AS {lat} FROM {name}_3)"""


ORACLE["centroid_ellipsoid"] = _ctes(
    f"shapes AS ({duckdb_text('postal_shapes')})",
    """corners AS (SELECT s.*, r.hole, c.corner, 0 AS piece,
    s.lon + s.half_width * c.across * r.size + s.slant * s.half_height * c.up * r.size AS x,
    s.lat + s.half_height * c.up * r.size + s.tilt * s.half_width * c.across * r.size AS y
  FROM shapes s, (VALUES (FALSE, 1.0E0), (TRUE, 0.5E0)) r(hole, size),
    (VALUES (0, -1, -1), (1, 1, -1), (2, 1, 1), (3, -1, 1), (4, -1, -1)) c(corner, across, up)
  WHERE s.has_hole OR NOT r.hole)""",
    """sides AS (SELECT *, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM corners
  WINDOW w AS (PARTITION BY plz, hole ORDER BY corner))""",
    """cut AS (SELECT *, CAST(coalesce(greatest(1, ceil(greatest(abs(x2 - x), abs(y2 - y)) / 0.25E0)), 1) AS BIGINT) AS n FROM sides)""",
    """pieces AS (SELECT plz, lon, lat, hole, corner, k AS piece, x + coalesce(x2 - x, 0.0E0) * k / n AS x,
    y + coalesce(y2 - y, 0.0E0) * k / n AS y FROM (SELECT *, unnest(range(n)) AS k FROM cut))""",
    _ellipsoid_centroid("corners", "plain", "centroid_lon", "centroid_lat"),
    _ellipsoid_centroid("pieces", "smooth", "edges_lon", "edges_lat"),
) + (
    "SELECT p.plz, " + ", ".join(_r(c, c) for c in ("centroid_lon", "centroid_lat", "edges_lon", "edges_lat"))
    + " FROM plain p JOIN smooth s ON s.plz = p.plz"
)

_DAY = ["temperature", "wind_speed", "sunshine"]
ORACLE["idw_mean"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop"), _readings("obs"),
    """joined AS (SELECT p.plz, date_trunc('day', r.timestamp) AS day, r.temperature, r.wind_speed,
  r.sunshine, 1.0E0 / (p.distance_km + 0.1E0) AS w
  FROM readings r JOIN pairs p ON r.source_id = p.source_id)""",
) + "SELECT plz, CAST(day AS TIMESTAMP) AS day, " + ", ".join(
    _r(f"sum({f} * w) / sum(CASE WHEN {f} IS NOT NULL THEN w END)", f) for f in _DAY
) + " FROM joined GROUP BY plz, day"

ORACLE["idw_many_pairs"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop", radius="25.0E0"), _readings("obs"), _interpolated("obs"),
    "stations AS (SELECT plz, timestamp, count(DISTINCT source_id) AS n FROM joined GROUP BY plz, timestamp)",
) + (
    "SELECT r.plz, r.timestamp, " + _r("temperature", "temperature") + ", " + _r("pressure_msl", "pressure_msl")
    + ", condition, num_stations, s.n AS distinct_stations FROM result r JOIN stations s "
    "ON s.plz = r.plz AND s.timestamp = r.timestamp"
)

ORACLE["condition_mode"] = _ctes(
    SYNOP,
    """days AS (SELECT source_id, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS day, condition
  FROM synop)""",
    """votes AS (SELECT source_id, day, condition, row_number() OVER (PARTITION BY source_id, day
  ORDER BY count(*) DESC, condition) AS place
  FROM days WHERE condition IS NOT NULL GROUP BY source_id, day, condition)""",
) + """SELECT k.source_id, k.day, v.condition FROM (SELECT DISTINCT source_id, day FROM days) k
LEFT JOIN votes v ON v.source_id = k.source_id AND v.day = k.day AND v.place = 1"""

_ALL_ROWS = f"""rows_ AS (SELECT source_id, timestamp, event_id, ingested_at, {_renamed()}
  FROM synop)"""
ORACLE["quality_score"] = _ctes(SYNOP, _ALL_ROWS) + (
    f"SELECT event_id, ingested_at, {_r(_score(), 'quality_score')} FROM rows_"
)
ORACLE["quality_score_sql"] = ORACLE["quality_score"]
ORACLE["row_validity"] = _ctes(SYNOP, _ALL_ROWS) + (
    f"SELECT event_id, ingested_at, {_valid()} AS is_valid FROM rows_"
)
ORACLE["valid_rows_only"] = _ctes(SYNOP, _ALL_ROWS) + (
    "SELECT event_id, ingested_at, "
    + ", ".join(_r(f, f) for f in ("temperature", "precipitation", "pressure_msl"))
    + f" FROM rows_ WHERE {_valid()}"
)
ORACLE["forecast_validity"] = _ctes(FORECASTS) + (
    f"SELECT event_id, forecast_created_at, {_valid()} AND {PROBABLE} AS is_valid, "
    f"{_r(_score(), 'quality_score')} FROM fc"
)

STATION_COLUMNS = ", ".join(schemas.WEATHER_STATIONS.columns)
OBS_NUMBERS = [
    "cloud_cover", "pressure_msl", "relative_humidity", "temperature", "precipitation_60",
    "sunshine_60", "wind_direction_60", "wind_speed_60",
]
_OBS_SHOWN = "source_id, timestamp, event_id, condition, ingested_at, " + ", ".join(
    _r(f, f) for f in OBS_NUMBERS
)
_FC_SHOWN = (
    "source_id, timestamp, event_id, condition, forecast_created_at, ingested_at, "
    + ", ".join(_r(f, f) for f in FC_FIELDS)
)
LATEST_OBS = """newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, timestamp
  ORDER BY ingested_at DESC, event_id DESC) AS rn FROM synop) WHERE rn = 1)"""
ORACLE["latest_version_stations"] = _ctes(STATIONS, CURRENT) + f"SELECT {STATION_COLUMNS} FROM st"
ORACLE["latest_version_obs"] = _ctes(SYNOP, LATEST_OBS) + f"SELECT {_OBS_SHOWN} FROM newest"
ORACLE["latest_forecast_issue"] = _ctes(FORECASTS) + (
    f"SELECT {_FC_SHOWN} FROM (SELECT *, row_number() OVER (PARTITION BY source_id, timestamp "
    "ORDER BY forecast_created_at DESC, ingested_at DESC, event_id DESC) AS rn FROM fc) WHERE rn = 1"
)
ORACLE["upsert_result"] = ORACLE["latest_version_stations"]
ORACLE["delete_by_key"] = _ctes(STATIONS) + (
    f"SELECT {STATION_COLUMNS} FROM all_stations WHERE observation_type <> 'forecast'"
)

ORACLE["postal_prefix"] = _ctes(PLACES) + (
    f"SELECT plz, note, {_r('centroid_lat', 'centroid_lat')}, {_r('centroid_lon', 'centroid_lon')}, "
    "ingested_at FROM pc WHERE plz LIKE '10%' ORDER BY plz"
)
ORACLE["stations_by_type"] = _ctes(STATIONS, CURRENT) + (
    f"SELECT {STATION_COLUMNS} FROM st WHERE observation_type = 'synop' ORDER BY id"
)
ORACLE["stations_near_prefix"] = _ctes(
    PLACES, STATIONS, CURRENT, _pairs(None, "(p.plz LIKE '10%' OR p.plz LIKE '12%')")
) + "SELECT DISTINCT source_id AS id, observation_type FROM pairs"
_ACTIVE = "observation_type = 'synop' AND CAST(last_record AS DATE) >= DATE '2024-01-31'"
ORACLE["source_filter"] = _ctes(SYNOP, LATEST_OBS) + (
    f"SELECT {_OBS_SHOWN} FROM newest WHERE source_id = 3 ORDER BY timestamp DESC LIMIT 1000"
)
ORACLE["active_synop"] = _ctes(STATIONS, CURRENT) + (
    f"SELECT {STATION_COLUMNS} FROM st WHERE {_ACTIVE}"
)
ORACLE["active_synop_readings"] = _ctes(STATIONS, CURRENT, SYNOP, LATEST_OBS) + (
    "SELECT source_id, timestamp, event_id, ingested_at FROM newest "
    f"WHERE source_id IN (SELECT id FROM st WHERE {_ACTIVE})"
)
_REACHING = (
    "observation_type = 'forecast' AND last_record >= TIMESTAMP '2024-01-31 00:00:00' "
    "+ INTERVAL '8' DAY"
)
ORACLE["forecast_horizon_stations"] = _ctes(STATIONS, CURRENT) + (
    f"SELECT {STATION_COLUMNS} FROM st WHERE {_REACHING}"
)
ORACLE["latest_obs"] = _ctes(SYNOP, LATEST_OBS) + (
    f"SELECT {_OBS_SHOWN} FROM newest ORDER BY timestamp DESC, source_id LIMIT 100"
)
ORACLE["latest_forecasts"] = _ctes(FORECASTS) + (
    f"SELECT {_FC_SHOWN} FROM (SELECT *, row_number() OVER ("
    "PARTITION BY source_id, timestamp, forecast_created_at "
    "ORDER BY ingested_at DESC, event_id DESC) AS rn FROM fc) WHERE rn = 1 "
    "ORDER BY forecast_created_at DESC, timestamp DESC, source_id LIMIT 100"
)

ORACLE["conform_stations"] = _ctes(STATIONS) + (
    "SELECT " + ", ".join(schemas.WEATHER_STATIONS.payload.fieldNames()) + " FROM all_stations"
)


def _payload(table: schemas.Table, present: list[str]) -> str:
    """All columns of the payload; the ones the wire lacks are null."""
    kinds = {f.name: f.dataType.simpleString() for f in table.payload.fields}
    shown = []
    for name, kind in kinds.items():
        if kind != "double":
            shown.append(name if name in present else f"CAST(NULL AS VARCHAR) AS {name}")
        elif name in present:
            shown.append(_r(name, name))
        else:
            shown.append(f"CAST(NULL AS DOUBLE) AS {name}")
    return ", ".join(shown)


def _first_of_batch(key: str, table: schemas.Table, present: list[str], source: str) -> str:
    order = ", ".join(
        f"{f} ASC NULLS LAST" for f in table.payload.fieldNames()
        if f in present and f not in key.split(", ")
    )
    return (
        f"SELECT {_payload(table, present)} FROM (SELECT *, row_number() OVER (PARTITION BY {key} "
        f"ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


ORACLE["conform_obs"] = _ctes(SYNOP) + _first_of_batch(
    "source_id, timestamp", schemas.OBSERVATIONS_SYNOP,
    ["source_id", "timestamp", "condition", *OBS_NUMBERS], "synop",
)


def _issued(as_of: str) -> str:
    return f"""issued AS (SELECT * EXCLUDE (forecast_created_at), CASE WHEN event_id % 29 = 0
  THEN TIMESTAMP '{as_of}' ELSE forecast_created_at END AS forecast_created_at FROM fc)"""


ORACLE["conform_forecasts"] = _ctes(
    STATIONS, CURRENT, FORECASTS, _issued("2024-01-31 00:00:00"),
    f"kept AS (SELECT * FROM issued WHERE source_id IN (SELECT id FROM st WHERE {_REACHING}))",
) + _first_of_batch(
    "source_id, timestamp, forecast_created_at", schemas.FORECASTS,
    ["source_id", "timestamp", "condition", "forecast_created_at", *FC_FIELDS], "kept",
)
ORACLE["forecast_issue_time"] = _ctes(FORECASTS, _issued("2024-01-15 06:30:00")) + (
    f"SELECT DISTINCT source_id, timestamp, forecast_created_at FROM issued WHERE {WEEK_OF_DAYS}"
)


def _counted(table: str, source: str, key: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", (SELECT count(*) FROM {source}) AS rows, "
        f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {source})) AS distinct_keys"
    )


ORACLE["table_counts"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, FORECASTS, _pairs("synop"), _readings("obs"),
    "result AS (SELECT DISTINCT p.plz, r.timestamp FROM readings r JOIN pairs p "
    "ON r.source_id = p.source_id)",
) + " UNION ALL ".join(
    [
        _counted("raw.postal_codes", "pc", "plz"),
        _counted("raw.weather_stations", "all_stations", "id, observation_type"),
        _counted("raw.weather_observations_synop", "synop", "source_id, timestamp"),
        "SELECT 'raw.weather_observations' AS \"table\", 0 AS rows, 0 AS distinct_keys",
        _counted("raw.weather_forecasts", "fc", "source_id, timestamp, forecast_created_at"),
        _counted("staging.observations_by_postal_code", "result", "plz, timestamp"),
    ]
)


def _status(table: str, source: str, timed: bool) -> list[str]:
    metrics = {"rows": "CAST(count(*) AS VARCHAR)"}
    text = "strftime({}, '%Y-%m-%d %H:%M:%S')"
    metrics["latest_ingestion"] = text.format("max(ingested_at)")
    if timed:
        metrics["first_timestamp"] = text.format("min(timestamp)")
        metrics["last_timestamp"] = text.format("max(timestamp)")
    return [
        f"SELECT '{table}' AS \"table\", '{m}' AS metric, {e} AS value FROM {source}"
        for m, e in metrics.items()
    ]


ORACLE["db_status"] = _ctes(PLACES, STATIONS, SYNOP, FORECASTS) + " UNION ALL ".join(
    [
        *_status("raw.postal_codes", "pc", False),
        *_status("raw.weather_stations", "all_stations", False),
        *_status("raw.weather_observations_synop", "synop", True),
        "SELECT 'raw.weather_observations' AS \"table\", 'rows' AS metric, '0' AS value",
        *_status("raw.weather_forecasts", "fc", True),
    ]
)
ORACLE["ingest_stats"] = _ctes(SYNOP) + (
    "SELECT count(*) AS rows, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp, "
    "count(DISTINCT source_id) AS stations FROM synop"
)
ORACLE["type_frequency"] = _ctes(STATIONS, CURRENT) + (
    "SELECT observation_type, count(*) AS stations FROM st GROUP BY observation_type"
)
ORACLE["non_null_counts"] = _ctes(SYNOP) + " UNION ALL ".join(
    f"SELECT '{f}' AS field, count({f}) AS non_null FROM synop"
    for f in ("temperature", "precipitation_60", "sunshine_60", "condition")
)
_PRODUCED = """produced AS (SELECT DISTINCT p.plz, r.timestamp
  FROM readings r JOIN pairs p ON r.source_id = p.source_id)"""
ORACLE["coverage"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop"), _readings("obs", WEEK_BACK), _PRODUCED
) + """SELECT pc.plz, CAST(168 AS BIGINT) AS expected_hours, count(x.timestamp) AS produced_hours,
  168 - count(x.timestamp) AS missing_hours
FROM pc LEFT JOIN produced x ON x.plz = pc.plz GROUP BY pc.plz"""
ORACLE["missing_hours"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop"), _readings("obs", DAY_BACK), _PRODUCED,
    """hours AS (SELECT unnest(range(TIMESTAMP '2024-01-14 07:00:00', TIMESTAMP '2024-01-15 07:00:00',
  INTERVAL '1' HOUR)) AS timestamp)""",
) + """SELECT pc.plz, h.timestamp FROM pc CROSS JOIN hours h
WHERE NOT EXISTS (SELECT 1 FROM produced x WHERE x.plz = pc.plz AND x.timestamp = h.timestamp)"""
ORACLE["prefix_run_totals"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop"), _readings("obs"), _PRODUCED
) + "SELECT left(plz, 2) AS prefix, count(*) AS rows FROM produced GROUP BY left(plz, 2)"

ORACLE["hourly_window"] = _ctes(
    SYNOP,
    """hours AS (SELECT source_id, date_trunc('hour', timestamp) AS timestamp, temperature,
  sunshine_60, condition FROM synop)""",
    """votes AS (SELECT source_id, timestamp, condition, row_number() OVER (
  PARTITION BY source_id, timestamp ORDER BY count(*) DESC, condition) AS place
  FROM hours WHERE condition IS NOT NULL GROUP BY source_id, timestamp, condition)""",
    """sums AS (SELECT source_id, timestamp, count(*) AS rows, avg(temperature) AS temperature,
  avg(sunshine_60) AS sunshine_60 FROM hours GROUP BY source_id, timestamp)""",
) + (
    f"SELECT s.source_id, s.timestamp, s.rows, {_r('s.temperature', 'temperature')}, "
    f"{_r('s.sunshine_60', 'sunshine_60')}, v.condition FROM sums s LEFT JOIN votes v "
    "ON v.source_id = s.source_id AND v.timestamp = s.timestamp AND v.place = 1"
)
ORACLE["stream_dedup"] = _ctes(SYNOP) + "SELECT DISTINCT source_id, timestamp FROM synop"
ORACLE["stream_interpolated"] = ORACLE["obs_by_postal_code"]
ORACLE["stream_fc_by_postal_code"] = ORACLE["fc_by_postal_code"]
# The stored table has no event number: equal versions are decided by the remaining columns.
_BY_VALUES = ", ".join(f"{f} DESC NULLS LAST" for f in [*FIELDS, "condition"])
ORACLE["stream_obs_by_postal_code"] = _staged("obs", tie=_BY_VALUES) + _shown("obs")

_HOURLY_SHOWN = "source_id, timestamp, event_id, condition, ingested_at, " + ", ".join(
    _r(f, f.removesuffix("_60")) for f in OBS_NUMBERS
)
ORACLE["latest_hourly_obs"] = _ctes(SYNOP, LATEST_OBS) + (
    f"SELECT {_HOURLY_SHOWN} FROM newest ORDER BY timestamp DESC, source_id LIMIT 250"
)
ORACLE["one_postal_code"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, _pairs("synop"), _readings("obs"), _PRODUCED
) + (
    f"SELECT pc.plz, {_r('any_value(centroid_lat)', 'centroid_lat')}, {_r('any_value(centroid_lon)', 'centroid_lon')}, "
    "CASE WHEN count(x.timestamp) > 0 THEN count(x.timestamp) END AS hours, max(x.timestamp) AS last_hour "
    "FROM pc LEFT JOIN produced x ON x.plz = pc.plz WHERE pc.plz = '10042' GROUP BY pc.plz"
)
ORACLE["head_sample"] = _ctes(SYNOP, LATEST_OBS) + (
    f"SELECT source_id, timestamp, {_r('temperature', 'temperature')} FROM newest ORDER BY source_id, timestamp LIMIT 100"
)
# Stored without its event number: equal versions are decided by the remaining columns.
_STORED_TIE = ", ".join(f"{f} DESC NULLS LAST" for f in [
    "cloud_cover", "condition", "pressure_msl", "relative_humidity", "temperature", "precipitation_60",
    "sunshine_60", "wind_direction_60", "wind_speed_60",
])
ORACLE["sql_with_parameters"] = _ctes(
    SYNOP,
    f"""newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, timestamp
  ORDER BY ingested_at DESC, {_STORED_TIE}) AS rn FROM synop) WHERE rn = 1)""",
) + (
    "SELECT source_id, count(*) AS hours, count(DISTINCT CAST(timestamp AS DATE)) AS days, "
    f"{_r('avg(temperature)', 'temperature')} FROM newest WHERE {_range('2024-01-05 06:00:00', '2024-01-15 12:00:00')} "
    "AND temperature > 0.0E0 GROUP BY source_id"
)
ORACLE["delete_readings_by_key"] = _ctes(SYNOP) + (
    "SELECT source_id, CAST(timestamp AS DATE) AS day, count(*) AS rows, count(temperature) AS temperatures FROM synop "
    "WHERE NOT (source_id % 2 = 0 AND CAST(timestamp AS DATE) IN (DATE '2024-01-03', DATE '2024-01-10', DATE '2024-01-20')) "
    "GROUP BY ALL"
)
_WRITTEN = {
    "raw.postal_codes": "pc", "raw.weather_stations": "all_stations", "raw.weather_observations_synop": "synop",
    "raw.weather_observations": "synop", "raw.weather_forecasts": "fc", "staging.observations_by_postal_code": "produced",
}
ORACLE["typed_rows"] = _ctes(
    PLACES, STATIONS, CURRENT, SYNOP, FORECASTS, _pairs("synop"), _readings("obs"), _PRODUCED
) + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows, count(*) AS returned FROM {_WRITTEN[t]}"
    if t in _WRITTEN else f"SELECT '{t}' AS \"table\", 0 AS rows, 0 AS returned"
    for t in schemas.TABLES
)
ORACLE["schema_check"] = " UNION ALL ".join(
    f"SELECT '{t.name}' AS \"table\", '{c}' AS \"column\", "
    f"{'TRUE' if t.name in ('raw.postal_codes', 'raw.weather_stations') else 'FALSE'} AS present"
    for t in schemas.TABLES.values() for c in t.columns
)


def _reported(stored: str, written: str, rejected: int, versions: int = 1, verified: str | None = None) -> str:
    return (
        f"(SELECT count(*) FROM {written}) AS written, {verified or f'(SELECT count(*) FROM {written})'} AS verified, "
        f"CAST({rejected} AS BIGINT) AS rejected, {stored} AS stored, CAST({versions} AS BIGINT) AS versions"
    )


ORACLE["ingest_codes_job"] = _ctes(PLACES) + (
    f"SELECT left(plz, 3) AS prefix, count(*) AS codes, {_reported('(SELECT count(*) FROM pc)', 'pc', 2)} "
    "FROM pc GROUP BY left(plz, 3)"
)
ORACLE["ingest_stations_job"] = _ctes(
    PLACES, STATIONS, CURRENT, _pairs(None, "(p.plz LIKE '10%' OR p.plz LIKE '11%')"),
    """found AS (SELECT source_id, observation_type, round(distance_km * 1000.0E0, 2) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY plz) AS rn FROM pairs) WHERE rn = 1)""",
) + (
    f"SELECT source_id AS id, observation_type, distance, {_reported('(SELECT count(*) FROM found)', 'found', 0)} FROM found"
)
ORACLE["ingest_obs_job"] = _ctes(
    STATIONS, CURRENT, SYNOP,
    f"""taken AS (SELECT DISTINCT source_id, timestamp FROM synop
  WHERE source_id IN (SELECT id FROM st WHERE {_ACTIVE}))""",
) + (
    "SELECT CAST(timestamp AS DATE) AS day, count(*) AS readings, count(DISTINCT source_id) AS stations, "
    f"{_reported('(SELECT 2 * count(*) FROM taken)', 'taken', 3, 2)} FROM taken GROUP BY CAST(timestamp AS DATE)"
)
ORACLE["ingest_forecasts_job"] = _ctes(
    STATIONS, CURRENT, FORECASTS, _issued("2024-01-15 06:30:00"),
    f"""taken AS (SELECT DISTINCT source_id, timestamp, forecast_created_at FROM issued WHERE {WEEK_OF_DAYS}
  AND source_id IN (SELECT id FROM st WHERE observation_type = 'forecast'
    AND last_record >= TIMESTAMP '2024-01-15 06:30:00' + INTERVAL '8' DAY))""",
) + (
    "SELECT CAST(timestamp AS DATE) AS day, count(*) AS forecasts, count(DISTINCT forecast_created_at) AS issues, "
    f"{_reported('(SELECT count(*) FROM taken)', 'taken', 0, 1, 'CAST(NULL AS BIGINT)')} FROM taken GROUP BY CAST(timestamp AS DATE)"
)
ORACLE["staged_forecasts_saved"] = _staged("fc", where=WEEK_AHEAD) + (
    "SELECT plz, count(*) AS hours, n AS first, n AS second, CAST(0 AS BIGINT) AS empty, 2 * n AS stored "
    "FROM result, (SELECT count(*) AS n FROM result) GROUP BY plz, n"
)
ORACLE["stations_by_range"] = _ctes(
    SYNOP,
    """ranges(name, start, stop) AS (VALUES ('first week', DATE '2024-01-01', DATE '2024-01-08'),
  ('month', DATE '2024-01-01', DATE '2024-02-01'), ('day', DATE '2024-01-10', DATE '2024-01-11'),
  ('ahead', DATE '2030-01-01', DATE '2030-02-01'))""",
) + (
    "SELECT r.name, count(timestamp) AS rows, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp, "
    "TRUE AS within_bound FROM ranges r LEFT JOIN synop ON CAST(timestamp AS DATE) >= start AND CAST(timestamp AS DATE) < stop GROUP BY r.name"
)
ORACLE["stream_landed_obs"] = _ctes(STATIONS, CURRENT, SYNOP, LATEST_OBS) + (
    f"SELECT source_id, timestamp, {_r('temperature', 'temperature')}, condition, CAST(3 AS BIGINT) AS rejected "
    f"FROM newest WHERE source_id IN (SELECT id FROM st WHERE {_ACTIVE})"
)
