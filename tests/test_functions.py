import math
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from stationfield.functions import geo, quality, temporal


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def km(spark, *point_pair):
    return one(spark, geo.great_circle_km(*[F.lit(float(v)) for v in point_pair]))[0]


def test_distance(spark):
    # The arc cosine resolves some 0.1 m.
    assert km(spark, 52.52, 13.4, 52.52, 13.4) == pytest.approx(0.0, abs=2e-4)
    assert km(spark, 50, 10, 51, 10) == pytest.approx(111.19, abs=0.01)
    # Berlin to Munich
    assert km(spark, 52.52, 13.405, 48.137, 11.575) == pytest.approx(504.4, abs=0.5)
    assert km(spark, 10, 179.95, 10, -179.95) == pytest.approx(10.95, abs=0.01)


def test_weight(spark):
    assert one(spark, geo.idw_weight(F.lit(0.0)))[0] == pytest.approx(10.0)
    assert one(spark, geo.idw_weight(F.lit(9.9)))[0] == pytest.approx(0.1)


def score_of(spark, ranges=quality.DEFAULT_RANGES, **row):
    clean = {
        "temperature": 10.0, "precipitation": 0.0, "relative_humidity": 50.0, "wind_speed": 5.0,
        "pressure_msl": 1000.0,
    }
    values = {**clean, **row}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))
    got = quality.add_quality(quality.nan_to_null(df), ranges).first()
    return got["is_valid"], got["quality_score"]


@pytest.mark.parametrize(
    "row, valid, score",
    [
        ({}, True, 1.0),
        ({"temperature": 50.1}, False, 0.5),
        ({"precipitation": -0.1}, False, 0.5),
        ({"relative_humidity": 100.1}, False, 0.7),
        ({"wind_speed": 200.1}, False, 0.7),
        ({"pressure_msl": 799.9}, False, 0.7),
        ({"temperature": -31.0, "pressure_msl": 1100.5}, False, 0.35),
        ({"temperature": None}, True, 0.7 + 0.3 * 2 / 3),
        ({"temperature": math.nan}, True, 0.7 + 0.3 * 2 / 3),
        ({"temperature": None, "precipitation": None, "relative_humidity": None}, True, 0.7),
        ({"wind_speed": None, "pressure_msl": None}, True, 1.0),
        ({"temperature": -30.0, "precipitation": 0.0, "relative_humidity": 0.0, "wind_speed": 0.0,
          "pressure_msl": 800.0}, True, 1.0),
        ({"temperature": 50.0, "precipitation": 200.0, "relative_humidity": 100.0,
          "wind_speed": 200.0, "pressure_msl": 1100.0}, True, 1.0),
    ],
)
def test_quality(spark, row, valid, score):
    got = score_of(spark, **row)
    assert got[0] is valid
    assert got[1] == pytest.approx(score)


def test_missing_can_count_as_invalid(spark):
    strict = quality.Ranges(missing_is_invalid=True)
    valid, score = score_of(spark, strict, temperature=math.nan)
    assert valid is False
    assert score == pytest.approx(0.5 * 0.9)


def test_probability_invalidates_but_keeps_the_score(spark):
    assert score_of(spark, precipitation_probability=120.0) == (False, 1.0)
    assert score_of(spark, precipitation_probability=100.0) == (True, 1.0)
    assert score_of(spark, precipitation_probability=None) == (True, 1.0)


def test_only_present_fields_count(spark):
    df = spark.createDataFrame([(99.0,)], "temperature double")
    got = quality.add_quality(df).first()
    assert (got["is_valid"], got["quality_score"]) == (False, 0.5)
    bare = spark.createDataFrame([(1,)], "other int")
    assert quality.add_quality(bare).first()["quality_score"] == 1.0
    assert quality.keep_valid(bare).count() == 1


def test_own_ranges(spark):
    assert score_of(spark, quality.Ranges(temperature=(0.0, 5.0)))[0] is False


def test_station_factor(spark):
    got = [one(spark, quality.station_factor(F.lit(n)))[0] for n in (1, 2, 3, 9)]
    assert got == pytest.approx([1 / 3, 2 / 3, 1.0, 1.0])


def test_parse_utc(spark):
    texts = ["2024-01-01T10:30:00+00:00", "2024-01-01T12:30:00+02:00", "2024-01-01 10:30:00.987", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [
        r[0] for r in df.select(temporal.format_utc(temporal.parse_utc(F.col("t")))).collect()
    ]
    assert got == ["2024-01-01 10:30:00"] * 3 + [None]


def test_windows():
    as_of = datetime(2024, 1, 15, 6, 30)
    assert temporal.lookback(as_of, 24) == (datetime(2024, 1, 14, 7), datetime(2024, 1, 15, 7))
    assert temporal.horizon(as_of, 7) == (datetime(2024, 1, 15, 6), datetime(2024, 1, 22, 6))
    assert temporal.calendar_horizon(as_of, 7) == (datetime(2024, 1, 15), datetime(2024, 1, 22))


def test_literals_are_utc(spark):
    naive = temporal.utc(datetime(2024, 1, 1, 5))
    aware = temporal.utc(datetime(2024, 1, 1, 5, tzinfo=UTC))
    assert one(spark, temporal.format_utc(naive), temporal.format_utc(aware)) == (
        "2024-01-01 05:00:00", "2024-01-01 05:00:00",
    )


def test_hour_sequence(spark):
    hours = temporal.hour_sequence(datetime(2024, 1, 1, 22), datetime(2024, 1, 2, 2))
    assert one(spark, F.size(hours))[0] == 4


def centroid(spark, geometry):
    got = one(spark, geo.area_centroid(geo.rings_of(F.lit(geometry))))[0]
    return tuple(got) if got else (None, None)


def ring(west, south, east, north):
    return [[west, south], [east, south], [east, north], [west, north], [west, south]]


def equal_area_mid(south, north):
    return math.degrees(
        math.asin((math.sin(math.radians(south)) + math.sin(math.radians(north))) / 2)
    )


def text(kind, coordinates):
    return f'{{"type": "{kind}", "coordinates": {coordinates}}}'


def test_centroid_of_a_square(spark):
    square = ring(13.0, 52.0, 13.5, 52.4)
    want = (13.25, equal_area_mid(52.0, 52.4))
    assert centroid(spark, text("Polygon", [square])) == pytest.approx(want, abs=1e-10)
    assert centroid(spark, text("Polygon", [square[::-1]])) == pytest.approx(want, abs=1e-10)
    assert centroid(spark, text("MultiPolygon", [[square]])) == pytest.approx(want, abs=1e-10)
    # A ring that is not closed counts as if it were.
    assert centroid(spark, text("Polygon", [square[:-1]])) == pytest.approx(want, abs=1e-10)


def test_centroid_with_a_hole(spark):
    outer, hole = ring(10.0, 50.0, 12.0, 51.0), ring(11.0, 50.0, 12.0, 51.0)
    for h in (hole, hole[::-1]):
        lon, lat = centroid(spark, text("Polygon", [outer, h]))
        assert lon == pytest.approx(10.5, abs=1e-9)
        assert lat == pytest.approx(equal_area_mid(50.0, 51.0), abs=1e-9)


def test_centroid_of_two_parts(spark):
    # The same band of latitude, three times as wide: three times the weight.
    parts = [[ring(10.0, 50.0, 11.0, 51.0)], [ring(20.0, 50.0, 23.0, 51.0)[::-1]]]
    lon, _ = centroid(spark, text("MultiPolygon", parts))
    assert lon == pytest.approx((10.5 * 1 + 21.5 * 3) / 4, abs=1e-9)


def test_centroid_of_other_geometry_is_null(spark):
    assert centroid(spark, text("Point", [13.0, 52.0])) == (None, None)


@pytest.mark.parametrize("figure", [geo.SPHERE, geo.WGS84])
def test_height_and_latitude_are_inverse(spark, figure):
    lats = [-90.0, -89.9, -45.0, -1e-6, 0.0, 12.3, 50.0, 51.0, 85.0, 90.0]
    df = spark.createDataFrame([(v,) for v in lats], "lat double")
    got = df.select("lat", figure.height(F.col("lat")).alias("h")).select("lat", "h", figure.latitude(F.col("h")).alias("back"))
    for r in got.collect():
        assert r["back"] == pytest.approx(r["lat"], abs=1e-10 if abs(r["lat"]) < 89 else 1e-6)
    # The share of the ellipsoid's surface between the equator and 45 degrees, by fine sums.
    heights = {r["lat"]: r["h"] for r in got.collect()}
    e2 = figure.eccentricity_squared
    n = 20000

    def area(top):
        mids = [math.radians(top) * (k + 0.5) / n for k in range(n)]
        return sum(math.cos(p) * (1 - e2) / (1 - e2 * math.sin(p) ** 2) ** 2 for p in mids) * math.radians(top) / n

    assert -heights[-45.0] == pytest.approx(area(45.0), abs=1e-9)


def test_centroid_on_the_ellipsoid(spark):
    square = ring(13.0, 52.0, 13.5, 52.4)
    text_ = text("Polygon", [square])
    lon, lat = one(spark, geo.area_centroid(geo.rings_of(F.lit(text_)), geo.WGS84))[0]
    assert lon == pytest.approx(13.25, abs=1e-10)
    # The latitude that halves the area: between that of the sphere and some 1e-5 degrees from it.
    assert lat == pytest.approx(equal_area_mid(52.0, 52.4), abs=2e-5) and lat != equal_area_mid(52.0, 52.4)


@pytest.mark.parametrize("closed", [True, False])
def test_dense_edges_are_straight_in_longitude_and_latitude(spark, closed):
    triangle = [[0.0, 0.0], [40.0, 10.0], [5.0, 60.0], [0.0, 0.0]][: 4 if closed else 3]
    rings = geo.rings_of(F.lit(text("Polygon", [triangle])))

    def at(edge):
        cut = geo.densified(rings, edge)
        return one(spark, geo.area_centroid(cut, geo.WGS84))[0]

    coarse, fine, finest = at(90.0), at(0.5), at(0.05)
    assert tuple(coarse) == pytest.approx(tuple(one(spark, geo.area_centroid(rings, geo.WGS84))[0]), abs=1e-9)
    assert tuple(fine) == pytest.approx(tuple(finest), abs=1e-3)
    assert abs(coarse["lat"] - finest["lat"]) > 0.1
    # Against strips of latitude: between its edges, straight in degrees, the triangle is as wide as they are apart.
    n, area, along, mid = 100_000, 0.0, 0.0, 0.0
    e2 = geo.WGS84.eccentricity_squared
    for k in range(n):
        lat = 60.0 * (k + 0.5) / n
        left = 5.0 * lat / 60.0
        right = 4.0 * lat if lat <= 10.0 else 40.0 - 35.0 * (lat - 10.0) / 50.0
        p = math.radians(lat)
        strip = math.cos(p) / (1 - e2 * math.sin(p) ** 2) ** 2 * (right - left)
        area, along, mid = area + strip, along + strip * (left + right) / 2, mid + strip * float(height_of(lat, e2))
    want = one(spark, geo.WGS84.latitude(F.lit(mid / area)))[0]
    assert tuple(finest) == pytest.approx((along / area, want), abs=1e-4)


def height_of(lat, e2):
    e, sine = math.sqrt(e2), math.sin(math.radians(lat))
    return (1 - e2) / 2 * (sine / (1 - e2 * sine**2) + math.log((1 + e * sine) / (1 - e * sine)) / (2 * e))


def test_sql_functions(spark):
    geo.register_sql_functions(spark)
    quality.register_sql_functions(spark)
    got = spark.sql(
        "SELECT great_circle_km(50D, 10D, 51D, 10D), idw_weight(0D), "
        "quality_score(NULL, 0D, 50D, 5D, 1000D)"
    ).first()
    assert tuple(got) == pytest.approx((111.19, 10.0, 0.9), abs=0.01)
