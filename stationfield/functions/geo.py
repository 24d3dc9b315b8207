"""Distances, weights, grid cells and area centroids as native column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
WEIGHT_OFFSET_KM = 0.1


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines. The cosine is clamped, so coincident points are 0 km apart."""
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    cosine = (
        F.cos(phi1) * F.cos(phi2) * F.cos(F.radians(lon2) - F.radians(lon1))
        + F.sin(phi1) * F.sin(phi2)
    )
    return distance_of_cosine(cosine)


def distance_of_cosine(cosine: Column) -> Column:
    return F.lit(EARTH_RADIUS_KM) * F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine)))


def idw_weight(distance_km: Column) -> Column:
    return F.lit(1.0) / (distance_km + F.lit(WEIGHT_OFFSET_KM))


@dataclass(frozen=True)
class Grid:
    """Cells for an equi join that finds every pair of points at most `radius_km` apart.

    Bands of latitude are one radius high. Each band is cut into a whole number of columns, at
    least one radius wide anywhere in the band. Columns count around the globe, so the
    antimeridian needs no special case; a circle that holds a pole covers whole bands.
    """

    radius_km: float

    @property
    def reach(self) -> float:
        # Degrees of latitude, rounded up beyond the error of the arc cosine.
        padded = self.radius_km * (1 + 1e-6) + 1e-3
        return min(180.0, math.degrees(padded / EARTH_RADIUS_KM))

    def band(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.reach)).cast("int")

    def columns_in(self, band: Column) -> Column:
        edge = F.greatest(F.abs(band), F.abs(band + 1)) * F.lit(self.reach)
        girth = F.cos(F.radians(F.least(F.lit(90.0), edge))) * F.lit(360.0)
        return F.greatest(F.lit(1), F.floor(girth / F.lit(self.reach)).cast("int"))

    def column(self, lon: Column, band: Column) -> Column:
        """Unwrapped column number; take it modulo `columns_in(band)`."""
        return F.floor(lon / F.lit(360.0) * self.columns_in(band)).cast("int")

    def cell_of(self, lat: Column, lon: Column) -> tuple[Column, Column]:
        band = self.band(lat)
        return band, F.pmod(self.column(lon, band), self.columns_in(band))

    def bands_around(self, lat: Column) -> Column:
        return F.sequence(self.band(lat) - 1, self.band(lat) + 1)

    def columns_around(self, lat: Column, lon: Column, band: Column) -> Column:
        """The columns of `band` that a circle around the point can touch."""
        total = self.columns_in(band)
        every = F.sequence(F.lit(0), total - 1)
        sine = F.lit(math.sin(math.radians(min(self.reach, 90.0)))) / F.cos(F.radians(lat))
        spread = F.degrees(F.asin(F.least(F.lit(1.0), sine))) * F.lit(1 + 1e-9)
        low, high = self.column(lon - spread, band), self.column(lon + spread, band)
        holds_pole = F.abs(lat) + F.lit(self.reach) >= 90.0
        return F.when(holds_pole | (high - low + 1 >= total), every).otherwise(
            F.sequence(low, high)
        )


def rings_of(geometry_json: Column) -> Column:
    """GeoJSON Polygon or MultiPolygon text -> polygons > rings > points > (lon, lat)."""
    ring = "array<array<array<double>>>"
    geometry = F.from_json(geometry_json, "type string, coordinates string")
    kind, coordinates = geometry["type"], geometry["coordinates"]
    return (
        F.when(kind == "Polygon", F.array(F.from_json(coordinates, ring)))
        .when(kind == "MultiPolygon", F.from_json(coordinates, f"array<{ring}>"))
    )


@dataclass(frozen=True)
class Figure:
    """An earth with its equal-area latitude: a sphere where the eccentricity is 0, else an ellipsoid.

    In the cylindrical equal-area plane a point lies at its longitude in radians and at `height` of its
    latitude, half the authalic q. On a sphere that is the sine.
    """

    eccentricity_squared: float = 0.0

    @property
    def _e(self) -> float:
        return math.sqrt(self.eccentricity_squared)

    def height(self, lat: Column) -> Column:
        """From degrees of latitude to the plane."""
        sine = F.sin(F.radians(lat))
        e2, e = self.eccentricity_squared, self._e
        if not e2:
            return sine
        logarithm = F.log((F.lit(1.0) + sine * e) / (F.lit(1.0) - sine * e)) / (2.0 * e)
        return (sine / (F.lit(1.0) - sine * sine * e2) + logarithm) * ((1.0 - e2) / 2.0)

    def latitude(self, height: Column) -> Column:
        """The inverse of `height`, in degrees. The authalic latitude is corrected by its series in
        powers of the eccentricity up to the eighth; the error stays below 1e-10 degrees."""
        e2 = self.eccentricity_squared
        if not e2:
            return F.degrees(F.asin(height))
        e, e4, e6, e8 = self._e, e2**2, e2**3, e2**4
        pole = (1.0 - e2) / 2.0 * (1.0 / (1.0 - e2) + math.log((1.0 + e) / (1.0 - e)) / (2.0 * e))
        authalic = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), height / pole)))
        # The series of the latitude in sines of multiples of the authalic latitude.
        terms = {
            2: e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040 + 120389 * e8 / 1814400,
            4: 23 * e4 / 360 + 251 * e6 / 3780 + 102287 * e8 / 1814400,
            6: 761 * e6 / 45360 + 47561 * e8 / 1814400,
            8: 6059 * e8 / 1209600,
        }
        corrected = authalic
        for multiple, term in terms.items():
            corrected = corrected + F.sin(authalic * float(multiple)) * term
        return F.degrees(corrected)


SPHERE = Figure()
# Fixed value: the first eccentricity of WGS 84, squared.
WGS84 = Figure(0.00669437999014132)


def dense(ring: Column, max_edge_degrees: float) -> Column:
    """The ring with every longer edge cut evenly, so that no piece spans more degrees than that in
    longitude or latitude. An edge is straight in longitude and latitude; in the plane it is a curve,
    of which the corners of the ring alone give the chord. Short edges stay as they are."""

    def pieces(p: Column, i: Column) -> Column:
        to = F.coalesce(F.get(ring, i + 1), ring[0])
        span = F.greatest(F.abs(to[0] - p[0]), F.abs(to[1] - p[1]))
        cuts = F.greatest(F.lit(1), F.ceil(span / F.lit(max_edge_degrees)).cast("int"))

        def at(k: Column) -> Column:
            part = k.cast("double") / cuts
            return F.array(p[0] + (to[0] - p[0]) * part, p[1] + (to[1] - p[1]) * part)

        return F.transform(F.sequence(F.lit(0), cuts - 1), at)

    return F.flatten(F.transform(ring, pieces))


def densified(polygons: Column, max_edge_degrees: float) -> Column:
    return F.transform(
        polygons, lambda polygon: F.transform(polygon, lambda ring: dense(ring, max_edge_degrees))
    )


def area_centroid(polygons: Column, figure: Figure = SPHERE) -> Column:
    """Struct (lon, lat) of the area centroid in the cylindrical equal-area plane.

    In that plane (longitude in radians, height of the latitude) the signed areas and first moments of
    the rings add up. Exterior rings add and holes take away, whichever way round they are drawn.
    Each ring is passed over once, from its last point round to its last point; coordinates are
    relative to the first point, as differences of large products would lose digits.
    """
    origin = polygons[0][0][0]
    lon0, y0 = F.radians(origin[0]), figure.height(origin[1])
    zero = F.lit(0.0)

    def x_of(point: Column) -> Column:
        return F.radians(point[0]) - lon0

    def y_of(point: Column) -> Column:
        return figure.height(point[1]) - y0

    def step(acc: Column, point: Column) -> Column:
        cross = acc["x"] * point["y"] - point["x"] * acc["y"]
        return F.struct(
            (acc["area"] + cross).alias("area"),
            (acc["mx"] + (acc["x"] + point["x"]) * cross).alias("mx"),
            (acc["my"] + (acc["y"] + point["y"]) * cross).alias("my"),
            point["x"].alias("x"), point["y"].alias("y"),
        )

    def moments(ring: Column, position: Column) -> Column:
        plane = F.transform(ring, lambda p: F.struct(x_of(p).alias("x"), y_of(p).alias("y")))
        last = F.element_at(ring, -1)
        start = F.struct(
            zero.alias("area"), zero.alias("mx"), zero.alias("my"),
            x_of(last).alias("x"), y_of(last).alias("y"),
        )
        side = F.when(position == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.aggregate(
            plane, start, step,
            lambda acc: F.struct(
                *[(acc[m] * F.signum(acc["area"]) * side).alias(m) for m in ("area", "mx", "my")]
            ),
        )

    def add(acc: Column, m: Column) -> Column:
        return F.struct(*[(acc[c] + m[c]).alias(c) for c in ("area", "mx", "my")])

    # The sums are twice the area and six times the moments.
    return F.aggregate(
        F.flatten(F.transform(polygons, lambda polygon: F.transform(polygon, moments))),
        F.struct(zero.alias("area"), zero.alias("mx"), zero.alias("my")),
        add,
        lambda acc: F.struct(
            F.degrees(lon0 + F.try_divide(acc["mx"], acc["area"] * 3.0)).alias("lon"),
            figure.latitude(y0 + F.try_divide(acc["my"], acc["area"] * 3.0)).alias("lat"),
        ),
    )


def register_sql_functions(spark: SparkSession) -> None:
    """`great_circle_km` and `idw_weight` for SQL users; Catalyst inlines both."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION great_circle_km"
        "(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN "
        f"{EARTH_RADIUS_KM}D * acos(least(1D, greatest(-1D, "
        "cos(radians(lat1)) * cos(radians(lat2)) * cos(radians(lon2) - radians(lon1)) "
        "+ sin(radians(lat1)) * sin(radians(lat2)))))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION idw_weight(distance_km DOUBLE) RETURNS DOUBLE "
        f"RETURN 1D / (distance_km + {WEIGHT_OFFSET_KM}D)"
    )
