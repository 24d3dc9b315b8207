"""Radius join of places and stations, and what follows from it."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from stationfield.functions.geo import EARTH_RADIUS_KM, Grid, distance_of_cosine, great_circle_km
from stationfield.operators.parts import ranks_on_ground, reached_on_ground
from stationfield.operators.versions import first_seen
from stationfield.session import BROADCAST_ROWS, fits, materialize

CELL = ["_band", "_column"]
# A cell with more places or stations than this is cut into blocks, so that no task compares more
# than BLOCK x BLOCK of them.
BLOCK = 4096
# Stations that may be broadcast; a row is about 50 bytes.
STATION_ROWS = BROADCAST_ROWS // 10
# What a station knows of the place that found it, in order of preference.
PLACE = ["plz", "centroid_lat", "centroid_lon"]
# Places that a station is first compared with when any place will do; then twice as many, and so on.
FIRST_PLACES = 64
# Beyond the rounding error of a distance; such distances are left to the SQL expression.
EDGE_KM = 1e-3
# Beyond the rounding error of a cosine.
DOT_SLACK = 1e-12
# Grid cells are put together, up to HALVINGS doublings, to blocks of at most so many places.
PLACE_ROWS = 65_536
HALVINGS = 4
# Places whose stations are ranked by one task.
RANKED_PLACES = 8192
# Parts that are more tasks than the session is sized for, and the most tasks.
MOST_TASKS = 16_384
# Places are ranked ring by ring, so that no task sorts all stations of a crowded place.
RING_KM = 0.25


def _real(lat: str, lon: str) -> Column:
    known = F.col(lat).between(-90.0, 90.0) & (F.abs(F.col(lon)) < F.lit(float("inf")))
    return F.coalesce(known, F.lit(False))


def unlocated(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """The rows that a radius join leaves out: without a finite longitude and a latitude within 90
    degrees they are near nothing."""
    return df.where(~_real(lat, lon))


def _wrapped(lon: str) -> Column:
    """The longitude, modulo 360 if it is far round the globe."""
    return F.when(F.abs(F.col(lon)) <= 540.0, F.col(lon)).otherwise(
        F.pmod(F.col(lon), F.lit(360.0))
    )


def _in_every_cell_around(df: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    banded = df.withColumn("_band", F.explode(grid.bands_around(F.col(lat))))
    around = grid.columns_around(F.col(lat), _wrapped(lon), F.col("_band"))
    return banded.withColumn("_column", F.explode(around)).withColumn(
        "_column", F.pmod("_column", grid.columns_in(F.col("_band")))
    )


def _in_own_cell(df: DataFrame, grid: Grid, lat: str, lon: str) -> DataFrame:
    band, column = grid.cell_of(F.col(lat), _wrapped(lon))
    return df.withColumns({"_band": band, "_column": column})


def _cut_hot_cells(
    places: DataFrame, stations: DataFrame, place_id: Column, station_id: Column
) -> tuple[DataFrame, DataFrame]:
    """Block join: a hot cell's places are cut `p` ways and its stations `s` ways by a hash of
    their ids, and each part of one side meets each part of the other in a task of its own. The
    list of hot cells is short (at most one per BLOCK rows) and is broadcast where it fits, so
    that looking a cell up does not gather its rows."""
    crowded = (
        places.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("_p"))
        .join(
            stations.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).alias("_s")), CELL
        )
        .where("_p > 1 OR _s > 1")
    )
    crowded = materialize(crowded, "crowded")
    if fits(crowded):
        crowded = F.broadcast(crowded)

    def cut(df: DataFrame, own: str, other: str, row_id: Column) -> DataFrame:
        ways = F.coalesce(F.col(own), F.lit(1))
        copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col(other), F.lit(1)) - 1)
        return (
            df.join(crowded, CELL, "left")
            .withColumn(own + "_block", F.pmod(F.xxhash64(row_id), ways))
            .withColumn(other + "_block", F.explode(copies))
            .drop("_p", "_s")
        )

    return cut(places, "_p", "_s", place_id), cut(stations, "_s", "_p", station_id)


def radius_join(
    places: DataFrame,
    stations: DataFrame,
    radius_km: float = 10.0,
    few_stations: bool | None = None,
) -> DataFrame:
    """Every (plz, source_id) at most `radius_km` apart, with `distance_km`.

    `places` has plz, centroid_lat, centroid_lon and `stations` has source_id, lat, lon; further
    columns are carried along. Each place looks into the grid cells its circle touches, which
    makes this an equi join. A station side of few rows is broadcast; a larger one is shuffled by
    cell, with hot cells cut into blocks. The rows are counted unless `few_stations` tells.
    Rows without real coordinates are in no pair; `unlocated` gives them.
    """
    grid = Grid(radius_km)
    places = places.where(_real("centroid_lat", "centroid_lon"))
    stations = stations.where(_real("lat", "lon"))
    measured_places = _measured(places, "_p", "centroid_lat", "centroid_lon")
    measured_stations = _measured(stations, "_s", "lat", "lon")
    probe = _in_every_cell_around(measured_places, grid, "centroid_lat", "centroid_lon")
    build = _in_own_cell(measured_stations, grid, "lat", "lon")
    if few_stations is None:
        few_stations = fits(stations, STATION_ROWS)
    if few_stations:
        candidates = probe.join(F.broadcast(build), CELL)
    else:
        probe, build = _cut_hot_cells(probe, build, F.col("plz"), F.col("source_id"))
        candidates = probe.join(build, [*CELL, "_p_block", "_s_block"]).drop("_p_block", "_s_block")
    # Three products tell most candidates that are too far; rounding is left to the distance itself.
    dot = sum((F.col(f"_p_{c}") * F.col(f"_s_{c}") for c in ("y", "sin")), F.col("_p_x") * F.col("_s_x"))
    least = math.cos(min(math.pi, max(0.0, radius_km) / EARTH_RADIUS_KM)) - DOT_SLACK
    distance = distance_of_cosine(
        F.col("_p_cos") * F.col("_s_cos") * F.cos(F.col("_s_lon") - F.col("_p_lon")) + F.col("_p_sin") * F.col("_s_sin")
    )
    return (
        candidates.where(dot >= F.lit(least))
        .withColumn("distance_km", distance)
        .where(F.col("distance_km") <= F.lit(float(radius_km)))
        .drop(*CELL, *[f"{side}_{c}" for side in ("_p", "_s") for c in ("cos", "sin", "lon", "x", "y")])
    )


def _measured(df: DataFrame, side: str, lat: str, lon: str) -> DataFrame:
    """What the distance wants of one point, computed once for all its candidates."""
    phi, lam = F.radians(lat), F.radians(_wrapped(lon))
    return df.withColumns(
        {
            f"{side}_cos": F.cos(phi), f"{side}_sin": F.sin(phi), f"{side}_lon": lam,
            f"{side}_x": F.cos(phi) * F.cos(lam), f"{side}_y": F.cos(phi) * F.sin(lam),
        }
    )


def rank_by_distance(pairs: DataFrame, ring_km: float = RING_KM) -> DataFrame:
    """Adds `distance_rank`, 1 for the nearest station of a place.

    A station's rank is its rank in its ring of distances plus the stations of all inner rings.
    The pairs are read twice, so better a written table than a plan.
    """
    ringed = pairs.withColumn("_ring", F.floor(F.col("distance_km") / F.lit(ring_km)))
    inner = Window.partitionBy("plz").orderBy("_ring").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ringed.groupBy("plz", "_ring").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(inner), F.lit(0))).drop("_n")
    )
    within = Window.partitionBy("plz", "_ring").orderBy("distance_km", "source_id")
    return (
        ringed.withColumn("_place", F.row_number().over(within))
        .join(before, ["plz", "_ring"])
        .withColumn("distance_rank", F.col("_before") + F.col("_place"))
        .drop("_ring", "_before", "_place")
    )


@dataclass(frozen=True)
class Ground:
    """Places and the stations within `radius_km` of them, dealt out by blocks of ground; their pairs are made by the task
    that has the block, not written or moved. `places` has plz, centroid_lat, centroid_lon and `_block`, once; `stations`
    source_id, lat, lon and `_block`, once for each block that may have a place in range. `sizes` counts the places of a block."""

    places: DataFrame
    stations: DataFrame
    sizes: DataFrame
    radius_km: float

    def pairs(self) -> DataFrame:
        """Every pair in range, as rows."""
        stations = self.stations.select("source_id", "lat", "lon").distinct()
        return radius_join(self.places.drop("_block"), stations, self.radius_km).select(
            "plz", "source_id", "distance_km", "centroid_lat", "centroid_lon"
        )

    def rows(self, places: DataFrame, stations: DataFrame) -> DataFrame:
        """Places and what is at the stations as rows of one table, with `_place`, `_lat` and `_lon`."""
        located = places.withColumns({"_place": F.lit(True), "_lat": F.col("centroid_lat"), "_lon": _wrapped("centroid_lon")})
        sited = stations.withColumns({"_place": F.lit(False), "_lat": F.col("lat"), "_lon": _wrapped("lon")})
        return located.drop("centroid_lat", "centroid_lon").unionByName(sited.drop("lat", "lon"), allowMissingColumns=True)


def ground(places: DataFrame, stations: DataFrame, radius_km: float = 10.0) -> Ground:
    """Deals places (plz, centroid_lat, centroid_lon) and stations (source_id, lat, lon) out by blocks.

    A block is the largest square of grid cells around a place with at most PLACE_ROWS places, or one cell. A station goes to the
    blocks of the cells around it, at most nine or, near a pole, some bands of them.
    """
    grid = Grid(radius_km)
    located = materialize(
        _in_own_cell(places.where(_real("centroid_lat", "centroid_lon")), grid, "centroid_lat", "centroid_lon"), "located"
    )
    cells = located.groupBy(*CELL).agg(F.count(F.lit(1)).alias("_places"))
    level, names = F.lit(0), []
    for k in range(1, HALVINGS + 1):
        around = [F.shiftright(c, k) for c in CELL]
        cells = cells.withColumn(f"_at_{k}", F.sum("_places").over(Window.partitionBy(*around)))
        level = F.when(F.col(f"_at_{k}") <= PLACE_ROWS, F.lit(k)).otherwise(level)
        names.append(f"_at_{k}")
    number = F.xxhash64("_level", *[F.expr(f"shiftright({c}, _level)") for c in CELL])
    cells = materialize(
        cells.withColumn("_level", level).select(*CELL, number.alias("_block"), "_places"), "cells"
    )
    sizes = cells.groupBy("_block").agg(F.sum("_places").alias("_places"))
    block_of = cells.drop("_places")
    if fits(block_of):
        block_of = F.broadcast(block_of)
    sited = _in_every_cell_around(stations.where(_real("lat", "lon")), grid, "lat", "lon")
    served = sited.join(block_of, CELL).drop(*CELL).distinct()
    return Ground(
        located.join(block_of, CELL).drop(*CELL), materialize(served, "served"), materialize(sizes, "sizes"), radius_km
    )


def rank_on_ground(spot: Ground) -> DataFrame:
    """plz, source_id, distance_km and `distance_rank`, 1 for the nearest station of a place, of equal ones the smallest id.

    A task ranks the places of a share of a block, all of whose stations it has: neither pairs nor ranks are moved or
    sorted by Spark.
    """
    shares = spot.sizes.select("_block", F.ceil(F.col("_places") / F.lit(RANKED_PLACES)).cast("int").alias("_shares"))
    n_parts, known = shares.agg(F.sum("_shares"), F.count(F.lit(1))).first()
    if known <= BROADCAST_ROWS:
        shares = F.broadcast(shares)
    places = spot.places.join(shares, "_block").withColumn("_share", F.pmod(F.xxhash64("centroid_lat", "centroid_lon", "plz"), F.col("_shares")).cast("int"))
    stations = spot.stations.join(shares, "_block").withColumn("_share", F.explode(F.sequence(F.lit(0), F.col("_shares") - 1)))
    n = max(int(spot.places.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(n_parts or 1, MOST_TASKS))
    key = ["_block", "_share"]
    parts = spot.rows(places, stations).drop("_shares").repartition(n, *key)
    shape = StructType([
        spot.places.schema["plz"], spot.stations.schema["source_id"],
        StructField("distance_km", DoubleType()), StructField("distance_rank", IntegerType()),
    ])
    return parts.groupBy(*key).applyInArrow(ranks_on_ground(spot.radius_km), shape)


def reached(spot: Ground, some: DataFrame) -> Ground:
    """The places within range of the stations whose source_id is in `some`, with all their stations. A block's places are at most
    PLACE_ROWS, or those of one cell."""
    asked = spot.stations.join(some.select("source_id").distinct(), "source_id", "left_semi")
    shape = StructType([spot.places.schema["plz"], StructField("_lat", DoubleType()), StructField("_lon", DoubleType())])
    hits = spot.rows(spot.places, asked).groupBy("_block").applyInArrow(reached_on_ground(spot.radius_km), shape)
    places = hits.select("plz", F.col("_lat").alias("centroid_lat"), F.col("_lon").alias("centroid_lon"))
    return ground(places, spot.stations.select("source_id", "lat", "lon").distinct(), spot.radius_km)


def _first_in_range(radius_km: float, carried: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function for a cell: each station with the first place of the order in range. Places so near the edge of the
    circle that rounding decides go along, up to the first that is surely inside."""

    def rows_of(places: pa.Table, stations: pa.Table) -> pa.Table:
        order = [(c, "ascending") for c in PLACE]
        places = places.take(pc.sort_indices(places, sort_keys=order, null_placement="at_start"))
        phi, lam = (np.radians(places[c].to_numpy()) for c in ("centroid_lat", "_centroid_lon"))
        phi_s, lam_s = (np.radians(stations[c].to_numpy()) for c in ("lat", "_lon"))
        left, found = np.arange(stations.num_rows), [(np.empty(0, int), np.empty(0, int))]
        low, width = 0, FIRST_PLACES
        while low < places.num_rows and len(left):
            some = slice(low, low + width)
            cosine = np.cos(phi[some]) * np.cos(phi_s[left])[:, None] * np.cos(lam_s[left][:, None] - lam[some])
            cosine += np.sin(phi[some]) * np.sin(phi_s[left])[:, None]
            apart = EARTH_RADIUS_KM * np.arccos(np.clip(cosine, -1.0, 1.0))
            sure = apart <= radius_km - EDGE_KM
            first = np.where(sure.any(axis=1), sure.argmax(axis=1), apart.shape[1])
            maybe = (apart <= radius_km + EDGE_KM) & (np.arange(apart.shape[1]) <= first[:, None])
            station, place = np.nonzero(maybe)
            found.append((left[station], place + low))
            left = left[first == apart.shape[1]]
            low, width = low + width, max(1, min(2 * width, BLOCK * FIRST_PLACES // max(len(left), 1)))
        station, place = (np.concatenate(c) for c in zip(*found, strict=True))
        hits = {c: places[c].take(pa.array(place)) for c in PLACE}
        return pa.table({**hits, **{c: stations[c].take(pa.array(station)) for c in carried}})

    return rows_of


def discover_stations(
    places: DataFrame, catalogue: DataFrame, radius_km: float = 10.0
) -> DataFrame:
    """Stations of the catalogue near any place, once per id.

    A station keeps the record and the distance (in metres) of the first place, in order of plz,
    that found it. The places around a cell are looked through in that order until each of its stations has
    one, so the pairs in range are never made.
    """
    grid = Grid(radius_km)
    stations = catalogue.withColumnRenamed("id", "source_id").drop("distance")
    carried = stations.columns
    located = places.select(*PLACE).where(_real("centroid_lat", "centroid_lon"))
    build = _in_own_cell(stations.where(_real("lat", "lon")), grid, "lat", "lon")
    cells = build.select(*CELL).distinct()
    probe = _in_every_cell_around(located, grid, "centroid_lat", "centroid_lon").join(cells, CELL, "left_semi")
    probe, build = _cut_hot_cells(probe, build, F.struct(*PLACE), F.col("source_id"))
    probe = probe.withColumn("_centroid_lon", _wrapped("centroid_lon"))
    build = build.withColumn("_lon", _wrapped("lon"))
    key = [*CELL, "_p_block", "_s_block"]
    shape = StructType([*located.schema.fields, *stations.schema.fields])
    near = probe.groupBy(*key).cogroup(build.groupBy(*key)).applyInArrow(_first_in_range(radius_km, carried), shape)
    distance = great_circle_km(
        F.col("centroid_lat"), _wrapped("centroid_lon"), F.col("lat"), _wrapped("lon")
    )
    hits = near.withColumn("distance_km", distance).where(F.col("distance_km") <= F.lit(float(radius_km)))
    first = first_seen(hits, ["source_id"], ["plz", "observation_type"])
    found = first.withColumn("distance", F.col("distance_km") * 1000.0).withColumnRenamed(
        "source_id", "id"
    )
    kept = [c for c in catalogue.columns if c != "distance"]
    return found.select(*kept, "distance")


def near_places(stations: DataFrame, places: DataFrame, radius_km: float = 10.0) -> DataFrame:
    """Stations with at least one place in range."""
    located = stations.select(F.col("id").alias("source_id"), "lat", "lon")
    ids = radius_join(places.select("plz", "centroid_lat", "centroid_lon"), located, radius_km)
    return stations.join(ids.select(F.col("source_id").alias("id")), "id", "left_semi")
