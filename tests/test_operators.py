import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stationfield import schemas
from stationfield.functions.geo import great_circle_km
from stationfield.functions.quality import Ranges
from stationfield.operators import idw, radius, versions
from stationfield.operators.conform import conform
from stationfield.plans import reads, transforms
from stationfield.session import fits, materialize


def places(spark, rows):
    return spark.createDataFrame(rows, "plz string, centroid_lat double, centroid_lon double")


def stations(spark, rows):
    return spark.createDataFrame(rows, "source_id bigint, lat double, lon double")


def ids(df):
    got = [(r["plz"], r["source_id"]) for r in df.collect()]
    assert len(got) == len(set(got)), "a pair came twice"
    return set(got)


def brute_force(p, s, r):
    pairs = p.where(F.col("centroid_lat").isNotNull()).join(s, F.lit(True))
    d = great_circle_km(*[F.col(c) for c in ("centroid_lat", "centroid_lon", "lat", "lon")])
    return ids(pairs.where(d <= r))


REGIONS = {
    "germany": (47.0, 55.0, 6.0, 15.0, 60.0),
    "antimeridian": (-20.0, -15.0, 177.0, 183.0, 80.0),
    "north pole": (87.5, 90.0, -180.0, 180.0, 50.0),
    "south pole": (-90.0, -86.0, -180.0, 180.0, 120.0),
    "globe": (-90.0, 90.0, -180.0, 180.0, 1500.0),
    "half the globe": (-90.0, 90.0, -180.0, 180.0, 9000.0),
    "one spot": (52.5, 52.5, 13.4, 13.4, 0.001),
}


@pytest.mark.parametrize("region", REGIONS)
@pytest.mark.parametrize("few_stations", [None, False])
def test_radius_join_equals_brute_force(spark, region, few_stations, monkeypatch):
    south, north, west, east, r = REGIONS[region]
    rng = random.Random(region)

    def points(n):
        return [
            (i, rng.uniform(south, north), (rng.uniform(west, east) + 180.0) % 360.0 - 180.0)
            for i in range(n)
        ]

    monkeypatch.setattr(radius, "BLOCK", 3)  # every busy cell is cut
    p = places(spark, [(str(i), lat, lon) for i, lat, lon in points(70)])
    s = stations(spark, points(60))
    got = ids(radius.radius_join(p, s, r, few_stations))
    assert got == brute_force(p, s, r)
    assert got


def test_radius_join_keeps_finite_longitudes_and_tells_the_rest(spark):
    p = places(spark, [("a", 50.0, 10.0), ("b", 50.0, 730.0)])
    s = stations(spark, [(1, 50.0, 10.01 - 1080.0), (2, 50.0, float("inf")), (3, 91.0, 10.0), (4, None, 1.0)])
    assert ids(radius.radius_join(p, s, 10.0)) == {("a", 1), ("b", 1)}
    assert {r["source_id"] for r in radius.unlocated(s, "lat", "lon").collect()} == {2, 3, 4}
    assert radius.unlocated(p, "centroid_lat", "centroid_lon").count() == 0


def test_radius_join_edge_and_bad_coordinates(spark):
    p = places(spark, [("a", 50.0, 10.0), ("b", None, 10.0), ("c", float("nan"), 10.0)])
    step = 10.0 / 111.19492664
    s = stations(
        spark,
        [(1, 50.0, 10.0), (2, 50.0 + step * 0.999999, 10.0), (3, 50.0 + step * 1.000001, 10.0),
         (4, float("nan"), 10.0), (5, 50.0, None)],
    )
    assert ids(radius.radius_join(p, s, 10.0)) == {("a", 1), ("a", 2)}


def test_hot_cell_is_cut(spark, monkeypatch):
    monkeypatch.setattr(radius, "BLOCK", 10)
    p = places(spark, [(str(i), 50.0, 10.0) for i in range(95)] + [("far", 10.0, 10.0)])
    s = stations(spark, [(i, 50.0, 10.0) for i in range(45)] + [(99, 10.0, 10.0)])
    got = ids(radius.radius_join(p, s, 10.0, few_stations=False))
    assert len(got) == 95 * 45 + 1


def test_rank_and_discovery(spark):
    p = places(spark, [("20", 50.0, 10.0), ("10", 50.05, 10.0)])
    catalogue = spark.createDataFrame(
        [(7, "x", "synop", 50.0, 10.0), (8, "y", "synop", 50.05, 10.0), (9, "z", "synop", 60.0, 10.0)],
        "id bigint, station_name string, observation_type string, lat double, lon double",
    )
    found = {r["id"]: r for r in radius.discover_stations(p, catalogue).collect()}
    assert set(found) == {7, 8}
    # Seen first from plz 10, 5.56 km away.
    assert found[7]["distance"] == pytest.approx(5559.7, abs=1.0)
    assert found[8]["distance"] == pytest.approx(0.0, abs=0.2)
    s = catalogue.select(F.col("id").alias("source_id"), "lat", "lon")
    ranks = radius.rank_by_distance(radius.radius_join(p, s)).collect()
    assert {(r["plz"], r["source_id"]): r["distance_rank"] for r in ranks} == {
        ("20", 7): 1, ("20", 8): 2, ("10", 8): 1, ("10", 7): 2,
    }


def test_ranks_run_on_across_rings(spark):
    rng = random.Random(3)
    rows = [(str(i % 3), i, rng.choice([0.1, 0.3, 0.3, rng.uniform(0, 10)])) for i in range(200)]
    pairs = spark.createDataFrame(rows, "plz string, source_id bigint, distance_km double")
    got = {(r["plz"], r["source_id"]): r["distance_rank"] for r in radius.rank_by_distance(pairs).collect()}
    for plz in "012":
        ordered = sorted((d, s) for p, s, d in rows if p == plz)
        assert [got[plz, s] for _, s in ordered] == list(range(1, len(ordered) + 1))


READING = "source_id bigint, timestamp timestamp, value double, condition string, quality_score double"
H = datetime(2024, 1, 1, 10)


def pairs_of(spark, rows):
    full = [(plz, sid, d, 50.0, 10.0) for plz, sid, d in rows]
    return materialize(
        spark.createDataFrame(
            full,
            "plz string, source_id bigint, distance_km double, centroid_lat double, "
            "centroid_lon double",
        ),
        "pairs",
    )


WAYS = [
    pytest.param({"cut": False, "counted": True}, id="whole, counted"),
    pytest.param({"cut": False, "counted": False}, id="whole, plain"),
    pytest.param({"cut": True, "counted": True}, id="cut, counted"),
    pytest.param({"cut": True, "counted": False}, id="cut, plain"),
]


@pytest.fixture(autouse=True)
def cut_blocks(request, monkeypatch):
    """Blocks cut both ways, down to single readings and pairs."""
    way = getattr(request.node, "callspec", None)
    if way and way.params.get("way", {}).get("cut"):
        monkeypatch.setattr(idw, "SLICE_ROWS", 1)
        monkeypatch.setattr(idw, "PAIR_ROWS", 1)


def run(spark, readings, pairs, way, minimum=1):
    df = spark.createDataFrame(readings, READING)
    words = idw.condition_vocabulary(df) if way["counted"] else None
    out = idw.interpolate(df, pairs, ["value", "absent"], minimum, Ranges(), words, distinct_stations=True)
    return {(r["plz"], r["timestamp"].hour): r for r in out.collect()}


def test_what_the_pairs_make_is_not_shuffled(spark):
    """Both sides of the block join move by part; above it there is no exchange, and no broadcast of pairs."""
    pairs = pairs_of(spark, [(str(p), s, 1.0 + s) for p in range(20) for s in range(3)])
    df = spark.createDataFrame([(s, H, 1.0, "dry", 1.0) for s in range(3)], READING)
    out = idw.interpolate(df, pairs, ["value"], vocabulary=["dry"])
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    above, joined, below = plan.partition("SortMergeJoin [_block")
    assert joined and "Exchange" not in above
    assert below.count("REPARTITION_BY_NUM") == 2


def test_parts_are_bounded(spark, monkeypatch):
    """A crowded block with a busy station is cut by hours and by places."""
    monkeypatch.setattr(idw, "SLICE_ROWS", 50)
    monkeypatch.setattr(idw, "PAIR_ROWS", 40)
    pairs = pairs_of(spark, [(str(p), s, 1.0) for p in range(100) for s in range(2)])
    df = spark.range(600).select(
        (F.col("id") % 2).alias("source_id"), (F.lit(H) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("timestamp"),
        F.col("id").cast("double").alias("value"), F.lit("dry").alias("condition"), F.lit(1.0).alias("quality_score"),
    )
    sums = idw.station_sums(df, ["value"], ["dry"])
    parts = idw._block_join(sums, pairs, idw.reading_profile(df)).groupBy(*idw.PART).agg(
        F.count_distinct("plz").alias("places"), F.count_distinct("timestamp").alias("hours")
    ).collect()
    assert len(parts) == 12 * 5
    assert max(r["places"] for r in parts) < 40 and max(r["hours"] for r in parts) < 100
    out = idw.interpolate(df, pairs, ["value"], vocabulary=["dry"])
    assert out.count() == 100 * 600 and out.agg(F.max("num_stations")).first()[0] == 1


@pytest.mark.parametrize("way", WAYS)
def test_interpolation(spark, way):
    pairs = pairs_of(spark, [("a", 1, 0.0), ("a", 2, 0.9), ("b", 2, 4.9), ("c", 3, 1.0)])
    readings = [
        (1, H, 10.0, "dry", 1.0),
        (2, H, 20.0, "rain", 0.5),
        (2, H, 22.0, "rain", 0.5),  # two readings of a station both count
        (1, H.replace(hour=11), None, None, 0.9),
        (2, H.replace(hour=11), 5.0, "fog", 1.0),
        (2, H.replace(hour=12), None, None, 1.0),
        (9, H, 99.0, "dry", 1.0),  # in nobody's range
    ]
    got = run(spark, readings, pairs, way)
    assert set(got) == {("a", 10), ("b", 10), ("a", 11), ("b", 11), ("a", 12), ("b", 12)}
    a = got["a", 10]
    assert a["value"] == pytest.approx((10 * 10.0 + 1 * 20.0 + 1 * 22.0) / 12.0)
    assert a["absent"] is None
    assert (a["condition"], a["num_stations"], a["distinct_stations"]) == ("rain", 3, 2)
    assert a["data_quality_score"] == pytest.approx(2.0 / 3 * 1.0)
    assert got["b", 10]["value"] == pytest.approx(21.0)
    # Null at the nearest station: the others alone.
    assert got["a", 11]["value"] == pytest.approx(5.0)
    assert (got["a", 11]["condition"], got["a", 11]["num_stations"]) == ("fog", 2)
    assert got["a", 12]["value"] is None
    assert got["a", 12]["condition"] is None
    assert got["b", 12]["data_quality_score"] == pytest.approx(1 / 3)
    assert set(run(spark, readings, pairs, way, minimum=2)) == {("a", 10), ("a", 11), ("b", 10)}


@pytest.mark.parametrize("way", WAYS)
def test_condition_ties_go_to_the_smallest(spark, way):
    pairs = pairs_of(spark, [("a", i, 1.0) for i in range(5)])
    votes = ["snow", "dry", None, None, "rain"]
    got = run(spark, [(i, H, 1.0, v, 1.0) for i, v in enumerate(votes)], pairs, way)
    assert got["a", 10]["condition"] == "dry"


@pytest.mark.parametrize("way", WAYS)
def test_means_stay_within_their_readings(spark, way):
    rng = random.Random(5)
    pairs = pairs_of(spark, [("a", i, rng.uniform(0, 10)) for i in range(20)])
    values = [rng.uniform(-20, 30) for _ in range(20)]
    got = run(spark, [(i, H, v, "dry", 1.0) for i, v in enumerate(values)], pairs, way)["a", 10]
    assert min(values) <= got["value"] <= max(values)
    assert 0.0 <= got["data_quality_score"] <= 1.0


def test_one_station_holds_most_readings(spark):
    pairs = pairs_of(spark, [(str(p), s, 1.0 + s) for p in range(20) for s in range(3)])
    df = spark.range(30_000).select(
        F.when(F.col("id") < 29_000, 0).otherwise(F.col("id") % 3).alias("source_id"),
        F.lit(H).alias("timestamp"), (F.col("id") % 7).cast("double").alias("value"),
        F.lit("dry").alias("condition"), F.lit(1.0).alias("quality_score"),
    )
    sums = idw.station_sums(df, ["value"])
    assert sums.count() == 3  # what meets the places
    out = idw.interpolate(df, pairs, ["value"]).collect()
    assert len(out) == 20
    assert {r["num_stations"] for r in out} == {30_000}


def test_too_many_conditions_are_not_counted(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("condition"))
    assert idw.condition_vocabulary(df, 9) is None
    assert idw.condition_vocabulary(df, 10) == [str(i) for i in range(10)]


VERSIONED = "k int, v timestamp, tag string"


def test_latest(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [(1, t2, "new"), (1, t1, "old"), (2, t1, "a"), (2, t1, "b"), (3, t1, "only")], VERSIONED
    )
    got = {r["k"]: r["tag"] for r in versions.latest(df, ["k"], "v").collect()}
    assert got == {1: "new", 2: "b", 3: "only"}
    again = versions.latest(df.unionByName(df), ["k"], "v")
    assert {r["k"]: r["tag"] for r in again.collect()} == got
    assert again.count() == 3


def test_latest_limits_groups_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 1), "x")], VERSIONED)
    plan = versions.latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_issue_wins_even_when_null(spark):
    rows = [(1, H, datetime(2024, 1, 1, h), H, v) for h, v in ((0, 1.0), (6, 2.0), (9, None))]
    df = spark.createDataFrame(
        rows,
        "source_id bigint, timestamp timestamp, forecast_created_at timestamp, "
        "ingested_at timestamp, temperature double",
    )
    got = versions.latest_issue(df).collect()
    assert len(got) == 1
    assert got[0]["forecast_created_at"].hour == 9
    assert got[0]["temperature"] is None


def test_first_seen_and_without_keys(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "c", 1)], "k int, o string, x int")
    got = {r["k"]: r["x"] for r in versions.first_seen(df, ["k"], ["o"]).collect()}
    assert got == {1: 9, 2: 1}
    doomed = spark.createDataFrame([(1,)], "k int")
    assert [r["k"] for r in versions.without_keys(df, doomed, ["k"]).collect()] == [2]


def test_conform(spark):
    df = spark.createDataFrame([("z", 5, 1.5)], "extra string, source_id int, temperature double")
    got = conform(df, schemas.OBSERVATIONS_SYNOP.payload)
    assert got.columns == schemas.OBSERVATIONS_SYNOP.payload.fieldNames()
    row = got.first()
    assert (row["source_id"], row["temperature"], row["wind_speed_10"]) == (5, 1.5, None)


def test_table_shapes():
    sizes = {n.split(".")[1]: len(t.columns) for n, t in schemas.TABLES.items()}
    assert sizes == {
        "postal_codes": 6, "weather_stations": 12, "weather_observations_synop": 31,
        "weather_observations": 19, "weather_forecasts": 20, "observations_by_postal_code": 15,
        "forecasts_by_postal_code": 17,
    }


def test_prefixes_are_literal(spark):
    df = places(spark, [("10115", 1.0, 1.0), ("1_115", 1.0, 1.0), ("20115", 1.0, 1.0)])
    assert transforms.with_prefix(df, "1_").count() == 1
    assert transforms.with_prefix(df, ["10", "20"]).count() == 2
    assert transforms.with_prefix(df, "").count() == 3
    assert transforms.with_prefix(df, None).count() == 3


def test_newest(spark):
    t = datetime(2024, 1, 1, 10)
    rows = [
        (s, t.replace(hour=h), t.replace(hour=h, minute=v), float(v))
        for s in range(3) for h in range(5, 10) for v in (0, 1)
    ]
    df = spark.createDataFrame(
        rows, "source_id bigint, timestamp timestamp, ingested_at timestamp, temperature double"
    )
    got = reads.latest_observations_synop(df, limit=4).collect()
    assert [(r["source_id"], r["timestamp"].hour, r["temperature"]) for r in got] == [
        (0, 9, 1.0), (1, 9, 1.0), (2, 9, 1.0), (0, 8, 1.0),
    ]
    only = reads.latest_observations(df, source_id=0, limit=2).collect()
    assert [r["source_id"] for r in only] == [0, 0]


def test_hour_window_and_alignment(spark):
    rows = [
        (1, datetime(2024, 1, 15, h, m, s), datetime(2024, 1, 15, 12), float(h))
        for h, m, s in ((10, 0, 0), (10, 59, 59), (11, 0, 0), (9, 59, 59))
    ]
    df = spark.createDataFrame(
        rows, "source_id bigint, timestamp timestamp, ingested_at timestamp, temperature double"
    )
    raw = conform(df, schemas.OBSERVATIONS_SYNOP.schema)
    got = transforms.prepare_readings(
        raw, transforms.OBSERVATION, datetime(2024, 1, 15, 10, 20), 1
    ).collect()
    assert [r["timestamp"].hour for r in got] == [10, 10]


def test_forecasts_off_the_hour_do_not_match(spark):
    rows = [(1, datetime(2024, 1, 15, 10, m), H, H) for m in (0, 30)]
    df = spark.createDataFrame(
        rows,
        "source_id bigint, timestamp timestamp, forecast_created_at timestamp, ingested_at timestamp",
    )
    raw = conform(df, schemas.FORECASTS.schema)
    assert transforms.prepare_readings(raw, transforms.FORECAST).count() == 1


def test_fits(spark):
    assert fits(spark.range(10), 10)
    assert not fits(spark.range(11), 10)


def test_a_reading_goes_to_few_parts_of_a_crowded_degree(spark, monkeypatch):
    """Blocks are halved where pairs are many, so that places near one another, and with them their stations, share a part."""
    monkeypatch.setattr(idw, "PAIR_ROWS", 64)
    spots = [(s, 50.03 + (s // 16) / 16, 10.03 + (s % 16) / 16) for s in range(256)]
    pairs = materialize(
        spark.createDataFrame(
            [(f"{s}-{k}", s, 1.0, lat, lon) for s, lat, lon in spots for k in range(4)],
            "plz string, source_id bigint, distance_km double, centroid_lat double, centroid_lon double",
        ),
        "pairs",
    )
    df = spark.createDataFrame([(s, H, float(s), "dry", 1.0) for s in range(256)], READING)
    sums = idw.station_sums(df, ["value"], ["dry"])
    joined = idw._block_join(sums, pairs, idw.reading_profile(df))
    assert joined.count() == 1024
    assert joined.select(*idw.PART, "source_id", "timestamp").distinct().count() == 256
    out = {r["plz"]: r["value"] for r in idw.interpolate(df, pairs, ["value"], vocabulary=["dry"]).collect()}
    assert len(out) == 1024 and all(v == pytest.approx(float(p.split("-")[0])) for p, v in out.items())


def test_what_the_pairs_make_is_in_no_aggregate(spark):
    pairs = pairs_of(spark, [(str(p), s, 1.0 + s) for p in range(20) for s in range(3)])
    df = spark.createDataFrame([(s, H, 1.0, "dry", 1.0) for s in range(3)], READING)
    out = idw.interpolate(df, pairs, ["value"], vocabulary=["dry"])
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert "Aggregate" not in plan.partition("SortMergeJoin [_block")[0]


@pytest.mark.parametrize("way", WAYS)
def test_odd_readings_and_pairs(spark, way):
    """Infinite values reach the places near their station alone, a pair given twice counts twice, a reading without a time stays."""
    pairs = pairs_of(spark, [("a", 1, 0.0), ("b", 2, 0.9), ("b", 2, 0.9), ("b", 3, 0.9), (None, 3, 1.0)])
    readings = [
        (1, H, float("inf"), "dry", 1.0), (2, H, 2.0, "dry", 1.0), (3, H, 5.0, "fog", 1.0), (3, None, 7.0, None, 1.0),
    ]
    df = spark.createDataFrame(readings, READING)
    words = idw.condition_vocabulary(df) if way["counted"] else None
    out = idw.interpolate(df, pairs, ["value"], 1, Ranges(), words).collect()
    got = {(r["plz"], r["timestamp"]): (r["value"], r["condition"], r["num_stations"]) for r in out}
    assert got == {
        ("a", H): (float("inf"), "dry", 1), ("b", H): (pytest.approx(3.0), "dry", 3), (None, H): (pytest.approx(5.0), "fog", 1),
        ("b", None): (pytest.approx(7.0), None, 1), (None, None): (pytest.approx(7.0), None, 1),
    }


def test_discovery_makes_no_pairs(spark, monkeypatch):
    """A cell's stations leave with the first places that found them, whatever the number of places; equal to brute force."""
    monkeypatch.setattr(radius, "BLOCK", 300)
    monkeypatch.setattr(radius, "FIRST_PLACES", 4)
    rng = random.Random(11)
    p = [(f"{i:05}", 50.0 + rng.uniform(0, 0.3), 10.0 + rng.uniform(0, 0.4)) for i in range(1500)] + [("x", None, 10.0)]
    s = [(i, rng.choice(["synop", "forecast"]), 49.85 + rng.uniform(0, 0.6), 9.8 + rng.uniform(0, 0.8)) for i in range(200)]
    places = spark.createDataFrame(p, "plz string, centroid_lat double, centroid_lon double")
    catalogue = spark.createDataFrame(s, "id bigint, observation_type string, lat double, lon double")
    found = radius.discover_stations(places, catalogue)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan
    pairs = radius.radius_join(places, catalogue.withColumnRenamed("id", "source_id"))
    first = {}
    for r in pairs.orderBy("plz", ascending=False).collect():
        first[r["source_id"]] = r["distance_km"] * 1000.0
    assert {r["id"]: r["distance"] for r in found.collect()} == first and len(first) > 50


def test_one_postal_code_pairs_its_own_place_alone(spark, monkeypatch):
    from stationfield.plans import registry

    asked = []
    pairs = registry.transforms.station_pairs

    def watched(*given):
        asked.append(given[3])
        return pairs(*given)

    monkeypatch.setattr(registry.transforms, "station_pairs", watched)
    assert registry.QUERIES["one_postal_code"](spark, "/root/testdata/sf0.001").count() == 1
    assert asked == ["10042"]


def test_far_candidates_cost_no_arc(spark):
    """Sines and cosines are taken of points, not of candidates, and the arc only of those that a product of vectors leaves."""
    places = spark.createDataFrame([("a", 50.0, 10.0)], "plz string, centroid_lat double, centroid_lon double")
    stations = spark.createDataFrame([(i, 50.0 + i / 100, 10.0) for i in range(30)], "source_id bigint, lat double, lon double")
    near = radius.radius_join(places, stations)
    plan = near._jdf.queryExecution().optimizedPlan().toString()
    above, joined, below = plan.partition("Join Inner")
    above += joined + below.partition("\n")[0]
    assert "SIN(" not in above and above.count("ACOS(") == 2
    assert {r["source_id"] for r in near.collect()} == set(range(9))
    assert near.columns == ["plz", "centroid_lat", "centroid_lon", "source_id", "lat", "lon", "distance_km"]


def scattered(spark, seed):
    """Places and stations round a pole, across the antimeridian and close together, some without real coordinates."""
    import random

    rng = random.Random(seed)
    spots = [(89.95, 0.0, 180.0), (50.0, 179.99, 0.2), (-10.0, -179.99, 0.2), (51.0, 11.0, 0.3)]
    p, s = [("none", None, 1.0), ("nan", float("nan"), 1.0)], [(9000, None, 1.0), (9001, 95.0, 1.0)]
    for k, (lat, lon, wide) in enumerate(spots):
        p += [(f"{k}-{i}", min(90.0, lat + rng.uniform(-0.2, 0.2)), lon + rng.uniform(-wide, wide)) for i in range(40)]
        s += [(100 * k + i, min(90.0, lat + rng.uniform(-0.2, 0.2)), lon + rng.uniform(-wide, wide)) for i in range(30)]
    s += [(500, *s[2][1:]), (501, *s[2][1:])]  # as far from any place as another
    return (
        spark.createDataFrame(p, "plz string, centroid_lat double, centroid_lon double"),
        spark.createDataFrame(s, "source_id bigint, lat double, lon double"),
    )


@pytest.mark.parametrize("small", [False, True])
def test_ground_gives_the_means_and_ranks_of_the_pairs(spark, monkeypatch, small):
    from stationfield.operators import parts

    if small:
        for module, name, value in (
            (radius, "PLACE_ROWS", 4), (radius, "RANKED_PLACES", 3), (idw, "MADE_ROWS", 20), (idw, "SLICE_ROWS", 7),
            (parts, "GROUND_CELLS", 6), (parts, "OUT_ROWS", 5), (parts, "RANKED_ROWS", 7),
        ):
            monkeypatch.setattr(module, name, value)
    places, stations = scattered(spark, 3)
    pairs = radius.radius_join(places, stations).select("plz", "source_id", "distance_km", "centroid_lat", "centroid_lon")
    spot = radius.ground(places, stations)
    rows = [
        (i, datetime(2024, 1, 1 + i % 3, i % 5), float(i % 17) if i % 7 else None, ["dry", "fog", None][i % 3])
        for _, i in zip(range(5000), [r["source_id"] for r in stations.collect()] * 5)
    ] + [(1, None, 1.0, "dry"), (None, datetime(2024, 1, 1), 1.0, "dry")]
    df = spark.createDataFrame(rows, "source_id bigint, timestamp timestamp, value double, condition string")

    def table(out):
        return sorted(
            (r["plz"], str(r["timestamp"]), r["value"] and round(r["value"], 6), r["condition"], r["num_stations"], r["distinct_stations"])
            for r in out.collect()
        )

    for words in (["dry", "fog"], None):
        got, want = (table(idw.interpolate(df, p, ["value"], 2, vocabulary=words, distinct_stations=True)) for p in (spot, pairs))
        assert got == want and len(want) > 100
    ranked = [
        {(r["plz"], r["source_id"]): r["distance_rank"] for r in out.collect()}
        for out in (radius.rank_on_ground(spot), radius.rank_by_distance(pairs))
    ]
    assert ranked[0] == ranked[1] and len(ranked[0]) > 100


@pytest.mark.parametrize("name", ["coverage", "forecast_horizon_refresh", "missing_hours", "nearest_station_rank"])
def test_pairs_are_neither_written_nor_moved(spark, monkeypatch, name):
    from stationfield.plans import registry, transforms

    def refused(*_, **__):
        raise AssertionError("pairs as rows")

    monkeypatch.setattr(transforms, "radius_join", refused)
    monkeypatch.setattr(radius, "radius_join", refused)
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


@pytest.mark.parametrize("words", ["few", "many"])
def test_newest_issue_of_two_runs_is_chosen_where_they_are_made(spark, monkeypatch, words):
    places, stations = scattered(spark, 5)
    spot = radius.ground(places, stations)
    rows = [
        (s, datetime(2024, 1, 1 + s % 3, h), datetime(2023, 12, 31, (s * h) % 20), float(s + 100 * run), f"w{s if words == 'many' else s % 3}", run)
        for s in range(130) for h in range(4) for run in (0, 1) if (s + h + run) % 3
    ]
    shape = "source_id bigint, timestamp timestamp, forecast_created_at timestamp, temperature double, condition string, run int"
    raw = spark.createDataFrame(rows, shape)
    runs = [conform(raw.where(F.col("run") == i), schemas.FORECASTS.schema) for i in (0, 1)]
    made = [transforms.transform(r, spot, transforms.FORECAST).collect() for r in runs]
    want = {}
    for r in [r for run in made for r in run]:
        key = (r["plz"], r["timestamp"])
        if key not in want or r["forecast_created_at"] >= want[key]["forecast_created_at"]:
            want[key] = r
    out = reads.current_forecast_of_runs(runs, spot)
    if words == "few":
        assert "Window [plz" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r["plz"], r["timestamp"]): r for r in out.collect()}
    assert got.keys() == want.keys() and len(got) > 50
    assert {k: r["forecast_created_at"] for k, r in got.items()} == {k: r["forecast_created_at"] for k, r in want.items()}
    if words == "few":
        assert {k: r["temperature"] for k, r in got.items()} == {k: r["temperature"] for k, r in want.items()}


def test_a_place_goes_to_as_few_slices_as_the_tasks_want_unless_rows_are_stored_by_day(spark, monkeypatch):
    monkeypatch.setattr(idw, "MADE_ROWS", 20)
    places, stations = scattered(spark, 7)
    spot = radius.ground(places, stations)
    rows = [(i % 130, datetime(2024, 1, 1 + i % 20, i % 24), float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "source_id bigint, timestamp timestamp, value double").withColumn("condition", F.lit("dry"))
    moved, dealt = [], radius.Ground.rows
    monkeypatch.setattr(radius.Ground, "rows", lambda self, p, s: moved.append((p.count(), s.count())) or dealt(self, p, s))

    def table(**options):
        out = idw.interpolate(df, spot, ["value"], vocabulary=["dry"], **options)
        return sorted((r["plz"], str(r["timestamp"]), round(r["value"], 6), r["num_stations"]) for r in out.collect())

    assert table() == table(few_days=True)
    (few, once), (many, again) = moved
    assert 4 * few < many and once <= again


@pytest.mark.parametrize("wide", [0.0, 0.02, 3.0, 180.0])
@pytest.mark.parametrize("radius_km", [0.0, 10.0, 500.0, 30000.0])
def test_arcs_are_those_of_all_pairs_in_range(monkeypatch, wide, radius_km):
    import numpy as np
    import pyarrow as pa

    from stationfield.operators import parts

    rng = np.random.default_rng(1)
    here, there = (
        parts.Sphere(pa.array(50 + rng.uniform(-wide, wide, n) / 5), pa.array(10 + rng.uniform(-wide, wide, n))) for n in (60, 40)
    )
    some, those = np.arange(5, 60), np.arange(0, 40, 2)
    cosine = np.cos(here.phi[some])[:, None] * np.cos(there.phi[those]) * np.cos(there.lam[those] - here.lam[some][:, None])
    cosine += np.sin(here.phi[some])[:, None] * np.sin(there.phi[those])
    want = parts.EARTH_RADIUS_KM * np.arccos(np.clip(cosine, -1.0, 1.0))
    want[want > radius_km] = np.inf
    for few in (0.0, 0.3, 2.0):
        monkeypatch.setattr(parts, "FEW", few)
        assert np.array_equal(here.apart(some, there, those, radius_km), want)
