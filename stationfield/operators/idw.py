"""Inverse-distance-weighted interpolation of station readings to places.

Sums are enough: the weight of a station is fixed per place, so readings are first summed per
station, time and condition, and only these sums meet the places. A station with many readings
per hour, or one that holds most of them, thus shrinks before anything is multiplied by places.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from stationfield.functions.geo import idw_weight
from stationfield.functions.quality import DEFAULT_RANGES, Ranges, station_factor
from stationfield.operators.parts import means_of_part, means_on_ground
from stationfield.operators.radius import MOST_TASKS, Ground
from stationfield.session import BROADCAST_ROWS, fits, materialize

ISSUE = "forecast_created_at"
# Places that share a block are interpolated by the same task. Blocks are this many degrees wide, and halved up to
# HALVINGS times where they are crowded.
BLOCK_DEGREES = 1.0
HALVINGS = 4
# Readings of a block that are one slice of it, and pairs that are one share.
SLICE_ROWS = 262_144
PAIR_ROWS = 2_097_152
# Rows that a part on the ground makes, at least where there are parts for all tasks, and at most; and products of its
# places and readings.
MADE_ROWS = 1_048_576
MOST_MADE_ROWS = 8_388_608
PRODUCTS = 4_294_967_296
PART = ["_block", "_slice", "_share"]
# Beyond the rounding error of a weighted mean.
MEAN_SLACK = 1e-9
# With no more distinct conditions than this, each has its votes in a column of its own.
VOCABULARY_LIMIT = 32


def weighted_mean(value: Column, weight: Column) -> Column:
    """Null-skipping weighted mean as a plain aggregate; null where every value is null."""
    return F.try_divide(
        F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight))
    )


def most_frequent(value: Column) -> Column:
    """Most frequent non-null value, the smallest one of a tie."""
    return F.mode(value, True)


def _present(readings: DataFrame, fields: Sequence[str]) -> list[str]:
    return [f for f in fields if f in readings.columns]


def condition_vocabulary(raw: DataFrame, limit: int = VOCABULARY_LIMIT) -> list[str] | None:
    """The distinct conditions in ascending order, or None if there are more than `limit`.

    Reads one column, combined on the map side; no more than `limit` + 1 values reach the driver.
    """
    distinct = raw.select("condition").where(F.col("condition").isNotNull()).distinct()
    found = distinct.limit(limit + 1).collect()
    return sorted(row["condition"] for row in found) if len(found) <= limit else None


def _votes(vocabulary: Sequence[str]) -> list[str]:
    return [f"votes_{i}" for i in range(len(vocabulary))]


def votes_for(vocabulary: Sequence[str]) -> list[Column]:
    """Aggregates that count each condition in a column of its own."""
    return [
        F.count(F.when(F.col("condition") == word, F.lit(1))).alias(name)
        for word, name in zip(vocabulary, _votes(vocabulary), strict=True)
    ]


def winner_of(vocabulary: Sequence[str]) -> Column:
    """The condition with the most votes, the first in the vocabulary of a tie."""
    size = len(vocabulary)
    ballots = [
        F.when(F.col(v) > 0, F.col(v) * size + (size - 1 - i))
        for i, v in enumerate(_votes(vocabulary))
    ]
    # `greatest` skips nulls and wants two arguments.
    top = F.greatest(*ballots, F.lit(None).cast("bigint"), F.lit(None).cast("bigint"))
    words = F.array(*[F.lit(w) for w in vocabulary]) if size else F.expr("array('')")
    return F.get(words, F.lit(size - 1) - F.pmod(top, F.lit(max(size, 1))))


def station_sums(
    readings: DataFrame,
    fields: Sequence[str],
    vocabulary: Sequence[str] | None = None,
    distinct_stations: bool = False,
) -> DataFrame:
    """Per station and time: sum and count of each field, summed quality and row count, and the
    votes for each condition of the vocabulary. Without one the condition is part of the key.
    `stations`, if wanted, is 1 once per station and time."""
    sums = [F.sum(f).alias(f"sum_{f}") for f in fields]
    counts = [F.count(f).cast("double").alias(f"n_{f}") for f in fields]
    issue = [F.max(ISSUE).alias(ISSUE)] if ISSUE in readings.columns else []
    quality = F.sum("quality_score") if "quality_score" in readings.columns else F.count(F.lit(1))
    key, votes = ["source_id", "timestamp"], []
    if vocabulary is None:
        key.append("condition")
    else:
        votes = votes_for(vocabulary)
    summed = readings.groupBy(*key).agg(
        *sums, *counts, *votes, quality.cast("double").alias("quality"),
        F.count(F.lit(1)).alias("rows"), *issue,
    )
    if not distinct_stations:
        return summed
    if vocabulary is not None:
        return summed.withColumn("stations", F.lit(1))
    first = F.row_number().over(Window.partitionBy("source_id", "timestamp").orderBy("condition"))
    return summed.withColumn("stations", (first == 1).cast("int"))


def _combine(
    weighted: DataFrame,
    fields: Sequence[str],
    key: Sequence[str],
    vocabulary: Sequence[str] | None,
) -> DataFrame:
    """Weighted sums and the most frequent condition per place and time.

    With a vocabulary this is one hash aggregate over numbers. Without, an inner grouping counts
    each condition and an outer one picks the most frequent, which takes a sort.
    """
    names = [*[f"{kind}_{f}" for f in fields for kind in ("sum", "n")], "quality", "rows"]
    names += [c for c in ("stations",) if c in weighted.columns]
    issue = [F.max(ISSUE).alias(ISSUE)] if ISSUE in weighted.columns else []
    if vocabulary is not None:
        summed = [F.sum(c).alias(c) for c in [*names, *_votes(vocabulary)]]
        combined = weighted.groupBy(*key).agg(*summed, *issue)
        return combined.withColumn("condition", winner_of(vocabulary))
    totals = [F.sum(c).alias(c) for c in names]
    by_condition = weighted.groupBy(*key, "condition").agg(*totals, *issue)
    ballot = F.struct(-F.col("rows"), F.col("condition"))
    winner = F.min(F.when(F.col("condition").isNotNull(), ballot))["condition"]
    return by_condition.groupBy(*key).agg(*totals, *issue, winner.alias("condition"))


def reading_profile(raw: DataFrame) -> DataFrame:
    """(source_id, condition, rows), written once: what the vocabulary and the cuts are taken from.
    One scan of two columns, combined on the map side."""
    return materialize(
        raw.groupBy("source_id", "condition").agg(F.count(F.lit(1)).alias("rows")), "profile"
    )


def interpolate(
    readings: DataFrame,
    pairs: DataFrame | Ground,
    fields: Sequence[str],
    min_stations: int = 1,
    ranges: Ranges = DEFAULT_RANGES,
    vocabulary: Sequence[str] | None = None,
    profile: DataFrame | None = None,
    distinct_stations: bool = False,
    days: int | None = None,
    few_days: bool = False,
) -> DataFrame:
    """One row per place and time with at least `min_stations` readings in range.

    `readings`: source_id, timestamp (already aligned), condition, the fields, quality_score and,
    for forecasts, the issue time. `pairs`: plz, source_id, distance_km, centroid_lat,
    centroid_lon, read more than once, so better a written table than a plan; or the `Ground` on which the tasks
    find them, which takes the pairs' growth with the square of the density off the disk (`days`: of the readings; counted unless given). `vocabulary`, if
    given, holds every condition that occurs (see `condition_vocabulary`). `profile` has at least as many
    `rows` of each station as `readings` (see `reading_profile`); it is taken of the readings unless given. `num_stations` counts readings;
    `distinct_stations` adds a column of that name that counts stations. `few_days`: on the ground each task has few days of its
    places, for who stores its rows by day where they are made.
    """
    present = _present(readings, fields)
    sums = station_sums(readings, present, vocabulary, distinct_stations)
    profile = reading_profile(readings) if profile is None else profile
    if vocabulary is not None and isinstance(pairs, Ground):
        days = count_days(readings) if days is None else days
        combined = _meet_on_ground(sums, pairs, profile, days, present, vocabulary, few_days=few_days)
        return _finish(combined, fields, present, min_stations, ranges)
    if isinstance(pairs, Ground):
        pairs = materialize(pairs.pairs(), "pairs")
    if vocabulary is not None:
        combined = _meet_in_parts(sums, pairs, profile, present, vocabulary)
        return _finish(combined, fields, present, min_stations, ranges)
    spread = _block_join(sums, pairs, profile)
    key = ["plz", "timestamp", *PART]
    names = [f"{kind}_{f}" for f in present for kind in ("sum", "n")]
    carried = [c for c in sums.columns if c not in [*names, "source_id", "timestamp"]]
    weighted = spread.select(*key, *carried, *[(F.col(c) * F.col("_weight")).alias(c) for c in names])
    combined = _combine(weighted, present, key, vocabulary)
    means = combined.withColumns({f: F.try_divide(f"sum_{f}", f"n_{f}") for f in present})
    return _finish(means, fields, present, min_stations, ranges)


def interpolate_runs(
    runs: Sequence[DataFrame],
    spot: Ground,
    fields: Sequence[str],
    min_stations: int,
    ranges: Ranges,
    vocabulary: Sequence[str],
    profile: DataFrame,
    days: int,
) -> DataFrame:
    """Each run of forecasts interpolated by itself; of the rows of a place and time the newest issue stays, of equal
    issues the last run's. `profile` and `days` are those of all runs together."""
    present = _present(runs[0], fields)
    sums = [station_sums(r, present, vocabulary).withColumn("_run", F.lit(i)) for i, r in enumerate(runs)]
    combined = _meet_on_ground(
        reduce(DataFrame.unionByName, sums), spot, profile, days, present, vocabulary, min_stations
    )
    return _finish(combined, fields, present, min_stations, ranges)


def _blocks(placed: DataFrame) -> DataFrame:
    """The block of each cell (the smallest block there is) that holds pairs: the largest one around it with at most
    PAIR_ROWS pairs. A reading goes to each block its station serves, so blocks are as large as their pairs allow."""
    cells = placed.groupBy("_down", "_across").agg(F.count(F.lit(1)).alias("_pairs"))
    level, names = F.lit(0), []
    for k in range(1, HALVINGS + 1):
        around = [F.shiftright("_down", k), F.shiftright("_across", k)]
        cells = cells.withColumn(f"_at_{k}", F.sum("_pairs").over(Window.partitionBy(*around)))
        level = F.when(F.col(f"_at_{k}") <= PAIR_ROWS, F.lit(k)).otherwise(level)
        names.append(f"_at_{k}")
    sized = cells.withColumn("_level", level).drop("_pairs", *names)
    number = F.xxhash64(
        "_level", F.expr("shiftright(_down, _level)"), F.expr("shiftright(_across, _level)")
    )
    return materialize(sized.select("_down", "_across", number.alias("_block")), "blocks")


def _dealt(sums: DataFrame, pairs: DataFrame, profile: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The station sums and the pairs, dealt out by part.

    A part is a block of places, cut by hours into as many slices as it has SLICE_ROWS readings and by
    places into as many as it has PAIR_ROWS pairs, which only the smallest blocks have. A sum goes to each share of
    the places its station serves, and a pair to each slice of its block: both sides move once, by part, and what they
    make, some dozens of rows for each sum, is never shuffled. No part grows with the table or with the density of a block.
    """
    cell = BLOCK_DEGREES / 2**HALVINGS
    across = F.floor((F.col("centroid_lon") + 180.0) / cell)
    down = F.floor((F.col("centroid_lat") + 90.0) / cell)
    placed = pairs.select(
        "plz", "source_id", idw_weight(F.col("distance_km")).alias("_weight"),
        down.alias("_down"), across.alias("_across"),
    )
    blocks = _blocks(placed)
    if fits(blocks):
        blocks = F.broadcast(blocks)
    placed = placed.join(blocks, ["_down", "_across"]).drop("_down", "_across")
    served = materialize(
        placed.groupBy("source_id", "_block").agg(F.count(F.lit(1)).alias("_pairs")), "served"
    )
    per_station = profile.groupBy("source_id").agg(F.sum("rows").alias("_rows"))
    cuts = materialize(
        served.join(per_station, "source_id").groupBy("_block").agg(
            F.ceil(F.sum("_rows") / F.lit(SLICE_ROWS)).cast("int").alias("_slices"),
            F.ceil(F.sum("_pairs") / F.lit(PAIR_ROWS)).cast("int").alias("_shares"),
        ),
        "cuts",
    )
    parts, known = cuts.agg(F.sum(F.col("_slices").cast("bigint") * F.col("_shares")), F.count(F.lit(1))).first()
    if known <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)

    spark = sums.sparkSession
    # As many tasks as the session is sized for, or as there are parts: what a part makes is far more than the bytes that
    # it reads, by which small partitions would be put together.
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(parts or 1, MOST_TASKS))

    def all_of(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    moved = (
        sums.join(served.drop("_pairs").join(cuts, "_block"), "source_id")
        .withColumn("_slice", F.pmod(F.xxhash64("timestamp"), F.col("_slices")).cast("int"))
        .withColumn("_share", all_of("_shares")).drop("_slices", "_shares").repartition(n, *PART)
    )
    target = (
        placed.join(cuts, "_block")
        .withColumn("_share", F.pmod(F.xxhash64("plz"), F.col("_shares")).cast("int"))
        .withColumn("_slice", all_of("_slices")).drop("_slices", "_shares").repartition(n, *PART)
    )
    # Both sides are dealt by part already; the station is an equal key only within it. The size of the
    # pairs in all slices is not what a plan made from files knows, so a broadcast is not its choice.
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return moved, target


def _block_join(sums: DataFrame, pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """Each station sum beside each place of its part, with `_weight`; for conditions without a vocabulary."""
    moved, target = _dealt(sums, pairs, profile)
    return moved.join(target.hint("merge"), [*PART, "source_id"])


def _meet_in_parts(
    sums: DataFrame,
    pairs: DataFrame,
    profile: DataFrame,
    present: Sequence[str],
    vocabulary: Sequence[str],
) -> DataFrame:
    """Means per place and time. The sums and the pairs of a station meet as lists within their part, and the stations of
    a part as matrices (see `parts`): what they make is never a row, and no aggregate holds the places of a task."""
    moved, target = _dealt(sums, pairs, profile)
    key = [*PART, "source_id"]
    told = [c for c in moved.columns if c not in key]
    readings = moved.groupBy(*key).agg(F.collect_list(F.struct(*told)).alias("_readings"))
    near = target.groupBy(*key).agg(F.collect_list(F.struct("plz", "_weight")).alias("_pairs"))
    met = readings.join(near.hint("merge"), key)
    issue = ISSUE if ISSUE in sums.columns else None
    means = met.groupBy(*PART).applyInArrow(
        means_of_part(list(present), len(vocabulary), issue, "stations" in sums.columns), _shape(pairs, sums, present)
    )
    return _with_words(means, vocabulary)


def _shape(places: DataFrame, sums: DataFrame, present: Sequence[str]) -> StructType:
    issue = [StructField(ISSUE, sums.schema[ISSUE].dataType)] if ISSUE in sums.columns else []
    stations = [StructField("stations", LongType())] if "stations" in sums.columns else []
    return StructType(
        [
            StructField("plz", places.schema["plz"].dataType),
            StructField("timestamp", sums.schema["timestamp"].dataType),
            *issue,
            *[StructField(f, DoubleType()) for f in present],
            StructField("_word", IntegerType()), StructField("quality", DoubleType()),
            StructField("rows", LongType()), *stations,
        ]
    )


def _with_words(means: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    words = F.array(*[F.lit(w) for w in vocabulary]) if vocabulary else F.expr("array('')")
    return means.withColumn("condition", F.get(words, F.col("_word")))


def count_days(readings: DataFrame) -> int:
    """The distinct days of the readings; one scan of a column, combined on the map side."""
    return readings.select(F.to_date("timestamp")).distinct().count()


def _meet_on_ground(
    sums: DataFrame,
    spot: Ground,
    profile: DataFrame,
    days: int,
    present: Sequence[str],
    vocabulary: Sequence[str],
    least: int | None = None,
    few_days: bool = False,
) -> DataFrame:
    """Means per place and time. A part is a block of ground, cut by days into slices and, where its days are not enough, by
    places into shares. A sum goes to the blocks its station may serve and a place to the slices of its block, so what moves grows
    with the tables, not with the pairs; these are found in the task, once for each slice of their block: parts are as large as the
    tasks of the session allow, or small with `few_days`. A day of a place is whole in one part, so that
    results are in few files of a day folder without being moved again."""
    per_station = profile.groupBy("source_id").agg(F.sum("rows").alias("_rows"))
    per_block = spot.stations.join(per_station, "source_id").groupBy("_block").agg(F.sum("_rows").alias("_rows"))
    rows, places, span = F.col("_rows"), F.col("_places"), F.lit(max(days, 1))
    made, most = places * F.least(rows, span * 24), MADE_ROWS
    sized = materialize(spot.sizes.join(per_block, "_block"), "cuts")
    tasks = int(sums.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not few_days:
        most = min(MOST_MADE_ROWS, max(MADE_ROWS, (sized.agg(F.sum(made)).first()[0] or 0) // tasks))
    by_place = F.greatest(made / F.lit(most), rows / F.lit(PRODUCTS) * places)
    cuts = sized.withColumn("_slices", F.least(
        span, F.ceil(F.greatest(by_place, rows / F.lit(SLICE_ROWS)))).cast("int")
    ).select("_block", "_slices", F.ceil(by_place / F.col("_slices")).cast("int").alias("_shares"))
    parts, known = cuts.agg(F.sum(F.col("_slices").cast("bigint") * F.col("_shares")), F.count(F.lit(1))).first()
    if known <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    n = max(tasks, min(parts or 1, MOST_TASKS))

    def all_of(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    day = F.coalesce(F.unix_date(F.to_date("timestamp")), F.lit(0))
    moved = (
        sums.join(spot.stations.join(cuts, "_block"), "source_id")
        .withColumn("_slice", F.pmod(day, F.col("_slices"))).withColumn("_share", all_of("_shares"))
    )
    target = (
        spot.places.join(cuts, "_block")
        .withColumn("_share", F.pmod(F.xxhash64("centroid_lat", "centroid_lon", "plz"), F.col("_shares")).cast("int"))
        .withColumn("_slice", all_of("_slices"))
    )
    met = spot.rows(target, moved).drop("_slices", "_shares").repartition(n, *PART)
    issue = ISSUE if ISSUE in sums.columns else None
    means = met.groupBy(*PART).applyInArrow(
        means_on_ground(list(present), len(vocabulary), issue, "stations" in sums.columns, spot.radius_km, least),
        _shape(spot.places, sums, present),
    )
    return _with_words(means, vocabulary)


def finished(
    means: DataFrame, fields: Sequence[str], min_stations: int = 1, ranges: Ranges = DEFAULT_RANGES
) -> DataFrame:
    """Rows of a place and time (means of all fields, `condition`, sums of `quality` and `rows`) as results."""
    return _finish(means, fields, fields, min_stations, ranges)


def _finish(
    combined: DataFrame,
    fields: Sequence[str],
    present: Sequence[str],
    min_stations: int,
    ranges: Ranges,
) -> DataFrame:
    values = [
        (F.col(f) if f in present else F.lit(None).cast("double")).alias(f)
        for f in fields
    ]
    issue = [ISSUE] if ISSUE in combined.columns else []
    rows = F.col("rows")
    score = F.col("quality") / rows * station_factor(rows)
    shaped = combined.where(rows >= F.lit(min_stations)).select(
        "plz", "timestamp", *issue, *values, "condition",
        rows.alias("num_stations"), score.alias("data_quality_score"),
        *[F.col(c).alias("distinct_stations") for c in ("stations",) if c in combined.columns],
    )
    return shaped.withColumn("is_validated", ranges.row_valid(list(fields), MEAN_SLACK))
