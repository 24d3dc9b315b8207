"""The places of one part met with the readings of its stations: what a task does between the block join and its rows.

Weighted sums over the stations near each place are, hour by hour, a product of two matrices: weights of places and
stations times values of stations. Only a chunk of places and an hour of readings are held dense.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

from stationfield.functions.geo import EARTH_RADIUS_KM, WEIGHT_OFFSET_KM

# Weights of a chunk of places, as cells of a matrix of 8 bytes each.
CELLS = 4_194_304
# The same where the chunks are found on the ground: a smaller one has fewer stations out of its places' reach.
GROUND_CELLS = 1_048_576
# The same in a square, whose places are listed beside their neighbours.
SQUARE_CELLS = 131_072
# Rows of a batch that leaves the task.
OUT_ROWS = 32_768
# Beyond the rounding error of a cosine.
DOT_SLACK = 1e-12
# Share of candidates among pairs up to which they are looked at one by one.
FEW = 0.3
_NONE = np.iinfo(np.int64).min
HOUR = 3_600_000_000


def _flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, pa.StructArray]:
    """The row that each element of a list column is in, and the elements."""
    whole = pa.concat_arrays(lists.chunks)
    return np.repeat(np.arange(len(whole)), whole.value_lengths().to_numpy()), whole.flatten()


def _numbers(rows: pa.StructArray, names: Sequence[str]) -> np.ndarray:
    """One column for each name, missing values as 0."""
    out = np.zeros((len(rows), len(names)))
    for i, name in enumerate(names):
        out[:, i] = rows.field(name).cast(pa.float64(), safe=False).fill_null(0.0).to_numpy(zero_copy_only=False)
    return out


def _micros(values: pa.Array) -> np.ndarray:
    return values.cast(pa.int64()).fill_null(_NONE).to_numpy(zero_copy_only=False)


def _times(micros: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array(micros, mask=micros == _NONE).cast(kind)


def _product(weights: np.ndarray, values: np.ndarray, near: np.ndarray) -> np.ndarray:
    """`weights.T @ values`, in which a value that is not finite counts only for the places it is near."""
    finite = np.isfinite(values)
    if finite.all():
        return weights.T @ values
    out = weights.T @ np.where(finite, values, 0.0)
    for row, column in np.argwhere(~finite):
        reached = near[row] > 0
        out[reached, column] += weights[row, reached] * values[row, column]
    return out


def _halved(
    place: np.ndarray, station: np.ndarray, low: int, high: int, cells: int = CELLS
) -> Iterator[tuple[int, int, np.ndarray, slice]]:
    """Runs of places, cut until their matrix is small, with their stations and pairs; pairs are in order of the place."""
    pairs = slice(*np.searchsorted(place, [low, high]))
    stations = np.unique(station[pairs])
    if high - low > 1 and (high - low) * len(stations) > cells:
        middle = (low + high) // 2
        yield from _halved(place, station, low, middle, cells)
        yield from _halved(place, station, middle, high, cells)
    else:
        yield low, high, stations, pairs


def _around(points: np.ndarray, some: np.ndarray, others: np.ndarray, those: np.ndarray, reach: float) -> np.ndarray:
    """Of `those` other points the ones that any of `some` points can have within `reach` radians, and a few more."""
    centre = points[some].mean(axis=0)
    length = np.linalg.norm(centre)
    if length < 1e-6:
        return those
    centre /= length
    wide = np.arccos(np.clip((points[some] @ centre).min(), -1.0, 1.0)) + reach + 1e-6
    return those if wide >= np.pi else those[others[those] @ centre >= np.cos(wide)]


class Sphere:
    """Points of a table with `_lat` and `_lon` in degrees."""

    def __init__(self, lat: pa.Array, lon: pa.Array) -> None:
        self.phi, self.lam = (np.radians(c.to_numpy(zero_copy_only=False)) for c in (lat, lon))
        self.cos, self.sin = np.cos(self.phi), np.sin(self.phi)
        self.at = np.column_stack([self.cos * np.cos(self.lam), self.cos * np.sin(self.lam), self.sin])

    def apart(self, mine: np.ndarray, other: Sphere, those: np.ndarray, radius_km: float) -> np.ndarray:
        """Kilometres between each of `mine` and each of `those` other points, infinite beyond the radius. Where products of
        vectors leave few candidates, arcs are taken of these alone."""
        least = np.cos(min(np.pi, max(0.0, radius_km) / EARTH_RADIUS_KM)) - DOT_SLACK
        maybe = self.at[mine] @ other.at[those].T >= least
        if few := np.count_nonzero(maybe) < FEW * maybe.size:
            row, column = np.nonzero(maybe)
            arc = other.lam[those][column] - self.lam[mine][row]
            level = (self.cos[mine][row] * other.cos[those][column], self.sin[mine][row] * other.sin[those][column])
        else:
            arc = other.lam[those] - self.lam[mine][:, None]
            level = (self.cos[mine][:, None] * other.cos[those], self.sin[mine][:, None] * other.sin[those])
        np.cos(arc, out=arc)
        arc *= level[0]
        arc += level[1]
        np.clip(arc, -1.0, 1.0, out=arc)
        np.arccos(arc, out=arc)
        arc *= EARTH_RADIUS_KM
        arc[arc > radius_km] = np.inf
        if not few:
            return arc
        out = np.full(maybe.shape, np.inf)
        out[maybe] = arc
        return out


def chunks_on_ground(
    places: Sphere, stations: Sphere, radius_km: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places cut along their longest extent until their matrix is small: the places, the stations that may be near
    them, and the distance of each station and place, infinite beyond the radius."""
    open_ = [(np.arange(len(places.phi)), np.arange(len(stations.phi)))]
    while open_:
        some, those = open_.pop()
        those = _around(places.at, some, stations.at, those, radius_km / EARTH_RADIUS_KM)
        if not len(those):
            continue
        if len(some) > 1 and len(some) * len(those) > GROUND_CELLS:
            extent = np.ptp(places.at[some], axis=0).argmax()
            order = np.argsort(places.at[some, extent], kind="stable")
            half = len(some) // 2
            open_ += [(some[order[half:]], those), (some[order[:half]], those)]
        else:
            yield some, those, stations.apart(those, places, some, radius_km)


def _newest(found: list[tuple]) -> tuple:
    """Of the rows of several runs for one hour, those with the newest issue of each place, of equal issues the last run's."""
    where, hours, sums, totals, issues = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((-np.arange(len(where)), -issues.astype(float), where))
    order = order[np.r_[True, np.diff(where[order]) != 0]] if len(order) else order
    return where[order], hours[order], sums[order], totals[order], issues[order]


class Means:
    """Readings of a part, met chunk by chunk with the weights of places."""

    def __init__(
        self, readings: pa.StructArray, owner: np.ndarray, fields: Sequence[str], n_words: int, issue: str | None,
        stations: bool, least: int | None = None,
    ) -> None:
        self.fields, self.n_words, self.stations, self.least = fields, n_words, stations, least
        self.issue, self.kind = issue, readings.field("timestamp").type
        when = _micros(readings.field("timestamp"))
        # Several runs: an hour of each is a group of its own.
        run = _micros(readings.field("_run")) if least is not None else np.zeros(len(when), np.int64)
        order = np.lexsort((run, when))
        self.when, self.run, self.owner = when[order], run[order], owner[order]
        counted = ["quality", "rows", *[f"votes_{i}" for i in range(n_words)], *(["stations"] if stations else [])]
        self.values = _numbers(readings, [*[f"sum_{f}" for f in fields], *[f"n_{f}" for f in fields]])[order]
        self.counts = _numbers(readings, counted)[order]
        self.issued = _micros(readings.field(issue))[order] if issue else None
        self.issue_kind = readings.field(issue).type if issue else None

    def batch(self, found: list[tuple], plz: pa.Array) -> pa.RecordBatch:
        fields, n = self.fields, len(self.fields)
        where, hours, sums, totals, issues = (
            np.concatenate(c) if c[0] is not None else None for c in zip(*found, strict=True)
        )
        columns = {"plz": plz.take(pa.array(where)), "timestamp": _times(hours, self.kind)}
        if self.issue:
            columns[self.issue] = _times(issues, self.issue_kind)
        for i, f in enumerate(fields):
            none = sums[:, n + i] == 0
            columns[f] = pa.array(sums[:, i] / np.where(none, 1.0, sums[:, n + i]), mask=none)
        votes = totals[:, 2 : 2 + self.n_words]
        word = votes.argmax(axis=1) if self.n_words else np.zeros(len(votes), np.int64)
        lost = votes.max(axis=1) <= 0 if self.n_words else np.ones(len(votes), bool)
        columns["_word"] = pa.array(word.astype(np.int32), mask=lost)
        columns["quality"] = pa.array(totals[:, 0])
        columns["rows"] = pa.array(np.rint(totals[:, 1]).astype(np.int64))
        if self.stations:
            columns["stations"] = pa.array(np.rint(totals[:, -1]).astype(np.int64))
        return pa.RecordBatch.from_pydict(columns)

    def hours(self, at: np.ndarray, some: np.ndarray, weights: np.ndarray, near: np.ndarray) -> Iterator[tuple]:
        """Rows of `some` places, hour by hour. `at` is the row of each station in the matrices, -1 if it has none."""
        mine = np.flatnonzero(at[self.owner] >= 0)
        if not len(mine):
            return
        starts = np.flatnonzero(np.r_[True, (np.diff(self.when[mine]) != 0) | (np.diff(self.run[mine]) != 0)])
        waiting: list[tuple] = []
        for hour in np.split(mine, starts[1:]):
            rows = at[self.owner[hour]]
            around = near[rows]
            totals = _product(around, self.counts[hour], around)
            hit = np.flatnonzero(totals[:, 1] > 0)
            if self.least is not None:
                hit = hit[totals[hit, 1] >= self.least]
            sums = _product(weights[rows], self.values[hour], around)
            last = None
            if self.issue:
                told = self.issued[hour]
                last = (
                    np.full(len(hit), told[0]) if (told == told[0]).all()
                    else np.where(around[:, hit] > 0, told[:, None], _NONE).max(axis=0)
                )
            made = (some[hit], np.full(len(hit), self.when[hour[0]]), sums[hit], totals[hit], last)
            if self.least is None:
                yield made
                continue
            if waiting and waiting[0][0] != self.when[hour[0]]:
                yield _newest([m for _, m in waiting])
                waiting = []
            waiting.append((self.when[hour[0]], made))
        if waiting:
            yield _newest([m for _, m in waiting])

    def batches(self, rows: Iterator[tuple], plz: pa.Array) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for made in rows:
            found.append(made)
            held += len(made[0])
            if held >= OUT_ROWS:
                yield self.batch(found, plz)
                found, held = [], 0
        if held:
            yield self.batch(found, plz)


def means_of_part(
    fields: Sequence[str], n_words: int, issue: str | None, stations: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for a part: rows of a station, with the lists `_readings` and `_pairs`, to rows of a place and time:
    plz, timestamp, the issue if named, the mean of each field, the number of the word with the most votes, the first of a tie, and sums of
    quality and rows, and of stations if wanted."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        station, pairs = _flat(table["_pairs"])
        owner, readings = _flat(table["_readings"])
        coded = pairs.field("plz").dictionary_encode(null_encoding="encode")
        place = coded.indices.to_numpy()
        weight = pairs.field("_weight").fill_null(0.0).to_numpy(zero_copy_only=False)
        order = np.argsort(place, kind="stable")
        place, station, weight = place[order], station[order], weight[order]
        means = Means(readings, owner, fields, n_words, issue, stations)

        def made() -> Iterator[tuple]:
            for low, high, those, some in _halved(place, station, 0, len(coded.dictionary)):
                at = np.full(table.num_rows, -1)
                at[those] = np.arange(len(those))
                cell = (at[station[some]], place[some] - low)
                # A pair that is given twice counts twice.
                weights, near = np.zeros((len(those), high - low)), np.zeros((len(those), high - low))
                np.add.at(weights, cell, weight[some])
                np.add.at(near, cell, 1.0)
                yield from means.hours(at, np.arange(low, high), weights, near)

        yield from means.batches(made(), coded.dictionary)

    return rows_of


def means_on_ground(
    fields: Sequence[str], n_words: int, issue: str | None, stations: bool, radius_km: float, least: int | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """As `means_of_part`, of rows that are a place (`_place`) or a reading, each with `_lat` and `_lon`: the pairs are
    found here. With `least` readings have a `_run`, and of the runs' rows with so many readings the newest issue stays."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        places, readings = table.filter(table["_place"]), table.filter(pa.compute.invert(table["_place"]))
        if not (places.num_rows and readings.num_rows):
            return
        coded = readings["source_id"].combine_chunks().dictionary_encode()
        owner = coded.indices.to_numpy()
        first = np.unique(owner, return_index=True)[1]
        named = readings.take(pa.array(first))
        ground, sites = (Sphere(t["_lat"], t["_lon"]) for t in (places, named))
        plz = places["plz"].combine_chunks()
        means = Means(readings.to_struct_array().combine_chunks(), owner, fields, n_words, issue, stations, least)

        def made() -> Iterator[tuple]:
            for some, those, apart in chunks_on_ground(ground, sites, radius_km):
                at = np.full(len(first), -1)
                at[those] = np.arange(len(those))
                near = (apart <= radius_km).astype(float)
                # Beyond the radius a distance is infinite and its weight nothing.
                yield from means.hours(at, some, 1.0 / (apart + WEIGHT_OFFSET_KM), near)

        yield from means.batches(made(), plz)

    return rows_of


def together(key: str, lists: str) -> Callable[[pa.Table], pa.Table]:
    """The function for a group: one row with all its lists as one."""

    def row_of(table: pa.Table) -> pa.Table:
        flat = pa.concat_arrays(table[lists].chunks).flatten()
        whole = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
        return pa.table({key: table[key].slice(0, 1), lists: whole.cast(table.schema.field(lists).type)})

    return row_of


class Square:
    """Readings of some hours, met chunk by chunk with the places of a square."""

    def __init__(self, readings: pa.StructArray, fields: Sequence[str], issue: str | None) -> None:
        self.fields, self.issue = fields, issue
        when = _micros(readings.field("timestamp"))
        when = when - when % HOUR
        order = np.argsort(when, kind="stable")
        self.when, self.kind = when[order], readings.field("timestamp").type
        # Of every station that is told of here, its number.
        self.ids, owner = np.unique(readings.field("source_id").to_numpy(zero_copy_only=False), return_inverse=True)
        self.owner = owner[order]
        known = [readings.field(f).is_valid().to_numpy(zero_copy_only=False).astype(float) for f in fields]
        self.values = np.column_stack([_numbers(readings, fields), *known])[order]
        self.quality = np.column_stack([_numbers(readings, ["quality_score"])[:, 0], np.ones(len(when))])[order]
        # Words by their rank, so that the first of a tie is the smallest; -1 for none.
        words = readings.field("_word")
        self.words = words.drop_null().unique().sort()
        self.word = pa.compute.index_in(words, self.words).fill_null(-1).to_numpy(zero_copy_only=False)[order]
        self.issued = _micros(readings.field(issue))[order] if issue else None
        self.issue_kind = readings.field(issue).type if issue else None

    def _winners(self, told: np.ndarray, near: np.ndarray) -> np.ndarray:
        """The word with the most votes at each place, -1 where there is none."""
        order = np.argsort(told, kind="stable")
        order = order[told[order] >= 0]
        if not len(order):
            return np.full(near.shape[1], -1)
        some, starts = np.unique(told[order], return_index=True)
        votes = np.add.reduceat(near[order], starts, axis=0)
        return np.where(votes.max(axis=0) > 0, some[votes.argmax(axis=0)], -1)

    def hours(self, places: pa.StructArray) -> Iterator[tuple]:
        """Rows of the places, hour by hour: the place, hour, sums and weights, quality and rows, word, issue."""
        lists = places.field("_near")
        place = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        pairs = lists.flatten()
        station = pairs.field("source_id").to_numpy(zero_copy_only=False)
        number = np.minimum(np.searchsorted(self.ids, station), len(self.ids) - 1)
        told = self.ids[number] == station
        weight = pairs.field("_weight").fill_null(0.0).to_numpy(zero_copy_only=False)[told]
        place, station = place[told], number[told]
        for low, high, those, some in _halved(place, station, 0, len(places), SQUARE_CELLS):
            at = np.full(len(self.ids), -1)
            at[those] = np.arange(len(those))
            cell = (at[station[some]], place[some] - low)
            # A pair that is given twice counts twice.
            weights, near = np.zeros((len(those), high - low)), np.zeros((len(those), high - low))
            np.add.at(weights, cell, weight[some])
            np.add.at(near, cell, 1.0)
            mine = np.flatnonzero(at[self.owner] >= 0)
            starts = np.flatnonzero(np.diff(self.when[mine])) + 1
            for hour in np.split(mine, starts) if len(mine) else ():
                rows = at[self.owner[hour]]
                hit = np.flatnonzero(near[rows].any(axis=0))
                around = near[np.ix_(rows, hit)]
                issued = None
                if self.issue:
                    issued = np.where(around > 0, self.issued[hour][:, None], _NONE).max(axis=0)
                yield (
                    low + hit, np.full(len(hit), self.when[hour[0]]),
                    _product(weights[np.ix_(rows, hit)], self.values[hour], around), around.T @ self.quality[hour],
                    self._winners(self.word[hour], around), issued,
                )

    def batch(self, found: list[tuple], plz: pa.Array) -> pa.RecordBatch:
        n = len(self.fields)
        where, hours, sums, totals, words, issues = (
            np.concatenate(c) if c[0] is not None else None for c in zip(*found, strict=True)
        )
        columns = {"plz": plz.take(pa.array(where)), "timestamp": _times(hours, self.kind)}
        if self.issue:
            columns[self.issue] = _times(issues, self.issue_kind)
        for i, f in enumerate(self.fields):
            none = sums[:, n + i] == 0
            columns[f] = pa.array(sums[:, i] / np.where(none, 1.0, sums[:, n + i]), mask=none)
        columns["condition"] = self.words.take(pa.array(words, mask=words < 0))
        columns["quality"] = pa.array(totals[:, 0])
        columns["rows"] = pa.array(np.rint(totals[:, 1]).astype(np.int64))
        return pa.RecordBatch.from_pydict(columns)


def means_in_square(
    fields: Sequence[str], issue: str | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for rows with the readings of a square (`_readings`) and its places (`_places`), each with its stations and their
    weights (`_near`), to rows of a place and hour: plz, timestamp, the issue if named, the mean of each field, the most
    frequent condition, the smallest of a tie, and sums of quality and rows."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                readings, places = (batch.column(c).slice(i, 1).flatten() for c in ("_readings", "_places"))
                places = places.take(pa.compute.sort_indices(places.field("_so_far")))
                square = Square(readings, fields, issue)
                plz, found, held = places.field("plz"), [], 0
                for made in square.hours(places):
                    found.append(made)
                    held += len(made[0])
                    if held >= OUT_ROWS:
                        yield square.batch(found, plz)
                        found, held = [], 0
                if held:
                    yield square.batch(found, plz)

    return rows_of


# Ranks that leave a task together.
RANKED_ROWS = 262_144


def ranks_on_ground(radius_km: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for a part of places and stations: plz, source_id, distance and rank, 1 for the nearest station of a
    place, of equal distances the smallest id."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        places, stations = table.filter(table["_place"]), table.filter(pa.compute.invert(table["_place"]))
        if not (places.num_rows and stations.num_rows):
            return
        stations = stations.sort_by("source_id")
        ground, sites = (Sphere(t["_lat"], t["_lon"]) for t in (places, stations))
        for some, those, apart in chunks_on_ground(ground, sites, radius_km):
            width = max(1, RANKED_ROWS // len(those))
            for low in range(0, len(some), width):
                here = apart[:, low : low + width].T
                order = np.argsort(here, axis=1, kind="stable")  # stations are in order of their id
                sorted_ = np.take_along_axis(here, order, axis=1)
                place, rank = np.nonzero(sorted_ <= radius_km)
                if len(place):
                    yield pa.RecordBatch.from_pydict({
                        "plz": places["plz"].combine_chunks().take(pa.array(some[low + place])),
                        "source_id": stations["source_id"].combine_chunks().take(pa.array(those[order[place, rank]])),
                        "distance_km": pa.array(sorted_[place, rank]),
                        "distance_rank": pa.array(rank.astype(np.int32) + 1),
                    })

    return rows_of


def reached_on_ground(radius_km: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for a block of places and stations: plz and position of the places with a station in range."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        places, stations = table.filter(table["_place"]), table.filter(pa.compute.invert(table["_place"]))
        if not (places.num_rows and stations.num_rows):
            return
        ground, sites = (Sphere(t["_lat"], t["_lon"]) for t in (places, stations))
        for some, _, apart in chunks_on_ground(ground, sites, radius_km):
            hits = places.take(pa.array(some[(apart <= radius_km).any(axis=0)]))
            yield from hits.select(["plz", "_lat", "_lon"]).to_batches()

    return rows_of
