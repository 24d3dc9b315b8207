"""Read-back queries over deduplicated tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationfield import schemas
from stationfield.functions import temporal
from stationfield.operators.radius import Ground, near_places
from stationfield.operators.versions import first_per_key, latest
from stationfield.plans.transforms import (
    FORECAST,
    current_places,
    current_stations,
    newest_of_runs,
    transform,
)
from stationfield.schemas import Table
from stationfield.sources.warehouse import Warehouse

FORECAST_FRESHNESS_DAYS = 8
# Hours, from the newest back, among which a bound is looked for; some eleven years. Without one all is ranked.
HOURS_LOOKED_AT = 100_000


def postal_codes(table: DataFrame, prefixes: Sequence[str] | str | None = None) -> DataFrame:
    """Sorted by plz. A prefix is literal text; none or an empty one means all."""
    return current_places(table, prefixes).orderBy("plz")


def postal_code(table: DataFrame, plz: str) -> DataFrame:
    """The one postal code."""
    return current_places(table.where(F.col("plz") == plz))


def weather_stations(
    table: DataFrame,
    observation_type: str | None = None,
    near: DataFrame | None = None,
    radius_km: float = 10.0,
) -> DataFrame:
    """Sorted by id. `near` (postal codes) keeps the stations in range of one of them."""
    stations = current_stations(table, observation_type or None)
    if near is not None:
        stations = near_places(stations, near, radius_km).select(*stations.columns)
    return stations.orderBy("id", "observation_type")


def active_synop_stations(stations: DataFrame, as_of: datetime) -> DataFrame:
    """SYNOP stations with a record on the day of `as_of` or later."""
    current = current_stations(stations, "synop")
    return current.where(F.to_date("last_record") >= F.lit(temporal.naive_utc(as_of).date()))


def forecast_stations(
    stations: DataFrame, as_of: datetime, days: int = FORECAST_FRESHNESS_DAYS
) -> DataFrame:
    """Forecast stations that reach at least `days` ahead."""
    reach = temporal.utc(as_of) + F.expr(f"INTERVAL {int(days)} DAYS")
    return current_stations(stations, "forecast").where(F.col("last_record") >= reach)


def newest_bound(
    df: DataFrame, table: Table, lead: str, limit: int, hours: int = HOURS_LOOKED_AT
) -> datetime | None:
    """A whole hour from which on there are at least `limit` keys, or None where all rows are needed.

    The newest hours and their rows come from one scan of the leading column, combined on the map side.
    As many of them are taken as hold `limit` rows; versions of a key are several rows, so the keys
    of these hours, and of no others, are counted, and twice as many hours taken until there are enough.
    """
    hour = F.date_trunc("hour", lead).alias("hour")
    newest_hours = (
        df.where(F.col(lead).isNotNull()).groupBy(hour).agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("hour")).limit(hours)
        .select(temporal.format_utc(F.col("hour")), "rows").collect()  # a bounded list of hours
    )
    rows, n = 0, 0
    while n < len(newest_hours) and rows < limit:
        rows, n = rows + newest_hours[n][1], n + 1
    while rows >= limit and n:
        bound = datetime.fromisoformat(newest_hours[n - 1][0])
        chosen = df.where(F.col(lead) >= temporal.utc(bound))
        if chosen.select(*table.key).distinct().limit(limit).count() >= limit:
            return bound
        if n == len(newest_hours):
            break
        n = min(2 * n, len(newest_hours))
    return None


def newest(
    df: DataFrame,
    table: Table,
    order: Sequence[str],
    source_id: int | None = None,
    limit: int = 100,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The `limit` newest rows in descending `order` (columns of the key), then ascending key.

    The leading column is bounded first (`newest_bound`), which reaches the scan and its row groups; only
    what passes is ranked by version and key.
    """
    if source_id is not None:
        df = df.where(F.col("source_id") == source_id)
    rest = [c for c in table.key if c not in order]
    ordering = [*[F.col(c).desc() for c in order], *[F.col(c).asc() for c in rest]]
    bound = newest_bound(df, table, order[0], limit)
    if bound is not None:
        df = df.where(F.col(order[0]) >= temporal.utc(bound))
    return latest(df, table.key, table.version, tiebreak).orderBy(*ordering).limit(limit)


def latest_observations_synop(
    df: DataFrame, source_id: int | None = None, limit: int = 100,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    return newest(df, schemas.OBSERVATIONS_SYNOP, ["timestamp"], source_id, limit, tiebreak)


def latest_observations(
    df: DataFrame, source_id: int | None = None, limit: int = 100,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    return newest(df, schemas.OBSERVATIONS_HOURLY, ["timestamp"], source_id, limit, tiebreak)


def latest_forecasts(
    df: DataFrame, source_id: int | None = None, limit: int = 100,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    order = ["forecast_created_at", "timestamp"]
    return newest(df, schemas.FORECASTS, order, source_id, limit, tiebreak)


def head(df: DataFrame, table: Table, n: int = 5) -> DataFrame:
    """The first `n` rows in order of the key: each task sends on its own first `n`."""
    return df.orderBy(*table.key).limit(n)


def current_forecast(staged: DataFrame) -> DataFrame:
    """Newest issue per postal code and hour."""
    version = [c for c in ("created_at",) if c in staged.columns]
    order = [F.col(c).desc() for c in ["forecast_created_at", *version]]
    return first_per_key(staged, ["plz", "timestamp"], order)


def current_forecast_of_runs(
    runs: Sequence[DataFrame], spot: Ground, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """`current_forecast` of the results of `transform` of each run, chosen where they are made."""
    newest = newest_of_runs(runs, spot, tiebreak=tiebreak)
    if newest is not None:
        return newest
    made = [transform(r, spot, FORECAST, tiebreak=tiebreak) for r in runs]
    return current_forecast(reduce(DataFrame.unionByName, made))


class Reader:
    """The read-back queries bound to a warehouse."""

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse = warehouse

    def postal_codes(self, prefix: Sequence[str] | str | None = None) -> DataFrame:
        return postal_codes(self.warehouse.scan(schemas.POSTAL_CODES), prefix)

    def weather_stations(
        self, observation_type: str | None = None, near_prefix: str | None = None
    ) -> DataFrame:
        near = None
        if near_prefix:
            near = current_places(self.warehouse.scan(schemas.POSTAL_CODES), near_prefix)
        return weather_stations(
            self.warehouse.scan(schemas.WEATHER_STATIONS), observation_type, near
        )

    def _newest(
        self, table: Table, order: Sequence[str], source_id: int | None, limit: int,
        since: datetime | None,
    ) -> DataFrame:
        """The bound on the event time also says which day folders are opened for the ranking."""
        df = self.warehouse.scan(table, since)
        wanted = df if source_id is None else df.where(F.col("source_id") == source_id)
        if order[0] == table.event_time:
            bound = newest_bound(wanted, table, order[0], limit)
            if bound is not None:
                df = self.warehouse.scan(table, max(bound, temporal.naive_utc(since) or bound))
        return newest(df, table, order, source_id, limit)

    def latest_observations_synop(
        self, source_id: int | None = None, limit: int = 100, since: datetime | None = None
    ) -> DataFrame:
        return self._newest(schemas.OBSERVATIONS_SYNOP, ["timestamp"], source_id, limit, since)

    def latest_observations(
        self, source_id: int | None = None, limit: int = 100, since: datetime | None = None
    ) -> DataFrame:
        return self._newest(schemas.OBSERVATIONS_HOURLY, ["timestamp"], source_id, limit, since)

    def latest_forecasts(
        self, source_id: int | None = None, limit: int = 100, since: datetime | None = None
    ) -> DataFrame:
        order = ["forecast_created_at", "timestamp"]
        return self._newest(schemas.FORECASTS, order, source_id, limit, since)

    def head(self, table: Table, n: int = 5) -> DataFrame:
        """The first `n` current rows in order of the key."""
        return head(self.warehouse.read(table), table, n)
