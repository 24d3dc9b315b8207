"""Latest version per key, latest forecast issue, first seen, and removal by key.

All of them rank with `row_number() = 1`. Spark plans that as a group limit on both sides of the
shuffle: each map task sends at most one row per key, so a key that was delivered a billion times
does not reach one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def _total_order(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """Remaining columns, so that equal versions are decided the same way in every run."""
    return [F.col(c).desc_nulls_last() for c in df.columns if c not in used]


def latest(
    df: DataFrame, key: Sequence[str], version: str, tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """The newest version of each key. Of equal versions the one with the highest tiebreak wins."""
    rest = (
        _total_order(df, [*key, version])
        if tiebreak is None
        else [F.col(c).desc_nulls_last() for c in tiebreak]
    )
    return first_per_key(df, key, [F.col(version).desc(), *rest])


def latest_values(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """`latest` as an aggregate: where only keys are asked for, only keys are read and moved."""
    rest = [version, *[c for c in df.columns if c not in [*key, version]]]
    newest = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_newest"))
    return newest.select(*[F.col(c) if c in key else F.col("_newest")[c].alias(c) for c in df.columns])


def latest_issue(
    df: DataFrame,
    key: Sequence[str] = ("source_id", "timestamp"),
    issue: str = "forecast_created_at",
    version: str = "ingested_at",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Newest issue per key, in its newest version: one ranking instead of two."""
    rest = (
        _total_order(df, [*key, issue, version])
        if tiebreak is None
        else [F.col(c).desc_nulls_last() for c in tiebreak]
    )
    return first_per_key(df, key, [F.col(issue).desc(), F.col(version).desc(), *rest])


def first_seen(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that comes first in `order`, then in the remaining columns."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in [*key, *order]]
    return first_per_key(df, key, [*[F.col(c).asc() for c in order], *rest])


def without_keys(df: DataFrame, doomed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of `df` whose key is not among those of `doomed`."""
    return df.join(doomed.select(*key), list(key), "left_anti")
