"""Range checks, validity flags and the row quality score as native column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, mul

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# Factor applied to the score of a row whose field is out of range.
PENALTY = {
    "temperature": 0.5,
    "precipitation": 0.5,
    "relative_humidity": 0.7,
    "wind_speed": 0.7,
    "pressure_msl": 0.7,
}
CRITICAL_FIELDS = ("temperature", "precipitation", "relative_humidity")
COMPLETENESS_BASE = 0.7
COMPLETENESS_BONUS = 0.3
IDEAL_STATIONS = 3.0


@dataclass(frozen=True)
class Ranges:
    """Inclusive bounds per field (°C, mm, %, km/h, hPa)."""

    temperature: tuple[float, float] = (-30.0, 50.0)
    precipitation: tuple[float, float] = (0.0, 200.0)
    relative_humidity: tuple[float, float] = (0.0, 100.0)
    wind_speed: tuple[float, float] = (0.0, 200.0)
    pressure_msl: tuple[float, float] = (800.0, 1100.0)
    missing_is_invalid: bool = False

    def check(self, field: str, slack: float = 0.0) -> Column:
        """True when the value lies in range; a missing value is valid unless told otherwise."""
        low, high = getattr(self, field)
        inside = F.col(field).between(F.lit(low - slack), F.lit(high + slack))
        return F.coalesce(inside, F.lit(not self.missing_is_invalid))

    def row_valid(self, columns: list[str], slack: float = 0.0) -> Column:
        """All checks over the fields that exist. Computed values need some `slack`: the error of
        the last bits would push a mean of readings at a bound out of range."""
        checks = [self.check(f, slack) for f in PENALTY if f in columns]
        return reduce(and_, checks, F.lit(True))

    def score(self, columns: list[str]) -> Column:
        factors = [
            F.when(self.check(f), F.lit(1.0)).otherwise(F.lit(p))
            for f, p in PENALTY.items()
            if f in columns
        ]
        critical = [f for f in CRITICAL_FIELDS if f in columns]
        if critical:
            missing = reduce(lambda a, b: a + b, [F.col(f).isNull().cast("int") for f in critical])
            completeness = F.lit(1.0) - missing / F.lit(float(len(critical)))
            factors.append(
                F.lit(COMPLETENESS_BASE) + F.lit(COMPLETENESS_BONUS) * completeness
            )
        return reduce(mul, factors, F.lit(1.0))


DEFAULT_RANGES = Ranges()


def nan_to_null(df: DataFrame) -> DataFrame:
    """A missing number is null from here on; NaN would pass `>=` and fail `<=`."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def add_quality(df: DataFrame, ranges: Ranges = DEFAULT_RANGES) -> DataFrame:
    """Adds `is_valid` and `quality_score`. A probability outside 0..100 makes a row invalid but
    does not lower its score."""
    valid = ranges.row_valid(df.columns)
    if "precipitation_probability" in df.columns:
        probability = F.col("precipitation_probability")
        valid = valid & F.coalesce(probability.between(0.0, 100.0), F.lit(True))
    return df.withColumns({"is_valid": valid, "quality_score": ranges.score(df.columns)})


def keep_valid(df: DataFrame) -> DataFrame:
    return df.where("is_valid") if "is_valid" in df.columns else df


def station_factor(num_stations: Column) -> Column:
    """Full trust from three stations on."""
    return F.least(num_stations / F.lit(IDEAL_STATIONS), F.lit(1.0))


def register_sql_functions(spark: SparkSession, ranges: Ranges = DEFAULT_RANGES) -> None:
    """`quality_score(t, precip, rh, wind, pressure)` for SQL users; Catalyst inlines it."""
    args = list(PENALTY)
    factors = []
    for field, penalty in PENALTY.items():
        low, high = getattr(ranges, field)
        missing = "FALSE" if ranges.missing_is_invalid else "TRUE"
        factors.append(
            f"IF(coalesce({field} BETWEEN {low}D AND {high}D, {missing}), 1D, {penalty}D)"
        )
    missing = " + ".join(f"IF({f} IS NULL, 1, 0)" for f in CRITICAL_FIELDS)
    factors.append(
        f"({COMPLETENESS_BASE}D + {COMPLETENESS_BONUS}D"
        f" * (1D - ({missing}) / {float(len(CRITICAL_FIELDS))}D))"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION quality_score("
        + ", ".join(f"{a} DOUBLE" for a in args)
        + ") RETURNS DOUBLE RETURN " + " * ".join(factors)
    )
