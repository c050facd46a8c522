"""Cleaned, standardised and keyed results: one row per kept raw row, no shuffle.

Everything here is row-wise, so the same function serves batch and streaming input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.functions import athlete, clock, keys, speed, units
from stridebase.operators.settle import settle
from stridebase.schema import BRONZE_COLUMNS, BRONZE_SCHEMA

# Countries in scope.
EUROPE = (
    "SWE", "NOR", "FIN", "DNK", "DEU", "FRA", "ESP", "ITA",
    "GBR", "BEL", "NLD", "POL", "AUT", "CHE", "PRT", "CZE",
    "HUN", "ROU", "GRC", "HRV", "SVK", "SVN", "SRB", "BGR",
    "EST", "LVA", "LTU", "IRL", "LUX", "ISL", "MKD", "ALB",
)

# Plausible speeds in km/h, inclusive.
MIN_SPEED, MAX_SPEED = 0.5, 35.0

SILVER_COLUMNS = [
    *BRONZE_COLUMNS,
    "performance_seconds",
    "event_id",
    "athlete_key",
    "year_id",
    "athlete_age_at_event",
]


_TYPES = {
    "event_number_of_finishers": T.IntegerType(),
    "athlete_year_of_birth": T.IntegerType(),
    "athlete_average_speed": T.FloatType(),
    "performance_seconds": T.IntegerType(),
    "athlete_age_at_event": T.IntegerType(),
}
SILVER_SCHEMA = T.StructType(
    [
        T.StructField(name, _TYPES.get(name) or (BRONZE_SCHEMA[name].dataType if name in BRONZE_COLUMNS else T.StringType()))
        for name in SILVER_COLUMNS
    ]
)


def in_scope(countries: Sequence[str] = EUROPE) -> Column:
    """Row predicate on raw columns: a timed kilometre event of an athlete in scope, with a
    speed that is no clock text. Cheap tests come first."""
    performance = F.col("athlete_performance")
    return (
        performance.isNotNull()
        & F.col("event_distance_length").isNotNull()
        & F.col("athlete_id").isNotNull()
        & athlete.upper_code(F.col("athlete_country")).isin(*countries)
        & units.has_unit(F.col("event_distance_length"), "km")
        & (units.performance_unit(performance) == "h")
        & ~F.col("athlete_average_speed").contains(":")
    )


def with_measures(races: DataFrame) -> DataFrame:
    """Add ``speed_number`` and ``performance_seconds``, both NULL where unreadable."""
    rows = races.withColumn("speed_number", speed.speed_digits(F.col("athlete_average_speed")))
    bare = clock.without_unit(F.col("athlete_performance"))
    return clock.with_seconds(rows, bare, "performance_seconds")


def is_plausible(low: float = MIN_SPEED, high: float = MAX_SPEED) -> Column:
    """Predicate on the measures. A missing speed or time fails."""
    return F.col("speed_number").between(float(low), float(high)) & (F.col("performance_seconds") > 0)


def clean_results(
    races: DataFrame,
    countries: Sequence[str] = EUROPE,
    low: float = MIN_SPEED,
    high: float = MAX_SPEED,
) -> DataFrame:
    """Kilometre events of the given countries with a positive finishing time."""
    born = F.col("athlete_year_of_birth").try_cast("int")
    return (
        races.where(in_scope(countries))
        .transform(with_measures)
        .transform(settle, "speed_number", "performance_seconds")
        .where(is_plausible(low, high))
        .withColumns(
            {
                "event_id": keys.hash_key(F.col("event_name")),
                "athlete_key": keys.hash_key(F.col("athlete_id")),
                "year_id": keys.hash_key(F.col("year_of_event")),
                "athlete_age_at_event": athlete.age_in(F.col("year_of_event"), born),
                "athlete_average_speed": speed.leading_number(F.col("athlete_average_speed")),
                "athlete_year_of_birth": born,
                "event_number_of_finishers": F.col("event_number_of_finishers").try_cast("int"),
                "athlete_gender": athlete.known_gender(F.col("athlete_gender")),
                "athlete_country": athlete.upper_code(F.col("athlete_country")),
            }
        )
        .select(*SILVER_COLUMNS)
    )
