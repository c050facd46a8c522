"""Exploratory cleanings: all countries, timed and distance events, dense ids.

Two variants that differ in the speed limits and in how performances are read. They
keep zero and missing times, which the main cleaning drops.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridebase.functions import athlete, clock, speed, units
from stridebase.operators.dense_ids import with_dense_ids
from stridebase.operators.settle import settle
from stridebase.schema import BRONZE_COLUMNS

UNIT_COLUMNS = ("event_unit", "performance_unit", "is_valid_combo")
DENSE_IDS = {"event_id": "event_name", "athlete_key": "athlete_id", "year_id": "year_of_event"}


@dataclass(frozen=True)
class Variant:
    """``cut_unit``: drop a unit suffix before reading the performance, and read a time
    only up to its first space."""

    low: float
    high: float
    cut_unit: bool

    def time_text(self) -> Column:
        performance = F.col("athlete_performance")
        return clock.first_word(performance) if self.cut_unit else performance

    def kilometres(self) -> Column:
        performance = F.col("athlete_performance")
        if self.cut_unit:
            return clock.without_unit(performance).try_cast("float")
        return speed.leading_number(performance)


# The two variants.
V1 = Variant(low=1, high=30, cut_unit=False)
V2 = Variant(low=0.5, high=35, cut_unit=True)


def with_units(races: DataFrame) -> DataFrame:
    """Units as written (no trimming), loose performance unit, and whether the two fit."""
    event = units.ending_unit(F.col("event_distance_length"))
    performance = units.performance_unit_loose(F.col("athlete_performance"))
    return races.withColumns(
        {
            "event_unit": event,
            "performance_unit": performance,
            "is_valid_combo": units.is_valid_pair(event, performance),
        }
    )


def is_complete() -> Column:
    """Row predicate on the output of :func:`with_units`."""
    return (
        F.col("athlete_performance").isNotNull()
        & F.col("event_distance_length").isNotNull()
        & F.col("athlete_id").isNotNull()
        & (F.col("event_unit") != "d")
        & F.col("is_valid_combo")
        & ~F.col("athlete_average_speed").contains(":")
    )


def with_speed_number(rows: DataFrame) -> DataFrame:
    return rows.withColumn("speed_number", speed.speed_digits(F.col("athlete_average_speed")))


def is_plausible(variant: Variant) -> Column:
    """A missing speed fails."""
    return F.col("speed_number").between(float(variant.low), float(variant.high))


def explore_clean(races: DataFrame, variant: Variant = V1) -> DataFrame:
    """Kept rows with their units and the number in their speed."""
    return (
        with_units(races)
        .where(is_complete())
        .transform(with_speed_number)
        .transform(settle, "speed_number")
        .where(is_plausible(variant))
    )


def explore_converted(races: DataFrame, variant: Variant) -> DataFrame:
    """Kept rows with a time in seconds or a distance in km, by performance unit."""
    unit = F.col("performance_unit")
    kilometres = F.when(unit == "km", variant.kilometres())
    return (
        explore_clean(races, variant)
        .transform(clock.with_seconds, F.when(unit == "h", variant.time_text()), "performance_seconds")
        .withColumn("performance_km", kilometres)
    )


def explore_rows(races: DataFrame, variant: Variant) -> DataFrame:
    """Typed and normalised rows of a variant, still without ids."""
    born = F.col("athlete_year_of_birth").try_cast("int")
    return (
        explore_converted(races, variant)
        .withColumns(
            {
                "athlete_age_at_event": athlete.age_in(F.col("year_of_event"), born),
                "athlete_average_speed": speed.leading_number(F.col("athlete_average_speed")),
                "athlete_year_of_birth": born,
                "event_number_of_finishers": F.col("event_number_of_finishers").try_cast("int"),
                "athlete_gender": athlete.upper_code(F.col("athlete_gender")),
                "athlete_country": athlete.upper_code(F.col("athlete_country")),
            }
        )
        .drop(*UNIT_COLUMNS, "speed_number")
    )


def explore_silver(rows: DataFrame) -> DataFrame:
    """Stored rows of :func:`explore_rows` with their ids."""
    return with_dense_ids(rows, DENSE_IDS).select(
        *BRONZE_COLUMNS,
        "performance_seconds",
        "performance_km",
        *DENSE_IDS,
        "athlete_age_at_event",
    )
