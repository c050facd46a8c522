"""Aggregating a fact table by attributes of its dimensions.

The fact is first reduced to one row of partial measures per dimension key, then
joined, then reduced again. The join therefore never sees the raw fact: a key that
holds a third of the rows is folded on the map side and joins as a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPEED, _TIME = "athlete_average_speed", "performance_seconds"
MEASURES = ("results", "speed_sum", "speed_count", "seconds_sum", "seconds_count")


def partial_measures(fct: DataFrame, *keys: str) -> DataFrame:
    """Additive measures per key; the ones a query does not use are pruned by Catalyst."""
    return fct.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("results"),
        F.sum(_SPEED).alias("speed_sum"),
        F.count(_SPEED).alias("speed_count"),
        F.sum(_TIME).alias("seconds_sum"),
        F.count(_TIME).alias("seconds_count"),
    )


def merged_measures(partial: DataFrame, *keys: str) -> DataFrame:
    """Partial measures of several parts, or of finer keys, added up per key."""
    return partial.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MEASURES])


def total_results() -> Column:
    return F.sum("results")


def mean_speed() -> Column:
    return F.try_divide(F.sum("speed_sum"), F.sum("speed_count"))


def mean_seconds() -> Column:
    return F.try_divide(F.sum("seconds_sum"), F.sum("seconds_count"))
