"""Serving tables built from the star schema."""

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.operators.rollup import mean_seconds, mean_speed, partial_measures, total_results
from stridebase.operators.topk import least_with_ties, look_up

# Fixed values.
FASTEST_RESULTS = 1000
SECONDS_PER_HOUR = Decimal("3600.0")


def mart_top_countries(fct: DataFrame, dim_athlete: DataFrame) -> DataFrame:
    """Results, mean speed and mean time per country.

    The country is the athlete's latest one, not the one on the result. A stored table keeps no
    order; the questions asked of it sort.
    """
    return country_mart(partial_measures(fct, "athlete_key"), dim_athlete)


def country_mart(per_athlete: DataFrame, dim_athlete: DataFrame) -> DataFrame:
    """The same from partial measures by athlete, or by athlete and more."""
    countries = dim_athlete.select("athlete_key", "athlete_country")
    return (
        per_athlete.join(countries, "athlete_key", "left")
        .groupBy("athlete_country")
        .agg(
            total_results().alias("total_finishers"),
            F.round(mean_speed(), 2).alias("avg_speed_kmh"),
            F.round(mean_seconds() / float(SECONDS_PER_HOUR), 2).alias("avg_time_hours"),
        )
    )


def mart_fastest_athletes(
    fct: DataFrame, dim_athlete: DataFrame, dim_event: DataFrame, k: int = FASTEST_RESULTS
) -> DataFrame:
    """The ``k`` results with the least seconds over all distances.

    Ties are ordered by athlete, event, result and speed, which needs the dimensions, so
    the k-th least time is found on the fact alone and only rows up to it are joined.
    """
    candidates = least_with_ties(fct, "performance_seconds", k)
    hours = F.round(F.col("performance_seconds") / F.lit(SECONDS_PER_HOUR), 2)
    return (
        candidates.transform(look_up, dim_athlete, "athlete_key")
        .transform(look_up, dim_event, "event_id")
        .orderBy(
            "performance_seconds",
            F.asc_nulls_last("athlete_id"),
            F.asc_nulls_last("event_name"),
            "result_id",
            F.asc_nulls_last("athlete_average_speed"),
        )
        .limit(k)
        .select(
            "athlete_id",
            "athlete_country",
            "athlete_gender",
            "event_name",
            "event_distance_length",
            "performance_seconds",
            hours.alias("performance_hours"),
            "athlete_average_speed",
        )
    )
