"""Star schema over the cleaned results: three dimensions and one fact table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.functions.keys import hash_key
from stridebase.operators.latest import latest_by

ATHLETE_ATTRIBUTES = (
    "athlete_id",
    "athlete_country",
    "athlete_gender",
    "athlete_year_of_birth",
    "athlete_age_category",
)
EVENT_ATTRIBUTES = (
    "event_name",
    "event_distance_length",
    "event_number_of_finishers",
    "event_dates",
)


def dim_athlete(silver: DataFrame) -> DataFrame:
    return latest_by(silver, "athlete_key", "year_of_event", ATHLETE_ATTRIBUTES)


def dim_event(silver: DataFrame) -> DataFrame:
    return latest_by(silver, "event_id", "year_of_event", EVENT_ATTRIBUTES)


def dim_time(silver: DataFrame) -> DataFrame:
    return silver.groupBy("year_id").agg(F.max("year_of_event").alias("year_of_event"))


def fct_results(silver: DataFrame) -> DataFrame:
    """One row per cleaned result. ``result_id`` identifies athlete, event and year, so
    two distances of one event in one year share it."""
    return silver.select(
        hash_key(F.col("athlete_id"), F.col("event_id"), F.col("year_of_event")).alias("result_id"),
        "event_id",
        "athlete_key",
        "year_id",
        "performance_seconds",
        "athlete_average_speed",
        "athlete_age_at_event",
    )
