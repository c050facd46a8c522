"""Questions asked of the star schema, and the dashboard datasets.

The datasets that the dashboard filters by a clicked year take it as an optional argument: it
narrows the fact through ``dim_time`` before anything is aggregated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.operators.rollup import mean_speed, merged_measures, partial_measures, total_results
from stridebase.plans.marts import country_mart, mart_fastest_athletes

# Fixed values of the dashboard and of the standing questions.
FIRST_TREND_YEAR, LAST_TREND_YEAR = 1996, 2023
DASHBOARD_COUNTRIES = 15
DASHBOARD_FASTEST = 10
TOP_TEN = 10


@dataclass(frozen=True)
class Star:
    fct_results: DataFrame
    dim_athlete: DataFrame
    dim_event: DataFrame
    dim_time: DataFrame

    def in_year(self, year: int | None) -> Star:
        """The same star with the results of one year only."""
        if year is None:
            return self
        wanted = self.dim_time.where(F.col("year_of_event") == year).select("year_id")
        results = self.fct_results.join(wanted, "year_id", "left_semi")
        return Star(results, self.dim_athlete, self.dim_event, self.dim_time)

    def measures(self, *keys: str) -> DataFrame:
        """Partial measures of the results per key."""
        return partial_measures(self.fct_results, *keys)


@dataclass(frozen=True)
class SummedStar(Star):
    """A star whose measures are stored, per year and athlete and per year and event.

    Questions that need no single result are answered from these, without reading the fact.
    """

    athlete_years: DataFrame
    event_years: DataFrame

    def in_year(self, year: int | None) -> SummedStar:
        if year is None:
            return self
        wanted = self.dim_time.where(F.col("year_of_event") == year).select("year_id")
        kept = (df.join(wanted, "year_id", "left_semi") for df in (self.fct_results, self.athlete_years, self.event_years))
        results, athlete_years, event_years = kept
        return SummedStar(results, self.dim_athlete, self.dim_event, self.dim_time, athlete_years, event_years)

    def measures(self, *keys: str) -> DataFrame:
        return merged_measures(self.event_years if "event_id" in keys else self.athlete_years, *keys)


def star_wide(star: Star) -> DataFrame:
    """Every result with all attributes of its three dimensions."""
    return (
        star.fct_results.join(star.dim_time, "year_id", "left")
        .join(star.dim_event, "event_id", "left")
        .join(star.dim_athlete, "athlete_key", "left")
    )


# Standing questions


def top_country(mart: DataFrame) -> DataFrame:
    """The country with the most results."""
    return (
        mart.select("athlete_country", "total_finishers")
        .orderBy(F.desc("total_finishers"), "athlete_country")
        .limit(1)
    )


def participation(star: Star) -> DataFrame:
    """Results per year."""
    return (
        star.measures("year_id")
        .join(star.dim_time, "year_id")
        .groupBy("year_of_event")
        .agg(total_results().alias("total_results"))
        .orderBy("year_of_event")
    )


def gender_distribution(star: Star, year: int | None = None) -> DataFrame:
    """Results per gender; athletes of unknown gender are left out."""
    known = star.dim_athlete.where(F.col("athlete_gender").isNotNull())
    return (
        star.in_year(year).measures("athlete_key")
        .join(known.select("athlete_key", "athlete_gender"), "athlete_key")
        .groupBy("athlete_gender")
        .agg(total_results().alias("number_of_results"))
    )


def fastest_by_speed(mart: DataFrame, n: int = TOP_TEN) -> DataFrame:
    """Highest speeds among the results of the fastest-athletes mart."""
    return (
        mart.orderBy(
            F.desc_nulls_last("athlete_average_speed"),
            "performance_seconds",
            "athlete_id",
            F.asc_nulls_last("event_name"),
        )
        .limit(n)
        .select("athlete_country", "athlete_gender", "event_name", "athlete_average_speed")
    )


def speed_by_distance(star: Star, year: int | None = None) -> DataFrame:
    """Mean speed per distance. The distance is the event's latest one in ``dim_event``,
    not the one on the result, so an event with several distances counts under one."""
    distances = star.dim_event.select("event_id", "event_distance_length")
    return (
        star.in_year(year).measures("event_id")
        .join(distances, "event_id")
        .groupBy("event_distance_length")
        .agg(F.round(mean_speed(), 2).alias("avg_speed_kmh"))
        .orderBy(F.desc("avg_speed_kmh"), "event_distance_length")
    )


def top_speed_countries(mart: DataFrame, n: int = TOP_TEN) -> DataFrame:
    return (
        mart.select("athlete_country", "avg_speed_kmh")
        .orderBy(F.desc("avg_speed_kmh"), "athlete_country")
        .limit(n)
    )


# Dashboard datasets


def kpi_overview(star: Star, year: int | None = None) -> DataFrame:
    """Unique races, results, countries and mean speed, one row."""
    selected = star.in_year(year)
    per_country = (
        selected.measures("athlete_key")
        .join(star.dim_athlete.select("athlete_key", "athlete_country"), "athlete_key", "left")
        .groupBy("athlete_country")
        .agg(*[F.sum(c).alias(c) for c in ("results", "speed_sum", "speed_count")])
    )
    races = selected.measures("event_id").agg(F.count("event_id"))
    return per_country.agg(
        F.coalesce(total_results(), F.lit(0)).alias("total_results"),
        F.count("athlete_country").alias("countries"),
        F.round(mean_speed(), 2).alias("avg_speed_kmh"),
    ).select(races.scalar().alias("unique_races"), "total_results", "countries", "avg_speed_kmh")


def kpi_by_year(star: Star) -> DataFrame:
    """The same figures for every year at once: what a click on each year would show."""
    per_country = (
        star.measures("year_id", "athlete_key")
        .join(star.dim_athlete.select("athlete_key", "athlete_country"), "athlete_key", "left")
        .groupBy("year_id", "athlete_country")
        .agg(*[F.sum(c).alias(c) for c in ("results", "speed_sum", "speed_count")])
    )
    figures = per_country.groupBy("year_id").agg(
        total_results().alias("total_results"),
        F.count("athlete_country").alias("countries"),
        F.round(mean_speed(), 2).alias("avg_speed_kmh"),
    )
    races = (
        star.measures("year_id", "event_id")
        .groupBy("year_id")
        .agg(F.count("event_id").alias("unique_races"))
    )
    return (
        figures.join(races, "year_id")
        .join(star.dim_time, "year_id")
        .select("year_of_event", "unique_races", "total_results", "countries", "avg_speed_kmh")
        .orderBy("year_of_event")
    )


def top_countries(star: Star, year: int | None = None, n: int = DASHBOARD_COUNTRIES) -> DataFrame:
    mart = country_mart(star.in_year(year).measures("athlete_key"), star.dim_athlete)
    return (
        mart.select("athlete_country", "total_finishers", "avg_speed_kmh")
        .orderBy(F.desc("total_finishers"), "athlete_country")
        .limit(n)
    )


def participation_trend(
    star: Star, first: int = FIRST_TREND_YEAR, last: int = LAST_TREND_YEAR
) -> DataFrame:
    return participation(star).where(F.col("year_of_event").between(first, last))


def top10_fastest(star: Star, year: int | None = None, n: int = DASHBOARD_FASTEST) -> DataFrame:
    mart = mart_fastest_athletes(star.in_year(year).fct_results, star.dim_athlete, star.dim_event, n)
    return mart.select(
        "athlete_id",
        "athlete_country",
        "athlete_gender",
        "event_name",
        "athlete_average_speed",
        "performance_seconds",
        "performance_hours",
    )
