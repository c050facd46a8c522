"""Figures of any range of years, from what is stored per year.

Results and speeds add up over years; distinct races, athletes and countries do not, so they are
stored as bitmaps over dense ids. A question about a range reads the years' rows and bitmaps only, never the fact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.operators import distinct_bitmaps
from stridebase.operators.dense_ids import dense_ranks
from stridebase.operators.rollup import MEASURES, mean_speed, merged_measures, total_results
from stridebase.plans.star_queries import Star
from stridebase.sources.tables import cut_lineage

KINDS = {"unique_races": "event_id", "unique_athletes": "athlete_key", "countries": "athlete_country"}


@dataclass(frozen=True)
class YearFigures:
    """``sums``: the measures of every year. ``bitmaps``: ``year_of_event, kind, bucket, bitmap``."""

    sums: DataFrame
    bitmaps: DataFrame


def build(star: Star) -> YearFigures:
    """Figures of all years; store them before they are asked.

    The fact is reduced to one row per year and key, then numbered; raw rows meet no join.
    """
    years = star.dim_time.select("year_id", "year_of_event")
    countries = star.dim_athlete.select("athlete_key", "athlete_country")
    sums = merged_measures(star.measures("year_id", "athlete_key").join(years, "year_id"), "year_of_event")
    pairs = {
        "unique_races": star.measures("year_id", "event_id").select("year_id", "event_id"),
        "unique_athletes": star.measures("year_id", "athlete_key").select("year_id", "athlete_key"),
    }
    pairs["countries"] = pairs["unique_athletes"].join(countries, "athlete_key").select("year_id", "athlete_country").distinct()
    bitmaps = []
    for kind, column in KINDS.items():
        rows = cut_lineage(pairs[kind].join(years, "year_id").where(F.col(column).isNotNull()).select("year_of_event", column), kind)
        numbered = rows.join(dense_ranks(rows, {"number": column})["number"], column)
        bitmaps.append(distinct_bitmaps.construct(numbered, "number", "year_of_event").withColumn("kind", F.lit(kind)))
    every = bitmaps[0].unionByName(bitmaps[1]).unionByName(bitmaps[2])
    return YearFigures(sums, every)


def kpi_over_years(figures: YearFigures, first: int, last: int) -> DataFrame:
    """The KPIs of the years from ``first`` to ``last``, one row."""
    chosen = F.col("year_of_event").between(first, last)
    distinct = distinct_bitmaps.merged(figures.bitmaps.where(chosen), "kind").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0)).alias(kind) for kind in KINDS]
    )
    totals = figures.sums.where(chosen).agg(F.coalesce(total_results(), F.lit(0)).alias("total_results"), F.round(mean_speed(), 2).alias("avg_speed_kmh"))
    # Both are one row.
    return totals.select(
        *[distinct.select(kind).scalar().alias(kind) for kind in KINDS], "total_results", "avg_speed_kmh"
    )


def kpi_up_to_each_year(figures: YearFigures) -> DataFrame:
    """The KPIs of all years up to each year. Every year's rows count for all years from it on."""
    years = figures.sums.where("year_of_event IS NOT NULL").select(F.col("year_of_event").alias("up_to")).distinct()
    last = years.agg(F.max("up_to")).scalar()

    def from_then_on(rows: DataFrame) -> DataFrame:
        ends = rows.where("year_of_event IS NOT NULL").withColumn("last", last).withColumn("later", F.sequence("year_of_event", "last"))
        return ends.withColumn("up_to", F.explode("later")).drop("later", "last").join(years, "up_to")

    spread = distinct_bitmaps.merged(from_then_on(figures.bitmaps), "up_to", "kind")
    distinct = spread.groupBy("up_to").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.bitmap_count("bitmap"))), F.lit(0)).alias(kind) for kind in KINDS]
    )
    sums = from_then_on(figures.sums.select("year_of_event", *MEASURES)).groupBy("up_to").agg(
        total_results().alias("total_results"), F.round(mean_speed(), 2).alias("avg_speed_kmh")
    )
    return sums.join(distinct, "up_to", "left").select("up_to", *[F.coalesce(kind, F.lit(0)).alias(kind) for kind in KINDS], "total_results", "avg_speed_kmh")
