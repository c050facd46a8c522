"""The layers as stored tables: bronze, silver and gold, and the exploratory cleanings.

Every table is written once and read back by what follows, so four gold tables share
one cleaned copy instead of cleaning four times, and all reports of an exploratory
variant share another.
"""

from __future__ import annotations

import hashlib
import os
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.plans import explore, gold, marts, quality, year_figures
from stridebase.plans.silver import SILVER_COLUMNS, clean_results
from stridebase.plans.star_queries import Star, SummedStar
from stridebase.plans.year_figures import YearFigures
from stridebase.schema import BRONZE_SCHEMA
from stridebase.sources import races_csv
from stridebase.sources.audit import Finding, publish
from stridebase.sources.files import delete_folder, make_folder
from stridebase.sources.order_races import orders_state, races_from_orders
from stridebase.sources.tables import application_folder, create_schema, drop_table, is_stored, refresh_table
from stridebase.streaming.incremental import refresh_silver, stream_races, stream_silver
from stridebase.streaming.states import StateStore, refresh_states

GOLD_TABLES = (
    "dim_athlete",
    "dim_event",
    "dim_time",
    "fct_results",
    "mart_fastest_athletes",
    "mart_top_countries",
)
# Cached table -> (layer, stored name).
STORED = {
    "races": ("bronze", "races"),
    "silver": ("silver", "obt"),
    **{name: ("gold", name) for name in GOLD_TABLES},
    "explore_v1": ("explore", "rows_v1"),
    "explore_v2": ("explore", "rows_v2"),
    "explore_silver_v1": ("explore", "silver_v1"),
    "explore_silver_v2": ("explore", "silver_v2"),
    "fct_by_year": ("serving", "fct_by_year"),
    "fct_by_athlete": ("serving", "fct_by_athlete"),
    "fct_of_frequent": ("serving", "fct_of_frequent"),
    "dim_athlete_bucketed": ("serving", "dim_athlete"),
    "frequent_athletes": ("serving", "frequent_athletes"),
    "year_sums": ("serving", "year_sums"),
    "year_bitmaps": ("serving", "year_bitmaps"),
}
LAYERS = ("bronze", "silver", "gold", "explore", "serving")


class Warehouse:
    """Stored layers over one source of raw results.

    A table is built when it is first asked for; :meth:`refresh` builds all but the exploratory and serving
    ones, which are built anew when they are next asked for.
    ``prefix`` goes in front of the schema names, ``location`` is the folder they live in. If ``audited``, a
    star table is published only if its declared keys hold; :attr:`findings` has what was found.
    """

    def __init__(self, races: DataFrame, location: str, prefix: str = "", audited: bool = False) -> None:
        self.spark: SparkSession = races.sparkSession
        self._races = races
        self._prefix = prefix
        self.location = location
        self.audited = audited
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.findings: dict[str, list[Finding]] = {}
        for layer in LAYERS:
            create_schema(self.spark, self.schema(layer), f"{location}/{layer}")

    @property
    def star(self) -> Star:
        return Star(self.fct_results, self.dim_athlete, self.dim_event, self.dim_time)

    def schema(self, layer: str) -> str:
        return f"{self._prefix}{layer}"

    def _place(self, name: str) -> tuple[str, str]:
        """Table and folder of a stored layer."""
        layer, table = STORED[name]
        return f"{self.schema(layer)}.{table}", f"{self.location}/{layer}/{table}"

    def _store(self, name: str, df: DataFrame, comment: str) -> DataFrame:
        table, path = self._place(name)
        if not (self.audited and name in quality.PRIMARY_KEYS):
            return refresh_table(df, table, comment, path)
        dimensions = None if name != "fct_results" else Star(df, self.dim_athlete, self.dim_event, self.dim_time)
        stored, self.findings[name] = publish(df, table, comment, path, quality.declared_rules(name, dimensions))
        return stored

    @cached_property
    def races(self) -> DataFrame:
        return self._store("races", self._races, "Raw results, columns renamed")

    @cached_property
    def silver(self) -> DataFrame:
        comment = "Cleaned results: kilometre events of European athletes"
        return self._store("silver", clean_results(self.races), comment)

    @cached_property
    def dim_athlete(self) -> DataFrame:
        return self._store("dim_athlete", gold.dim_athlete(self.silver), "Latest athlete attributes")

    @cached_property
    def dim_event(self) -> DataFrame:
        return self._store("dim_event", gold.dim_event(self.silver), "Latest event attributes")

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._store("dim_time", gold.dim_time(self.silver), "Years")

    @cached_property
    def fct_results(self) -> DataFrame:
        return self._store("fct_results", gold.fct_results(self.silver), "One row per result")

    @cached_property
    def fct_by_year(self) -> DataFrame:
        """The fact in one folder per year; a year with most of the results is several files."""
        table, path = self._place("fct_by_year")
        return refresh_table(self.fct_results, table, "Results by year", path, ("year_id",))

    @property
    def star_by_year(self) -> Star:
        """The star for questions about single years: only the files of the years asked for are read."""
        return Star(self.fct_by_year, self.dim_athlete, self.dim_event, self.dim_time)

    @cached_property
    def frequent_athletes(self) -> DataFrame:
        """Athletes with more results than a bucket holds on average: fewer than there are buckets."""
        counts = self.fct_results.groupBy("athlete_key").agg(F.count(F.lit(1)).alias("n"))
        limit = self.fct_results.agg(F.count(F.lit(1)) / self.buckets).scalar()
        return self._store("frequent_athletes", counts.where(F.col("n") > limit).select("athlete_key"), "Athletes with very many results")

    @cached_property
    def fct_by_athlete(self) -> DataFrame:
        """The fact in buckets of athletes, without the frequent ones, so that no bucket is much larger than others."""
        table, path = self._place("fct_by_athlete")
        rare = self.fct_results.join(F.broadcast(self.frequent_athletes), "athlete_key", "left_anti").select(*self.fct_results.columns)
        return refresh_table(rare, table, "Results by athlete", path, buckets=(self.buckets, "athlete_key"))

    @cached_property
    def fct_of_frequent(self) -> DataFrame:
        """The results of the frequent athletes, as they come."""
        table, path = self._place("fct_of_frequent")
        frequent = self.fct_results.join(F.broadcast(self.frequent_athletes), "athlete_key", "left_semi")
        return refresh_table(frequent.select(*self.fct_results.columns), table, "Results of frequent athletes", path)

    @cached_property
    def dim_athlete_bucketed(self) -> DataFrame:
        table, path = self._place("dim_athlete_bucketed")
        return refresh_table(self.dim_athlete, table, "Latest athlete attributes", path, buckets=(self.buckets, "athlete_key"))

    def star_wide(self) -> DataFrame:
        """:func:`star_queries.star_wide` without a shuffle of the fact for its join with the athletes.

        Results and athletes lie in the same buckets; the results of frequent athletes meet their few rows of the
        dimension by broadcast, wherever they lie.
        """
        few = self.dim_athlete.join(F.broadcast(self.frequent_athletes), "athlete_key", "left_semi")
        parts = (
            self.fct_by_athlete.join(self.dim_athlete_bucketed, "athlete_key", "left"),
            self.fct_of_frequent.join(F.broadcast(few), "athlete_key", "left"),
        )
        rows = parts[0].unionByName(parts[1])
        return rows.join(self.dim_event, "event_id", "left").join(self.dim_time, "year_id", "left")

    @cached_property
    def year_figures(self) -> YearFigures:
        """What is stored per year for questions about ranges of years."""
        built = year_figures.build(self.star)
        comment = "of every year"
        return YearFigures(self._store("year_sums", built.sums, f"Measures {comment}"), self._store("year_bitmaps", built.bitmaps, f"Distinct values {comment}"))

    @cached_property
    def mart_top_countries(self) -> DataFrame:
        mart = marts.mart_top_countries(self.fct_results, self.dim_athlete)
        return self._store("mart_top_countries", mart, "Results, speed and time per country")

    @cached_property
    def mart_fastest_athletes(self) -> DataFrame:
        mart = marts.mart_fastest_athletes(self.fct_results, self.dim_athlete, self.dim_event)
        return self._store("mart_fastest_athletes", mart, "The 1,000 shortest finishing times")

    @cached_property
    def explore_v1(self) -> DataFrame:
        return self._store("explore_v1", explore.explore_rows(self.races, explore.V1), "Exploratory cleaning, variant 1")

    @cached_property
    def explore_v2(self) -> DataFrame:
        return self._store("explore_v2", explore.explore_rows(self.races, explore.V2), "Exploratory cleaning, variant 2")

    @cached_property
    def explore_silver_v1(self) -> DataFrame:
        return self._store("explore_silver_v1", explore.explore_silver(self.explore_v1), "Variant 1 with dense ids")

    @cached_property
    def explore_silver_v2(self) -> DataFrame:
        return self._store("explore_silver_v2", explore.explore_silver(self.explore_v2), "Variant 2 with dense ids")

    def gold(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in GOLD_TABLES}

    def refresh(self) -> dict[str, DataFrame]:
        """Build every table anew, in order of dependency."""
        for name in (*STORED, "year_figures"):
            self.__dict__.pop(name, None)
        return {"races": self.races, "silver": self.silver, **self.gold()}

    def stands(self) -> bool:
        """Whether the schemas, and all that has been stored so far, are still there."""
        schemas = all(self.spark.catalog.databaseExists(self.schema(layer)) for layer in LAYERS)
        return schemas and all(is_stored(self.spark, self._place(name)[0]) for name in STORED if name in self.__dict__)

    def drop(self) -> None:
        """Forget all tables and remove their files."""
        for name in STORED:
            drop_table(self.spark, *self._place(name))
            self.__dict__.pop(name, None)
        self.__dict__.pop("year_figures", None)


class StreamedWarehouse(Warehouse):
    """Stored layers over a landing folder of raw files that only ever gains files.

    A refresh cleans the files that are new since the last one, appends them to the
    cleaned results and takes them into mergeable states. Dimensions, both marts and the measures of
    :attr:`star` come from the states; the fact is a projection of the cleaned results, without a copy of its own.
    ``limits`` go to the cleaning (countries, low, high) and must stay the same for one location.
    """

    def __init__(
        self, spark: SparkSession, landing: str, location: str, prefix: str = "", file_format: str = "parquet", **limits
    ) -> None:
        make_folder(spark, landing)
        super().__init__(spark.createDataFrame([], BRONZE_SCHEMA), location, prefix)
        self.landing, self.file_format, self.limits = landing, file_format, limits
        self.store = StateStore(spark, f"{location}/silver/states")

    @cached_property
    def races(self) -> DataFrame:
        """The landing folder itself, as it is now."""
        if self.file_format == "csv":
            return races_csv.read_races_csv(self.spark, self.landing)
        return self.spark.read.schema(BRONZE_SCHEMA).parquet(self.landing)

    @cached_property
    def silver(self) -> DataFrame:
        target, checkpoint = f"{self.location}/silver/streamed", f"{self.location}/silver/checkpoint"
        arriving = stream_races(self.spark, self.landing, self.file_format)
        refresh_silver(arriving, target, checkpoint, **self.limits).awaitTermination()
        refresh_states(stream_silver(self.spark, target), self.store, f"{checkpoint}_states")
        return self.spark.read.parquet(target).select(*SILVER_COLUMNS)

    @property
    def star(self) -> SummedStar:
        self.silver  # refreshed first
        return self.store.star(self.fct_results)

    @cached_property
    def dim_athlete(self) -> DataFrame:
        self.silver
        return self._store("dim_athlete", self.store.dim_athlete(), "Latest athlete attributes")

    @cached_property
    def dim_event(self) -> DataFrame:
        self.silver
        return self._store("dim_event", self.store.dim_event(), "Latest event attributes")

    @cached_property
    def dim_time(self) -> DataFrame:
        self.silver
        return self._store("dim_time", self.store.dim_time(), "Years")

    @cached_property
    def fct_results(self) -> DataFrame:
        return gold.fct_results(self.silver)

    @cached_property
    def mart_top_countries(self) -> DataFrame:
        self.silver
        return self._store("mart_top_countries", self.store.mart_top_countries(), "Results, speed and time per country")

    @cached_property
    def mart_fastest_athletes(self) -> DataFrame:
        self.silver
        return self._store("mart_fastest_athletes", self.store.mart_fastest_athletes(), "The 1,000 shortest finishing times")

    def drop(self) -> None:
        super().drop()
        delete_folder(self.spark, f"{self.location}/silver")


_open: dict[tuple[str, str], tuple[tuple, Warehouse]] = {}


def order_warehouse(spark: SparkSession, directory: str | os.PathLike[str]) -> Warehouse:
    """The warehouse of this session over the order tables in ``directory``.

    Within one Spark application the stored layers are shared by all queries, as long as they are there and
    the order tables have not been replaced; otherwise they are built anew. A new application builds its own.
    """
    directory = os.fspath(directory)
    key = (spark.sparkContext.applicationId, directory)
    state = orders_state(spark, directory)
    folder = application_folder(spark)
    if key not in _open or _open[key][0] != state or not _open[key][1].stands():
        name = "races_" + hashlib.sha256(directory.encode()).hexdigest()[:12]
        location = f"{folder}/{name}"
        spark.catalog.refreshByPath(directory)
        _open[key] = state, Warehouse(races_from_orders(spark, directory), location, f"{name}_")
    return _open[key][1]
