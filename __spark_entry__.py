
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.duckdb_sql import ORACLE  # noqa: E402
from stridebase.operators import profiling, quantile_sketches  # noqa: E402
from stridebase.operators.dense_ids import dense_ranks  # noqa: E402
from stridebase.plans import explore, gold, marts, quality, reports, star_queries, year_figures  # noqa: E402
from stridebase.plans.explore import V1  # noqa: E402
from stridebase.plans.silver import clean_results  # noqa: E402
from stridebase.plans.star_queries import Star  # noqa: E402
from stridebase.plans.warehouse import StreamedWarehouse, Warehouse, order_warehouse  # noqa: E402
from stridebase.schema import BRONZE_TO_RAW  # noqa: E402
from stridebase.sources.audit import AuditFailed, as_table, publish  # noqa: E402
from stridebase.sources.drift import read_fitting_races  # noqa: E402
from stridebase.sources.order_races import races_from_orders  # noqa: E402
from stridebase.sources.races_csv import count_lines, read_races_csv, write_races_csv  # noqa: E402
from stridebase.sources.tables import create_schema, drop_table, refresh_table  # noqa: E402

try:
    import corpus_pipeline
    from stridebase.llm import queries as llm
except ImportError:  # the package may be left out
    llm = None

# Parameters of the registered reports.
AS_OF_YEAR = 2025
CLICKED_YEAR = 1998
FIRST_YEAR, LAST_YEAR = 1993, 1996  # of the range of years
MISSING_ATHLETES, DAMAGED_SECONDS = 50, 97  # multiples are left out of the dimension, and lose their event
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
LATE_YEARS, MIDDLE_YEARS = 1997, 1994  # from which on results land first and second
DAMAGED_IDS = 101  # multiples of this are damaged in the file whose lines are counted


def entry(spark: SparkSession) -> DataFrame:
    """Countries by number of results, from raw results through the star schema."""
    return queries()["mart_top_countries"](spark, "/root/testdata/sf0.001")


def _comparable(df: DataFrame) -> DataFrame:
    """32-bit floats and decimals as double, so that both engines hash alike."""
    narrow = (T.FloatType, T.DecimalType)
    casts = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, narrow)}
    return df.withColumns(casts) if casts else df


def _on_layers(build: Callable[[Warehouse], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query over the stored layers below the table it computes."""
    return lambda spark, sf_dir: _comparable(build(order_warehouse(spark, sf_dir)))


def _csv_round_trip(w: Warehouse) -> DataFrame:
    path = f"{w.location}/raw-{uuid.uuid4().hex}"
    write_races_csv(w.races, path)
    return read_races_csv(w.spark, path)


def _damaged_csv(w: Warehouse) -> DataFrame:
    """Line counts of a file in which some ids are no numbers."""
    path = f"{w.location}/damaged-{uuid.uuid4().hex}"
    broken = F.when(F.col("athlete_id") % DAMAGED_IDS == 0, F.concat("athlete_id", F.lit("x")))
    write_races_csv(w.races.withColumn("athlete_id", F.coalesce(broken, F.col("athlete_id").cast("string"))), path)
    return count_lines(w.spark, path)


def _drifted_files(w: Warehouse) -> DataFrame:
    """Rows that are read of a landing folder to which some years came with other columns, and why the files of
    those years were set aside."""
    folder = f"{w.location}/drifted-{uuid.uuid4().hex}"
    raw = w.races.withColumnsRenamed(BRONZE_TO_RAW)

    def land(rows: DataFrame) -> None:
        padded = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        rows.write.mode("append").options(**padded).csv(folder)

    year = F.col("Year of event")
    land(raw.where(year < MIDDLE_YEARS))
    land(raw.where((year >= MIDDLE_YEARS) & (year < LATE_YEARS)).withColumnRenamed("Athlete club", "Club"))
    land(raw.where(year >= LATE_YEARS).drop("Athlete gender"))
    rows, apart = read_fitting_races(w.spark, folder)
    reasons = apart.select("reason", "column_name", F.lit(None).cast("long").alias("rows")).distinct()
    return reasons.unionByName(rows.agg(F.lit("read").alias("reason"), F.lit("").alias("column_name"), F.count(F.lit(1)).alias("rows")))


def _streamed(w: Warehouse) -> StreamedWarehouse:
    """Layers that take the raw results from a landing folder."""
    run = f"{w.location}/stream-{uuid.uuid4().hex}"
    w.races.write.parquet(f"{run}/landing")
    return StreamedWarehouse(w.spark, f"{run}/landing", f"{run}/layers", f"s{uuid.uuid4().hex[:10]}_")


_landed: WeakKeyDictionary[Warehouse, StreamedWarehouse] = WeakKeyDictionary()


def _in_three_landings(w: Warehouse) -> StreamedWarehouse:
    """Layers after three landings, the latest years first, each with a refresh, and one batch that is replayed."""
    if w not in _landed:
        run = f"{w.location}/landings-{uuid.uuid4().hex}"
        layers = StreamedWarehouse(w.spark, f"{run}/landing", f"{run}/layers", f"i{uuid.uuid4().hex[:10]}_")
        third = F.when(F.col("year_of_event") >= LATE_YEARS, 0).when(F.col("year_of_event") >= MIDDLE_YEARS, 1).otherwise(2)
        for landing in range(3):
            arriving = w.races.where(third == landing)
            arriving.write.mode("append").parquet(f"{run}/landing")
            layers.refresh()
        layers.store.add(clean_results(arriving), 2)
        _landed[w] = layers
    return _landed[w]


def _audited_gold(w: Warehouse) -> DataFrame:
    """What the audits find while copies of the four star tables are published."""
    name = f"audit_{uuid.uuid4().hex[:10]}"
    copy = Warehouse(w.races, f"{w.location}/{name}", f"{name}_", audited=True)
    copy.__dict__["silver"] = w.silver
    copy.fct_results
    return as_table(w.spark, [finding for findings in copy.findings.values() for finding in findings])


def _rejected_keys(w: Warehouse) -> DataFrame:
    """The keys for which a damaged fact is not published."""
    schema = f"rejected_{uuid.uuid4().hex[:10]}"
    create_schema(w.spark, schema, f"{w.location}/{schema}")
    fewer = w.dim_athlete.where(F.col("athlete_id") % MISSING_ATHLETES != 0)
    damaged = F.when(F.col("performance_seconds") % DAMAGED_SECONDS != 0, F.col("event_id"))
    star = Star(w.fct_results.withColumn("event_id", damaged), fewer, w.dim_event, w.dim_time)
    try:
        publish(star.fct_results, f"{schema}.fct_results", "", f"{w.location}/{schema}/fct", quality.declared_rules("fct_results", star))
    except AuditFailed as failed:
        return failed.violations
    raise AssertionError("the damaged fact was published")


def _sketched_speeds(w: Warehouse) -> DataFrame:
    """Number of speeds per year, whether the quantiles of their sketches, merged from sketches by event and year,
    are as exact as promised, and the exact median."""
    parts = quantile_sketches.sketch(w.fct_results, "athlete_average_speed", "year_id", "event_id")
    found = quantile_sketches.quantiles(quantile_sketches.merged(parts, "year_id"), QUANTILES)
    errors = quantile_sketches.measured_rank_errors(w.fct_results, "athlete_average_speed", ["year_id"], found, QUANTILES)
    return (
        errors.join(w.dim_time, "year_id")
        .groupBy("year_of_event", "quantile")
        .agg(F.max("values").alias("speeds"), (F.max("error") <= quantile_sketches.rank_error()).alias("within_error"))
    )


def _dense_ids(w: Warehouse, value: str, rank: str, n: int | None = None) -> DataFrame:
    ranks = dense_ranks(w.explore_v1, {rank: value})[rank]
    return ranks if n is None else ranks.orderBy(rank).limit(n)


def _unique_counts(w: Warehouse) -> DataFrame:
    """Unique raw events, and unique values behind the exploratory ids."""
    raw = profiling.unique_counts(w.races, ["event_name"])
    kept = profiling.unique_counts(w.explore_v1, list(explore.DENSE_IDS.values()))
    return raw.withColumn("layer", F.lit("bronze")).unionByName(kept.withColumn("layer", F.lit("explore_v1")))


def _layer_row_counts(w: Warehouse) -> DataFrame:
    return reports.layer_row_counts({"bronze": w.races, "silver": w.silver, "gold": w.fct_results})


def _after_a_drop(w: Warehouse) -> DataFrame:
    """What is left of two stored tables when one has been dropped with its files."""
    schema = f"drop_{uuid.uuid4().hex[:10]}"
    place = f"{w.location}/{schema}"
    create_schema(w.spark, schema, place)
    for name in ("dim_time", "dim_event"):
        refresh_table(getattr(w, name), f"{schema}.{name}", "Copy", f"{place}/{name}")
    drop_table(w.spark, f"{schema}.dim_time", f"{place}/dim_time")
    return quality.table_inventory(w.spark, schema)


def _layer_columns(w: Warehouse) -> DataFrame:
    w.races, w.silver  # stored first
    return quality.layer_columns(w.spark, {layer: w.schema(layer) for layer in ("bronze", "silver")})


def _gold_inventory(w: Warehouse, inventory: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    w.gold()
    return inventory(w.spark, w.schema("gold"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    on_layers: dict[str, Callable[[Warehouse], DataFrame]] = {
        # Layers
        "bronze_races_csv": _csv_round_trip,
        "silver_obt": lambda w: clean_results(w.races),
        "silver_stream": lambda w: _streamed(w).silver,
        "mart_top_countries_streamed": lambda w: _streamed(w).mart_top_countries,
        "mart_top_countries_incremental": lambda w: _in_three_landings(w).store.mart_top_countries(),
        "mart_fastest_athletes_incremental": lambda w: _in_three_landings(w).store.mart_fastest_athletes(),
        "dim_athlete_incremental": lambda w: _in_three_landings(w).store.dim_athlete(),
        "dim_event_incremental": lambda w: _in_three_landings(w).store.dim_event(),
        "kpi_overview_incremental": lambda w: star_queries.kpi_overview(_in_three_landings(w).star),
        "kpi_by_year_incremental": lambda w: star_queries.kpi_by_year(_in_three_landings(w).star),
        "gender_incremental": lambda w: star_queries.gender_distribution(_in_three_landings(w).star),
        "speed_by_distance_incremental": lambda w: star_queries.speed_by_distance(_in_three_landings(w).star),
        "csv_line_counts": _damaged_csv,
        "csv_files_set_aside": _drifted_files,
        "dim_athlete": lambda w: gold.dim_athlete(w.silver),
        "dim_event": lambda w: gold.dim_event(w.silver),
        "dim_time": lambda w: gold.dim_time(w.silver),
        "fct_results": lambda w: gold.fct_results(w.silver),
        "star_wide": lambda w: star_queries.star_wide(w.star),
        "star_wide_bucketed": lambda w: w.star_wide(),
        "mart_top_countries": lambda w: marts.mart_top_countries(w.fct_results, w.dim_athlete),
        "mart_fastest_athletes": lambda w: marts.mart_fastest_athletes(w.fct_results, w.dim_athlete, w.dim_event),
        # Standing questions
        "genie_top_country": lambda w: star_queries.top_country(w.mart_top_countries),
        "genie_participation": lambda w: star_queries.participation(w.star),
        "genie_gender": lambda w: star_queries.gender_distribution(w.star),
        "genie_fastest": lambda w: star_queries.fastest_by_speed(w.mart_fastest_athletes),
        "genie_speed_by_distance": lambda w: star_queries.speed_by_distance(w.star),
        "genie_top_speed_countries": lambda w: star_queries.top_speed_countries(w.mart_top_countries),
        # Dashboard
        "dash_kpi_overview": lambda w: star_queries.kpi_overview(w.star),
        "dash_top_countries": lambda w: star_queries.top_countries(w.star),
        "dash_gender_distribution": lambda w: star_queries.gender_distribution(w.star),
        "dash_participation_trend": lambda w: star_queries.participation_trend(w.star),
        "dash_speed_by_distance": lambda w: star_queries.speed_by_distance(w.star),
        "dash_top10_fastest": lambda w: star_queries.top10_fastest(w.star),
        "kpi_by_year": lambda w: star_queries.kpi_by_year(w.star),
        # Dashboard after a click on one year
        "kpi_year_filter": lambda w: star_queries.kpi_overview(w.star_by_year, CLICKED_YEAR),
        "top_countries_year_filter": lambda w: star_queries.top_countries(w.star_by_year, CLICKED_YEAR),
        "gender_year_filter": lambda w: star_queries.gender_distribution(w.star_by_year, CLICKED_YEAR),
        "speed_by_distance_year_filter": lambda w: star_queries.speed_by_distance(w.star_by_year, CLICKED_YEAR),
        "top10_fastest_year_filter": lambda w: star_queries.top10_fastest(w.star_by_year, CLICKED_YEAR),
        # Ranges of years, from what is stored per year
        "kpi_year_range": lambda w: year_figures.kpi_over_years(w.year_figures, FIRST_YEAR, LAST_YEAR),
        "kpi_up_to_each_year": lambda w: year_figures.kpi_up_to_each_year(w.year_figures),
        "speed_sketches_by_year": _sketched_speeds,
        # Profiles of raw results
        "describe_numeric": lambda w: profiling.describe(w.races).withColumns(
            {"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)}
        ),
        "null_counts_wide": lambda w: profiling.null_counts(w.races),
        "null_or_blank_pct": lambda w: profiling.null_or_blank_pct(w.races),
        "null_summary": lambda w: profiling.null_summary(w.races),
        "value_counts_country": lambda w: profiling.value_counts(w.races, "athlete_country"),
        "country_counts": lambda w: profiling.value_counts(w.races, "athlete_country", None, "results"),
        "distance_counts": lambda w: profiling.value_counts(w.races, "event_distance_length", None, "results"),
        "unique_counts": _unique_counts,
        "age_distribution_bronze": lambda w: reports.age_distribution_bronze(w.races, AS_OF_YEAR),
        "distinct_birth_years": lambda w: reports.distinct_values(w.races, "athlete_year_of_birth"),
        "distance_suffix_counts": lambda w: reports.distance_suffix_counts(w.races),
        "event_unit_counts": lambda w: reports.event_unit_counts(w.races),
        "event_unit_counts_normalised": lambda w: reports.event_unit_counts_normalised(w.races),
        "performance_unit_counts": lambda w: reports.performance_unit_counts(w.races),
        "performance_format_counts": lambda w: reports.performance_format_counts(w.races),
        "performance_seconds_parsed": lambda w: reports.performance_seconds_parsed(w.races),
        "unit_combo_profile": lambda w: reports.unit_combo_profile(w.races),
        "invalid_combo_count": lambda w: reports.invalid_combo_count(w.races),
        "speed_quartiles": lambda w: reports.speed_quartiles(w.races),
        "cleaning_report": lambda w: reports.cleaning_report(w.races),
        # Exploratory cleanings
        "explore_clean": lambda w: explore.explore_clean(w.races, V1).drop("speed_number"),
        "explore_silver_v1": lambda w: explore.explore_silver(w.explore_v1),
        "explore_silver_v2": lambda w: explore.explore_silver(w.explore_v2),
        "dense_ids_event": lambda w: _dense_ids(w, "event_name", "event_id"),
        "dense_ids_athlete": lambda w: _dense_ids(w, "athlete_id", "athlete_key"),
        "dense_ids_year": lambda w: _dense_ids(w, "year_of_event", "year_id"),
        "dense_ids_event_first10": lambda w: _dense_ids(w, "event_name", "event_id", 10),
        "dense_ids_athlete_first10": lambda w: _dense_ids(w, "athlete_id", "athlete_key", 10),
        "performance_sample": lambda w: reports.performance_sample(w.races),
        "conversion_failures": lambda w: reports.conversion_failures(w.races),
        "speed_top20": lambda w: reports.speed_top20(w.races),
        "speed_stats": lambda w: reports.speed_stats(w.races),
        "speed_p99": lambda w: reports.speed_p99(w.races),
        "null_counts_silver": lambda w: profiling.null_counts(w.explore_silver_v2),
        "age_distribution": lambda w: reports.age_distribution(w.explore_v2),
        "marathon_type_counts": lambda w: reports.marathon_type_counts(w.explore_v2),
        "race_type_counts_explore": lambda w: reports.race_type_counts(w.explore_v2),
        "hour_event_profile": lambda w: reports.hour_distance_profile(w.explore_v2),
        "hour_performance_profile": lambda w: reports.hour_performance_profile(w.explore_v2),
        "hour_distance_counts_top20": lambda w: reports.distance_counts_top(
            w.explore_v2, "performance_km"
        ),
        "distance_stats": lambda w: reports.distance_stats(w.explore_v2),
        "distance_stats_silver": lambda w: reports.distance_stats(w.silver),
        "zero_time_stats_silver": lambda w: reports.zero_time_stats(w.silver),
        "explore_review_sample": lambda w: reports.review_sample(w.explore_silver_v1),
        "zero_time_stats": lambda w: reports.zero_time_stats(w.explore_v2),
        # Cleaned results and star schema
        "distance_counts_top20": lambda w: reports.distance_counts_top(w.silver, "performance_seconds"),
        "race_type_counts": lambda w: reports.race_type_counts(w.silver),
        "distinct_distances": lambda w: reports.distinct_values(w.silver, "event_distance_length"),
        "distinct_distances_top50": lambda w: reports.distinct_values(w.silver, "event_distance_length", 50),
        "distinct_countries_silver": lambda w: reports.distinct_values(w.silver, "athlete_country"),
        "distinct_countries_gold": lambda w: reports.distinct_values(w.dim_athlete, "athlete_country"),
        "odd_distances": lambda w: reports.odd_distances(w.dim_event),
        "performance_hms": lambda w: reports.performance_hms(w.fct_results),
        "surrogate_keys": lambda w: reports.surrogate_keys(w.silver),
        "layer_row_counts": _layer_row_counts,
        "layer_schema_inventory": _layer_columns,
        "tables_after_drop": _after_a_drop,
        "gold_table_inventory": lambda w: _gold_inventory(w, quality.table_inventory),
        "gold_schema_inventory": lambda w: _gold_inventory(w, quality.column_inventory),
        # Data quality
        "audit_gold": _audited_gold,
        "audit_rejected_keys": _rejected_keys,
        "dq_pk_duplicates": lambda w: quality.primary_key_duplicates(w.star),
        "dq_fk_orphans": lambda w: quality.foreign_key_orphans(w.star),
        "dq_result_id_collisions": lambda w: quality.result_id_collisions(w.silver),
        "dq_birth_year": lambda w: quality.birth_year_plausibility(w.races),
    }
    registered = {name: _on_layers(build) for name, build in on_layers.items()}
    if llm:
        registered |= {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return {"bronze_races": races_from_orders, **registered}


def oracle_sql() -> dict[str, str]:
    return {**ORACLE, **(llm.SQL if llm else {})}
