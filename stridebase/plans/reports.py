"""Profiling reports over raw, cleaned and exploratory rows."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stridebase.functions import clock, keys, speed, units
from stridebase.operators.profiling import percent
from stridebase.operators.quantiles import exact_quantiles
from stridebase.plans import explore, silver

# Fixed values.
COMMON_DISTANCES = ("50km", "100km", "50mi", "100mi")
CLOCK_FORMAT, DECIMAL_FORMAT, OTHER_FORMAT = "HH:MM:SS", "decimal", "övrigt"
TIME_BASED, DISTANCE_BASED = "time_based", "distance_based"
MILES, KILOMETERS, OTHER_TYPE = "miles", "kilometers", "other"
SAMPLE_ROWS = 20
REVIEWED = (
    "event_id", "event_name", "event_distance_length",
    "athlete_key", "athlete_id",
    "athlete_performance", "performance_seconds", "performance_km",
    "athlete_gender", "athlete_country", "year_of_event",
)
VARIANTS = {"v1": explore.V1, "v2": explore.V2}


def _counted(df: DataFrame, *columns: str | Column, name: str = "results") -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# Raw rows


def age_distribution_bronze(races: DataFrame, as_of_year: int) -> DataFrame:
    """Results per age in a given year (a parameter, so reports can be repeated)."""
    age = F.lit(as_of_year) - F.col("athlete_year_of_birth")
    return _counted(races, age.alias("age")).orderBy(F.asc_nulls_first("age"))


def distance_suffix_counts(races: DataFrame) -> DataFrame:
    """Trailing lower-case letters of the distance; none gives the empty text."""
    suffix = F.regexp_extract("event_distance_length", "[a-z]+$", 0)
    return _counted(races, suffix.alias("suffix")).orderBy(F.desc("results"), "suffix")


def event_unit_counts(races: DataFrame) -> DataFrame:
    """Units as written, with a bucket for what has none."""
    unit = F.coalesce(units.ending_unit(F.col("event_distance_length")), F.lit(units.UNKNOWN_UNIT))
    return _counted(races, unit.alias("event_unit")).orderBy(F.desc("results"), "event_unit")


def event_unit_counts_normalised(races: DataFrame) -> DataFrame:
    """Units of the trimmed, lower-cased distance, days included."""
    unit = units.event_unit(F.col("event_distance_length"), units.PROFILE_UNITS)
    return _counted(races, unit.alias("event_unit")).orderBy(F.desc("results"), "event_unit")


def performance_unit_counts(races: DataFrame) -> DataFrame:
    """Strict performance units."""
    unit = units.performance_unit(F.col("athlete_performance"))
    return _counted(races, unit.alias("performance_unit")).orderBy(F.desc("results"), "performance_unit")


def performance_format_counts(races: DataFrame) -> DataFrame:
    performance = F.col("athlete_performance")
    shape = (
        F.when(performance.contains(":"), CLOCK_FORMAT)
        .when(performance.rlike(r"^\d+\.\d+"), DECIMAL_FORMAT)
        .otherwise(OTHER_FORMAT)
    )
    return _counted(races, shape.alias("format")).orderBy(F.desc("results"), "format")


def unit_combo_profile(races: DataFrame) -> DataFrame:
    """Results per loose unit pair and its validity."""
    return _counted(explore.with_units(races), *explore.UNIT_COLUMNS).orderBy(
        F.desc("results"), F.asc_nulls_first("event_unit"), "performance_unit"
    )


def invalid_combo_count(races: DataFrame) -> DataFrame:
    return explore.with_units(races).agg(F.count_if(~F.col("is_valid_combo")).alias("invalid_rows"))


def performance_seconds_parsed(races: DataFrame) -> DataFrame:
    """Every performance text with its seconds as each cleaning reads it."""
    performance = F.col("athlete_performance")
    return (
        _counted(races, "athlete_performance")
        .transform(clock.with_seconds, clock.without_unit(performance), "seconds")
        .transform(clock.with_seconds, performance, "seconds_with_unit")
        .transform(clock.with_seconds, clock.first_word(performance), "seconds_first_word")
    )


def speed_quartiles(races: DataFrame) -> DataFrame:
    """Least, quartiles and greatest of the digits of the speed, outliers included."""
    number = speed.speed_digits(F.col("athlete_average_speed")).cast("double")
    points = {"min_speed": 0.0, "q1_speed": 0.25, "q3_speed": 0.75, "max_speed": 1.0}
    return exact_quantiles(races.select(number.alias("speed_num")), "speed_num", points)


def cleaning_report(races: DataFrame) -> DataFrame:
    """Rows before, after and removed per cleaning, all from one scan."""
    rules = {
        "silver": silver.in_scope() & silver.is_plausible(),
        "explore_v1": explore.is_complete() & explore.is_plausible(explore.V1),
        "explore_v2": explore.is_complete() & explore.is_plausible(explore.V2),
    }
    after = [
        F.struct(F.lit(name).alias("cleaning"), F.count_if(rule).alias("rows_after"))
        for name, rule in rules.items()
    ]
    row = (
        silver.with_measures(explore.with_units(races))
        .agg(F.count(F.lit(1)).alias("rows_before"), F.array(*after).alias("cleanings"))
    )
    return (
        row.select("rows_before", F.inline("cleanings"))
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
        .withColumn("removed_pct", percent("rows_removed", "rows_before", 2))
    )


# Exploratory rows


def _both_variants(races: DataFrame) -> DataFrame:
    """Complete rows with the measures of both variants, from one scan and one parse of each text."""
    rows = explore.with_units(races).where(explore.is_complete()).transform(explore.with_speed_number)
    timed, measured = F.col("performance_unit") == "h", F.col("performance_unit") == "km"
    for name, variant in VARIANTS.items():
        rows = clock.with_seconds(rows, F.when(timed, variant.time_text()), f"seconds_{name}")
        rows = rows.withColumn(f"km_{name}", F.when(measured, variant.kilometres()))
    return rows


def _per_variant(rows: DataFrame, figures: Callable[[str, Column], list[Column]]) -> DataFrame:
    """One row per variant from one aggregate; ``figures`` get its name and which rows it keeps."""
    found = [
        F.struct(F.lit(name).alias("variant"), *figures(name, explore.is_plausible(variant)))
        for name, variant in VARIANTS.items()
    ]
    return rows.agg(F.array(*found).alias("found")).select(F.inline("found"))


def conversion_failures(races: DataFrame) -> DataFrame:
    """Times that could not be read, and rows left without any measure, per variant."""

    def figures(name: str, kept: Column) -> list[Column]:
        no_time = kept & F.col(f"seconds_{name}").isNull()
        return [
            F.count_if(no_time & (F.col("performance_unit") == "h")).alias("failed_times"),
            F.count_if(no_time & F.col(f"km_{name}").isNull()).alias("no_measure"),
        ]

    return _per_variant(_both_variants(races), figures)


def performance_sample(races: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """First ``n`` performances in text order with what they were converted to."""
    columns = ["athlete_performance", "performance_unit", "performance_seconds", "performance_km"]
    return (
        explore.explore_converted(races, explore.V1)
        .select(*columns)
        .orderBy("athlete_performance", "performance_unit")
        .limit(n)
        .withColumn("performance_km", F.col("performance_km").cast("double"))
    )


def _clean_speeds(races: DataFrame) -> DataFrame:
    rows = explore.explore_clean(races, explore.V1)
    return rows.withColumn("speed_float", F.col("speed_number").cast("double"))


def speed_top20(races: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    return (
        _clean_speeds(races)
        .select("athlete_average_speed", "event_distance_length", "speed_float")
        .orderBy(F.desc("speed_float"), "athlete_average_speed", "event_distance_length")
        .limit(n)
    )


def speed_stats(races: DataFrame) -> DataFrame:
    """Least, greatest and mean speed: as digits in v1, as stored in v2. One scan for both."""
    rows = explore.with_units(races).where(explore.is_complete()).transform(explore.with_speed_number)
    read = {"v1": F.col("speed_number"), "v2": speed.leading_number(F.col("athlete_average_speed"))}

    def figures(name: str, kept: Column) -> list[Column]:
        value = F.when(kept, read[name].cast("double"))
        return [
            F.min(value).alias("min_speed"),
            F.max(value).alias("max_speed"),
            F.round(F.avg(value), 6).alias("avg_speed"),
        ]

    return _per_variant(rows, figures)


def speed_p99(races: DataFrame) -> DataFrame:
    """Approximate on purpose: a sketch of bounded size, one pass, no shuffle of values."""
    return _clean_speeds(races).agg(F.percentile_approx("speed_float", 0.99).alias("p99_speed"))


def marathon_type_counts(rows: DataFrame) -> DataFrame:
    kind = F.when(F.col("performance_seconds").isNotNull(), TIME_BASED).otherwise(DISTANCE_BASED)
    return _counted(rows, kind.alias("marathon_type"))


def race_type_counts(rows: DataFrame) -> DataFrame:
    distance = F.col("event_distance_length")
    kind = F.when(distance.like("%mi"), MILES).when(distance.like("%km"), KILOMETERS).otherwise(OTHER_TYPE)
    return _counted(rows, kind.alias("race_type"))


def hour_distance_profile(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Most frequent converted measures of timed events."""
    by = ["event_distance_length", "performance_km", "performance_seconds"]
    return _most_frequent(rows, by, n).withColumn("performance_km", F.col("performance_km").cast("double"))


def hour_performance_profile(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Most frequent raw performances of timed events."""
    by = ["event_distance_length", "athlete_performance", "athlete_average_speed"]
    return _most_frequent(rows, by, n).withColumn(
        "athlete_average_speed", F.col("athlete_average_speed").cast("double")
    )


def _most_frequent(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    timed = rows.where(F.col("event_distance_length").like("%h"))
    return (
        _counted(timed, *by)
        .orderBy(F.desc("results"), *[F.asc_nulls_first(c) for c in by])
        .limit(n)
    )


def distance_counts_top(rows: DataFrame, measure: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """Most frequent distances among rows that have the measure."""
    return (
        _counted(rows.where(F.col(measure).isNotNull()), "event_distance_length")
        .orderBy(F.desc("results"), "event_distance_length")
        .limit(n)
    )


def _hours(seconds: Column) -> Column:
    return F.round(seconds / F.lit(Decimal("3600.0")), 2).cast("double")


def distance_stats(rows: DataFrame) -> DataFrame:
    """Fastest time, mean speed and results of the common distances."""
    fastest = F.min("performance_seconds")
    return (
        rows.where(F.col("event_distance_length").isin(*COMMON_DISTANCES))
        .groupBy("event_distance_length")
        .agg(
            fastest.alias("fastest_seconds"),
            _hours(fastest).alias("fastest_hours"),
            F.round(F.avg("athlete_average_speed"), 2).alias("avg_speed_kmh"),
            F.count(F.lit(1)).alias("results"),
        )
        .orderBy("event_distance_length")
    )


def zero_time_stats(rows: DataFrame) -> DataFrame:
    """Zero times of the common distances, and the fastest time above zero."""
    seconds = F.col("performance_seconds")
    fastest = F.min(F.when(seconds > 0, seconds))
    return (
        rows.where(F.col("event_distance_length").isin(*COMMON_DISTANCES))
        .groupBy("event_distance_length")
        .agg(
            F.count(F.lit(1)).alias("results"),
            F.count_if(seconds == 0).alias("zero_times"),
            fastest.alias("fastest_seconds"),
            _hours(fastest).alias("fastest_hours"),
        )
        .orderBy("event_distance_length")
    )


def review_sample(rows: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """Key columns of the first ``n`` exploratory rows in the order of these columns."""
    return rows.select(*REVIEWED).orderBy(*map(F.asc_nulls_first, REVIEWED)).limit(n)


def age_distribution(rows: DataFrame) -> DataFrame:
    return _counted(rows, "athlete_age_at_event").orderBy(F.asc_nulls_first("athlete_age_at_event"))


# Cleaned rows


def distinct_values(rows: DataFrame, column: str, n: int | None = None) -> DataFrame:
    values = rows.select(column).distinct().orderBy(F.asc_nulls_first(column))
    return values if n is None else values.limit(n)


def odd_distances(dim_event: DataFrame) -> DataFrame:
    """Distances that do not end in km or that list several."""
    distance = F.col("event_distance_length")
    odd = ~distance.like("%km") | distance.like("%,%") | distance.like("%/%")
    return dim_event.where(odd).select("event_distance_length").distinct()


def performance_hms(fct: DataFrame) -> DataFrame:
    return fct.select(
        "result_id", "performance_seconds", clock.seconds_to_clock(F.col("performance_seconds")).alias("performance_hms")
    )


def surrogate_keys(results: DataFrame) -> DataFrame:
    """Every surrogate key with the value it stands for, from one scan and one distinct.

    Only distinct values are hashed.
    """
    sources = {"event_id": "event_name", "athlete_key": "athlete_id", "year_id": "year_of_event"}
    values = [
        F.struct(F.lit(key).alias("key_column"), F.col(source).cast("string").alias("source_value"))
        for key, source in sources.items()
    ]
    return (
        results.select(F.inline(F.array(*values)))
        .distinct()
        .transform(keys.with_hash_key, ["source_value"], "key_value")
    )


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows")) for name, df in layers.items()]
    )
