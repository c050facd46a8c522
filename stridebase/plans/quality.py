"""Data-quality checks over the stored layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridebase.plans.star_queries import Star
from stridebase.sources.audit import Rules

# Declared keys of the star schema.
PRIMARY_KEYS = {
    "fct_results": "result_id",
    "dim_athlete": "athlete_key",
    "dim_event": "event_id",
    "dim_time": "year_id",
}
FOREIGN_KEYS = {"dim_athlete": "athlete_key", "dim_event": "event_id", "dim_time": "year_id"}
# Two distances of one event in one year share a result id, so its repeats are reported only.
REPORTED_KEYS = {"fct_results"}


def declared_rules(table: str, star: Star) -> Rules:
    """The declared keys of a table as rules of an audit; the fact refers to the dimensions of ``star``."""
    key = PRIMARY_KEYS[table]
    if table != "fct_results":
        return Rules(key, required=(key,))
    references = {column: getattr(star, dimension).select(column) for dimension, column in FOREIGN_KEYS.items()}
    return Rules(key, table not in REPORTED_KEYS, (key, *references), references)


def primary_key_duplicates(star: Star) -> DataFrame:
    """Key values that occur more than once, per table."""
    repeated = [
        getattr(star, table)
        .groupBy(F.lit(table).alias("table_name"), F.col(key).alias("key_value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
        for table, key in PRIMARY_KEYS.items()
    ]
    return reduce(DataFrame.unionByName, repeated)


def foreign_key_orphans(star: Star) -> DataFrame:
    """Fact rows without a matching dimension row, per dimension.

    The fact is reduced to one row per key before the anti join, so a frequent key
    costs no more than a rare one.
    """
    orphans = []
    for table, key in FOREIGN_KEYS.items():
        used = star.fct_results.groupBy(key).agg(F.count(F.lit(1)).alias("results"))
        missing = used.join(getattr(star, table).select(key), key, "left_anti")
        orphans.append(
            missing.agg(
                F.lit(table).alias("dimension"),
                F.count(F.lit(1)).alias("orphan_keys"),
                F.coalesce(F.sum("results"), F.lit(0)).alias("orphan_results"),
            )
        )
    return reduce(DataFrame.unionByName, orphans)


def result_id_collisions(silver: DataFrame) -> DataFrame:
    """Athlete, event and year combinations that share one result id, with the number of
    results and of distances behind it."""
    who = ["athlete_id", "event_name", "year_of_event"]
    per_distance = silver.groupBy(*who, "event_distance_length").agg(F.count(F.lit(1)).alias("results"))
    return (
        per_distance.groupBy(*who)
        .agg(F.sum("results").alias("results"), F.count(F.lit(1)).alias("distances"))
        .where(F.col("results") > 1)
    )


def birth_year_plausibility(races: DataFrame, earliest: int = 1900) -> DataFrame:
    """Missing, too early and impossible years of birth. They are reported, not removed."""
    born = F.col("athlete_year_of_birth")
    return races.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(born.isNull()).alias("missing"),
        F.count_if(born < earliest).alias("too_early"),
        F.count_if(born > F.col("year_of_event")).alias("after_event"),
        F.min(born).alias("earliest_year"),
        F.max(born).alias("latest_year"),
    )


def table_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Stored tables of a schema with their number of rows."""
    names = sorted(table.name for table in spark.catalog.listTables(schema))
    counts = [
        spark.table(f"{schema}.{name}").agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"))
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def layer_columns(spark: SparkSession, layers: dict[str, str]) -> DataFrame:
    """Columns of all stored tables of several schemas, given as ``{layer: schema}``."""
    found = [column_inventory(spark, schema).select(F.lit(layer).alias("layer"), "*") for layer, schema in layers.items()]
    return reduce(DataFrame.unionByName, found)


def column_inventory(spark: SparkSession, schema: str) -> DataFrame:
    """Columns of every stored table with type and number of values, one scan per table."""
    described = []
    for table in sorted(table.name for table in spark.catalog.listTables(schema)):
        df = spark.table(f"{schema}.{table}")
        columns = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(position).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.count(field.name).alias("values"),
            )
            for position, field in enumerate(df.schema.fields, start=1)
        ]
        described.append(df.agg(F.array(*columns).alias("columns")).select(F.inline("columns")))
    return reduce(DataFrame.unionByName, described)
