"""Incremental refresh of the cleaned results.

Cleaning keeps no state, so new files are cleaned and appended without touching what is
already there, and the outcome equals a batch run over all files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stridebase.plans.silver import EUROPE, MAX_SPEED, MIN_SPEED, SILVER_SCHEMA, clean_results
from stridebase.schema import BRONZE_SCHEMA, RAW_SCHEMA, RAW_TO_BRONZE
from stridebase.sources.tables import is_refreshed_in_full


def stream_races(
    spark: SparkSession, folder: str, file_format: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Raw results from files arriving in a landing folder, as ``parquet`` or headed ``csv``.

    The folder must only ever gain files. One that a table is refreshed in is refused: a full
    refresh writes the same rows to new files, which a stream would take in again.
    """
    if is_refreshed_in_full(spark, folder):
        raise ValueError(f"{folder} belongs to a table that is refreshed in full; stream the landing folder of raw files")
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if file_format == "csv":
        rows = reader.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", False).csv(folder)
        return rows.withColumnsRenamed(RAW_TO_BRONZE)
    return reader.schema(BRONZE_SCHEMA).parquet(folder)


def stream_silver(spark: SparkSession, target: str) -> DataFrame:
    """Cleaned results as :func:`refresh_silver` appends them, for what keeps itself up to date by them."""
    return spark.readStream.schema(SILVER_SCHEMA).parquet(target)


def refresh_silver(
    races: DataFrame,
    target: str,
    checkpoint: str,
    countries: Sequence[str] = EUROPE,
    low: float = MIN_SPEED,
    high: float = MAX_SPEED,
) -> StreamingQuery:
    """Clean all files that are new since the last run, append them, and stop.

    The checkpoint must outlive the run and be reachable by the whole cluster; it is
    what makes a repeated or interrupted run write each file exactly once.
    """
    return (
        clean_results(races, countries, low, high)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
