"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stridebase.sources.tables import application_folder, cut_lineage

__all__ = ["application_folder", "cut_lineage", "fresh_name", "partitions", "table"]


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
