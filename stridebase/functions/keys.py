"""Surrogate keys."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: separator between the hashed parts.
KEY_SEPARATOR = "||"


def hash_key(*parts: Column) -> Column:
    """SHA-256 of the parts as text. NULL parts are skipped, so the key is never NULL."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *[part.cast("string") for part in parts]), 256)


def with_hash_key(df: DataFrame, source_columns: list[str], key_column: str) -> DataFrame:
    """For ``df.transform(with_hash_key, ["event_name"], "event_id")``."""
    return df.withColumn(key_column, hash_key(*[F.col(c) for c in source_columns]))
