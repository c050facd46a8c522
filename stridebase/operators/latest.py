"""Latest-value dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, key: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """Per key the attributes of the row with the greatest ``order``.

    All attributes come from one row. Ties go to the greatest attributes in the listed
    order. Rows without ``order`` are ignored, and a key that has no other rows keeps
    NULL attributes.

    One ``max`` over a struct needs one shuffle and has a map side, so a key that holds a
    large share of the rows is reduced in every task before it is shuffled.
    """
    return attributes_of(newest_by(df, key, order, attributes), key, attributes)


def newest_by(df: DataFrame, key: str, order: str, attributes: Sequence[str]) -> DataFrame:
    """Per key ``newest``, its greatest struct of ``order`` and attributes. The greatest of several parts' is that of all."""
    newest = F.max(F.when(F.col(order).isNotNull(), F.struct(order, *attributes)))
    return df.groupBy(key).agg(newest.alias("newest"))


def attributes_of(newest: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    return newest.select(key, *[F.col(f"newest.{name}").alias(name) for name in attributes])
