"""Filtering on an expensive computed column without computing it twice."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, with ``columns`` passed through a one-element ``inline``.

    Spark pushes a filter on a computed column below the projection that computes it and
    so evaluates the expression, with all its parts, in the filter and again in the
    projection. A filter on the output of a generator stays above it.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns)))).select(*df.columns)
