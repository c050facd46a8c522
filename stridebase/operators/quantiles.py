"""Exact discrete quantiles of a column of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.operators.slices import place_in_slices, running_total


def exact_quantiles(df: DataFrame, column: str, quantiles: dict[str, float]) -> DataFrame:
    """One row with, per ``{name: p}``, the least value that at least ``p`` of the values
    do not exceed. NULLs are left out.

    Equal values are counted first, with a map side, so repeated values cost little.
    """
    counts = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("occurrences"))
    )
    placed = place_in_slices(counts, column)
    total = placed.agg(F.sum("occurrences")).scalar()
    running = running_total(placed, (column,), "occurrences", "up_to")
    return running.agg(
        *[
            F.min(F.when(F.col("up_to") >= F.ceil(total * F.lit(p)), F.col(column))).alias(name)
            for name, p in quantiles.items()
        ]
    )
