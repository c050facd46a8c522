"""Quantiles per group from mergeable sketches.

A KLL sketch of ``k`` keeps a few times ``k`` values of a group of any size, and sketches of parts merge
into that of the whole. The rank of a value it returns is off by at most about ``rank_error(k)`` of the
group's size, with a confidence of 99 %; a group of at most ``k`` values is exact.
:func:`measured_rank_errors` measures it against the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 800


def rank_error(k: int = K) -> float:
    """Share of a group's values by which the rank of a quantile may be off."""
    return 2.446 / k**0.9433


def sketch(df: DataFrame, column: str, *groups: str, k: int = K) -> DataFrame:
    """``groups``, ``sketch`` and ``values`` (their number, NULLs left out). Aggregated in every task before the shuffle."""
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(*groups).agg(
        F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("values")
    )


def merged(sketches: DataFrame, *groups: str, k: int = K) -> DataFrame:
    """The sketches of coarser groups, or of several batches."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"), F.sum("values").alias("values"))


def quantiles(sketches: DataFrame, names: dict[str, float]) -> DataFrame:
    """A column per ``{name: p}``: a value that about ``p`` of the group's values do not exceed."""
    return sketches.withColumns({name: F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for name, p in names.items()}).drop("sketch")


def measured_rank_errors(df: DataFrame, column: str, groups: Sequence[str], found: DataFrame, names: dict[str, float]) -> DataFrame:
    """Per group and name, how far the rank of the value found is from p, as a share of the group.

    ``found`` is the output of :func:`quantiles`; groups are compared null-safe. Equal values share all their ranks, and the nearest counts.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*groups, F.col(column).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    right = found.select(*[F.col(g).alias(f"_{g}") for g in groups], "values", *names)
    joined = counts.join(right, [counts[g].eqNullSafe(right[f"_{g}"]) for g in groups])
    ranks = joined.groupBy(*groups).agg(
        F.first("values").alias("values"),
        *[F.coalesce(F.sum(F.when(F.col("value") < F.col(name), F.col("n"))), F.lit(0)).alias(f"below_{name}") for name in names],
        *[F.coalesce(F.sum(F.when(F.col("value") <= F.col(name), F.col("n"))), F.lit(0)).alias(f"upto_{name}") for name in names],
    )
    errors = [
        F.struct(
            F.lit(name).alias("quantile"),
            F.greatest(F.col(f"below_{name}") / F.col("values") - p, p - F.col(f"upto_{name}") / F.col("values"), F.lit(0.0)).alias("error"),
        )
        for name, p in names.items()
    ]
    return ranks.select(*groups, "values", F.inline(F.array(*errors)))
