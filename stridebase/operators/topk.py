"""Top-k over a fact table, and looking up attributes for the few rows that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridebase.sources.tables import cut_lineage


def least_with_ties(df: DataFrame, column: str, k: int) -> DataFrame:
    """All rows whose ``column`` is among the ``k`` least values, ties of the k-th included.

    The cut-off is a top-k on the one column, so only that column is read for it. The
    rows are written out: what comes next plans with their true size.
    """
    present = df.where(F.col(column).isNotNull())
    cutoff = present.select(column).orderBy(column).limit(k).agg(F.max(column)).scalar()
    return cut_lineage(present.where(F.col(column) <= cutoff), "topk")


def look_up(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join that narrows a large dimension to the keys in ``rows`` first.

    An outer join cannot broadcast its preserved side, so joining few rows to a large
    dimension directly would shuffle the dimension. The semi join can broadcast them if
    they are small enough, and Catalyst falls back to a shuffle if they are not.
    """
    needed = dimension.join(rows.select(key), key, "left_semi")
    return rows.join(needed, key, "left")
