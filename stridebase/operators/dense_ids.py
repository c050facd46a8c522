"""Dense ids (1, 2, 3, … in value order) without sorting the table in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridebase.operators.slices import place_in_slices, running_total
from stridebase.sources.tables import cut_lineage

LOOKUP_BYTES = 64 << 20  # of ranks that are sent to every executor
ROW_BYTES = 64  # of a rank besides its text


def dense_ranks(df: DataFrame, ids: dict[str, str]) -> dict[str, DataFrame]:
    """Per ``{id column: value column}`` the distinct values with their dense rank; NULL counts
    as the least value. Values are texts or whole numbers.

    All columns are ranked together, from one pass over them: the distinct values of all
    are put in one order, by column and value, and a rank is a position less where its column begins. The
    ranks are stored by column, so a join plans with the size of its own, broadcasting
    few and shuffling many.
    """

    def entry(rank: str, column: str):
        is_text = isinstance(df.schema[column].dataType, T.StringType)
        number = F.lit(None) if is_text else F.col(column)
        text = F.col(column) if is_text else F.lit(None)
        return F.struct(F.lit(rank).alias("id"), number.cast("long").alias("number"), text.cast("string").alias("text"))

    order = ("id", "number", "text")
    values = df.select(F.inline(F.array(*[entry(*pair) for pair in ids.items()]))).distinct()
    placed = place_in_slices(values.withColumn("step", F.lit(1)), *order)
    positions = running_total(placed, order, "step", "position")
    before = cut_lineage(positions.select(*order, "position"), "positions")
    first = before.groupBy("id").agg((F.min("position") - 1).alias("before"))  # one row per id column
    rank = (F.col("position") - F.col("before")).cast("int")
    ranked = cut_lineage(before.join(F.broadcast(first), "id").select(*order, rank.alias("rank")), "ranks", ("id",))
    return _by_column(ranked, df, ids)


def _by_column(ranked: DataFrame, df: DataFrame, ids: dict[str, str]) -> dict[str, DataFrame]:
    def of(rank: str, column: str) -> DataFrame:
        kind = df.schema[column].dataType
        value = F.col("text") if isinstance(kind, T.StringType) else F.col("number").cast(kind)
        return ranked.where(F.col("id") == rank).select(value.alias(column), F.col("rank").alias(rank))

    return {rank: of(rank, column) for rank, column in ids.items()}


def with_dense_ids(df: DataFrame, ids: dict[str, str]) -> DataFrame:
    """Add one dense id per ``{id column: value column}``. ``df`` is read twice: store it first.

    The ranks are joined back null-safe. Those of up to ``LOOKUP_BYTES`` are looked up where the rows lie, so
    only columns with more values than that cost a shuffle of the rows. Ranks are unique per value, so a value that
    holds a large share of the rows is then a skewed join side that adaptive execution splits.
    """
    out = df
    for rank, ranks in dense_ranks(df, ids).items():
        column, key = ids[rank], f"{rank}_value"
        values = ranks.withColumnRenamed(column, key)
        size = values.agg(F.coalesce(F.sum(ROW_BYTES + F.coalesce(F.octet_length(F.col(key).cast("string")), F.lit(0))), F.lit(0))).first()[0]
        out = out.join(F.broadcast(values) if size <= LOOKUP_BYTES else values, out[column].eqNullSafe(values[key]), "left").drop(key)
    return out
