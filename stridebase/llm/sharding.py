"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals.

Rows are range-partitioned into pieces in the wanted order. Each piece is summed, the
sums of the pieces before it give where it starts, and a running sum inside the piece
gives every row its global byte position. A row belongs to the shard whose equal share
of all bytes holds the row's middle, so shards are contiguous and none is further from its
target than half a row at either end. No task sees more than one piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stridebase.llm.tables import cut_lineage, fresh_name, partitions


def utf8_size(text: Column) -> Column:
    """Bytes of the text in UTF-8; none for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def shard_by_bytes(rows: DataFrame, order_by: Sequence[str], size: str, shards: int) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards`` - 1), ``slot`` (from 0 without gaps in each
    shard) and ``first_byte`` (position among all bytes).

    ``size`` names a column of sizes; NULL or negative counts as 0. Order: ``order_by``,
    NULL first, and rows that tie there in any order, so equal rows are interchangeable.
    If all sizes are 0 everything is in shard 0; an empty table gives no rows; shards
    stay empty if there are fewer rows than shards or one row is larger than several
    shares. Existing columns named ``shard``, ``slot`` or ``first_byte`` are replaced;
    all others are kept as they are.

    All columns are carried through one range exchange: select what is needed first, and
    store what is costly to compute, because the range bounds are sampled in a pass of their own.
    """
    rows = rows.drop("shard", "slot", "first_byte")
    tie, piece, weight, number, before, ahead, total = (
        fresh_name(rows, f"_{n}") for n in ("tie", "piece", "weight", "number", "before", "ahead", "total")
    )
    keys = [F.asc_nulls_first(c) for c in order_by]
    placed = cut_lineage(
        # the row number keeps rows that are equal in every key from meeting in one piece
        rows.withColumn(tie, F.monotonically_increasing_id())
        .withColumn(weight, F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long"))
        .repartitionByRange(partitions(rows.sparkSession), *keys, F.col(tie))
        .withColumn(piece, F.spark_partition_id()),
        "pieces",
    )

    # One row per piece: bounded by the number of partitions, not by the data.
    earlier = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(piece).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        placed.groupBy(piece)
        .agg(F.sum(weight).alias(before), F.count(F.lit(1)).alias(ahead))
        .select(
            piece,
            F.sum(before).over(everything).alias(total),
            F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(before),
            F.coalesce(F.sum(ahead).over(earlier), F.lit(0)).alias(ahead),
        )
    )
    so_far = Window.partitionBy(piece).orderBy(*keys, tie).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = 2 * F.col("first_byte") + F.col(weight)
    share = F.floor(middle * shards / F.greatest(2 * F.col(total), F.lit(1)).cast("decimal(38,0)"))
    numbered = (
        placed.join(F.broadcast(starts), piece)
        .withColumn("first_byte", F.col(before) + F.sum(weight).over(so_far) - F.col(weight))
        .withColumn(number, F.col(ahead) + F.count(F.lit(1)).over(so_far) - 1)
        .withColumn("shard", F.least(share, F.lit(shards - 1)).cast("int"))
    )
    first = fresh_name(rows, "_first")
    firsts = numbered.groupBy("shard").agg(F.min(number).alias(first))  # one row per shard
    return (
        numbered.join(F.broadcast(firsts), "shard")
        .withColumn("slot", F.col(number) - F.col(first))
        .select(*rows.columns, "shard", "slot", "first_byte")
    )
