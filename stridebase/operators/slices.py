"""Global order over many values without one task sorting them all.

Values are range-partitioned into slices. Within a slice they are ordered locally, and
a slice starts where the ones before it end, so running counts need no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stridebase.sources.tables import cut_lineage


def place_in_slices(values: DataFrame, *columns: str) -> DataFrame:
    """Add ``slice``, ascending with ``columns`` and NULL first.

    The result is written out: whatever reads it twice must see the same cut, and range
    boundaries are sampled anew whenever a plan is run again.
    """
    slices = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = values.repartitionByRange(slices, *map(F.asc_nulls_first, columns))
    return cut_lineage(placed.withColumn("slice", F.spark_partition_id()), f"slices-{columns[0]}")


def running_total(placed: DataFrame, columns: tuple[str, ...], weight: str, name: str) -> DataFrame:
    """Add the sum of ``weight`` over all values up to and including this one.

    There is one start per slice, so at most spark.sql.shuffle.partitions of them: few
    enough for a window without partitions and for a broadcast.
    """
    before = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("slice")
        .agg(F.sum(weight).alias("size"))
        .select("slice", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    within = (
        Window.partitionBy("slice")
        .orderBy(*map(F.asc_nulls_first, columns))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        placed.join(F.broadcast(starts), "slice")
        .withColumn(name, F.col("start") + F.sum(weight).over(within))
        .drop("slice", "start")
    )
