"""Exact distinct counts over any union of groups, from stored bitmaps.

A value is a number from 1 on, best a dense id. The numbers of a group are bits of bitmaps of 32,768 bits,
one row per group and bitmap. The distinct values of several groups are the bits that are set in
any of them: bitmaps are merged with OR, a bitmap at a time, and counted. No value is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def construct(rows: DataFrame, number: str, *groups: str) -> DataFrame:
    """``groups``, ``bucket``, ``bitmap``. NULL numbers set no bit."""
    present = rows.where(F.col(number).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(number).cast("long")).alias("bucket")
    position = F.bitmap_bit_position(F.col(number).cast("long"))
    return present.groupBy(*groups, bucket).agg(F.bitmap_construct_agg(position).alias("bitmap"))


def merged(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """The bitmaps of coarser groups."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counted(bitmaps: DataFrame, *groups: str, name: str = "distinct_values") -> DataFrame:
    """Set bits per group; merge first if a group and bucket occur in several rows."""
    return bitmaps.groupBy(*groups).agg(total_bits().alias(name))


def total_bits() -> Column:
    return F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0))
