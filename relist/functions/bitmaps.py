"""Exact distinct counts by bitmaps over a dictionary.

The values of a column get dense numbers (per partition of their distinct
rows), a set of them is one bitmap per bucket of 32,768 numbers, and sets are
merged by OR.  So one dictionary serves any grouping and any roll-up, several
distinct counts never multiply the input, and what a task holds is a bitmap
of 4 KB per group and bucket, not the values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dictionary(df: DataFrame, value: str) -> DataFrame:
    """(value, id) of the distinct non-null values."""
    some = df.where(F.col(value).isNotNull()).select(value).distinct()
    return some.withColumn("id", F.monotonically_increasing_id())


def bitmaps(ids: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, bucket, bits) of ``ids`` (groups, id)."""
    bucket = F.bitmap_bucket_number("id").alias("bucket")
    return ids.groupBy(*groups, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merged(sets: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The sets rolled up to fewer groups: unions, bucket by bucket."""
    return sets.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(sets: DataFrame, groups: Sequence[str] = (), name: str = "n") -> DataFrame:
    """Members per group; a grand total of no set at all is 0."""
    sized = sets.select(*groups, F.bitmap_count("bits").alias("_m"))
    return sized.groupBy(*groups).agg(F.coalesce(F.sum("_m"), F.lit(0)).alias(name))


def distinct_count(df: DataFrame, value: str) -> Column:
    """Number of distinct non-null values, as a scalar subquery."""
    return counted(bitmaps(dictionary(df, value).select("id"))).scalar()
