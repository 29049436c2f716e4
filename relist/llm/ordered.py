"""Places of rows in a sorted table, without a window over a whole group.

``lay_out`` deals the rows by ranges of their order, sorts every partition
and writes it with one running number per row.  ``starts`` then knows, per
group and partition, where the group begins in that partition and how many
of its rows lie in earlier ones, so a place is a difference of two numbers.
A group of any size is spread over as many partitions as its rows need; the
only windows are over one row per group and partition (``starts``) or within
one partition (``running``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise


def lay_out(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` written in ``order`` (which begins with the group), with
    ``seq`` (ascending in that order) and ``part``.  ``rows`` is read twice,
    as ranges are sampled first."""
    laid = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("seq", F.monotonically_increasing_id()))
    return materialise(laid, name).withColumn("part", F.shiftright("seq", 33).cast("int"))


def starts(laid: DataFrame, group: str, name: str) -> DataFrame:
    """(group, part, first, before, n): the first ``seq`` of a group in a
    partition, its rows in earlier ones and all its rows."""
    here = laid.groupBy(group, "part").agg(F.min("seq").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return materialise(here.select(group, "part", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
                                   F.sum("rows").over(whole).alias("n")), name)


def place(laid: DataFrame, begun: DataFrame, group: str) -> DataFrame:
    """``laid`` with ``pos``, the place within the group from 0, and whatever
    else ``begun`` (from ``starts``) tells of the group.  The key of the join
    is a group within a partition, so no key has more rows than one has."""
    found = laid.join(broadcast_if_small(begun, 120), [group, "part"])
    return found.withColumn("pos", F.col("seq") - F.col("first") + F.col("before")).drop("seq", "part", "first", "before")


def running(laid: DataFrame, sums: list[str], name: str) -> DataFrame:
    """``laid`` with ``pos`` over the whole table and, for each long column of
    ``sums``, ``<name>_before``: its sum over the rows before."""
    here = laid.groupBy("part").agg(F.min("seq").alias("first"), F.count("*").alias("rows"), *[F.sum(c).alias(f"{c}_sum") for c in sums])
    # one row per partition: as many as the write had tasks
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = here.select("part", "first", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_offset")
                                             for c in ("rows", *[f"{c}_sum" for c in sums])])
    offsets = materialise(offsets, name)
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    found = laid.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{c}_before") for c in sums])
    found = found.join(broadcast_if_small(offsets, 80), "part")
    for c in sums:
        found = found.withColumn(f"{c}_before", F.col(f"{c}_before") + F.col(f"{c}_sum_offset"))
    found = found.withColumn("pos", F.col("seq") - F.col("first") + F.col("rows_offset"))
    return found.drop("seq", "part", "first", "rows_offset", *[f"{c}_sum_offset" for c in sums])
