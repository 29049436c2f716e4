"""Brand × marketplace count analytics: latest counts, totals, ranking,
pivot matrix and subsets.

No window is without a key: ranks come from counts per range (``ranked``),
so the number of brands has no limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import ordinal
from .dedupe import latest_by
from .joins import overlay
from .metrics import price_range

TOTAL_MARKETPLACES = ("leboncoin", "vinted")


def latest_counts(counts: DataFrame) -> DataFrame:
    """Latest count per (brand, marketplace); a tie on run time → larger count."""
    return latest_by(counts, ["brand", "marketplace"], ["run_ts"], ["count"]) \
        .withColumnRenamed("run_ts", "last_run_at")


def latest_by_marketplace(counts: DataFrame, brand: str | None = None) -> DataFrame:
    """Latest count per marketplace ignoring brand (optionally one brand)."""
    df = counts if brand is None else counts.filter(F.col("brand") == brand)
    return latest_by(df, ["marketplace"], ["run_ts"], ["count", "brand"]) \
        .withColumnRenamed("run_ts", "last_run_at")


def brand_totals(live: DataFrame, baseline: DataFrame,
                 marketplaces: Sequence[str] = TOTAL_MARKETPLACES) -> DataFrame:
    """Per brand: sum over ``marketplaces`` of live-else-baseline counts
    (a live 0 counts as missing)."""
    o = overlay(live, baseline, zero_is_missing=True)
    return (o.filter(F.col("marketplace").isin(*marketplaces))
            .groupBy("brand").agg(F.sum("count").cast("bigint").alias("total")))


HEAD = 2


def ranked(rows: DataFrame, value: str, tie: str, name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 by ``value`` descending, then ``tie``,
    without a window over the whole table.

    Ranges of the value (``metrics.price_range``) lie in spans of 512, of
    which there are a thousand at most, and the rows of one value under the
    heads of their ties.  A row's place is what stands in higher spans (one small
    array of counts), in higher ranges of its span, under higher values and
    earlier heads of its range, and before it under its own head.  Every window has one of these
    as its key; only the last is over rows, all others are over counts."""
    parts = rows.withColumns({"_v": F.col(value), "_r": F.coalesce(price_range(F.col(value).cast("double")), F.lit(-(1 << 30))),
                              "_h": F.coalesce(F.substring(F.col(tie), 1, HEAD), F.lit(""))})

    def before(key: str, order: list[Column], n: str) -> Column:
        return F.coalesce(F.sum(n).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    heads = parts.groupBy("_r", "_v", "_h").agg(F.count(F.lit(1)).alias("_n"))
    heads = heads.withColumns({"_ahead": before("_r", [F.col("_v").desc_nulls_last(), F.col("_h")], "_n"), "_s": F.shiftright("_r", 9)})
    ranges = heads.groupBy("_s", "_r").agg(F.sum("_n").alias("_c"))
    spans = ranges.groupBy("_s").agg(F.sum("_c").alias("_c"))
    above = spans.withColumn("_all", spans.agg(F.collect_list(F.struct("_s", "_c"))).scalar()).select(
        "_s", F.aggregate(F.filter("_all", lambda x: x["_s"] > F.col("_s")), F.lit(0).cast("long"), lambda n, x: n + x["_c"]).alias("_above"))
    ranges = ranges.withColumn("_higher", before("_s", [F.col("_r").desc()], "_c")).join(above, "_s")
    offsets = heads.join(ranges.select("_r", (F.col("_higher") + F.col("_above")).alias("_offset")), "_r").select(
        "_r", "_v", "_h", (F.col("_ahead") + F.col("_offset")).alias("_offset"))
    own = Window.partitionBy("_r", "_v", "_h").orderBy(F.col(tie))
    place = (F.row_number().over(own) + F.col("_offset")).cast("int")
    same = F.col("a._r").eqNullSafe(F.col("b._r")) & F.col("a._v").eqNullSafe(F.col("b._v")) & F.col("a._h").eqNullSafe(F.col("b._h"))
    met = parts.alias("a").join(offsets.alias("b"), same).select("a.*", "b._offset")
    return met.withColumn(name, place).select(*rows.columns, name)


def brand_rank(totals: DataFrame, home: str | None = None) -> DataFrame:
    """Stable ranking by total desc (ties by brand), with 'rank / n' label and
    gap to the leader in percent; any number of brands."""
    whole = totals.agg(F.struct(F.count(F.lit(1)).alias("n"), F.max("total").alias("leader"))).scalar()
    r = (ranked(totals, "total", "brand").withColumn("_all", whole)
         .withColumns({"n": F.col("_all.n"), "leader_total": F.col("_all.leader")}).drop("_all"))
    r = r.withColumn("rank_label", F.concat(ordinal(F.col("rank")), F.lit(" / "), F.col("n").cast("string")))
    r = r.withColumn("gap_to_leader_pct", F.when(F.col("leader_total") > 0, F.bround(
        (F.col("leader_total") - F.col("total")) / F.col("leader_total") * 100, 0)).otherwise(F.lit(0.0)))
    if home is not None:
        r = r.withColumn("is_home", F.col("brand") == F.lit(home))
    return r.drop("leader_total")


def brand_matrix(values: DataFrame, marketplaces: Sequence[str]) -> DataFrame:
    """Brand × marketplace matrix (explicit pivot values: no extra pass to
    discover them, stable output schema)."""
    return (values.groupBy("brand").pivot("marketplace", list(marketplaces))
            .agg(F.max("count")))


def top_brands(baseline: DataFrame, k: int = 5, home: str | None = None,
               marketplaces: Sequence[str] = TOTAL_MARKETPLACES) -> DataFrame:
    """Top-k brands by baseline total over ``marketplaces`` plus the home brand."""
    t = (baseline.filter(F.col("marketplace").isin(*marketplaces))
         .groupBy("brand").agg(F.sum("count").cast("bigint").alias("baseline_total")))
    r = ranked(t, "baseline_total", "brand", "pos")
    cond = F.col("pos") <= k
    if home is not None:
        cond = cond | (F.col("brand") == F.lit(home))
    return r.filter(cond)


def marketplaces_with_data(values: DataFrame) -> DataFrame:
    """Marketplaces where at least one brand has a non-zero value."""
    return (values.groupBy("marketplace")
            .agg(F.max(F.coalesce(F.col("count") != 0, F.lit(False))).alias("has_data"))
            .filter(F.col("has_data")).select("marketplace"))
