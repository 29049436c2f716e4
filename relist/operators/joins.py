"""Joins: overlay of live over baseline values, lookup and anti joins, and
coverage of a (brand × marketplace) grid; the containment join is in
``containment``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .containment import contains_join  # noqa: F401  (one of the joins)

def overlay(live: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("brand", "marketplace"),
            value: str = "count", zero_is_missing: bool = False) -> DataFrame:
    """Live value over baseline per key (full outer join).

    ``zero_is_missing=False``: live wins whenever it is not null (a live 0
    stays 0).  ``zero_is_missing=True``: a live 0 counts as missing, then the
    baseline, then 0 (the ranking/total mode)."""
    l = live.select(*keys, F.col(value).alias("_live"))
    b = baseline.select(*keys, F.col(value).alias("_base"))
    j = l.join(b, list(keys), "full")
    if zero_is_missing:
        v = F.coalesce(F.nullif(F.col("_live"), F.lit(0)), F.col("_base"), F.lit(0))
        is_live = F.coalesce(F.col("_live") != 0, F.lit(False))
    else:
        v = F.coalesce(F.col("_live"), F.col("_base"))
        is_live = F.col("_live").isNotNull()
    return j.select(*keys, v.cast("bigint").alias(value), is_live.alias("is_live"),
                    F.col("_base").cast("bigint").alias("baseline"))


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left lookup join; the optimizer broadcasts the dimension if its size allows."""
    return df.join(dim, on, "left")


def without_existing(df: DataFrame, existing: DataFrame | None, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``existing`` (left anti join)."""
    return df if existing is None else df.join(existing, on, "left_anti")


def coverage(obs: DataFrame, brands: DataFrame, marketplaces: Sequence[str],
             brand: str = "brand", marketplace: str = "marketplace", value: str = "count") -> DataFrame:
    """Which (brand, marketplace) probes have an observation.

    The probe grid is each brand exploded over the bounded literal list of
    expected marketplaces (no cross join); observations are reduced to one
    row per pair (partial aggregation) and left-joined on the pair."""
    mk = F.array(*[F.lit(m) for m in marketplaces])
    grid = brands.select(brand).distinct().select(brand, F.explode(mk).alias(marketplace))
    seen = (obs.filter(F.col(marketplace).isin(*marketplaces))
            .groupBy(brand, marketplace)
            .agg(F.max(value).cast("bigint").alias(value), F.lit(True).alias("observed")))
    return (grid.join(seen, [brand, marketplace], "left")
            .select(brand, marketplace, value,
                    F.coalesce(F.col("observed"), F.lit(False)).alias("observed")))
