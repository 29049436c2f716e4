"""Deduplication and latest-per-key operators.

All are partial (map-side) aggregations or ranked windows on the key, so a hot key is
first reduced map-side (partial aggregate / partial window group limit)
before the shuffle: a key holding a third of the rows costs one row per map
task on the wire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import listing_key

LISTING_ATTRS = ["title", "description", "price", "url", "location", "latitude", "longitude",
                 "published_at", "primary_image_url", "is_never_worn"]


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name; columns missing on one side become null and
    numeric types widen (int + bigint → bigint)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def latest_struct(order: Sequence[Column | str], attrs: Sequence[str]) -> Column:
    """max(struct(order..., attrs...)): the attributes of the row with the
    largest ordering tuple, row-consistent and deterministic (ties broken by
    the attribute values themselves; nulls rank lowest)."""
    return F.max(F.struct(*[F.col(o) if isinstance(o, str) else o for o in order],
                          *[F.col(a) for a in attrs]))


def dedupe_listings(listings: DataFrame, seen_col: str = "seen_at",
                    attrs: Sequence[str] = tuple(LISTING_ATTRS), tasks: int = 0) -> DataFrame:
    """Gold listings: one row per ``source_externalId`` with first/last seen
    and the attributes of the latest observation.  They are sorted by key in
    memory; ``tasks`` > 0 says over how many tasks (else the session does)."""
    attrs = [a for a in attrs if a in listings.columns]
    latest = latest_struct([F.col(seen_col).alias("_seen")], attrs).alias("_latest")
    # the key is a function of (source, external_id): group on those two
    # and derive it after the shuffle (narrower sort/shuffle keys)
    if tasks:
        listings = listings.repartition(tasks, "source", "external_id")
    agg = (listings.groupBy("source", "external_id")
           .agg(F.min(seen_col).alias("first_seen_at"), F.max(seen_col).alias("last_seen_at"), latest))
    return agg.select(listing_key(F.col("source"), F.col("external_id")).alias("listing_key"),
                      "source", "external_id", "first_seen_at", "last_seen_at",
                      *[F.col("_latest").getField(a).alias(a) for a in attrs])


def dedupe_stores(stores: DataFrame, seen_col: str = "seen_at") -> DataFrame:
    """One row per (name, city); attributes of the latest observation."""
    attrs = ["address", "postal_code", "phone", "lat", "lng"]
    agg = (stores.groupBy("name", "city")
           .agg(latest_struct([F.col(seen_col).alias("_seen")], attrs).alias("_l"),
                F.max(seen_col).alias("last_seen_at")))
    return agg.select("name", "city", *[F.col("_l").getField(a).alias(a) for a in attrs], "last_seen_at")


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Per key, the values of the row with the largest ``order`` tuple
    (ties → larger values), e.g. latest count per (brand, marketplace)."""
    agg = df.groupBy(*keys).agg(latest_struct(order, values).alias("_l"))
    return agg.select(*keys, *[F.col("_l").getField(c).alias(c) for c in list(order) + list(values)])


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key under ``order`` (row_number = 1).  Spark
    plans this as a window group limit, applied partially before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def first_wins(df: DataFrame, key: str, list_col: Column | str, order: Sequence[Column | str]) -> DataFrame:
    """Rows tagged with the result list they came from (``list_col``, lower
    = earlier list): for each key the row from the earliest list, then the
    earliest position, wins; rows without a key are dropped."""
    cols = [F.col(list_col) if isinstance(list_col, str) else list_col] + \
        [F.col(o) if isinstance(o, str) else o for o in order]
    return latest_per_key(df.filter(F.col(key).isNotNull()), [key], cols)


def merge_first_wins(results: Sequence[DataFrame], key: str, order: Sequence[Column | str]) -> DataFrame:
    """Merge overlapping result lists given as separate DataFrames (see
    :func:`first_wins`)."""
    tagged = [d.withColumn("_list", F.lit(i)) for i, d in enumerate(results)]
    return first_wins(union_by_name(*tagged), key, "_list", order)


def distinct_pairs(*dfs: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Union of several lists → distinct tuples of ``cols``."""
    return union_by_name(*[d.select(*cols) for d in dfs]).dropDuplicates(list(cols))
