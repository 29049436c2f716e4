"""Flagship query: landed listing rows → silver → gold dedupe → category stats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.dedupe import dedupe_listings
from ..operators.metrics import category_stats
from . import adapter as A


def flagship(spark: SparkSession, d: str) -> DataFrame:
    return category_stats(dedupe_listings(A.listings(spark, d), tasks=A.listing_tasks(spark, d)))
