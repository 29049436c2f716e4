"""Silver-layer cleaning: landed rows → typed, filtered records.

All functions are DataFrame → DataFrame built from column expressions, so
filters and projections stay pushable to the scan and inside codegen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import ids
from ..functions.clean import (clean_string, coalesce_existing, mixed_timestamp, parse_price,
                               parse_rating, run_timestamp, safe_double, safe_long)
from ..schemas import CLEAN_COUNTS


def _col_or_null(df: DataFrame, name: str, typ: str = "string"):
    return F.col(name) if name in df.columns else F.lit(None).cast(typ)


def clean_listings(raw: DataFrame, sources=C.LISTING_SOURCES) -> DataFrame:
    """Landed listing rows → silver listings (without coordinates).

    Allow-listed sources only; blank ids are derived from the URL; rows
    without an id are dropped; strings trimmed; price safely cast;
    ``is_never_worn`` from the text; ``published_at`` normalised from
    ISO / epoch text to a timestamp; ``seen_at`` = scrape time, else ingest
    time (the observation time used for first/last seen)."""
    df = raw.filter(F.col("source").isin(*sources))
    eid = ids.external_id(F.col("source"), F.col("external_id"), F.col("url"))
    seen = F.coalesce(mixed_timestamp(_col_or_null(raw, "scraped_at")),
                      _col_or_null(raw, "_ingested_at", "timestamp"),
                      _col_or_null(raw, "seen_at", "timestamp"))
    title = clean_string(F.col("title"))
    desc = clean_string(F.col("description"))
    return (df.select(
                F.col("source"),
                eid.alias("external_id"),
                title.alias("title"),
                desc.alias("description"),
                safe_double(F.col("price")).alias("price"),
                F.col("url").cast("string").alias("url"),
                clean_string(F.col("location")).alias("location"),
                safe_double(_col_or_null(raw, "latitude", "double")).alias("latitude"),
                safe_double(_col_or_null(raw, "longitude", "double")).alias("longitude"),
                mixed_timestamp(F.col("published_at")).alias("published_at"),
                clean_string(_col_or_null(raw, "primary_image_url")).alias("primary_image_url"),
                C.never_worn(title, desc).alias("is_never_worn"),
                seen.alias("seen_at"))
            .filter(F.length(F.trim(F.col("external_id"))) > 0))   # null or blank id → dropped


def clean_manual_listings(raw: DataFrame, sources=C.MANUAL_SOURCES) -> DataFrame:
    """Manually exported CSV listings (columns drift per file) → silver."""
    source = ids.source_from_path(_col_or_null(raw, "_source_file"))
    url = coalesce_existing(raw, ["item_page_link", "item_page_title"], "")
    title = F.trim(coalesce_existing(raw, ["product_name", "item_page_title", "name"], ""))
    desc = F.trim(coalesce_existing(raw, ["description", "data", "product_name"], ""))
    price = parse_price(coalesce_existing(raw, ["price_1", "price", "price1"], "0"))
    image = F.trim(coalesce_existing(raw, ["main_image", "image"], ""))
    location = F.trim(coalesce_existing(raw, ["data2", "seller_location", "data3"], ""))
    eid = ids.manual_external_id(source, coalesce_existing(raw, ["sku"]), url)
    ingested = _col_or_null(raw, "_ingested_at", "timestamp")
    return (raw.select(source.alias("source"), eid.alias("external_id"), title.alias("title"),
                       desc.alias("description"), price.alias("price"), url.alias("url"),
                       location.alias("location"),
                       F.lit(None).cast("double").alias("latitude"),
                       F.lit(None).cast("double").alias("longitude"),
                       ingested.alias("published_at"), image.alias("primary_image_url"),
                       F.lit(False).alias("is_never_worn"), ingested.alias("seen_at"))
            .filter(F.col("source").isin(*sources))
            .filter(F.length(F.trim(F.col("external_id"))) > 0))


def empty_counts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CLEAN_COUNTS)


def clean_counts(raw: DataFrame) -> DataFrame:
    """Count observations → (brand, marketplace, count, run_ts).

    Rows without brand/marketplace/count are skipped (also after the safe
    cast); the run time accepts several ISO shapes, else the ingest time.
    If the landed data has no count columns at all, an empty typed frame."""
    if "brand" not in raw.columns or "marketplace" not in raw.columns or "count" not in raw.columns:
        return empty_counts(raw.sparkSession)
    fallback = _col_or_null(raw, "_ingested_at", "timestamp")
    return (raw.filter(F.col("brand").isNotNull() & F.col("marketplace").isNotNull()
                       & F.col("count").isNotNull())
            .select(F.trim(F.col("brand").cast("string")).alias("brand"),
                    F.lower(F.trim(F.col("marketplace").cast("string"))).alias("marketplace"),
                    safe_long(F.col("count")).alias("count"),
                    run_timestamp(F.col("timestamp").cast("string"), fallback).alias("run_ts"))
            .filter(F.col("count").isNotNull()))


PRODUCT_COLUMNS = ["product_uid", "product_code", "title", "universe", "universe_key", "category",
                   "color", "price", "list_price", "currency", "product_url", "primary_image_url",
                   "rating", "total_reviews", "scraped_at"]


def clean_catalog(raw: DataFrame) -> DataFrame:
    """Collected catalog rows → typed products (one row per observation)."""
    return (raw.filter(F.col("product_uid").isNotNull()
                       & (F.trim(F.col("product_uid").cast("string")) != ""))
            .select(F.trim(F.col("product_uid").cast("string")).alias("product_uid"),
                    clean_string(F.col("product_code")).alias("product_code"),
                    clean_string(F.col("title")).alias("title"),
                    clean_string(F.col("universe")).alias("universe"),
                    clean_string(F.col("universe_key")).alias("universe_key"),
                    clean_string(F.col("category")).alias("category"),
                    clean_string(F.col("color")).alias("color"),
                    safe_double(F.col("price")).alias("price"),
                    safe_double(F.col("list_price")).alias("list_price"),
                    F.coalesce(F.col("currency").cast("string"), F.lit("EUR")).alias("currency"),
                    clean_string(F.col("product_url")).alias("product_url"),
                    clean_string(F.col("primary_image_url")).alias("primary_image_url"),
                    safe_double(F.col("rating")).alias("rating"),
                    F.coalesce(safe_long(F.col("total_reviews")), F.lit(0).cast("bigint")).alias("total_reviews"),
                    mixed_timestamp(F.col("scraped_at")).alias("scraped_at")))


# Column-name candidates of the two manual catalog exports.
CATALOG_A_MAPPING = {
    "price": ["price_1", "product4_price", "price"], "image": ["image_1", "image"],
    "rating": ["rating", "product1_rating"], "title": ["name", "data"],
    "category": ["breadcrumbs_1", "breadcrumbs"], "color": ["Available_Colors"],
}
CATALOG_B_MAPPING = {
    "price": ["price_1", "Product_4_Price", "Product_2_Price", "price"], "image": ["image_1", "image"],
    "rating": ["rating", "product_4_rating", "product_1_rating"],
    "title": ["name", "data", "Product_2_Name"], "category": ["breadcrumbs", "breadcrumb"],
    "color": ["current_color"],
}


def clean_manual_catalog(raw: DataFrame, mapping: dict, universe: str,
                         literal_fallback: bool = False) -> DataFrame:
    """Manual catalog CSV → product rows (uid from URL, price/rating from text)."""
    url = F.trim(coalesce_existing(raw, ["item_page_link"], ""))
    uid = ids.product_uid(url, literal_fallback)
    price = parse_price(coalesce_existing(raw, mapping["price"], "0"))
    ingested = _col_or_null(raw, "_ingested_at", "timestamp")
    return (raw.select(uid.alias("product_uid"), uid.alias("product_code"),
                       F.trim(coalesce_existing(raw, mapping["title"], "")).alias("title"),
                       F.lit(universe).alias("universe"), F.lit(universe).alias("universe_key"),
                       F.trim(coalesce_existing(raw, mapping["category"], "")).alias("category"),
                       F.trim(coalesce_existing(raw, mapping["color"], "")).alias("color"),
                       price.alias("price"), price.alias("list_price"), F.lit("EUR").alias("currency"),
                       url.alias("product_url"),
                       F.trim(coalesce_existing(raw, mapping["image"], "")).alias("primary_image_url"),
                       parse_rating(coalesce_existing(raw, mapping["rating"], "0")).alias("rating"),
                       F.lit(0).cast("bigint").alias("total_reviews"),
                       ingested.alias("scraped_at"))
            .filter(F.length(F.trim(F.coalesce(F.col("product_uid"), F.lit("")))) > 0))


def clean_stores(raw: DataFrame) -> DataFrame:
    return raw.select(*[clean_string(F.col(c)).alias(c) for c in
                        ("name", "city", "address", "postal_code", "phone")],
                      safe_double(F.col("lat")).alias("lat"), safe_double(F.col("lng")).alias("lng"),
                      _col_or_null(raw, "_ingested_at", "timestamp").alias("seen_at"))
