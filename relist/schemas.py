"""Record contracts (StructTypes) shared by the operators."""

from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampType)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# One scraped listing as landed by the collectors.
LISTING = _s(
    ("source", StringType()), ("external_id", StringType()), ("title", StringType()),
    ("description", StringType()), ("price", DoubleType()), ("url", StringType()),
    ("location", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("published_at", StringType()), ("scraped_at", StringType()),
    ("primary_image_url", StringType()), ("seller_id", StringType()),
)

# Cleaned listing (silver) – the columns every metric reads.
SILVER_LISTING = _s(
    ("source", StringType()), ("external_id", StringType()), ("title", StringType()),
    ("description", StringType()), ("price", DoubleType()), ("url", StringType()),
    ("location", StringType()), ("latitude", DoubleType()), ("longitude", DoubleType()),
    ("published_at", TimestampType()), ("primary_image_url", StringType()),
    ("is_never_worn", BooleanType()), ("seen_at", TimestampType()),
)

# Catalog product.
PRODUCT = _s(
    ("product_code", StringType()), ("product_uid", StringType()), ("title", StringType()),
    ("universe", StringType()), ("universe_key", StringType()), ("category", StringType()),
    ("color", StringType()), ("price", DoubleType()), ("list_price", DoubleType()),
    ("currency", StringType()), ("product_url", StringType()),
    ("primary_image_url", StringType()), ("rating", StringType()),
    ("total_reviews", LongType()), ("scraped_at", StringType()),
)

STORE = _s(
    ("name", StringType()), ("city", StringType()), ("address", StringType()),
    ("postal_code", StringType()), ("phone", StringType()), ("lat", DoubleType()),
    ("lng", DoubleType()),
)

COUNT_OBS = _s(
    ("brand", StringType()), ("marketplace", StringType()), ("count", LongType()),
    ("timestamp", StringType()), ("category", StringType()),
)

CLEAN_COUNTS = _s(
    ("brand", StringType()), ("marketplace", StringType()), ("count", LongType()),
    ("run_ts", TimestampType()),
)

CHUNK = StructType([
    StructField("source", StringType(), False),
    StructField("chunk_index", IntegerType(), False),
    StructField("content", StringType(), False),
])
