"""Test-data adapter: the driver's star-schema tables re-read as marketplace
data (listings, catalog, count observations, stores, postal rows, gazetteer).

Everything is derived by Spark from the given tables, so every query's work
grows with the scale factor.  The same derivations are written in DuckDB SQL
in :mod:`relist.plans.oracle` for the correctness gate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare

# Fixture vocabulary (own choice): a garment word per part, so the category
# and condition rules see French listing titles/descriptions.
GARMENTS = ["robe", "jean slim", "veste", "t-shirt", "basket", "lot de 3 bodies", "body bébé",
            "pyjama", "sac", "legging sport", "pull", "manteau"]
SOURCES6 = ["leboncoin", "vinted", "ebay", "label_emmaus", "vestiaire", "facebook"]
CONDITION_NOTES = {("N", "O"): " neuf avec étiquette", ("N", "F"): " jamais porté",
                   ("R", "O"): " très bon état", ("R", "F"): " bon état",
                   ("A", "O"): " petits défauts", ("A", "F"): " quelques traces"}
LISTINGS_PER_TASK = 200_000
MANY_PARTS = 500_000
MARKETPLACES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def _pick(values, idx):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def listing_tasks(spark: SparkSession, d: str) -> int:
    """Tasks that rows as wide as listings are dealt to, by rows (from the footers)."""
    return max(spark.sparkContext.defaultParallelism, table(spark, d, "lineitem").count() // LISTINGS_PER_TASK + 1)


def raw_listings(spark: SparkSession, d: str) -> DataFrame:
    """Landed listing rows (JSON-like, strings) – one per lineitem."""
    # the orders come first: the partitioning by order key serves that join
    # and spreads the rows of a file with a single row group over all cores.
    # A line is a few numbers here and half a kilobyte of text afterwards, so
    # tasks are dealt by rows, not by the bytes they read
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                            "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate")
    tasks = listing_tasks(spark, d)
    li = li.repartition(tasks, "l_orderkey")
    pa = table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    od = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    na = table(spark, d, "nation").select("n_nationkey", "n_name")   # 25 rows by spec
    # customers meet the orders, not the lines: the many rows cross the network once less
    od = (od.join(cu, od.o_custkey == cu.c_custkey).join(F.broadcast(na), cu.c_nationkey == na.n_nationkey)
          .select("o_orderkey", "o_custkey", "o_orderdate", "n_name"))
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    if pa.count() > MANY_PARTS:     # too many to broadcast: the lines move to them, dealt by rows again
        j = j.repartition(tasks, "l_partkey")
    j = j.join(pa, j.l_partkey == pa.p_partkey)
    src = _pick(SOURCES6, F.col("l_suppkey") % 6)
    num_id = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string")
    # URL slug from the line's own part key: the URL (and the id derived
    # from it) depends on lineitem columns only, so the id filter of the
    # cleaning step is evaluated right after the lineitem scan
    slug = F.concat(F.lit("article-"), F.col("l_partkey").cast("string"))
    url = (F.when(src == "leboncoin", F.concat(F.lit("https://www.leboncoin.fr/ad/vetements/"), num_id))
           .when(src == "vinted", F.concat(F.lit("https://www.vinted.fr/items/"), num_id, F.lit("-"), slug))
           .when(src == "ebay", F.concat(F.lit("https://www.ebay.fr/itm/"), num_id))
           .when(src == "label_emmaus", F.concat(F.lit("https://www.label-emmaus.co/fr/"), slug, F.lit("-"), num_id, F.lit("/")))
           .when(src == "vestiaire", F.concat(F.lit("https://fr.vestiairecollective.com/"), slug, F.lit("-"), num_id, F.lit(".shtml")))
           .otherwise(F.concat(F.lit("https://www.facebook.com/marketplace/item/"), num_id)))
    ext = F.when(F.col("l_linenumber") == 1, F.lit("")).otherwise(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")))
    note = F.lit("")
    for (rf, ls), txt in CONDITION_NOTES.items():
        note = F.when((F.col("l_returnflag") == rf) & (F.col("l_linestatus") == ls), F.lit(txt)).otherwise(note)
    code = F.lpad(F.col("o_custkey").cast("string"), 5, "0")
    loc = (F.when(F.col("o_custkey") % 4 == 0, F.col("n_name"))
           .when(F.col("o_custkey") % 4 == 1, F.concat(F.col("n_name"), F.lit(", France")))
           .otherwise(F.concat(F.col("n_name"), F.lit(" ("), code, F.lit(")"))))
    pub = (F.when(F.col("l_linenumber") == 6, F.lit(""))
           .when(F.col("l_orderkey") % 3 == 0, F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"))
           .when(F.col("l_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")))
    return j.select(
        src.alias("source"), ext.alias("external_id"),
        F.concat(_pick(GARMENTS, F.col("p_partkey") % 12), F.lit(" "), F.col("p_name")).alias("title"),
        F.concat(F.lower(F.col("p_type")), note).alias("description"),
        F.col("l_quantity").cast("double").alias("price"), url.alias("url"), loc.alias("location"),
        F.lit(None).cast("double").alias("latitude"), F.lit(None).cast("double").alias("longitude"),
        pub.alias("published_at"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("scraped_at"),
        F.concat(F.lit("https://img.example.org/p/"), F.col("p_partkey").cast("string"), F.lit(".JPEG")).alias("primary_image_url"))


def listings(spark: SparkSession, d: str) -> DataFrame:
    """Silver listings (cleaned, ids derived) from the adapter rows."""
    from ..operators.cleaning import clean_listings
    return clean_listings(raw_listings(spark, d))


def raw_catalog(spark: SparkSession, d: str) -> DataFrame:
    """Manual catalog export rows (CSV-like strings) – one per part."""
    pa = table(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    slug = F.translate(F.col("p_name"), " ", "-")
    base = F.lit("https://shop.example.com/")
    k = (F.col("p_partkey") % 500).cast("string")
    link = (F.when(F.col("p_partkey") % 10 == 0, F.concat(base, slug, F.lit(".html")))
            .when(F.col("p_partkey") % 10 == 1, F.concat(base, slug, F.lit("_P"), k))
            .otherwise(F.concat(base, slug, F.lit("_P"), k, F.lit("C"), (F.col("p_size") % 3).cast("string"))))
    price = F.concat((F.floor("p_retailprice") % 40 + 5).cast("string"), F.lit(","),
                     F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"), F.lit(" €"))
    return pa.select(
        link.alias("item_page_link"), price.alias("price_1"),
        F.when(F.col("p_partkey") % 97 == 0, F.lit("")).otherwise(F.col("p_name")).alias("name"),
        F.col("p_type").alias("breadcrumbs"),
        F.split(F.col("p_name"), " ").getItem(0).alias("Available_Colors"),
        F.concat((F.col("p_size") % 5).cast("string"), F.lit(".5/5")).alias("rating"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp")
         + F.make_interval(days=(F.col("p_partkey") % 7).cast("int"))).alias("_ingested_at"))


def products(spark: SparkSession, d: str) -> DataFrame:
    from ..operators.cleaning import CATALOG_A_MAPPING, clean_manual_catalog
    return clean_manual_catalog(raw_catalog(spark, d), CATALOG_A_MAPPING, "bebe")


def raw_counts(spark: SparkSession, d: str) -> DataFrame:
    """Count observations: brand = user bucket, marketplace = event type."""
    ev = table(spark, d, "events").select("user_id", "event_type", "ts", "value", "event_id")
    ts = (F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
          .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")))
    return ev.select(
        F.concat(F.lit(" Brand#"), ((F.col("user_id") % 25) + 1).cast("string")).alias("brand"),
        F.upper(F.col("event_type")).alias("marketplace"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None))
         .otherwise(F.round(F.col("value") * 100).cast("bigint")).alias("count"),
        ts.alias("timestamp"))


def baseline_counts(spark: SparkSession, d: str) -> DataFrame:
    """Static baseline per (brand, marketplace) aggregated from ``part``."""
    pa = table(spark, d, "part").select("p_brand", "p_size", "p_partkey")
    return (pa.select(F.col("p_brand").alias("brand"),
                      _pick(MARKETPLACES, F.col("p_size") % 5).alias("marketplace"), "p_partkey")
            .groupBy("brand", "marketplace").agg(F.count(F.lit(1)).alias("count")))


def stores(spark: SparkSession, d: str) -> DataFrame:
    """Stores = suppliers with coordinates by arithmetic on the key."""
    su = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return su.select(F.col("s_name").alias("name"),
                     F.concat(F.lit("CITY_"), F.col("s_nationkey").cast("string")).alias("city"),
                     (F.lit(42.0) + (F.col("s_suppkey") * 37 % 900) / 100.0).alias("lat"),
                     (F.lit(-4.5) + (F.col("s_suppkey") * 53 % 1200) / 100.0).alias("lng"))


def customer_points(spark: SparkSession, d: str) -> DataFrame:
    cu = table(spark, d, "customer").select("c_custkey")
    return cu.select("c_custkey",
                     (F.lit(42.0) + (F.col("c_custkey") * 17 % 900) / 100.0).alias("lat"),
                     (F.lit(-4.5) + (F.col("c_custkey") * 29 % 1200) / 100.0).alias("lng"))


def postal_rows(spark: SparkSession, d: str) -> DataFrame:
    """Postal file rows (all strings, several per code) from ``orders``."""
    od = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    # every fifth customer's code is written with 6 digits: it never matches
    # (an unknown postal code → gazetteer fallback); no row is dropped
    width = F.when(F.col("o_custkey") % 5 == 0, F.lit(6)).otherwise(F.lit(5))
    return od.select(
        F.lpad(F.col("o_custkey").cast("string"), width, "0").alias("code_postal"),
        (F.lit(43.0) + (F.col("o_orderkey") % 700) / 100.0).cast("string").alias("latitude"),
        (F.lit(-1.0) + (F.col("o_orderkey") % 500) / 100.0).cast("string").alias("longitude"))


def gazetteer(spark: SparkSession, d: str) -> DataFrame:
    """Ordered (name, lat, lon) list from ``nation`` (25 rows by spec)."""
    na = table(spark, d, "nation").select("n_nationkey", "n_name")
    return na.select(F.lower(F.col("n_name")).alias("name"),
                     (F.lit(44.0) + F.col("n_nationkey") / 5.0).alias("lat"),
                     (F.lit(0.5) + F.col("n_nationkey") / 4.0).alias("lon"),
                     F.col("n_nationkey").alias("ord"))
