"""Medallion refresh: landing files → bronze (incremental streams) → silver
(clean, classify, geocode) → gold (dedupe, nearest store, catalog × market,
latest counts), in dependency order.

Landing layout (sub-folders of ``landing``)::

    listings/**.json[l]           listing rows and count observations (JSON lines)
    manual_scraping/listings/*.csv, essentials_bebe/*.csv, essentials_femme/*.csv
    essentials/*.json[l]          catalog rows (fixed schema)
    stores/*.json                 one multi-line JSON array of stores
    enrichment_files/postal*.csv  postal codes (code_postal, latitude, longitude)
    enrichment_files/gazetteer.csv  ordered name,lat,lon list (optional)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..operators import cleaning as CL
from ..operators import competition as CP
from ..operators import dedupe as D
from ..operators import geo as G
from ..operators.market import catalog_market
from ..schemas import PRODUCT, STORE
from ..session import path_exists
from ..sources.readers import read_csv_strings
from ..sources.sinks import write_view
from ..streaming.ingest import ingest, read_table


def _p(*parts):
    return "/".join(p.rstrip("/") for p in parts)


def bronze(spark: SparkSession, landing: str, out: str) -> None:
    """Incremental ingest of every landing folder (each file exactly once)."""
    ck = _p(out, "_checkpoints")
    specs = [
        ("bronze_listings", _p(landing, "listings"), "json", None, "*.{json,jsonl}", False),
        ("bronze_manual_listings", _p(landing, "manual_scraping", "listings"), "csv", None, "*.csv", False),
        ("bronze_catalog_a", _p(landing, "manual_scraping", "essentials_bebe"), "csv", None, "*.csv", False),
        ("bronze_catalog_b", _p(landing, "manual_scraping", "essentials_femme"), "csv", None, "*.csv", False),
        ("bronze_catalog", _p(landing, "essentials"), "json", PRODUCT, "*.{json,jsonl}", False),
        ("bronze_stores", _p(landing, "stores"), "json", STORE, "*.json", True),
    ]
    for name, src, fmt, schema, glob, ml in specs:
        if path_exists(spark, src):
            ingest(spark, src, _p(out, name), _p(ck, name), fmt=fmt, schema=schema, glob=glob, multiline=ml)


def _read(spark, out, name, schema=None) -> DataFrame:
    return read_table(spark, _p(out, name), schema)


def silver(spark: SparkSession, landing: str, out: str, sources=C.LISTING_SOURCES) -> dict[str, DataFrame]:
    raw = _read(spark, out, "bronze_listings")
    enr = _p(landing, "enrichment_files")
    postal = G.postal_centroids(read_csv_strings(spark, enr, "postal*.csv")) if path_exists(spark, enr) else \
        spark.createDataFrame([], "code_postal string, avg_lat double, avg_lon double")
    gaz_path = _p(enr, "gazetteer.csv")
    if path_exists(spark, gaz_path):
        g = read_csv_strings(spark, gaz_path)
        # list order is semantic: an explicit `ord` column, else the line
        # order of this single small file (one partition, so the generated
        # ids follow the file and are the same on every re-read)
        order = (F.col("ord").try_cast("bigint") if "ord" in g.columns
                 else F.monotonically_increasing_id())
        gaz = g.coalesce(1).select("name", F.col("lat").try_cast("double").alias("lat"),
                                   F.col("lon").try_cast("double").alias("lon"), order.alias("ord"))
    else:
        gaz = spark.createDataFrame([], "name string, lat double, lon double, ord long")
    out_ = {}
    if "source" in raw.columns:
        out_["silver_listings"] = G.geocode(CL.clean_listings(raw, sources), postal, gaz)
    out_["silver_counts"] = CL.clean_counts(raw)
    man = _read(spark, out, "bronze_manual_listings")
    if man.columns:
        out_["silver_manual_listings"] = CL.clean_manual_listings(man)
    cat = _read(spark, out, "bronze_catalog")
    parts = []
    if cat.columns:
        parts.append(CL.clean_catalog(cat))
    for name, mapping, universe in (("bronze_catalog_a", CL.CATALOG_A_MAPPING, "bebe"),
                                    ("bronze_catalog_b", CL.CATALOG_B_MAPPING, "femme")):
        b = _read(spark, out, name)
        if b.columns:
            parts.append(CL.clean_manual_catalog(b, mapping, universe))
    if parts:
        out_["silver_catalog"] = D.union_by_name(*parts)
    st = _read(spark, out, "bronze_stores")
    if st.columns:
        out_["silver_stores"] = CL.clean_stores(st)
    return out_


def gold(spark: SparkSession, s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    out = {}
    lists = [s[k] for k in ("silver_listings", "silver_manual_listings") if k in s]
    if lists:
        gl = D.dedupe_listings(D.union_by_name(*lists))
        if "silver_stores" in s:
            stores = D.dedupe_stores(s["silver_stores"])
            out["gold_stores"] = stores
            gl = G.nearest(gl, stores, lat="latitude", lng="longitude") \
                .withColumnRenamed("store_name", "nearest_store_name") \
                .withColumnRenamed("store_km", "nearest_store_km")
        out["gold_listings"] = gl
    out["gold_counts"] = CP.latest_counts(s["silver_counts"])
    if "silver_catalog" in s and "gold_listings" in out:
        prods = D.latest_per_key(s["silver_catalog"], ["product_uid"],
                                 [F.col("scraped_at").desc_nulls_last(), F.col("product_url").desc_nulls_last(),
                                  F.col("title").desc_nulls_last()])
        out["gold_catalog"] = catalog_market(prods, out["gold_listings"])
    return out


def _audited(df: DataFrame) -> DataFrame:
    """With the time of this recompute, the same for all rows of a table."""
    return df.withColumn("_processed_at", F.current_timestamp())


def run_pipeline(spark: SparkSession, landing: str, out: str) -> dict[str, str]:
    """One refresh: bronze appends new files, silver and gold are recomputed
    and written (overwrite).  Gold reads the written silver tables back, so
    silver is computed once and the lineage is cut at the layer boundary.
    Returns table name → path."""
    bronze(spark, landing, out)
    written = {}
    for name, df in silver(spark, landing, out).items():
        write_view(_audited(df), _p(out, name))
        written[name] = _p(out, name)
    s = {name: spark.read.parquet(path) for name, path in written.items()}
    for name, df in gold(spark, s).items():
        write_view(_audited(df), _p(out, name))
        written[name] = _p(out, name)
    return written
