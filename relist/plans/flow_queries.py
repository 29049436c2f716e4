"""Sources, sinks and routing as queries: rows of the given tables are landed
in the formats the pipeline reads, go through ingest, cleaning and export, and
are held against SQL on the tables themselves.

Everything lands under the shared checkpoint folder, a new folder per call."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cleaning as CL
from ..operators import dedupe as D
from ..operators import extraction as X
from ..operators import geo as G
from ..schemas import PRODUCT, STORE
from ..session import checkpoint_dir
from ..sources.readers import read_csv_strings, route_files
from ..sources.sinks import write_run, write_table, write_view
from ..streaming.ingest import RESCUED, ingest, read_table
from . import adapter as A
from . import oracle as O
from .queries import GOLD_SQL, gold_listings
from .registry import register


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------- ingest ---

@register("stores_ingest", """
SELECT s_name AS name, 'CITY_' || s_nationkey AS city, CASE WHEN s_suppkey % 3 = 0 THEN 'new ' ELSE 'old ' END || s_suppkey || ' street' AS address,
       lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS postal_code,
       42.0 + CAST(s_suppkey * 37 % 900 AS DOUBLE) / 100.0 + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS lat,
       -4.5 + CAST(s_suppkey * 53 % 1200 AS DOUBLE) / 100.0 AS lng
FROM supplier""")
def q_stores_ingest(spark, d):
    """Stores as multi-line JSON arrays with a declared schema, landed twice
    (every third store moves in the second run): one row per store, the
    latest observation as a whole."""
    base = _folder(spark, "stores")
    number = F.col("s_suppkey")

    def land(rows, run, label, move):
        stores = rows.select(
            "name", "city", F.concat(F.lit(label), number.cast("string"), F.lit(" street")).alias("address"),
            F.lpad(number.cast("string"), 5, "0").alias("postal_code"), (F.col("lat") + move).alias("lat"), "lng")
        files = stores.groupBy(F.pmod(F.xxhash64("name"), F.lit(4)).alias("part")).agg(
            F.to_json(F.collect_list(F.struct(*stores.columns))).alias("value"))
        files.select("part", F.regexp_replace("value", r"\},\{", "},\n{").alias("value")).write.partitionBy("part").text(f"{base}/landing/{run}")
        ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ck", schema=STORE, glob="*.txt", multiline=True)

    su = A.table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("_n"))
    rows = A.stores(spark, d).join(su, F.col("name") == F.col("_n"))
    land(rows, "run1", "old ", 0)
    land(rows.where(number % 3 == 0), "run2", "new ", 1)
    return D.dedupe_stores(CL.clean_stores(read_table(spark, f"{base}/bronze", None))).select(
        "name", "city", "address", "postal_code", "lat", "lng")


@register("catalog_ingest", """
SELECT 'U' || p_partkey AS product_uid, p_name AS title, p_type AS category, p_retailprice AS price,
       CASE WHEN p_partkey % 4 = 0 THEN 'USD' ELSE 'EUR' END AS currency, CAST(p_size AS BIGINT) AS total_reviews,
       CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE TIMESTAMP '2024-01-01' + to_days(CAST(p_partkey % 28 AS INTEGER)) END AS scraped_at
FROM part WHERE p_partkey % 7 <> 0""")
def q_catalog_ingest(spark, d):
    """Catalog rows as JSON lines under the declared 15-field schema, some
    fields absent, some ids blank."""
    base = _folder(spark, "catalog")
    key = F.col("p_partkey")
    rows = A.table(spark, d, "part").select(
        F.when(key % 7 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" U"), key.cast("string"))).alias("product_uid"),
        F.concat(F.col("p_name"), F.lit("  ")).alias("title"), F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"),
        F.when(key % 4 == 0, F.lit("USD")).alias("currency"), F.col("p_size").alias("total_reviews"),
        F.when(key % 5 != 0, F.date_format(F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(days=(key % 28).cast("int")),
                                           "yyyy-MM-dd'T'HH:mm:ss")).alias("scraped_at"))
    rows.write.json(f"{base}/landing")
    ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ck", schema=PRODUCT, glob="*.json")
    return CL.clean_catalog(read_table(spark, f"{base}/bronze")).select(
        "product_uid", "title", "category", "price", "currency", "total_reviews", "scraped_at")


@register("manual_listings", "WITH " + O.RAW_LISTINGS + """
SELECT source, CASE source WHEN 'ebay' THEN external_id ELSE regexp_extract(url, '(\\d+)\\.shtml$', 1) END AS external_id,
       title, CASE source WHEN 'ebay' THEN title ELSE description END AS description, price, url, location, false AS is_never_worn
FROM raw_listings WHERE source IN ('ebay', 'vestiaire') AND (source = 'vestiaire' OR external_id <> '')""")
def q_manual_listings(spark, d):
    """Manual CSV exports of two shops, whose columns differ, and of a third
    one that is not wanted: columns inferred and merged by the ingest, the
    shop taken from the file's path."""
    base = _folder(spark, "manual")
    r = A.raw_listings(spark, d)
    price = F.translate(F.col("price").cast("string"), ".", ",")
    ebay = r.where("source = 'ebay'").select(
        F.concat(F.lit("  "), F.col("external_id")).alias("sku"), F.col("url").alias("item_page_link"), F.col("title").alias("product_name"),
        F.concat(F.lit("US $"), F.col("price").cast("string")).alias("price1"), F.col("location").alias("data2"))
    shop = r.where("source = 'vestiaire'").select(
        F.col("url").alias("item_page_link"), F.col("title").alias("name"), "description", F.concat(price, F.lit(" €")).alias("price_1"),
        F.col("location").alias("seller_location"), F.col("primary_image_url").alias("main_image"))
    for rows, name in ((ebay, "EBAY_export"), (shop, "vestiaire-2026"), (ebay.limit(5), "other")):
        rows.write.option("header", "true").csv(f"{base}/landing/{name}")
    ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ck", fmt="csv", glob="*.csv")
    return CL.clean_manual_listings(read_table(spark, f"{base}/bronze")).select(
        "source", "external_id", "title", "description", "price", "url", "location", "is_never_worn")


@register("postal_from_csv", "WITH " + O.GEO_REF + """
SELECT code_postal, round(avg_lat, 6) AS avg_lat, round(avg_lon, 6) AS avg_lon FROM centroids""")
def q_postal_from_csv(spark, d):
    """The postal file read as text columns (leading zeros stay), cast later."""
    path = _folder(spark, "postal")
    A.postal_rows(spark, d).write.option("header", "true").csv(path)
    c = G.postal_centroids(read_csv_strings(spark, path, "*.csv"))
    return c.select("code_postal", F.round("avg_lat", 6).alias("avg_lat"), F.round("avg_lon", 6).alias("avg_lon"))


@register("ingest_lineage", "WITH " + O.RAW_LISTINGS + """
, f AS (SELECT *, CASE WHEN length(title) % 3 = 0 THEN 'run2' ELSE 'run1' END AS run FROM raw_listings)
SELECT run, count(*) AS landed_rows, count(DISTINCT source || external_id || url) AS keys,
       CAST(sum(CASE WHEN run = 'run2' THEN 1 ELSE 0 END) AS BIGINT) AS with_seller,
       CAST(sum(CASE WHEN run = 'run2' AND length(title) % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rescued,
       CAST(sum(CASE WHEN run = 'run2' AND length(title) % 2 = 0 THEN 0 ELSE price END) AS DOUBLE) AS price_sum,
       true AS whole
FROM f GROUP BY run""")
def q_ingest_lineage(spark, d):
    """Two runs and an idle one.  The second brings a new column and prices
    that are no numbers: those fields alone are rescued.  Every landed file is
    in the table once with all its rows, by source file and ingest time."""
    base = _folder(spark, "lineage")
    r = A.raw_listings(spark, d).withColumn("n", F.length("title"))
    first = r.where("n % 3 <> 0").drop("n")
    price = F.when(F.col("n") % 2 == 0, F.concat(F.lit("about "), F.col("price").cast("string"))).otherwise(F.col("price").cast("string"))
    second = r.where("n % 3 = 0").withColumn("seller_id", F.lit("s")).withColumn("price", price)
    body = F.to_json(F.struct(*[c for c in second.columns if c not in ("n", "price")]))
    shown = F.when(F.col("n") % 2 == 0, F.concat(F.lit('"'), F.col("price"), F.lit('"'))).otherwise(F.col("price"))
    lines = second.select(body.alias("_b"), shown.alias("_s")).select(
        F.concat(F.expr("substring(_b, 1, length(_b) - 1)"), F.lit(',"price":'), F.col("_s"), F.lit("}")).alias("value"))
    first.write.option("compression", "gzip").json(f"{base}/landing/run1")
    ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ck", glob="*.{json,txt}.gz")
    lines.write.option("compression", "gzip").text(f"{base}/landing/run2")
    for _ in range(2):
        ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ck", glob="*.{json,txt}.gz")
    run = F.when(F.col("_source_file").contains("/run2"), "run2").otherwise("run1")
    table = read_table(spark, f"{base}/bronze").withColumn("run", run)
    landed = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{json,txt}.gz").text(f"{base}/landing") \
        .groupBy(F.col("_metadata.file_path").alias("_source_file")).agg(F.count("*").alias("lines"))
    files = table.groupBy("run", "_source_file").agg(F.count("*").alias("rows"), F.count("_ingested_at").alias("timed"))
    whole = files.join(landed, "_source_file", "full").groupBy("run").agg(
        F.min((F.coalesce("rows", F.lit(0)) == F.coalesce("lines", F.lit(0))) & (F.col("timed") == F.col("rows"))).alias("whole"))
    told = table.groupBy("run").agg(
        F.count("*").alias("landed_rows"), F.countDistinct(F.concat("source", "external_id", "url")).alias("keys"),
        F.count("seller_id").alias("with_seller"), F.count_if(F.get_json_object(RESCUED, "$.price").startswith("about ")).alias("rescued"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("price_sum"))
    return told.join(whole, "run").select("run", "landed_rows", "keys", "with_seller", "rescued", "price_sum", "whole")


# -------------------------------------------------------------- sinks ---

@register("export_roundtrip", O.with_listings(GOLD_SQL + """
SELECT source, count(*) AS view_rows, 2 * count(*) AS run_rows, count(*) AS csv_rows, count(*) AS table_rows,
       CAST(sum(price) AS DOUBLE) AS price_sum
FROM gold GROUP BY source"""))
def q_export_roundtrip(spark, d):
    """Gold listings as a view partitioned by source, as run-stamped JSON (two
    runs) and CSV exports, and as a table replaced by one of another schema:
    what each holds per source."""
    base = _folder(spark, "export")
    write_view(gold_listings(spark, d).select("listing_key", "source", "title", "price"), f"{base}/gold")
    gold = spark.read.parquet(f"{base}/gold")           # computed once for both views
    write_view(gold, f"{base}/view")
    write_view(gold, f"{base}/view", ["source"])        # a full recompute replaces it
    view = spark.read.parquet(f"{base}/view")
    for run in ("r1", "r2"):
        write_run(view, f"{base}/json", run)
    write_run(view, f"{base}/csv", "r1", fmt="csv", append=False)
    name = f"export_{uuid.uuid4().hex}"
    write_table(view.select("listing_key"), name, path=f"{base}/table")
    write_table(view.select("listing_key", "source", "price"), name, ["source"], path=f"{base}/table")
    out = view.groupBy("source").agg(F.count("*").alias("view_rows"), F.sum("price").alias("price_sum"))
    kinds = "listing_key string, title string, price double, run_id string, source string"
    runs = spark.read.schema(kinds).json(f"{base}/json").where("run_id in ('r1', 'r2')")
    for rows, n in ((runs, "run_rows"), (spark.read.option("header", "true").csv(f"{base}/csv"), "csv_rows"), (spark.table(name), "table_rows")):
        out = out.join(rows.groupBy("source").agg(F.count("*").alias(n)), "source")
    return out.select("source", "view_rows", "run_rows", "csv_rows", "table_rows", "price_sum")


# ---------------------------------------------------- guards and routes ---

@register("counts_guarded", "WITH " + O.RAW_COUNTS + "\nSELECT brand, marketplace, count, run_ts, 2 AS parts FROM counts")
def q_counts_guarded(spark, d):
    """Count cleaning over a landing without count columns (an empty typed
    frame) and one with them, in one union."""
    raw = A.raw_counts(spark, d)
    both = CL.clean_counts(raw.drop("brand")).unionByName(CL.clean_counts(raw))
    return both.select("brand", "marketplace", "count", "run_ts", F.lit(2).alias("parts"))


@register("file_routes", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'catalog_a' WHEN 1 THEN 'catalog_b' WHEN 2 THEN 'manual_listings'
       WHEN 3 THEN 'manual_listings' ELSE 'skip' END AS route FROM part""")
def q_file_routes(spark, d):
    """Landed file names dealt to their target tables."""
    k = F.col("p_partkey")
    part = F.when(k % 5 == 0, "Essentials_BEBE").when(k % 5 == 1, "essentials_femme_2026").when(k % 5 == 2, "eBay").when(k % 5 == 3, "VESTIAIRE").otherwise("notes")
    name = F.concat(F.translate("p_type", " ", "_"), F.lit("_"), part, F.lit("_"), k.cast("string"), F.lit(".csv"))
    return route_files(A.table(spark, d, "part").select("p_partkey", name.alias("name"))).select("p_partkey", "route")


@register("image_batch", O.with_listings(GOLD_SQL + """
SELECT listing_key, source || '/' || substring(replace(replace(external_id, '/', '_'), chr(92), '_'), 1, 200) || '/0.jpg' AS rel_path
FROM gold WHERE trim(coalesce(primary_image_url, '')) <> '' ORDER BY rel_path LIMIT 40"""))
def q_image_batch(spark, d):
    """The first images of the manifest, as one download batch takes them."""
    return X.image_manifest(gold_listings(spark, d), limit=40).select("listing_key", "rel_path")


# ------------------------------------------------------------- replies ---

@register("structured_replies", """
SELECT conv_id, turn,
       CASE turn % 6 WHEN 4 THEN '{"search_text": ' || length(text) WHEN 5 THEN trim(text) WHEN 2 THEN 'robe ' || length(text) || ' fille'
            WHEN 3 THEN NULL ELSE 'words ' || length(text) END AS search_text,
       CASE WHEN turn % 6 IN (0, 1, 2) THEN 'robe' END AS category
FROM conversations WHERE text IS NOT NULL""")
def q_structured_replies(spark, d):
    """Replies as a model writes them: fenced or plain JSON, JSON without a
    search text (built from its attributes then) or without anything, broken
    JSON and plain text (both kept as they are)."""
    cv = A.table(spark, d, "conversations").filter(F.col("text").isNotNull())
    n = F.length("text").cast("string")
    full = F.to_json(F.struct(F.lit("robe").alias("category"), n.alias("color"), F.concat(F.lit("words "), n).alias("search_text")))
    parts = F.to_json(F.struct(F.lit("robe").alias("category"), n.alias("color"), F.lit("fille").alias("gender"), F.lit(" ").alias("search_text")))
    kind = F.col("turn") % 6
    reply = (F.when(kind == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```"))).when(kind == 1, full).when(kind == 2, F.concat(F.lit("```\n"), parts, F.lit("```")))
             .when(kind == 3, F.lit("{}")).when(kind == 4, F.concat(F.lit('{"search_text": '), n)).otherwise(F.col("text")))
    told = X.parse_reply(reply)
    return cv.select("conv_id", "turn", X.search_text_from_attrs(told).alias("search_text"), told.getField("category").alias("category"))
