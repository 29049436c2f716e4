"""Incremental ingest and the medallion pipeline on landed fixture files."""

import json
import os

from pyspark.sql import functions as F

from relist.plans.pipeline import run_pipeline
from relist.streaming.ingest import ingest, read_table


def _write_jsonl(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r, ensure_ascii=False) + "\n")


def test_incremental_ingest_with_schema_evolution(spark, tmp):
    land, out, ck = f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/ck"
    _write_jsonl(f"{land}/a.jsonl", [{"source": "vinted", "external_id": "1", "price": 5.0},
                                     {"source": "ebay", "external_id": "2", "price": 7.5}])
    with open(f"{land}/notes.md", "w") as f:
        f.write("# not data\n")
    ingest(spark, land, out, ck, glob="*.{json,jsonl}")
    df = read_table(spark, out)
    assert df.count() == 2 and "_source_file" in df.columns and "_ingested_at" in df.columns
    _write_jsonl(f"{land}/sub/b.json", [{"source": "vinted", "external_id": "3", "price": 1.0, "seller_id": "s9"}])
    ingest(spark, land, out, ck, glob="*.{json,jsonl}")
    ingest(spark, land, out, ck, glob="*.{json,jsonl}")          # nothing new: no duplicates
    df = read_table(spark, out)
    assert df.count() == 3
    got = {r.external_id: r.seller_id for r in df.select("external_id", "seller_id").collect()}
    assert got == {"1": None, "2": None, "3": "s9"}


def test_pipeline_end_to_end(spark, tmp):
    land, out = f"{tmp}/landing", f"{tmp}/out"
    _write_jsonl(f"{land}/listings/run1/leboncoin.jsonl", [
        {"source": "leboncoin", "external_id": "", "title": "Robe neuve", "description": "jamais porté",
         "price": 12.0, "url": "https://www.leboncoin.fr/ad/vetements/3155730669", "location": "Lille (59000)",
         "published_at": "2026-03-01T10:00:00", "scraped_at": "2026-03-02T10:00:00", "primary_image_url": "", "seller_id": "u1"},
        {"source": "leboncoin", "external_id": "3155730669", "title": "Robe neuve", "description": "jamais porté",
         "price": 11.0, "url": "https://www.leboncoin.fr/ad/vetements/3155730669", "location": "Lille (59000)",
         "published_at": "1772445600", "scraped_at": "2026-03-05T10:00:00", "primary_image_url": ""},
        {"source": "facebook", "external_id": "9", "title": "x", "price": 1.0},
        {"source": "vinted", "external_id": "", "title": "Jean slim", "price": 8.0,
         "url": "https://www.vinted.fr/items/42-jean", "location": "Évry", "published_at": ""},
    ])
    _write_jsonl(f"{land}/listings/counts.jsonl", [
        {"brand": "HomeBrand", "marketplace": "Vinted ", "count": 10, "timestamp": "2026-03-06T21:55:11Z"},
        {"brand": "HomeBrand", "marketplace": "vinted", "count": 12, "timestamp": "2026-03-07T21:55:11.123456Z"},
        {"brand": "HomeBrand", "marketplace": "leboncoin", "count": None, "timestamp": "2026-03-07T21:55:11Z"},
    ])
    os.makedirs(f"{land}/manual_scraping/listings", exist_ok=True)
    with open(f"{land}/manual_scraping/listings/ebay_export.csv", "w") as f:
        f.write("sku,item_page_link,product_name,price1,data2\nA1,https://www.ebay.fr/itm/1,Pull bleu,US $9.99,Located in France\n"
                ",https://www.ebay.fr/itm/2,Pull,3 €,\n")
    _write_jsonl(f"{land}/essentials/cat.jsonl", [
        {"product_code": "P1", "product_uid": "U1", "title": "Robe", "price": 10.0, "scraped_at": "2026-03-01T00:00:00"},
        {"product_code": "P2", "product_uid": "U2", "title": "", "price": 5.0, "scraped_at": "2026-03-01T00:00:00"},
    ])
    os.makedirs(f"{land}/manual_scraping/essentials_bebe", exist_ok=True)
    with open(f"{land}/manual_scraping/essentials_bebe/export.csv", "w") as f:
        f.write('item_page_link,name,price_1,rating\n'
                'https://shop.example.com/body-bebe_P123C456,Jean slim,"12,50 €",4.5/5\n'
                'https://shop.example.com/nothing-here.html,Pull,3 €,\n')
    os.makedirs(f"{land}/stores", exist_ok=True)
    with open(f"{land}/stores/stores.json", "w") as f:
        json.dump([{"name": "Store Lille", "city": "Lille", "lat": 50.63, "lng": 3.06},
                   {"name": "Store Evry", "city": "Evry", "lat": 48.63, "lng": 2.44}], f, indent=1)
    os.makedirs(f"{land}/enrichment_files", exist_ok=True)
    with open(f"{land}/enrichment_files/postal_codes.csv", "w") as f:
        f.write("code_postal,latitude,longitude\n59000,50.63,3.06\n59000,50.64,3.07\n")
    with open(f"{land}/enrichment_files/gazetteer.csv", "w") as f:
        f.write("name,lat,lon\nevry,48.63,2.44\nlille,50.63,3.06\n")
    t = run_pipeline(spark, land, out)
    gl = spark.read.parquet(t["gold_listings"])
    rows = {r.listing_key: r for r in gl.collect()}
    assert set(rows) == {"leboncoin_3155730669", "vinted_42", "ebay_A1"}
    lbc = rows["leboncoin_3155730669"]
    assert lbc.price == 11.0 and lbc.is_never_worn is True          # latest observation
    assert str(lbc.first_seen_at) < str(lbc.last_seen_at)
    assert lbc.nearest_store_name == "Store Lille" and lbc.nearest_store_km == 0.7   # centroid (50.635, 3.065)
    assert rows["vinted_42"].nearest_store_name == "Store Evry"
    assert rows["ebay_A1"].price == 9.99 and rows["ebay_A1"].nearest_store_name is None
    gc = {r.brand + "/" + r.marketplace: r["count"] for r in spark.read.parquet(t["gold_counts"]).collect()}
    assert gc == {"HomeBrand/vinted": 12}
    cat = {r.product_uid: (r.resell_count, r.price, r.universe) for r in spark.read.parquet(t["gold_catalog"]).collect()}
    assert cat["U1"][0] == 1 and cat["U2"][0] == 0                   # blank title matches nothing
    assert cat["P123C456"] == (1, 12.5, "bebe")                      # manual export: uid from URL, price text
    assert len(cat) == 4                                             # the other uid falls through to sha1(url)
    # second refresh with nothing new: gold unchanged, bronze not duplicated
    t2 = run_pipeline(spark, land, out)
    assert spark.read.parquet(t2["gold_listings"]).count() == 3
    assert spark.read.parquet(f"{out}/bronze_listings").count() == 7
    assert spark.read.parquet(t2["silver_counts"]).filter(F.col("brand") == "HomeBrand").count() == 2


def test_run_export_and_routing(spark, tmp):
    from relist.sources.readers import read_documents, route_files
    from relist.sources.sinks import write_run
    df = spark.createDataFrame([("vinted", "1"), ("ebay", "2"), ("vinted", "3")], "source string, external_id string")
    write_run(df, f"{tmp}/runs", "r1")
    write_run(df.limit(1), f"{tmp}/runs", "r2")
    back = spark.read.json(f"{tmp}/runs")
    assert back.count() == 4 and {r.run_id for r in back.select("run_id").collect()} == {"r1", "r2"}
    assert {r.source for r in back.select("source").distinct().collect()} == {"vinted", "ebay"}
    files = spark.createDataFrame([("essentials_bebe_2026.csv",), ("Ebay_export.csv",), ("vestiaire.csv",),
                                   ("essentials_femme.csv",), ("notes.csv",)], "name string")
    got = [r.route for r in route_files(files).collect()]
    assert got == ["catalog_a", "manual_listings", "manual_listings", "catalog_b", "skip"]
    os.makedirs(f"{tmp}/docs", exist_ok=True)
    for n, t in (("a.md", "# A\n\ntext"), (".hidden.md", "x"), ("b.txt", "no")):
        with open(f"{tmp}/docs/{n}", "w") as f:
            f.write(t)
    docs = {r.source: r.text for r in read_documents(spark, f"{tmp}/docs").collect()}
    assert docs == {"a.md": "# A\n\ntext"}


def test_csv_files_with_different_headers(spark, tmp):
    """Columns go by name, whatever their order and number; leading zeros,
    rows that do not fit, later files and a repeated run."""
    land, out, ck = f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/ck"
    os.makedirs(f"{land}/sub")

    def put(name, text):
        with open(f"{land}/{name}", "w") as f:
            f.write(text)

    put("a.csv", "sku,price\n007,1\n8,2\n")
    put("b.csv", "price,name,sku\n3,\"x, y\",9\n4,z,10,extra\n")
    put("sub/c.csv", "sku,price\n11,5\n")
    put("d.txt", "not,this\n1,2\n")
    ingest(spark, land, out, ck, fmt="csv", glob="*.csv")
    put("e.csv", "sku,colour\n12,red\n")
    for _ in range(2):
        ingest(spark, land, out, ck, fmt="csv", glob="*.csv")
    df = read_table(spark, out)
    got = {r.sku: (r.price, r.name, r.colour, os.path.basename(r._source_file)) for r in df.collect()}
    assert df.count() == 6 and got["007"] == ("1", None, None, "a.csv") and got["9"] == ("3", "x, y", None, "b.csv")
    assert got["12"] == (None, None, "red", "e.csv") and got["11"][3] == "c.csv"
    assert [r.sku for r in df.where("_rescued_data is not null").collect()] == ["10"]
    assert {r._batch for r in df.collect()} == {0, 1}
