"""Hand-checked values for rules, regexes and the decided semantics."""

import math
import unicodedata

from pyspark.sql import functions as F

from relist.functions import classify as C
from relist.functions import clean as CLN
from relist.functions import geo as GEO
from relist.functions import ids as IDS
from relist.operators import extraction as X


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("r")).first()["r"]


def test_category_rules_order(spark):
    cat = lambda t: one(spark, lambda c: C.category(c).getField("label"), t)
    assert cat("Lot de 3 bodies bébé") == "Lot / Bundle"
    assert cat("Body bébé 6 mois") == "Bébé"
    assert cat("Legging sport") == "Pantalons & Jeans"
    assert cat("Basket montante") == "Chaussures"
    assert cat("hot rod") == "Vêtements divers"
    assert cat(None) == "Vêtements divers"


def test_condition_rules(spark):
    cond = lambda t: one(spark, lambda c: C.condition(c, F.lit("")).getField("label"), t)
    assert cond("Robe neuf avec étiquette") == "Never Worn / New with Tags"
    assert cond("très bon état") == "Very Good Condition"  # tested before "bon état"
    assert cond("bon état général") == "Good Condition"
    assert cond("petits défauts") == "Fair / Minor Defects"
    assert cond("usé") == "Worn / Defects"
    assert cond("rien") == "Condition Not Specified"


def test_never_worn(spark):
    nw = lambda t: one(spark, lambda c: C.never_worn(c, F.lit(None)), t)
    assert nw("Robe NEUVE taille 4") is True
    assert nw("jamais porté") is True
    assert nw("neuftaille") is False
    assert nw(None) is False


def test_bands(spark):
    price = lambda v: one(spark, lambda c: C.bucketize(c, C.PRICE_BANDS).getField("label"), v, "double")
    assert price(4.99) == "0–5€" and price(5.0) == "5–10€" and price(30.0) == "30€+"
    age = lambda v: one(spark, lambda c: C.bucketize(c, C.AGE_BANDS, inclusive=True).getField("ord"), v, "int")
    assert age(7) == 1 and age(8) == 2 and age(180) == 4 and age(181) == 5 and age(None) == 5


def test_price_parse(spark):
    p = lambda t: one(spark, CLN.parse_price, t)
    assert p("64 €") == 64.0
    assert p("US $9.99") == 9.99
    assert p("12,50 €") == 12.5
    assert p("1 299,00 €") == 1.0          # thousands not understood (reference behaviour)
    assert p("") is None
    loc = lambda t: one(spark, CLN.parse_price_locale, t)
    assert loc("1 299,00 €") == 1299.0 and loc("1,299.00") == 1299.0


def test_mixed_timestamp_and_run_ts(spark):
    ts = lambda t: one(spark, CLN.mixed_timestamp, t)
    assert str(ts("2024-03-05T10:00:00")) == "2024-03-05 10:00:00"
    assert str(ts("1709632800")) == "2024-03-05 10:00:00"
    assert ts("") is None and ts("garbage") is None
    rt = lambda t: one(spark, lambda c: CLN.run_timestamp(c), t)
    assert str(rt("2026-03-06T21:55:11Z")) == "2026-03-06 21:55:11"
    assert str(rt("2026-03-06T21:55:11.123456Z")) == "2026-03-06 21:55:11.123456"


def test_ordinal_and_discount(spark):
    o = lambda n: one(spark, CLN.ordinal, n, "int")
    assert [o(n) for n in (1, 2, 3, 4, 11, 12, 13, 21, 22, 111)] == \
        ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "22nd", "111th"]
    d = lambda p: one(spark, lambda c: CLN.discount_pct(c, F.lit(10.0)), p, "double")
    assert d(2.0) == 80.0 and d(20.0) == 0.0 and d(None) == 0.0 and d(0.0) == 99.0


def test_external_id_from_url(spark):
    rows = [("leboncoin", "", "https://www.leboncoin.fr/ad/vetements/3155730669"),
            ("leboncoin", None, "https://www.leboncoin.fr/ad/vetements/3155730669/?x=1"),
            ("vinted", "", "https://www.vinted.fr/items/123-robe"),
            ("ebay", " ", "https://www.ebay.fr/itm/456"),
            ("label_emmaus", "", "https://x.co/fr/haut-ml-102833181/"),
            ("vestiaire", "", "https://x.com/a-1.shtml"),
            ("vinted", " 77 ", "https://www.vinted.fr/items/123-robe")]
    df = spark.createDataFrame(rows, "source string, external_id string, url string")
    got = [r[0] for r in df.select(IDS.external_id(F.col("source"), F.col("external_id"), F.col("url"))).collect()]
    assert got == ["3155730669", "3155730669", "123", "456", "102833181", "", "77"]


def test_product_uid_fallthrough(spark):
    urls = ["https://shop.example.com/robe_P2876777C2876928", "https://shop.example.com/robe-fille_P123",
            "https://shop.example.com/robe.html"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(IDS.product_uid(F.col("u"))).collect()]
    assert got[0] == "P2876777C2876928" and got[1] == "robe-fille" and len(got[2]) == 40
    lit = [r[0] for r in df.select(IDS.product_uid(F.col("u"), literal_fallback=True)).collect()]
    assert lit[1] == "" and lit[2] == ""   # the literal chain never falls through


def test_fold_and_postal(spark):
    f = lambda t: one(spark, GEO.fold_accents, t)
    for s in ("Évry", "Île-de-France", "Saint-Étienne", "Cœur", "Ærø"):
        ref = unicodedata.normalize("NFD", s.lower()).encode("ascii", "ignore").decode("ascii")
        assert f(s) == ref
    assert one(spark, GEO.postal_code, "Lille (59000)") == "59000"
    assert one(spark, GEO.postal_code, "123456") is None
    assert one(spark, GEO.city_label, "Lille (59000)") == "Lille (59000)"
    assert one(spark, GEO.city_label, "Lille, Hauts-de-France") == "Lille"
    r = one(spark, GEO.latlng_from_text, "lat=50.62 lng=3.06")
    assert (r["lat"], r["lng"]) == (50.62, 3.06)
    assert one(spark, GEO.geocode_key, " Lille (59000) ") == "59000, France"
    assert one(spark, GEO.geocode_key, "") is None


def test_haversine_matches_python(spark):
    pts = [(48.85, 2.35, 50.63, 3.06), (43.3, 5.37, 45.76, 4.84), (0.0, 0.0, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "a double, b double, c double, d double")
    got = [r[0] for r in df.select(GEO.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    for (a, b, c, d), g in zip(pts, got):
        p1, l1, p2, l2 = map(math.radians, (a, b, c, d))
        h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin((l2 - l1) / 2) ** 2
        assert g == round(2 * 6371.0 * math.asin(math.sqrt(max(0.0, h))), 1)


def test_counts_and_slug(spark):
    c = lambda t: one(spark, lambda x: X.count_from_text(x, sentinel=X.CATALOG_TOTAL_SENTINEL), t)
    assert c('{"totalCount": 42, "total": 7}') == 42
    assert c("1234 Résultats") == 1234
    assert c('"total": 6734195') is None
    assert c("nothing") is None
    s = lambda t: one(spark, lambda x: X.count_from_spans(x), t)
    assert s('"text": "1 234" "text": "5"') == 1234
    assert s('"text": "5"') is None
    sl = lambda t: one(spark, X.slug, t)
    assert sl("  Petit Bateau ") == "petit-bateau"
    assert sl("Tape à l'Œil & Co") == "tape-a-lil-co"


def test_parse_reply(spark):
    p = lambda t: one(spark, X.parse_reply, t)
    r = p('```json\n{"category": "robe", "color": "rouge"}\n```')
    assert r["category"] == "robe" and r["color"] == "rouge"
    r = p("une robe rouge")
    assert r["search_text"] == "une robe rouge" and r["category"] is None
    st = one(spark, lambda x: X.search_text_from_attrs(X.parse_reply(x)), '{"category": "robe", "gender": "fille"}')
    assert st == "robe fille"


def test_count_schema_guard_and_table_sink(spark, tmp):
    from relist.operators.cleaning import clean_counts
    from relist.sources.sinks import write_table
    listings_only = spark.createDataFrame([("vinted", "1")], "source string, external_id string")
    out = clean_counts(listings_only)
    assert out.count() == 0 and out.columns == ["brand", "marketplace", "count", "run_ts"]
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    write_table(df, "relist_sink_test", path=f"{tmp}/tbl")
    write_table(df.withColumn("w", F.lit(2)), "relist_sink_test", path=f"{tmp}/tbl")
    assert spark.table("relist_sink_test").columns == ["id", "v", "w"]
    spark.sql("DROP TABLE relist_sink_test")
