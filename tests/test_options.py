"""Options promised for decided semantics, and cards with the price first."""

from pyspark.sql import functions as F

from relist.operators import extraction as X
from relist.operators import geo as G
from relist.operators import metrics as M


def test_source_coordinates_may_stay(spark):
    df = spark.createDataFrame([(1, "Lille (59000)", 1.0, 2.0), (2, "Lille (59000)", None, 2.0), (3, None, 5.0, 6.0), (4, "nowhere", None, None)],
                               "id int, location string, latitude double, longitude double")
    cen = spark.createDataFrame([("59000", 50.6, 3.0)], "code_postal string, avg_lat double, avg_lon double")
    gaz = G.gazetteer_frame(spark, [("nice", 43.7, 7.2)])
    got = {r.id: (r.latitude, r.longitude) for r in G.geocode(df, cen, gaz).collect()}
    assert got == {1: (50.6, 3.0), 2: (50.6, 3.0), 3: (None, None), 4: (None, None)}
    kept = {r.id: (r.latitude, r.longitude) for r in G.geocode(df, cen, gaz, prefer_source_coords=True).collect()}
    assert kept == {1: (1.0, 2.0), 2: (50.6, 3.0), 3: (5.0, 6.0), 4: (None, None)}


def test_unknown_age_band(spark):
    df = spark.createDataFrame([("2026-01-10",), ("2026-01-01",), ("soon",), (None,), ("2020-01-01",)], "published_at string")
    plain = {r.age_bucket: r.cnt for r in M.age_histogram(df, "2026-01-10").collect()}
    assert sum(plain.values()) == 4 and "unknown" not in plain
    rows = {r.age_bucket: r for r in M.age_histogram(df, "2026-01-10", unknown=True).collect()}
    assert rows["unknown"].cnt == 2 and rows["unknown"].sort_order == 6 and sum(r.cnt for r in rows.values()) == 5
    assert rows["unknown"].old_pct == rows["180+ days"].pct


def test_cards_with_the_price_on_either_side(spark):
    page = """<nav><a href="/fr/">home</a> 9,99 € off</nav>
      <div class="card"><span>7,50&nbsp;€</span>
        <a href="/fr/robe-1/">Robe</a></div>
      <div class="card"><a href='/fr/jupe-2/'>Jupe</a><p>1 299,00 €</p><s>1 500,00 €</s></div>
      <div class="card"><div>4.20 €</div><a href="/fr/pull-3/">Pull</a> 3,10 € today</div>
      <div class="card"><a href="/fr/sac-4/">Sac</a></div>
      <ul><li><b>2,00 €</b> <a href="/fr/bas-5/">Bas</a></li><li><a href="/fr/bob-6/">Bob</a> <i>6,00 €</i></li></ul>"""
    df = spark.createDataFrame([(1, "https://s.example/x", page.replace("&nbsp;", "\u00a0"))], "page_id int, url string, html string")
    got = {r.external_id: r.price for r in X.page_cards(df).collect()}
    assert got == {"1": 7.5, "2": 1299.0, "3": 3.1, "4": None, "5": 2.0, "6": 6.0}
    assert X.page_cards(df).columns == ["page_id", "position", "external_id", "title", "url", "price"]
