"""Listing records from payloads, every expected value typed by hand."""

import json

import pytest
from pyspark.sql import functions as F

from relist.operators.payloads import listings_from_payload


def listing(spark, source, *items):
    rows = [(i, x if x is None or isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)]
    raw = spark.createDataFrame(rows, "n int, payload string")
    out = listings_from_payload(raw, source, scraped_at=F.lit("2026-01-01T00:00:00Z")).collect()
    return [r.asDict() for r in out]


def test_leboncoin_ad(spark):
    full, bare, text, odd = listing(
        spark, "leboncoin",
        {"list_id": 3155730669, "subject": "Robe Kids", "body": "Taille 4 ans", "price": 12.5, "url": "https://www.leboncoin.fr/ad/vetements/3155730669",
         "location": {"city": "Lille", "city_label": "Lille (59000)", "zipcode": "59000", "lat": 50.63, "lng": 3.06},
         "index_date": "2026-01-02 10:00:00", "images": ["https://img/1.jpg", "https://img/2.jpg"], "_user_id": "abc-1"},
        {"url": "https://www.leboncoin.fr/ad/vetements/77?x=1", "price": [8], "images": [], "owner": {"user_id": "abc-2"}},
        {"list_id": " 5 ", "location": "Location(city='Nice', lat=43.7, lng=7.25)"},
        {"list_id": 6, "location": {"zipcode": "06000", "lat": 43.7}, "price": None})
    assert full == {"source": "leboncoin", "external_id": "3155730669", "title": "Robe Kids", "description": "Taille 4 ans", "price": 12.5,
                    "url": "https://www.leboncoin.fr/ad/vetements/3155730669", "location": "Lille (59000)", "latitude": 50.63, "longitude": 3.06,
                    "published_at": "2026-01-02 10:00:00", "scraped_at": "2026-01-01T00:00:00Z", "primary_image_url": "https://img/1.jpg",
                    "seller_id": "abc-1"}
    assert (bare["external_id"], bare["price"], bare["title"], bare["primary_image_url"], bare["seller_id"]) == ("77", 8.0, "", "", "abc-2")
    assert (text["external_id"], text["latitude"], text["longitude"]) == ("5", 43.7, 7.25)
    assert (odd["location"], odd["latitude"], odd["longitude"], odd["price"]) == ("06000", None, None, None)


@pytest.mark.parametrize("item, price", [
    ({"price": 7}, 7.0), ({"price": "7,5"}, 7.5), ({"price": " 7.50 "}, 7.5), ({"price": 0}, 0.0),
    ({"price": {"amount": "5"}}, 5.0), ({"price": {"amount": 5, "numeric": {"amount": 6}}}, 6.0), ({"price": {"amount": 5, "numeric": 6}}, 5.0),
    ({"price": {"numeric": {"float": 4.5}}}, 4.5), ({"price": {"current_value": "3.5"}}, 3.5),
    ({"price": {"amount": 0}, "price_numeric": "2.5"}, 2.5), ({"price_numeric": 9}, 9.0), ({"price_string": "7,50 €"}, 7.5),
    ({"price_string": "EUR 12.00"}, 12.0), ({"price": "free", "price_string": "x"}, None), ({"price": "7,50 €"}, None), ({}, None)])
def test_vinted_price(spark, item, price):
    assert listing(spark, "vinted", item)[0]["price"] == price


@pytest.mark.parametrize("item, url", [
    ({"photo": {"url": "https://a"}}, "https://a"), ({"photo": {"url": {"url": "//b"}}}, "//b"), ({"photo": {"url": "thumb", "full_size_url": "http://c"}}, "http://c"),
    ({"photo": {"high_resolution": {"url": "https://d", "timestamp": 1}}}, "https://d"), ({"photo": {"original_url": "https://e"}}, "https://e"),
    ({"photo": {"id": 1}, "photos": [{"full_size_url": "https://f"}]}, "https://f"), ({"photos": ["https://g", "https://h"]}, "https://g"),
    ({"photos": ["nothing"]}, ""), ({"photos": []}, ""), ({}, "")])
def test_vinted_photo(spark, item, url):
    assert listing(spark, "vinted", item)[0]["primary_image_url"] == url


def test_vinted_item(spark):
    a, b, c, d = listing(
        spark, "vinted",
        {"id": 12, "title": "Jean", "description": "neuf", "city": "Nice", "country": "France", "url": "https://www.vinted.fr/items/12-jean",
         "photo": {"high_resolution": {"timestamp": 1700000000}}},
        {"id": "13", "city": " ", "user": {"city": "Lyon", "country": "France"}},
        {"id": 14, "city": 5, "user": {"country": "Belgique"}}, {})
    assert (a["external_id"], a["location"], a["url"], a["published_at"]) == ("12", "Nice", "https://www.vinted.fr/items/12-jean", "1700000000")
    assert (b["location"], b["url"], b["published_at"]) == ("Lyon", "https://www.vinted.fr/catalog/13", "")
    assert c["location"] == "Belgique" and (d["location"], d["title"], d["external_id"]) == ("", "", "")


def test_ebay_item(spark):
    a, b, c, d = listing(
        spark, "ebay",
        {"itemId": "900", "title": "T-shirt", "viewItemURL": "https://www.ebay.fr/itm/900?x", "location": "Paris, France", "galleryURL": " https://g/1.jpg ",
         "condition": {"conditionDisplayName": "Neuf"}, "listingInfo": {"endTime": "2026-02-01T00:00:00Z"},
         "sellingStatus": {"convertedCurrentPrice": {"value": "9.99", "currencyId": "EUR"}, "currentPrice": {"value": "11"}}},
        {"itemId": 901, "itemWebUrl": "https://e/901", "sellingStatus": {"currentPrice": {"__value__": 4}}, "image": {"imageUrl": "https://g/2.jpg"}},
        {"itemId": 902, "sellingStatus": {"convertedCurrentPrice": {"currencyId": "EUR"}, "currentPrice": {"value": 3}}, "galleryURL": {"imageUrl": "https://g/3.jpg"}},
        {"itemId": 903})
    assert (a["external_id"], a["title"], a["description"], a["price"], a["url"], a["location"], a["published_at"], a["primary_image_url"]) == (
        "900", "T-shirt", "Neuf", 9.99, "https://www.ebay.fr/itm/900?x", "Paris, France", "2026-02-01T00:00:00Z", "https://g/1.jpg")
    assert (b["url"], b["price"], b["primary_image_url"], b["description"]) == ("https://e/901", 4.0, "https://g/2.jpg", "")
    assert (c["url"], c["price"], c["primary_image_url"]) == ("https://www.ebay.fr/itm/902", 0.0, "https://g/3.jpg")
    assert (d["price"], d["primary_image_url"], d["published_at"], d["latitude"]) == (None, "", "", None)


def test_export_line(spark):
    a, b, c = listing(
        spark, "facebook",
        {"id": 1, "title": "Manteau", "description": "d", "price": {"amount": "15.5", "currency": "EUR"}, "url": "https://f/1", "location": " Lille ",
         "created_time": "2026-01-05T08:00:00+0000", "image_url": "https://i/1.jpg"},
        {"listing_id": "L2", "price": 3, "location": {"city": "Lille"}, "primary_image_url": "https://i/2.jpg", "image_url": "https://i/3.jpg"}, {})
    assert (a["external_id"], a["price"], a["url"], a["location"], a["published_at"], a["primary_image_url"]) == (
        "1", 15.5, "https://f/1", "Lille", "2026-01-05T08:00:00+0000", "https://i/1.jpg")
    assert (b["external_id"], b["price"], b["url"], b["location"], b["primary_image_url"]) == ("L2", 3.0, "", "", "https://i/2.jpg")
    assert (c["external_id"], c["price"], c["url"]) == ("", None, "")


def test_broken_payloads(spark):
    for row in listing(spark, "ebay", "not json", "", None, "[1]", "5"):
        assert row["title"] == "" and row["price"] is None and row["url"] == "https://www.ebay.fr/itm/"
