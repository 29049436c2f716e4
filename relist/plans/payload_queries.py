"""Payload queries: item JSON of every source, written from the adapter rows
in the shapes that source is known to send, and read back as listings.

Each oracle is typed from the flat rows alone: it states what a listing must
look like for every shape and knows neither the paths nor the readers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.payloads import listings_from_payload
from . import adapter as A
from . import oracle as O
from .registry import register


def _members(**values: Column | str) -> list[tuple[str, Column]]:
    """Named values of a payload; null ones are left out."""
    return [(name, F.col(v) if isinstance(v, str) else v) for name, v in values.items()]


def _one_of(number: Column, *parts: list[tuple[str, Column]]) -> list[tuple[str, Column]]:
    """The part that ``number`` picks, the last one for all others."""
    last = len(parts) - 1
    picked = [number == k for k in range(last)] + [~F.coalesce(number.isin(*range(last)), F.lit(False))]
    return [(name, F.when(when, v)) for when, part in zip(picked, parts) for name, v in part]


def _payload(rows, *parts: list[tuple[str, Column]]):
    """One JSON text per row, written in one go; a name may stand for several
    members of different shapes, of which a row has one."""
    return rows.select(F.to_json(F.struct(*[v.alias(name) for part in parts for name, v in part])).alias("payload"))


def _raw(spark, d):
    return A.raw_listings(spark, d).withColumn("n", F.length("title"))


def _comma(price: Column) -> Column:
    return F.translate(price.cast("string"), ".", ",")


_LISTED = ("source", "external_id", "title", "description", "price", "url", "location", "latitude", "longitude", "published_at",
           "primary_image_url", "seller_id")


def _found(rows, source):
    return listings_from_payload(rows, source).select(*_LISTED)


@register("payload_listings", "WITH " + O.RAW_LISTINGS + """
SELECT 'vinted' AS source, external_id, title, description,
       CASE WHEN length(title) % 8 = 7 THEN NULL ELSE price END AS price,
       CASE WHEN length(title) % 2 = 0 THEN url ELSE 'https://www.vinted.fr/catalog/' || external_id END AS url,
       CASE length(title) % 3 WHEN 0 THEN location WHEN 1 THEN location ELSE 'France' END AS location,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       CASE WHEN length(title) % 7 = 2 THEN '1700000000' ELSE '' END AS published_at,
       CASE WHEN length(title) % 7 = 6 THEN '' ELSE primary_image_url END AS primary_image_url, '' AS seller_id
FROM raw_listings""")
def q_payload_listings(spark, d):
    r = _raw(spark, d)
    price, n = F.col("price"), F.col("n")
    amount = F.struct(price.alias("amount"))
    shown = F.concat(_comma(price), F.lit(" €"))
    cost = _one_of(n % 8, _members(price=price), _members(price=_comma(price)), _members(price=amount),
                   _members(price=F.struct(amount.alias("numeric"), (price + 1).alias("amount"))),
                   _members(price=F.struct(price.cast("string").alias("current_value"))),
                   _members(price_numeric=price.cast("string")), _members(price_string=shown), _members(price=shown))
    image = F.col("primary_image_url")
    photo = _one_of(n % 7, _members(photo=F.struct(image.alias("url"))),
                    _members(photo=F.struct(F.lit("thumb").alias("url"), image.alias("full_size_url"))),
                    _members(photo=F.struct(F.struct(image.alias("url"), F.lit(1700000000).alias("timestamp")).alias("high_resolution"))),
                    _members(photos=F.array(F.struct(image.alias("url")))),
                    _members(photos=F.array(F.struct(image.alias("full_size_url")))),
                    _members(photos=F.array(image)),
                    _members(photos=F.array(F.lit("no link"))))
    place = _one_of(n % 3, _members(city="location", user=F.struct(F.lit("Lyon").alias("city"))),
                    _members(city=F.lit(" "), user=F.struct(F.col("location").alias("city"), F.lit("France").alias("country"))),
                    _members(user=F.struct(F.lit("France").alias("country"))))
    head = _members(id="external_id", title="title", description="description", url=F.when(n % 2 == 0, F.col("url")))
    return _found(_payload(r, head, cost, photo, place), "vinted")


@register("payload_leboncoin", "WITH " + O.RAW_LISTINGS + """
SELECT 'leboncoin' AS source,
       CASE WHEN external_id <> '' THEN external_id WHEN source = 'facebook' OR source = 'leboncoin' OR source = 'ebay'
            THEN regexp_extract(url, '[0-9]+$') ELSE '' END AS external_id,
       title, description, price, url,
       CASE length(title) % 4 WHEN 0 THEN 'Location(lat=48.85, lng=2.35)' ELSE location END AS location,
       CASE length(title) % 4 WHEN 0 THEN 48.85::DOUBLE WHEN 1 THEN 50.63::DOUBLE END AS latitude,
       CASE length(title) % 4 WHEN 0 THEN 2.35::DOUBLE WHEN 1 THEN 3.06::DOUBLE END AS longitude,
       published_at, CASE WHEN length(title) % 3 = 0 THEN '' ELSE primary_image_url END AS primary_image_url,
       CASE WHEN length(title) % 2 = 0 THEN 'u-' || length(title) ELSE '' END AS seller_id
FROM raw_listings""")
def q_payload_leboncoin(spark, d):
    r = _raw(spark, d)
    n, at = F.col("n"), F.col("location")
    place = _one_of(n % 4, _members(location=F.lit("Location(lat=48.85, lng=2.35)")),
                    _members(location=F.struct(at.alias("city_label"), F.lit("x").alias("city"), F.lit(50.63).alias("lat"), F.lit("3.06").alias("lng"))),
                    _members(location=F.struct(at.alias("city"), F.lit(50.63).alias("lat"))),
                    _members(location=F.struct(F.lit("").alias("city"), at.alias("zipcode"))))
    image = F.when(n % 3 > 0, F.array("primary_image_url", F.lit("https://img.example.org/second"))).otherwise(F.array().cast("array<string>"))
    seller = F.when(n % 2 == 0, F.concat(F.lit("u-"), n.cast("string")))
    owner = _one_of(n % 4, _members(_user_id=seller), [], _members(owner=F.struct(seller.alias("user_id"))), [])
    price = _one_of(n % 2, _members(price="price"), _members(price=F.array("price")))
    head = _members(list_id=F.nullif("external_id", F.lit("")), subject="title", body="description", url="url",
                    index_date="published_at", images=image)
    return _found(_payload(r, head, place, owner, price), "leboncoin")


@register("payload_ebay", "WITH " + O.RAW_LISTINGS + """
SELECT 'ebay' AS source, external_id, title, CASE WHEN length(title) % 3 = 0 THEN '' ELSE description END AS description,
       CASE length(title) % 6 WHEN 4 THEN 0::DOUBLE WHEN 5 THEN NULL ELSE price END AS price,
       CASE WHEN length(title) % 3 = 2 THEN 'https://www.ebay.fr/itm/' || external_id ELSE url END AS url, location,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       CASE WHEN length(title) % 2 = 0 THEN published_at ELSE '' END AS published_at,
       CASE WHEN length(title) % 4 = 3 THEN '' ELSE primary_image_url END AS primary_image_url, '' AS seller_id
FROM raw_listings""")
def q_payload_ebay(spark, d):
    r = _raw(spark, d)
    n, price, image = F.col("n"), F.col("price"), F.col("primary_image_url")
    value = F.struct(price.cast("string").alias("value"))
    selling = _one_of(n % 6, _members(sellingStatus=F.struct(value.alias("convertedCurrentPrice"), F.struct((price + 5).alias("value")).alias("currentPrice"))),
                      _members(sellingStatus=F.struct(F.struct(price.alias("__value__")).alias("convertedCurrentPrice"))),
                      _members(sellingStatus=F.struct(value.alias("currentPrice"))),
                      _members(sellingStatus=F.struct(F.struct(price.alias("__value__")).alias("currentPrice"))),
                      _members(sellingStatus=F.struct(F.struct(F.lit("EUR").alias("currencyId")).alias("convertedCurrentPrice"), value.alias("currentPrice"))),
                      _members(sellingStatus=F.struct(F.lit("Active").alias("sellingState"))))
    gallery = _one_of(n % 4, _members(galleryURL=image), _members(galleryURL=F.struct(image.alias("imageUrl"))),
                      _members(image=F.struct(image.alias("imageUrl"))), [])
    link = _one_of(n % 3, _members(viewItemURL="url"), _members(itemWebUrl="url"), [])
    head = _members(itemId="external_id", title="title", location="location",
                    condition=F.when(n % 3 > 0, F.struct(F.col("description").alias("conditionDisplayName"))),
                    listingInfo=F.when(n % 2 == 0, F.struct(F.col("published_at").alias("endTime"))))
    return _found(_payload(r, head, selling, gallery, link), "ebay")


@register("payload_export", "WITH " + O.RAW_LISTINGS + """
SELECT 'facebook' AS source, external_id, title, description, CASE WHEN length(title) % 4 = 3 THEN NULL ELSE price END AS price,
       CASE WHEN length(title) % 2 = 0 THEN url ELSE '' END AS url,
       CASE WHEN length(title) % 3 = 0 THEN '' ELSE location END AS location,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, published_at, primary_image_url, '' AS seller_id
FROM raw_listings""")
def q_payload_export(spark, d):
    r = _raw(spark, d)
    n, price = F.col("n"), F.col("price")
    cost = _one_of(n % 4, _members(price=price), _members(price=F.struct(price.alias("amount"))), _members(price=price.cast("string")),
                   _members(price=F.struct(F.lit("EUR").alias("currency"))))
    ident = _one_of(n % 2, _members(id="external_id", listing_id=F.when(F.col("external_id") != "", F.lit("no"))), _members(listing_id="external_id"))
    image = _one_of(n % 2, _members(primary_image_url="primary_image_url", image_url=F.lit("no")), _members(image_url="primary_image_url"))
    place = _one_of(n % 3, _members(location=F.struct(F.col("location").alias("city"))), _members(location=F.concat(F.lit("  "), F.col("location"))),
                    _members(location="location"))
    head = _members(title="title", description="description", url=F.when(n % 2 == 0, F.col("url")), created_time="published_at")
    return _found(_payload(r, head, cost, ident, image, place), "facebook")
