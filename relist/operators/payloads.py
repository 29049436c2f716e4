"""Marketplace payloads → listing records, by tables of candidate paths.

A payload is parsed once per row into a VARIANT.  For every source a table
names, per listing field, the places where its value may stand, in the order
they are tried, and how each is read; the first that gives a value wins.  The
type is decided per candidate: a place that holds something of another shape
just gives nothing, so a price may be a number in one row, a text in the next
and an object in a third.

How a place is read:

* ``TEXT``: any scalar as its text, trimmed, if not blank
* ``STRING``: the same, but JSON strings only
* ``LINK``: a JSON string that begins with ``http``
* ``NUMBER``: a number, or a text that is one
* ``COMMA``: the same with a decimal comma
* ``AMOUNT``: a number other than 0, as 0 stands for "not given" there
* ``MONEY``: what digits and points are left of a text with a currency
* ``ZERO``: 0, if anything but nothing, ``{}`` or 0 stands there (a price
  object without an amount; later places are not looked at then)

A text field without a value is the empty text, a number without one is null.
A payload that is not JSON gives a row of empty fields.  Coordinates stand
in the payloads of one source only; the others get theirs from the location
(``operators.geo``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo as G

TEXT, STRING, LINK, NUMBER, COMMA, AMOUNT, MONEY, ZERO = "text", "string", "link", "number", "comma", "amount", "money", "zero"

_PHOTO = tuple(rule for key in ("url", "full_size_url", "high_resolution", "original_url")
               for rule in ((TEXT, f"$.photo.{key}.url"), (LINK, f"$.photo.{key}")))

# Where each source keeps a field, in the order it is looked for.
FIELD_PATHS: dict[str, dict[str, tuple[tuple[str, str], ...]]] = {
    "leboncoin": {
        "external_id": ((TEXT, "$.list_id"),),
        "title": ((TEXT, "$.subject"),),
        "description": ((TEXT, "$.body"),),
        "price": ((NUMBER, "$.price"), (NUMBER, "$.price[0]")),
        "url": ((TEXT, "$.url"),),
        "location": ((STRING, "$.location"), (TEXT, "$.location.city_label"), (TEXT, "$.location.city"), (TEXT, "$.location.zipcode")),
        "latitude": ((NUMBER, "$.location.lat"),),
        "longitude": ((NUMBER, "$.location.lng"),),
        "published_at": ((TEXT, "$.index_date"),),
        "primary_image_url": ((TEXT, "$.images[0]"),),
        "seller_id": ((TEXT, "$._user_id"), (TEXT, "$.owner.user_id")),
    },
    "vinted": {
        "external_id": ((TEXT, "$.id"),),
        "title": ((TEXT, "$.title"),),
        "description": ((TEXT, "$.description"),),
        "price": ((COMMA, "$.price"), (AMOUNT, "$.price.numeric.amount"), (AMOUNT, "$.price.numeric.float"),
                  (AMOUNT, "$.price.amount"), (AMOUNT, "$.price.float"), (NUMBER, "$.price.current_value"),
                  (NUMBER, "$.price_numeric"), (MONEY, "$.price_string")),
        "url": ((TEXT, "$.url"),),
        "location": ((STRING, "$.city"), (TEXT, "$.user.city"), (TEXT, "$.user.country")),
        "published_at": ((TEXT, "$.photo.high_resolution.timestamp"),),
        "primary_image_url": (*_PHOTO, (TEXT, "$.photos[0].url"), (TEXT, "$.photos[0].full_size_url"), (LINK, "$.photos[0]")),
    },
    "ebay": {
        "external_id": ((TEXT, "$.itemId"),),
        "title": ((TEXT, "$.title"),),
        "description": ((TEXT, "$.condition.conditionDisplayName"),),
        "price": ((AMOUNT, "$.sellingStatus.convertedCurrentPrice.value"), (AMOUNT, "$.sellingStatus.convertedCurrentPrice.__value__"),
                  (AMOUNT, "$.sellingStatus.convertedCurrentPrice"), (ZERO, "$.sellingStatus.convertedCurrentPrice"),
                  (AMOUNT, "$.sellingStatus.currentPrice.value"), (AMOUNT, "$.sellingStatus.currentPrice.__value__"),
                  (AMOUNT, "$.sellingStatus.currentPrice"), (ZERO, "$.sellingStatus.currentPrice")),
        "url": ((TEXT, "$.viewItemURL"), (TEXT, "$.itemWebUrl")),
        "location": ((TEXT, "$.location"),),
        "published_at": ((TEXT, "$.listingInfo.endTime"),),
        "primary_image_url": ((STRING, "$.galleryURL"), (TEXT, "$.galleryURL.url"), (TEXT, "$.galleryURL.imageUrl"),
                              (STRING, "$.image.imageUrl"), (TEXT, "$.image.imageUrl.url")),
    },
    "facebook": {
        "external_id": ((TEXT, "$.id"), (TEXT, "$.listing_id")),
        "title": ((TEXT, "$.title"),),
        "description": ((TEXT, "$.description"),),
        "price": ((NUMBER, "$.price"), (NUMBER, "$.price.amount")),
        "url": ((TEXT, "$.url"),),
        "location": ((STRING, "$.location"),),
        "published_at": ((TEXT, "$.created_time"),),
        "primary_image_url": ((TEXT, "$.primary_image_url"), (TEXT, "$.image_url")),
    },
}
#: the page of an item, where a payload without a link gets one
ITEM_PAGES = {"vinted": "https://www.vinted.fr/catalog/", "ebay": "https://www.ebay.fr/itm/"}
NUMBERS = ("price", "latitude", "longitude")
LISTING_FIELDS = ("external_id", "title", "description", "price", "url", "location", "latitude", "longitude",
                  "published_at", "primary_image_url", "seller_id")


def _blank_is_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def read(text: Column, how: str) -> Column:
    """A value as a rule reads it, from the text at its path (an object or an
    array is its JSON there); null where it is of another kind."""
    if how in (TEXT, STRING):
        return F.when(~text.startswith("{"), _blank_is_null(text))
    if how == LINK:
        return F.when(text.startswith("http"), text)
    if how == MONEY:
        return F.regexp_replace(F.translate(text, ",", "."), "[^0-9.]", "").try_cast("double")
    if how == ZERO:
        return F.when(~F.trim(text).isin("", "{}", "0", "0.0"), F.lit(0.0))
    # an object is no number: a failed cast costs far more than the look at its first character
    plain = F.when(~text.startswith("{"), F.translate(text, ",", ".") if how == COMMA else text)
    number = F.trim(plain).try_cast("double")
    return F.nullif(number, F.lit(0.0)) if how == AMOUNT else number


def _at(item: Column, how: str, path: str) -> Column:
    text = F.try_variant_get(item, path, "string")
    if how != STRING:
        return text
    return F.when(F.schema_of_variant(F.try_variant_get(item, path, "variant")) == "STRING", text)


def read_fields(items: DataFrame, item: str, rules: dict[str, tuple[tuple[str, str], ...]], numbers: Sequence[str] = NUMBERS) -> DataFrame:
    """One column per field of ``rules`` from the VARIANT ``item``.  Every
    path is read once, in a projection of its own; the rules only combine
    what was found there."""
    spots = {(how == STRING, path): _at(F.col(item), how, path) for found in rules.values() for how, path in found}
    named = {spot: f"_at{i}" for i, spot in enumerate(spots)}
    told = items.select(*[c.alias(named[spot]) for spot, c in spots.items()])

    def field(name: str) -> Column:
        found = [read(F.col(named[how == STRING, path]), how) for how, path in rules.get(name, ())]
        return F.coalesce(*found, F.lit(None).cast("double") if name in numbers else F.lit("")).alias(name)

    return told.select(*[field(name) for name in LISTING_FIELDS])


def listings_from_payload(raw: DataFrame, source: str, payload: str = "payload",
                          scraped_at: Column | None = None) -> DataFrame:
    """Raw item JSON of one source (one per row) → listing records.

    Beyond the table: an ad without an id takes it from its link, an ad whose
    location is a text with coordinates gives them up if it has no pair of
    its own, and an item without a link gets that of its page."""
    found = read_fields(raw.select(F.try_parse_json(F.col(payload)).alias("_item")), "_item", FIELD_PATHS[source])
    if source == "leboncoin":
        from_url = F.regexp_extract("url", r"/([0-9]+)(?:\?|$)", 1)
        both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
        told = G.latlng_from_text(F.col("location"))
        told = F.when(told["lat"].isNotNull() & told["lng"].isNotNull(), told)
        found = found.withColumns({
            "external_id": F.coalesce(_blank_is_null(F.col("external_id")), from_url),
            "latitude": F.when(both, F.col("latitude")).otherwise(told["lat"]),
            "longitude": F.when(both, F.col("longitude")).otherwise(told["lng"])})
    if source in ITEM_PAGES:
        page = F.concat(F.lit(ITEM_PAGES[source]), F.col("external_id"))
        found = found.withColumn("url", F.coalesce(_blank_is_null(F.col("url")), page))
    when = scraped_at if scraped_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return found.select(F.lit(source).alias("source"), "external_id", "title", "description", "price", "url", "location", "latitude",
                        "longitude", "published_at", when.alias("scraped_at"), "primary_image_url", "seller_id")
