"""Geo column builders: great-circle distance, accent folding, postal codes,
city labels and coordinate parsing."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 digits: int | None = 1) -> Column:
    """Great-circle distance in km (R = 6371.0); null if any input is null.

    Rounded half-even to ``digits`` (Python ``round`` semantics)."""
    rl1, rl2 = F.radians(lat1), F.radians(lat2)
    a = (F.pow(F.sin((rl2 - rl1) / 2), 2)
         + F.cos(rl1) * F.cos(rl2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2))
    d = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.greatest(F.lit(0.0), a)))
    return d if digits is None else F.bround(d, digits)


def _fold_tables() -> tuple[str, str]:
    """translate() tables derived by rule: every Latin character in
    U+00C0..U+024F and U+1E00..U+1EFF whose canonical decomposition starts
    with an ASCII letter maps to that letter.  Characters without one (œ, ß, ø…) are later
    removed with the other non-ASCII characters."""
    src, dst = [], []
    for cp in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        ch = chr(cp)
        base = unicodedata.normalize("NFD", ch)[0]
        if base.isascii() and base.isalpha():
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _fold_tables()


def fold_accents(text: Column) -> Column:
    """lower → strip diacritics → drop remaining non-ASCII characters."""
    t = F.translate(F.lower(text), FOLD_FROM, FOLD_TO)
    return F.regexp_replace(t, r"[^\x00-\x7F]", "")


def postal_code(text: Column) -> Column:
    """First standalone 5-digit code, null when absent."""
    return F.nullif(F.regexp_extract(text, r"\b(\d{5})\b", 1), F.lit(""))


def city_label(location: Column) -> Column:
    """'Town (59100)' kept with its code; otherwise the text before the first comma."""
    code = F.regexp_extract(location, r"\((\d{5})\)", 1)
    town = F.trim(F.regexp_replace(location, r"\s*\(\d{5}\)\s*$", ""))
    return F.when(code != "", F.concat(town, F.lit(" ("), code, F.lit(")")))\
            .otherwise(F.trim(F.split(location, ",").getItem(0)))


def latlng_from_text(text: Column) -> Column:
    """struct(lat, lng) from a 'lat=… lng=…' representation."""
    num = r"(-?\d+(?:\.\d+)?)"
    return F.struct(
        F.nullif(F.regexp_extract(text, r"lat\s*=\s*" + num, 1), F.lit("")).try_cast("double").alias("lat"),
        F.nullif(F.regexp_extract(text, r"(?:lng|lon)\s*=\s*" + num, 1), F.lit("")).try_cast("double").alias("lng"),
    )


def geocode_key(location: Column, country: str = "France") -> Column:
    """Lookup key for an external geocoder: '<postal>, France' when a code
    is present, else '<trimmed text>, France'; null for blank text."""
    t = F.trim(F.coalesce(location, F.lit("")))
    code = postal_code(t)
    return (F.when(t == "", F.lit(None).cast("string"))
            .when(code.isNotNull(), F.concat(code, F.lit(", " + country)))
            .otherwise(F.concat(t, F.lit(", " + country))))
