"""Identifier derivation: listing ids from URLs, product uids, source tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# URL patterns carrying the marketplace id (group 1).
URL_ID_PATTERNS = {
    "leboncoin": r".*/([0-9]+)/?(?:\?|$)",
    "vinted": r"/items/([0-9]+)-",
    "ebay": r"/itm/([0-9]+)",
    "label_emmaus": r"-([0-9]+)/?$",
}
VESTIAIRE_ID_PATTERN = r"[-/](\d+)\.(?:shtml|html)?(?:\?|$)"
PRODUCT_UID_PATTERNS = (r"[-_]([A-Z0-9]+C[0-9]+)(?:\?|$)", r"/([a-z0-9_-]+)_P\d")


def external_id(source: Column, ext_id: Column, url: Column) -> Column:
    """Keep a non-blank id, else extract it from the marketplace URL with the
    source's pattern ('' when nothing matches; the raw value for sources
    without a pattern).  One literal pattern per branch, compiled once."""
    raw = F.trim(F.coalesce(ext_id.cast("string"), F.lit("")))
    u = F.coalesce(url, F.lit(""))
    out = F.when(raw != "", raw)
    for src, pat in URL_ID_PATTERNS.items():
        out = out.when(source == src, F.regexp_extract(u, pat, 1))
    return out.otherwise(raw)


def manual_external_id(source: Column, sku: Column, url: Column) -> Column:
    return (F.when(source == "ebay", F.trim(F.coalesce(sku, F.lit(""))))
            .when(source == "vestiaire", F.regexp_extract(url, VESTIAIRE_ID_PATTERN, 1))
            .otherwise(F.lit("")))


def product_uid(url: Column, literal_fallback: bool = False) -> Column:
    """Product uid from a catalog URL: code pattern → slug pattern → sha1(url).

    ``regexp_extract`` yields '' on no match; by default '' falls through to
    the next candidate.  ``literal_fallback=True`` keeps the first extract
    even when it is '' (rows then drop at the non-blank filter)."""
    a = F.regexp_extract(url, PRODUCT_UID_PATTERNS[0], 1)
    b = F.regexp_extract(url, PRODUCT_UID_PATTERNS[1], 1)
    if literal_fallback:
        return F.coalesce(a, b, F.sha1(url))
    return F.coalesce(F.nullif(a, F.lit("")), F.nullif(b, F.lit("")), F.sha1(url))


def source_from_path(path: Column) -> Column:
    p = F.lower(F.coalesce(path, F.lit("")))
    return (F.when(p.contains("ebay"), F.lit("ebay"))
            .when(p.contains("vestiaire"), F.lit("vestiaire"))
            .otherwise(F.lit("manual")))


def listing_key(source: Column, ext_id: Column) -> Column:
    """source_externalId (null when either part is null)."""
    return F.concat(source, F.lit("_"), ext_id)


def chunk_id(source: Column, index: Column) -> Column:
    """Deterministic chunk id (stable across recomputation)."""
    return F.sha2(F.concat_ws("\u0001", source, index.cast("string")), 256)
