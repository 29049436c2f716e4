"""DuckDB SQL for the correctness gate: the adapter views and every
SQL-expressible query, written independently of the Spark code paths.
"""

from __future__ import annotations

from ..functions import classify as C
from ..functions.geo import FOLD_FROM, FOLD_TO
from ..functions.ids import URL_ID_PATTERNS, VESTIAIRE_ID_PATTERN
from .adapter import CONDITION_NOTES, GARMENTS, MARKETPLACES, SOURCES6


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def case_rules(expr: str, rules, default: str, what: str = "label") -> str:
    parts = []
    for i, (label, pat) in enumerate(rules, start=1):
        val = q(label) if what == "label" else str(i)
        parts.append(f"WHEN coalesce(regexp_matches({expr}, {q(pat)}), false) THEN {val}")
    dflt = q(default) if what == "label" else str(len(rules) + 1)
    return "CASE " + " ".join(parts) + f" ELSE {dflt} END"


def case_bands(expr: str, bands, inclusive: bool = False, what: str = "label") -> str:
    parts, fallback = [], None
    op = "<=" if inclusive else "<"
    for i, (b, label) in enumerate(bands, start=1):
        val = q(label) if what == "label" else str(i)
        if b is None:
            fallback = val
        else:
            parts.append(f"WHEN {expr} {op} {b} THEN {val}")
    return "CASE " + " ".join(parts) + f" ELSE {fallback} END"


def mixed_ts(expr: str) -> str:
    return (f"coalesce(TRY_CAST({expr} AS TIMESTAMP), "
            f"make_timestamp(TRY_CAST({expr} AS BIGINT) * 1000000))")


COND_NOTE = "CASE " + " ".join(
    f"WHEN l_returnflag = {q(rf)} AND l_linestatus = {q(ls)} THEN {q(t)}"
    for (rf, ls), t in CONDITION_NOTES.items()) + " ELSE '' END"

RAW_LISTINGS = f"""
raw_j AS (
  SELECT l.*, p.p_name, p.p_type, o.o_custkey, o.o_orderdate, n.n_name,
         {lst(SOURCES6)}[l_suppkey % 6 + 1] AS src,
         CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS num_id,
         'article-' || CAST(l.l_partkey AS VARCHAR) AS slug
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
       JOIN orders o ON l.l_orderkey = o.o_orderkey
       JOIN customer c ON o.o_custkey = c.c_custkey
       JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_listings AS (
  SELECT src AS source,
    CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS external_id,
    {lst(GARMENTS)}[l_partkey % 12 + 1] || ' ' || p_name AS title,
    lower(p_type) || {COND_NOTE} AS description,
    CAST(l_quantity AS DOUBLE) AS price,
    CASE src WHEN 'leboncoin' THEN 'https://www.leboncoin.fr/ad/vetements/' || num_id
             WHEN 'vinted' THEN 'https://www.vinted.fr/items/' || num_id || '-' || slug
             WHEN 'ebay' THEN 'https://www.ebay.fr/itm/' || num_id
             WHEN 'label_emmaus' THEN 'https://www.label-emmaus.co/fr/' || slug || '-' || num_id || '/'
             WHEN 'vestiaire' THEN 'https://fr.vestiairecollective.com/' || slug || '-' || num_id || '.shtml'
             ELSE 'https://www.facebook.com/marketplace/item/' || num_id END AS url,
    CASE WHEN o_custkey % 4 = 0 THEN n_name
         WHEN o_custkey % 4 = 1 THEN n_name || ', France'
         ELSE n_name || ' (' || lpad(CAST(o_custkey AS VARCHAR), 5, '0') || ')' END AS location,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
    CASE WHEN l_linenumber = 6 THEN ''
         WHEN l_orderkey % 3 = 0 THEN CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR)
         WHEN l_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS published_at,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') AS scraped_at,
    'https://img.example.org/p/' || CAST(l_partkey AS VARCHAR) || '.JPEG' AS primary_image_url
  FROM raw_j
)"""

_EID = "trim(coalesce(external_id, ''))"
LISTINGS = RAW_LISTINGS + f""",
listings_pre AS (
  SELECT source,
    CASE WHEN {_EID} <> '' THEN {_EID}
         WHEN source = 'leboncoin' AND coalesce(url, '') <> '' THEN regexp_extract(coalesce(url, ''), {q(URL_ID_PATTERNS['leboncoin'])}, 1)
         WHEN source = 'vinted' THEN regexp_extract(url, {q(URL_ID_PATTERNS['vinted'])}, 1)
         WHEN source = 'ebay' THEN regexp_extract(url, {q(URL_ID_PATTERNS['ebay'])}, 1)
         WHEN source = 'label_emmaus' THEN regexp_extract(url, {q(URL_ID_PATTERNS['label_emmaus'])}, 1)
         ELSE {_EID} END AS external_id,
    trim(coalesce(title, '')) AS title,
    trim(coalesce(description, '')) AS description,
    TRY_CAST(price AS DOUBLE) AS price, url,
    trim(coalesce(location, '')) AS location,
    latitude, longitude,
    {mixed_ts('published_at')} AS published_at,
    trim(coalesce(primary_image_url, '')) AS primary_image_url,
    coalesce(regexp_matches(lower(trim(coalesce(title, '')) || ' ' || trim(coalesce(description, ''))), {q(C.NEVER_WORN_PATTERN)}), false) AS is_never_worn,
    {mixed_ts('scraped_at')} AS seen_at
  FROM raw_listings
  WHERE source IN ({', '.join(q(s) for s in C.LISTING_SOURCES)})
),
listings AS (
  SELECT * FROM listings_pre WHERE external_id IS NOT NULL AND trim(external_id) <> ''
)"""


def with_listings(body: str) -> str:
    return "WITH " + LISTINGS + "\n" + body


PRICE_OK = "price IS NOT NULL AND price > 0 AND price < 500"
AVG500 = "ROUND(AVG(CASE WHEN price < 500 THEN price END), 2)"
NW_SUM = "CAST(SUM(CASE WHEN is_never_worn THEN 1 ELSE 0 END) AS BIGINT)"
CATEGORY = case_rules("lower(title)", C.CATEGORY_RULES, C.CATEGORY_DEFAULT)
COND_TEXT = "lower(coalesce(title, '') || ' ' || coalesce(description, ''))"

_UID1, _UID2 = r"[-_]([A-Z0-9]+C[0-9]+)(?:\?|$)", r"/([a-z0-9_-]+)_P\d"
RAW_CATALOG = f"""
raw_catalog AS (
  SELECT
    CASE WHEN p_partkey % 10 = 0 THEN 'https://shop.example.com/' || replace(p_name, ' ', '-') || '.html'
         WHEN p_partkey % 10 = 1 THEN 'https://shop.example.com/' || replace(p_name, ' ', '-') || '_P' || CAST(p_partkey % 500 AS VARCHAR)
         ELSE 'https://shop.example.com/' || replace(p_name, ' ', '-') || '_P' || CAST(p_partkey % 500 AS VARCHAR) || 'C' || CAST(p_size % 3 AS VARCHAR) END AS item_page_link,
    CAST(CAST(floor(p_retailprice) AS BIGINT) % 40 + 5 AS VARCHAR) || ',' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || ' €' AS price_1,
    CASE WHEN p_partkey % 97 = 0 THEN '' ELSE p_name END AS name,
    p_type AS breadcrumbs,
    split_part(p_name, ' ', 1) AS Available_Colors,
    CAST(p_size % 5 AS VARCHAR) || '.5/5' AS rating,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(p_partkey % 7 AS INTEGER)) AS _ingested_at
  FROM part
),
products AS (
  SELECT * FROM (
    SELECT
      coalesce(nullif(regexp_extract(u, {q(_UID1)}, 1), ''), nullif(regexp_extract(u, {q(_UID2)}, 1), ''), sha1(u)) AS product_uid,
      trim(coalesce(name, '')) AS title,
      'bebe' AS universe, 'bebe' AS universe_key,
      trim(coalesce(breadcrumbs, '')) AS category,
      trim(coalesce(Available_Colors, '')) AS color,
      TRY_CAST(regexp_extract(regexp_replace(coalesce(price_1, '0'), '[,'']', '.', 'g'), '[\\d.]+', 0) AS DOUBLE) AS price,
      'EUR' AS currency, u AS product_url, '' AS primary_image_url,
      TRY_CAST(regexp_extract(coalesce(rating, '0'), '[\\d.]+', 0) AS DOUBLE) AS rating,
      CAST(0 AS BIGINT) AS total_reviews,
      _ingested_at AS scraped_at
    FROM (SELECT *, trim(coalesce(item_page_link, '')) AS u FROM raw_catalog)
  ) WHERE length(trim(coalesce(product_uid, ''))) > 0
)"""

RAW_COUNTS = f"""
raw_counts AS (
  SELECT ' Brand#' || CAST(user_id % 25 + 1 AS VARCHAR) AS brand,
         upper(event_type) AS marketplace,
         CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS count,
         CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS timestamp
  FROM events
),
counts AS (
  SELECT trim(brand) AS brand, lower(trim(marketplace)) AS marketplace, TRY_CAST(count AS BIGINT) AS count,
         coalesce(try_strptime(timestamp, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(timestamp, '%Y-%m-%dT%H:%M:%S.%fZ')) AS run_ts
  FROM raw_counts
  WHERE brand IS NOT NULL AND marketplace IS NOT NULL AND count IS NOT NULL
),
live AS (
  SELECT brand, marketplace, arg_max(count, (run_ts, count)) AS count, max(run_ts) AS last_run_at
  FROM counts GROUP BY brand, marketplace
),
baseline AS (
  SELECT p_brand AS brand, {lst(MARKETPLACES)}[p_size % 5 + 1] AS marketplace, count(*) AS count
  FROM part GROUP BY 1, 2
)"""

STORES = """
stores AS (
  SELECT s_name AS name, 'CITY_' || CAST(s_nationkey AS VARCHAR) AS city,
         42.0 + CAST(s_suppkey * 37 % 900 AS DOUBLE) / 100.0 AS lat,
         -4.5 + CAST(s_suppkey * 53 % 1200 AS DOUBLE) / 100.0 AS lng
  FROM supplier
),
points AS (
  SELECT c_custkey, 42.0 + CAST(c_custkey * 17 % 900 AS DOUBLE) / 100.0 AS lat,
         -4.5 + CAST(c_custkey * 29 % 1200 AS DOUBLE) / 100.0 AS lng
  FROM customer
)"""

GEO_REF = """
postal AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), CASE WHEN o_custkey % 5 = 0 THEN 6 ELSE 5 END, '0') AS code_postal,
         CAST(43.0 + CAST(o_orderkey % 700 AS DOUBLE) / 100.0 AS VARCHAR) AS latitude,
         CAST(-1.0 + CAST(o_orderkey % 500 AS DOUBLE) / 100.0 AS VARCHAR) AS longitude
  FROM orders
),
centroids AS (
  SELECT code_postal, avg(TRY_CAST(latitude AS DOUBLE)) AS avg_lat, avg(TRY_CAST(longitude AS DOUBLE)) AS avg_lon
  FROM postal WHERE code_postal IS NOT NULL AND TRY_CAST(latitude AS DOUBLE) IS NOT NULL
  GROUP BY code_postal
),
gazetteer AS (
  SELECT lower(n_name) AS name, 44.0 + n_nationkey / 5.0 AS lat, 0.5 + n_nationkey / 4.0 AS lon, n_nationkey AS ord
  FROM nation
)"""

FOLD = (f"regexp_replace(translate(lower({{x}}), {q(FOLD_FROM)}, {q(FOLD_TO)}), "
        "'[^\\x00-\\x7F]', '', 'g')")


def fold(x: str) -> str:
    return FOLD.format(x=x)
