"""Extraction jobs over landed raw payloads and pages: product cards from
catalogue HTML, result counts from page text, slugs, embedded-JSON totals,
image manifests and structured replies (payloads: ``payloads``).

Native regex / JSON expressions throughout; the search for a total anywhere
in a JSON document is a fold over its levels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import FOLD_FROM, FOLD_TO

# Result-count patterns, tried in order (case-insensitive).
COUNT_PATTERNS = (
    r'"totalCount"\s*:\s*(\d+)',
    r'"total"\s*:\s*(\d+)',
    r'"productCount"\s*:\s*(\d+)',
    r'"nbResults?"\s*:\s*(\d+)',
    r'(\d+)\s*r[ée]sultat[s]?',
    r'(\d+)\s*article[s]?',
)
# The pattern families of the two other sources, for ``count_from_text``.
SEARCH_COUNT_PATTERNS = (
    r'"totalResults"\s*:\s*(\d+)',
    r'"total"\s*:\s*(\d+)',
    r'"nbHits"\s*:\s*(\d+)',
    r'(\d+)\s+r[ée]sultat',
    r'(\d+)\s+article',
)
HITS_COUNT_PATTERNS = (
    r'\\"nbHits\\"\s*:\s*(\d+)',
    r'"nbHits"\s*:\s*(\d+)',
    r'nbHits[^0-9]*(\d+)',
    r'"totalCount"\s*:\s*(\d+)',
    r'"total"\s*:\s*(\d+)',
    r'(\d+)\s+r[ée]sultat',
)
# Catalogue-wide total returned when a brand filter is ignored (not a brand count).
CATALOG_TOTAL_SENTINEL = 6_734_195
# Keys that carry a total in embedded JSON, in preference order.
TOTAL_KEYS = ("totalCount", "total_count", "totalItems", "totalResults", "nbHits", "total")
IMAGE_EXT_PATTERN = r"(?i)\.(jpe?g|png|webp|gif)(\?|$)"


def count_from_text(text: Column, patterns: Sequence[str] = COUNT_PATTERNS,
                    sentinel: int | None = None) -> Column:
    """First pattern (in order) that matches gives the count; null if none
    (or if it equals ``sentinel``)."""
    hits = [F.nullif(F.regexp_extract(text, "(?i)" + p, 1), F.lit("")) for p in patterns]
    n = F.coalesce(*hits).try_cast("bigint")
    if sentinel is not None:
        n = F.when(n == sentinel, F.lit(None).cast("bigint")).otherwise(n)
    return n


def count_from_spans(text: Column, min_digits: int = 2) -> Column:
    """First '"text": "<digits with space/nbsp separators>"' value with at
    least ``min_digits`` digits once separators are removed."""
    spans = F.regexp_extract_all(text, F.lit(r'"text"\s*:\s*"([\d \s]+)"'), F.lit(1))
    clean = F.transform(spans, lambda s: F.regexp_replace(F.trim(s), "[  ]", ""))
    ok = F.filter(clean, lambda s: s.rlike(r"^\d+$") & (F.length(s) >= min_digits))
    return F.try_element_at(ok, F.lit(1)).try_cast("bigint")


def slug(text: Column) -> Column:
    """URL slug: lower, trimmed, accents folded, spaces → '-', quotes and
    '&' dropped, runs of '-' collapsed, then anything outside [a-z0-9-]
    removed and edge hyphens stripped."""
    s = F.regexp_replace(F.lower(text), r"^\s+|\s+$", "")
    s = F.translate(s, FOLD_FROM, FOLD_TO)
    s = F.translate(s, "'&", "")
    s = F.regexp_replace(s, " ", "-")
    s = F.regexp_replace(s, "-+", "-")
    s = F.regexp_replace(s, "[^a-z0-9-]", "")
    return F.regexp_replace(s, "^-+|-+$", "")


# Character references that occur in card titles and links.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _decoded(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


# Where one card ends and the next begins: a closed block beside an opened one.
CARD_EDGE = (r"(?i)</(?:div|li|article|tr|section|ul|ol|nav|header|aside|form|table|tbody|thead)>\s*"
             r"(?:<(?:ul|ol|table|tbody|section|main)\b[^>]*>\s*)*<(?:div|li|article|tr|section)\b")
CARD_PRICE = r"([0-9]+[,.][0-9]+)\s*€"


def _card_price(text: Column) -> Column:
    """First price in a card's text, spaces and marks apart."""
    plain = F.regexp_replace(F.regexp_replace(text, "<[^>]*>?", " "), "[ \u00a0]", "")
    return F.regexp_replace(F.regexp_extract(plain, CARD_PRICE, 1), ",", ".").try_cast("double")


def page_cards(pages: DataFrame, key: str = "page_id", html: str = "html", url: str = "url",
               max_title: int | None = 500) -> DataFrame:
    """Product cards from catalogue pages: anchors to '/fr/<slug>-<id>/'
    (shop and shallow catalogue links excluded), non-empty title of at most
    ``max_title`` characters (None: any), the first 'n,nn €' price of the
    card, behind the anchor or before it, first occurrence of each id per
    page.  What lies between two anchors belongs to the first one's card up to
    the edge of the next (``CARD_EDGE``), all of it where there is no edge.
    Cards may span lines, links may stand in either quotes."""
    pieces = F.split(F.col(html), r"<a\s")
    beside = F.transform(pieces, lambda p, i: F.struct(F.get(pieces, i - 1).alias("before"), p.alias("own")))
    p = pages.select(key, F.regexp_extract(F.col(url), r"^(https?://[^/]+)", 1).alias("_base"),
                     F.posexplode(beside).alias("_pos", "_p")).filter(F.col("_pos") > 0)
    href = F.trim(F.regexp_extract("_p.own", r"""(?s)^[^>]*?href\s*=\s*(["'])(.*?)\1""", 2))
    inner = F.regexp_extract("_p.own", r"(?s)^[^>]*>(.*?)</a>", 1)
    title = F.regexp_replace(_decoded(F.regexp_replace(inner, "<[^>]*>", "")), r"\s+", " ")

    def between(piece: str, first: bool) -> Column:
        # the text before the first anchor of a page begins with no card of another
        rest = F.regexp_extract(piece, r"(?s)</a>(.*)$", 1) if first else \
            F.when(F.col("_pos") == 1, F.col(piece)).otherwise(F.regexp_extract(piece, r"(?s)</a>(.*)$", 1))
        parts = F.split(rest, CARD_EDGE)
        return F.element_at(parts, 1) if first else F.when((F.size(parts) > 1) | (F.col("_pos") == 1), F.element_at(parts, -1))

    p = p.select(key, "_pos", "_base", _decoded(href).alias("href"), F.trim(title).alias("title"),
                 F.coalesce(_card_price(between("_p.own", True)), _card_price(between("_p.before", False))).alias("price"))
    slashes = F.length("href") - F.length(F.regexp_replace("href", "/", ""))
    skip = (~F.col("href").contains("/fr/") | F.col("href").contains("/nos-boutiques/")
            | (F.col("href").contains("/catalogue/") & (slashes <= 4)))
    ext_id = F.regexp_extract("href", r"-(\d+)/?$", 1)
    cards = (p.filter(~skip)
             .select(key, "_pos", ext_id.alias("external_id"), "title",
                     F.when(F.col("href").startswith("http"), F.col("href"))
                      .otherwise(F.concat("_base", "href")).alias("url"), "price")
             .filter((F.col("external_id") != "") & (F.col("title") != "")))
    if max_title is not None:
        cards = cards.filter(F.length("title") <= max_title)
    w = Window.partitionBy(key, "external_id").orderBy("_pos")
    return (cards.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn").withColumnRenamed("_pos", "position"))


def embedded_json(html: Column, script_id: str = "__NEXT_DATA__") -> Column:
    return F.nullif(F.regexp_extract(
        html, r"(?s)<script[^>]+id=[\"']" + script_id + r"[\"'][^>]*>(.*?)</script>", 1), F.lit(""))


# What a value of a JSON document is, told by its first character once texts
# that begin like something else have been marked (``_marked``).
_NESTED, _WHOLE = r"^\s*[\[{]", r"^[1-9][0-9]*$"
_STEP = "array<struct<path: array<int>, text: string>>"


def _marked(text: Column) -> Column:
    """JSON in which no text begins with a bracket or a digit, so that a value
    read as text still shows whether it was an object, a list or a number."""
    return F.regexp_replace(text, r'"(?=\s*[\[{0-9])', '"~')


def first_total(text: Column, max_depth: int | None = 8, list_head: int | None = 5) -> Column:
    """First positive whole number under a total-like key of a JSON text, in
    document order (an object before what is in it), as text.

    The walk is a fold over the levels of the document: each step reads the
    objects and lists of a level once, takes the totals the objects hold, and
    goes on with what they contain.  A node is known by its path, and paths
    sort in document order, so the smallest path with a total is the first.
    ``max_depth`` and ``list_head`` bound the search as the definition does
    (None: no bound; a document that nests deeper than the JSON reader
    allows has no total)."""
    def object_of(node: Column) -> Column:
        return F.when(F.ltrim(node["text"]).startswith("{"), F.from_json(node["text"], "map<string,string>"))

    def values_of(node: Column) -> Column:
        listed = F.from_json(node["text"], "array<string>")
        some = listed if list_head is None else F.slice(listed, 1, list_head)
        return F.when(F.ltrim(node["text"]).startswith("{"), F.map_values(object_of(node))).otherwise(some)

    def total_of(node: Column) -> Column:
        held = object_of(node)
        named = [F.try_element_at(held, F.lit(k)) for k in TOTAL_KEYS]
        return F.struct(node["path"].alias("path"), F.coalesce(*[F.when(n.rlike(_WHOLE), n) for n in named]).alias("text"))

    def below(node: Column) -> Column:
        inner = F.transform(values_of(node), lambda v, i: F.struct(F.concat(node["path"], F.array(i)).alias("path"), v.alias("text")))
        return F.filter(F.coalesce(inner, F.array().cast(_STEP)), lambda x: F.coalesce(x["text"].rlike(_NESTED), F.lit(False)))

    def step(state: Column, _: Column) -> Column:
        level = state["level"]
        hits = F.filter(F.transform(level, total_of), lambda h: h["text"].isNotNull())
        best = F.array_min(F.array_compact(F.array(state["best"], F.array_min(hits))))
        return F.struct(F.flatten(F.transform(level, below)).alias("level"), best.alias("best"))

    whole = _marked(text)
    nested = F.regexp_count(text, F.lit(r"[\[{]"))
    steps = nested if max_depth is None else F.least(nested, F.lit(max_depth + 1))
    root = F.array(F.struct(F.array().cast("array<int>").alias("path"), F.coalesce(whole, F.lit("")).alias("text")))
    start = F.struct(root.cast(_STEP).alias("level"), F.lit(None).cast("struct<path: array<int>, text: string>").alias("best"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.coalesce(steps, F.lit(0)), F.lit(1))), start, step)["best"]["text"]


def total_from_json(pages: DataFrame, key: str = "page_id", html: str = "html", max_depth: int | None = 8,
                    list_head: int | None = 5) -> DataFrame:
    """First positive total-like key found depth-first in the page's embedded
    JSON (depth ≤ 8, first 5 list items by default, None for no bound); else
    the first total-like number in the raw text."""
    fallback = count_from_text(F.col(html), (r'"totalCount"\s*:\s*(\d+)', r'"nbHits"\s*:\s*(\d+)', r'"total"\s*:\s*(\d+)'))
    found = pages.select(key, embedded_json(F.col(html)).alias("_json"), fallback.alias("_fallback"))
    total = first_total(F.col("_json"), max_depth, list_head).try_cast("bigint")
    return found.select(key, F.coalesce(total, "_fallback").alias("total"))


def image_manifest(listings: DataFrame, existing: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """Target path per listing image: '<source>/<external_id>/0.<ext>' with
    path parts sanitised ('/' and '\\' → '_', 200 chars, 'unknown' when
    empty) and the extension taken from the URL path (jpeg → jpg, default
    jpg).  Already stored paths are skipped (anti join); ``limit`` > 0 caps
    the batch (the operator's own option)."""
    def part(c):
        s = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(s == "", F.lit("unknown")).otherwise(F.substring(F.regexp_replace(s, r"[/\\]", "_"), 1, 200))
    url = F.trim(F.coalesce(F.col("primary_image_url"), F.lit("")))
    path = F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))
    ext = F.lower(F.regexp_extract(path, IMAGE_EXT_PATTERN, 1))
    ext = F.when(ext == "", F.lit("jpg")).otherwise(F.regexp_replace(ext, "jpeg", "jpg"))
    src = F.when(F.coalesce(F.col("source"), F.lit("")) == "", F.lit("unknown")).otherwise(F.col("source"))
    m = (listings.filter(url != "")
         .select("listing_key", url.alias("image_url"),
                 F.concat_ws("/", part(src), part(F.col("external_id")), F.concat(F.lit("0."), ext)).alias("rel_path")))
    if existing is not None:
        m = m.join(existing.select("rel_path"), "rel_path", "left_anti")
    if limit:
        m = m.orderBy("rel_path").limit(limit)
    return m


REPLY_SCHEMA = "category string, color string, gender string, search_text string, style string"


def parse_reply(text: Column, schema: str = REPLY_SCHEMA) -> Column:
    """Model reply → struct: code fences and a leading 'json' tag removed,
    parsed as JSON; when it does not parse, the raw text becomes
    ``search_text``."""
    body = F.regexp_replace(F.trim(text), r"^```(?:json)?\s*|\s*```$", "")
    fields = [f.split()[0] for f in schema.split(",")]
    # broken JSON parses to a struct of nulls; the corrupt-record field tells it from an empty reply
    parsed = F.from_json(body, f"{schema}, _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"})
    ok = parsed.isNotNull() & parsed.getField("_corrupt_record").isNull() & F.trim(body).startswith("{")
    return F.when(ok, F.struct(*[parsed.getField(f).alias(f) for f in fields])).otherwise(F.struct(*[
        (F.trim(text) if f == "search_text" else F.lit(None).cast("string")).alias(f) for f in fields]))


def search_text_from_attrs(attrs: Column) -> Column:
    """search_text if non-empty, else non-empty category / color / gender joined by a space."""
    def ne(c):
        return F.nullif(F.trim(c), F.lit(""))
    return F.coalesce(ne(attrs.getField("search_text")),
                      F.nullif(F.concat_ws(" ", ne(attrs.getField("category")), ne(attrs.getField("color")),
                                           ne(attrs.getField("gender"))), F.lit("")))


# Catalogue pages: product items embedded in the page's __NEXT_DATA__ JSON.
ITEMS_SCHEMA = (
    "props struct<pageProps: struct<queryProductResponse: struct<category: struct<"
    "items: array<struct<productCode: string, productUidpk: string, productLabel: string, "
    "colorLabel: string, productUrl: string, rate: string, "
    "display: struct<price: struct<salePrice: double, listPrice: double, currency: string>, "
    "images: struct<productImagesSource: array<string>>, totalReviewCount: bigint>, "
    "seo: struct<breadcrumbs: array<struct<label: string>>>>>, totalPages: int>>>>")
def catalog_from_pages(pages: DataFrame, universe: str, universe_key: str, scraped_at: Column,
                       site_base: str, image_base: str, key: str = "page_id",
                       html: str = "html") -> DataFrame:
    """Product rows from catalogue pages: items of
    props.pageProps.queryProductResponse.category; category = second-to-last
    breadcrumb; product URLs prefixed with ``site_base`` (adding '/' when
    the item URL lacks it), the first image with ``image_base``."""
    doc = F.from_json(embedded_json(F.col(html)), ITEMS_SCHEMA)
    items = doc.getField("props").getField("pageProps").getField("queryProductResponse") \
        .getField("category").getField("items")
    it = F.col("_it")
    disp, price = it.getField("display"), it.getField("display").getField("price")
    crumbs = it.getField("seo").getField("breadcrumbs")
    imgs = disp.getField("images").getField("productImagesSource")
    raw_url = F.coalesce(it.getField("productUrl"), F.lit(""))
    return (pages.select(key, F.posexplode(items).alias("item_pos", "_it"))
            .select(key, "item_pos",
                    it.getField("productCode").alias("product_code"),
                    F.coalesce(it.getField("productUidpk"), F.lit("")).alias("product_uid"),
                    it.getField("productLabel").alias("title"),
                    F.lit(universe).alias("universe"), F.lit(universe_key).alias("universe_key"),
                    F.when(F.size(crumbs) >= 2, F.element_at(crumbs, -2).getField("label")).alias("category"),
                    it.getField("colorLabel").alias("color"),
                    price.getField("salePrice").alias("price"), price.getField("listPrice").alias("list_price"),
                    F.coalesce(F.nullif(price.getField("currency"), F.lit("")), F.lit("EUR")).alias("currency"),
                    F.concat(F.lit(site_base), F.when(raw_url.startswith("/"), F.lit("")).otherwise(F.lit("/")),
                             raw_url).alias("product_url"),
                    F.when(F.size(imgs) > 0, F.concat(F.lit(image_base), F.element_at(imgs, 1)))
                     .alias("primary_image_url"),
                    it.getField("rate").alias("rating"),
                    F.coalesce(F.nullif(disp.getField("totalReviewCount"), F.lit(0)), F.lit(0)).cast("bigint")
                     .alias("total_reviews"),
                    scraped_at.alias("scraped_at")))
