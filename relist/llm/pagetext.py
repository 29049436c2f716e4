"""Main text of web pages by consensus host paths.

1. Every page is parsed into blocks and containers.  A container (article,
   main, section, div, td, body) earns the text of the blocks below it, less
   with every level between, and nothing from links or boilerplate.  The page
   votes for its containers' generalised tag-class paths (digits dropped,
   classes sorted), each with its share of the best container's score.
2. Spark adds the votes up per host and path; the path with most votes wins
   (ties: the alphabetically first).  A host with very many pages is summed
   before the shuffle.
3. Pages are parsed again with their host's winning path: the main text is
   the text of the elements on that path, in page order.  A page that has no
   such element, or nothing in it, falls back on its own best container.

Inside the main text, menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out, by tag and by class
or id; headings in an article's own header stay, and so do headings,
paragraphs and inline tags whatever their class or id, and sections whatever
their id, as these are often made from titles.  Character references are
decoded, white space in a block becomes one space, blocks are joined by one.

Defined cases: null or empty html → empty text, 0 characters; a null url is
the host ``""``; broken markup is closed where HTML would close it; a page
without tags is one block of text; pages of any length and depth are read
whole, in time that grows with their length; repeated rows are pages of their
own (and votes); an empty table gives an empty result; ``text`` and
``n_chars`` columns of the input are replaced, other columns are kept.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import broadcast_if_small, materialise

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|.*)|<!\[CDATA\[(?:.*?\]\]>|.*)|<[!?][^>]*+>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|$)", re.S)
_OPEN = re.compile(r"</?[a-zA-Z]|<!--|<!\[CDATA\[")
_ATTR = re.compile(r"([^\s=\"'/<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")

VOID = frozenset("area base basefont br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp noembed noframes iframe textarea title".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p
pre search section summary table tbody td tfoot th thead title tr ul""".split())
CONTAINER = frozenset("article body div main section td".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: what holds text itself: its class or id names its looks or its title, not a part of the page
TEXT_TAGS = HEADING | frozenset("p pre blockquote".split())
#: parts whose id is often made from their title
TITLED = frozenset("section article".split())
#: start tags that close an open element of these names, up to the nearest element of the third set
CLOSES_P = BLOCK - {"caption", "legend", "option", "optgroup", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "head"}
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "tbody": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
          "tfoot": ({"tr", "td", "th", "tbody", "thead", "tfoot"}, {"table"}),
          "option": ({"option"}, {"select", "datalist"}), "body": ({"head"}, set())}
NOISE_TAGS = frozenset("""head script style noscript template nav footer aside form button select option textarea input
svg math canvas iframe object embed applet audio video dialog menu search xmp noembed noframes title datalist label
fieldset map""".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertisements advertising adsense adslot adbox
sponsor sponsored sponsors promo promos promotion promoted banner banners billboard cookie cookies consent gdpr privacy
notice notices notification notifications alert alerts popup popups popover modal overlay lightbox paywall newsletter
subscribe subscription signup login signin register sidebar sidebars aside rail menu menus nav navbar navi navigation
breadcrumb breadcrumbs pagination pager toolbar topbar navlinks masthead footer foot footnav copyright colophon legal
disclaimer share sharing sharebar social socials related recommended recommendations recommendation trending popular
widget widgets comment comments commentlist respond disqus reply replies discussion reactions form forms search skip
skiplink tagcloud teaser teasers outbrain taboola""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_NEGATED = frozenset("has with no without not is hide show".split())


def _noise_name(name: str) -> bool:
    """Whether a class or id names boilerplate by its first or last word."""
    words = [w.lower() for w in _SPLIT.split(name) if w]
    if not words or words[0] in _NEGATED:
        return False
    return words[0] in NOISE_WORDS or words[-1] in NOISE_WORDS


def _header_name(name: str) -> bool:
    words = [w.lower() for w in _SPLIT.split(name) if w]
    return bool(words) and words[-1] == "header"


@dataclass
class Element:
    tag: str
    path: str
    parent: int          # number of the enclosing element, -1 at the top
    noise: bool          # boilerplate, or inside it
    header: bool         # a header, or inside one: only headings count
    box: int = 0         # number of the nearest container, itself included
    score: float = 0.0


#: longest path kept as text; what lies deeper is known by a digest
PATH_CHARS = 1000


def _below(path: str, step: str) -> str:
    if len(path) + len(step) <= PATH_CHARS:
        return path + step
    return "#" + hashlib.md5((path + step).encode()).hexdigest() if step else path


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)   # (element, text, characters in links)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(text)} if text.strip("/ \t\r\n") else {}


@lru_cache(maxsize=None)                # one per name in RAW
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I)


@lru_cache(maxsize=4096)
def _nature(tag: str, rest: str) -> tuple[bool, bool, str]:
    """(boilerplate, header, step of the path) of a start tag."""
    attr = _attributes(rest)
    classes = sorted({re.sub(r"\d+", "", c) for c in attr.get("class", "").split()} - {""})
    step = ">" + ".".join([tag, *classes]) if tag in BLOCK else ""
    if tag in ("html", "body"):
        return False, False, step
    names = [*attr.get("class", "").split(), attr.get("id", "")]
    noise = (tag in NOISE_TAGS or attr.get("role", "").lower() in NOISE_ROLES or "hidden" in attr
             or attr.get("aria-hidden", "").lower() == "true" and tag != "main"
             or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attr.get("style", ""), re.I) is not None
             or tag in BLOCK - TEXT_TAGS and any(map(_noise_name, names if tag not in TITLED else names[:-1])))
    return noise, tag == "header" or tag in BLOCK - HEADING and any(map(_header_name, names)), step


def parse(html: str) -> Page:
    """Blocks of text with the elements they stand in."""
    page = Page()
    els = page.elements
    els.append(Element("", "", -1, False, False))
    stack = [0]
    open_at: dict[str, list[int]] = {}      # tag -> places in the stack, ascending
    block_at = [0]                          # places of the open blocks
    text: list[str] = []
    links = in_link = in_heading = 0

    def flush() -> None:
        nonlocal links
        if text:
            words = " ".join(_html.unescape("".join(text)).split())
            if words:
                page.blocks.append((stack[block_at[-1]], words, min(links, len(words))))
            text.clear()
        links = 0

    def add(piece: str) -> None:
        nonlocal links
        e = els[stack[-1]]
        if piece and not e.noise and (not e.header or in_heading):
            text.append(piece)
            if in_link:
                links += len(piece.strip())

    def push(tag: str, element: Element) -> None:
        nonlocal in_link, in_heading
        els.append(element)
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            block_at.append(len(stack))
        stack.append(len(els) - 1)
        in_link += tag == "a"
        in_heading += tag in HEADING

    def pop_to(depth: int) -> None:
        nonlocal in_link, in_heading
        while len(stack) > depth:
            tag = els[stack.pop()].tag
            open_at[tag].pop()
            if tag in BLOCK:
                block_at.pop()
            in_link -= tag == "a"
            in_heading -= tag in HEADING

    def close(names, within) -> None:
        """End the outermost of the open elements named, above the nearest of ``within``."""
        floor = max((open_at[t][-1] for t in within if open_at.get(t)), default=0)
        above = [places[bisect_right(places, floor)] for places in map(open_at.get, names) if places and places[-1] > floor]
        if above:
            flush()
            pop_to(min(above))

    pos, end, last = 0, len(html), html.rfind(">")
    while pos < end:
        m = _TOKEN.search(html, pos) if pos <= last else None
        if m is None:
            # no tag ends any more: text up to what begins like one
            rest = _OPEN.search(html, pos)
            add(html[pos:rest.start() if rest else end])
            break
        add(html[pos:m.start()])
        pos = m.end()
        slash, name, rest = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                add(_html.escape(m[0][9:].removesuffix("]]>")))
            continue
        tag = name.lower()
        if slash:
            if tag == "br":
                add(" ")
            if open_at.get(tag):
                depth = open_at[tag][-1]
                if tag in BLOCK:
                    flush()
                    pop_to(depth)
                elif block_at[-1] < depth:                  # an inline end tag never ends a block
                    pop_to(depth)
            continue
        if tag in BLOCK:
            flush()
        if tag in CLOSES_P:
            close({"p"}, {"table", "td", "th", "button", "object", "article", "section", "div", "li", "blockquote", "body", "main"})
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag == "br" or tag == "wbr":
            add(" " if tag == "br" else "")
            continue
        if tag in VOID:
            continue
        if tag in RAW:
            stop = _raw_end(tag).search(html, pos)
            pos = stop.end() if stop else end
            continue
        own, header, step = _nature(tag, rest)
        up = els[stack[-1]]
        push(tag, Element(tag, _below(up.path, step), stack[-1], up.noise or own, up.header or header,
                          len(els) if tag in CONTAINER else up.box))
    flush()
    return page


_CREDIT = (1.0, 0.5, 0.25, 0.1)


def score(page: Page) -> None:
    """Give each block's own text to the containers around it."""
    els = page.elements
    for k, words, links in page.blocks:
        if links * 2 > len(words):
            continue
        worth, k = len(words) - links, els[k].box
        for credit in _CREDIT:
            if k <= 0:
                break
            e = els[k]
            e.score += worth * credit * (1.5 if e.tag in ("article", "main") else 1.0)
            k = els[e.parent].box


def votes(html: str) -> list[tuple[str, float]]:
    """(path, share of the best score) of a page's containers."""
    page = parse(html)
    score(page)
    by: dict[str, float] = {}
    for e in page.elements:
        if e.score > 0:
            by[e.path] = by.get(e.path, 0.0) + e.score
    best = max(by.values(), default=0.0)
    return [(p, s / best) for p, s in sorted(by.items())]


def _text_under(page: Page, chosen: set[int]) -> str:
    inside = [False] * len(page.elements)
    for k, e in enumerate(page.elements):
        inside[k] = k in chosen or e.parent >= 0 and inside[e.parent]
    return " ".join(words for k, words, _ in page.blocks if inside[k])


def extract(html: str, path: str | None) -> str:
    """Text of the elements on ``path``, or of the page's own best container."""
    page = parse(html)
    got = _text_under(page, {k for k, e in enumerate(page.elements) if e.path == path and e.tag in CONTAINER}) if path else ""
    if got:
        return got
    score(page)
    best = max(range(len(page.elements)), key=lambda k: (page.elements[k].score, -k))
    return _text_under(page, {best} if page.elements[best].score > 0 else {0})


def host_paths(pages: DataFrame) -> DataFrame:
    """host → winning path."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            sums: dict[tuple[str, str], float] = {}         # summed per batch before the shuffle
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
                for path, share in votes(page or ""):
                    sums[host, path] = sums.get((host, path), 0.0) + share
            yield pa.RecordBatch.from_pydict({
                "host": pa.array([k[0] for k in sums], pa.string()), "path": pa.array([k[1] for k in sums], pa.string()),
                "votes": pa.array(list(sums.values()), pa.float64())})

    found = pages.select(_host().alias("host"), "html").mapInArrow(run, "host string, path string, votes double")
    total = found.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    first = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("votes"), "path"))
    return total.withColumn("place", first).where("place = 1").select("host", "path")


def _host():
    return F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit(""))


def main_text(pages: DataFrame) -> DataFrame:
    """Every page with ``text`` and ``n_chars`` (code points) instead of ``html``."""
    winners = broadcast_if_small(materialise(host_paths(pages), "host-paths"), 400)
    keep = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    schema = T.StructType([pages.schema[c] for c in keep]
                          + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            texts = [extract(h or "", p) for h, p in zip(b.column("__html").to_pylist(), b.column("__path").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*keep, "text", "n_chars"])

    rows = pages.select(*[F.col(f"`{c}`") for c in keep], F.col("html").alias("__html"), _host().alias("__host"))
    best = winners.select(F.col("host").alias("__h"), F.col("path").alias("__path"))
    joined = rows.join(best, F.col("__host") == F.col("__h"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in keep], "__html", "__path").mapInArrow(run, schema)
