"""Ordered rule classifiers and band bucketizers.

``classify`` and ``bucketize`` build one CASE expression that yields a
``struct<ord int, label string>`` so the label and its sort order come from a
single evaluation.  Rule lists are data; the defaults below are the market's
fixed vocabularies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as listed: labels, patterns, order, bounds).
# ---------------------------------------------------------------------------

# Garment category: first matching rule wins, matched on lower(title).
CATEGORY_RULES: list[tuple[str, str]] = [
    ("Lot / Bundle", "lot de|lot [0-9]|pack de|[0-9]+ pièces|[0-9]+ articles|x[0-9]"),
    ("Bébé", "bébé|bebe|naissance|nouveau.né|0.mois|3.mois|6.mois|12.mois|18.mois"),
    ("Chaussures", "chaussure|basket|botte|sandale|sneaker|espadrille"),
    ("Vestes & Manteaux", "veste|manteau|blouson|anorak|doudoune|parka"),
    ("Robes & Jupes", "robe|jupe|combinaison"),
    ("Pantalons & Jeans", "jean|pantalon|legging|short|bermuda|jogging|cargo"),
    ("Hauts & Pulls", "t-shirt|tshirt|polo|top|débardeur|chemise|pull|sweat|gilet|hoodie"),
    ("Accessoires", "sac|bonnet|écharpe|gants|ceinture|chapeau|casquette|collant"),
    ("Sous-vêt. & Nuit", "pyjama|sous.vête|lingerie|boxer|slip"),
    ("Sport", "sport|yoga|running|fitness"),
]
CATEGORY_DEFAULT = "Vêtements divers"

# Condition: matched on lower(title || ' ' || description), first match wins.
CONDITION_RULES: list[tuple[str, str]] = [
    ("Never Worn / New with Tags",
     "jamais port|neuf avec .tiquette|never worn|sans .tiquette|neuf complet|brand new"),
    ("Very Good Condition", "tr.s bon .tat|very good|parfait .tat|excellent .tat|impeccable"),
    ("Good Condition", "bon .tat|good condition|propre|bien entretenu"),
    ("Fair / Minor Defects", ".tat correct|acceptable|satisfaisant|petits d.fauts|l.ger"),
    ("Worn / Defects", "us.|worn|tach|trace|imperfection|abim|marqu"),
]
CONDITION_DEFAULT = "Condition Not Specified"

# Never-worn flag over lower(title || ' ' || description).
NEVER_WORN_PATTERN = (
    r"(?i)(\bneuf\b|\bneuve\b|jamais porté|jamais porte|never worn|neuf avec étiquette|"
    r"jamais utilisé|jamais utilise|sans port\b|avec étiquette)"
)

# Bulk / lot listing flag over lower(title).
BULK_PATTERN = "lot de|lot [0-9]|pack de|[0-9]+ pièces|[0-9]+ articles"

# Price bands: value < upper bound; None = open-ended last band.
PRICE_BANDS: list[tuple[float | None, str]] = [
    (5, "0–5€"), (10, "5–10€"), (15, "10–15€"), (20, "15–20€"), (30, "20–30€"), (None, "30€+"),
]

# Listing age in days: value <= upper bound.
AGE_BANDS: list[tuple[float | None, str]] = [
    (7, "0–7 days"), (30, "8–30 days"), (90, "31–90 days"), (180, "91–180 days"),
    (None, "180+ days"),
]

# Seller activity by listings per seller: value <= upper bound.
SELLER_BANDS: list[tuple[float | None, str]] = [
    (1, "Occasional (1 listing)"), (5, "Regular (2–5)"), (20, "Active (6–20)"),
    (None, "Power seller (21+)"),
]

# Approximate new retail price per category (EUR); 12.0 when unknown.
RETAIL_PRICES: dict[str, float] = {
    "Pantalons & Jeans": 16.0, "Hauts & Pulls": 9.0, "Bébé": 14.0,
    "Lot / Bundle": 25.0, "Robes & Jupes": 12.0, "Vestes & Manteaux": 24.0,
    "Sous-vêt. & Nuit": 8.0, "Chaussures": 16.0, "Accessoires": 8.0,
    "Sport": 14.0, "Vêtements divers": 12.0,
}
RETAIL_PRICE_DEFAULT = 12.0

# Listing sources admitted to the cleaned layer.
LISTING_SOURCES = ("leboncoin", "vinted", "ebay", "label_emmaus", "vestiaire")
MANUAL_SOURCES = ("ebay", "vestiaire")

# ---------------------------------------------------------------------------


def _label(ord_: int, label: str) -> Column:
    return F.struct(F.lit(ord_).alias("ord"), F.lit(label).alias("label"))


def classify(text: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """First rule whose regex matches ``text`` → struct(ord, label).

    ``ord`` is the 1-based rule position, ``len(rules)+1`` for the default.
    A null text falls to the default (null never matches).
    """
    expr = None
    for i, (label, pattern) in enumerate(rules, start=1):
        cond = F.coalesce(rlike_fast(text, pattern), F.lit(False))
        expr = F.when(cond, _label(i, label)) if expr is None else expr.when(cond, _label(i, label))
    dflt = _label(len(rules) + 1, default)
    return dflt if expr is None else expr.otherwise(dflt)


def bucketize(x: Column, bounds: Sequence[tuple[float | None, str]],
              inclusive: bool = False) -> Column:
    """Half-open (``x < b``) or closed (``x <= b``) bands → struct(ord, label).

    The band with bound None is the catch-all (also taken by null ``x``,
    as a SQL CASE would).
    """
    expr = None
    fallback = None
    for i, (b, label) in enumerate(bounds, start=1):
        if b is None:
            fallback = _label(i, label)
            continue
        cond = (x <= F.lit(b)) if inclusive else (x < F.lit(b))
        expr = F.when(cond, _label(i, label)) if expr is None else expr.when(cond, _label(i, label))
    if fallback is None:
        return expr
    return expr.otherwise(fallback)


def combined_text(title: Column, description: Column) -> Column:
    """lower(title || ' ' || description) with nulls as empty strings."""
    return F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit(" "),
                            F.coalesce(description, F.lit(""))))


def category(title: Column, rules=CATEGORY_RULES, default=CATEGORY_DEFAULT) -> Column:
    return classify(F.lower(title), rules, default)


def condition(title: Column, description: Column, rules=CONDITION_RULES,
              default=CONDITION_DEFAULT) -> Column:
    return classify(combined_text(title, description), rules, default)


def never_worn(title: Column, description: Column, pattern: str = NEVER_WORN_PATTERN) -> Column:
    return F.coalesce(rlike_fast(combined_text(title, description), pattern), F.lit(False))


def is_bulk(title: Column, pattern: str = BULK_PATTERN) -> Column:
    return F.coalesce(rlike_fast(F.lower(title), pattern), F.lit(False))


def discount_tier(pct: Column) -> Column:
    return F.when(pct > 50, F.lit("high")).when(pct > 25, F.lit("medium")).otherwise(F.lit("low"))


_META = set(".^$*+?{}[]()|\\")


def _alternatives(pattern: str) -> list[str] | None:
    """Top-level alternatives of ``pattern`` (one enclosing group and a
    leading inline-flag group are unwrapped); None if it cannot be split."""
    p = pattern
    if p.startswith("(?i)"):
        p = p[4:]
    if p.startswith("(") and p.endswith(")") and not p.startswith("(?"):
        depth = 0
        for i, ch in enumerate(p):
            depth += ch == "("
            depth -= ch == ")"
            if depth == 0 and i < len(p) - 1:
                break
        else:
            p = p[1:-1]
    alts, depth, cls, cur, i = [], 0, False, "", 0
    while i < len(p):
        ch = p[i]
        if ch == "\\":
            cur += p[i:i + 2]
            i += 2
            continue
        if cls:
            cls = ch != "]"
        elif ch == "[":
            cls = True
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "|" and depth == 0:
            alts.append(cur)
            cur = ""
            i += 1
            continue
        cur += ch
        i += 1
    alts.append(cur)
    return None if depth or cls else alts


def _longest_literal(alt: str) -> str:
    """Longest run of characters the alternative must match literally."""
    best, run, i = "", "", 0
    while i < len(alt):
        ch = alt[i]
        if ch in "*?{":              # the previous character is optional
            run = run[:-1]
            best, run = max(best, run, key=len), ""
        elif ch == "+":              # previous character required, run ends
            best, run = max(best, run, key=len), ""
        elif ch == "\\" or ch in _META:
            best, run = max(best, run, key=len), ""
            if ch == "\\":
                i += 1
            elif ch == "[":
                while i < len(alt) and alt[i] != "]":
                    i += 1
            elif ch == "(":
                return max(best, key=len) if best else ""   # nested groups: stop here
        else:
            run += ch
        i += 1
    return max(best, run, key=len)


def required_literals(pattern: str) -> list[str] | None:
    """For an alternation of mostly literal words, one substring per
    alternative that any match must contain (None when some alternative has
    no literal part).  Used only as a cheap necessary pre-check."""
    alts = _alternatives(pattern)
    if not alts:
        return None
    lits = [_longest_literal(a).lower() for a in alts]
    return None if any(len(x) < 2 for x in lits) else sorted(set(lits))


def rlike_fast(text: Column, pattern: str) -> Column:
    """``text rlike pattern`` with a substring pre-check: the regex runs only
    on rows whose lower-cased text contains one of the literals every match
    needs, so rows no alternative could match cost a few ``contains`` calls.
    Same result as the plain ``rlike``."""
    lits = required_literals(pattern)
    if not lits:
        return text.rlike(pattern)
    low = F.lower(text)
    pre = None
    for lit in lits:
        c = low.contains(lit)
        pre = c if pre is None else (pre | c)
    return pre & text.rlike(pattern)
