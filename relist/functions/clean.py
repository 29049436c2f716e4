"""Column builders for cleaning: strings, safe casts, prices, timestamps,
shares and display helpers.  All are built-in expressions (codegen, no
Python worker)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_string(c: Column) -> Column:
    """null → '' → trimmed string."""
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def safe_long(c: Column) -> Column:
    return c.try_cast("bigint")


def coalesce_existing(df: DataFrame, names: Sequence[str], default=None) -> Column:
    """First non-null among the named columns that exist in ``df``.

    Drifting CSV exports lack some columns; absent names are skipped instead
    of failing analysis.
    """
    present = {c.lower(): c for c in df.columns}
    cols = [F.col(f"`{present[n.lower()]}`").cast("string") for n in names if n.lower() in present]
    if default is not None:
        cols.append(F.lit(default))
    if not cols:
        return F.lit(None).cast("string")
    return cols[0] if len(cols) == 1 else F.coalesce(*cols)


def parse_price(text: Column) -> Column:
    """'64 €' → 64.0, 'US $9.99' → 9.99, '12,50 €' → 12.5.

    ',' and "'" become '.', the first run of digits/dots is cast; anything
    not castable is null (thousands separators are not understood: see
    ``parse_price_locale``)."""
    cleaned = F.regexp_replace(text.cast("string"), r"[,']", ".")
    return F.regexp_extract(cleaned, r"[\d.]+", 0).try_cast("double")


def parse_price_locale(text: Column) -> Column:
    """Price with thousands separators: '1 299,00 €' → 1299.0, '1,299.00' → 1299.0."""
    t = F.regexp_replace(text.cast("string"), r"[\s  ']", "")
    t = F.regexp_extract(t, r"[\d.,]+", 0)
    # decimal separator = the last of ',' / '.' when followed by 1-2 digits
    dec_comma = t.rlike(r",\d{1,2}$")
    t = F.when(dec_comma, F.regexp_replace(F.regexp_replace(t, r"\.", ""), ",", "."))\
         .otherwise(F.regexp_replace(t, ",", ""))
    return t.try_cast("double")


def parse_rating(text: Column, default: str = "0") -> Column:
    return F.regexp_extract(F.coalesce(text.cast("string"), F.lit(default)), r"[\d.]+", 0).try_cast("double")


def mixed_timestamp(c: Column) -> Column:
    """ISO text, epoch-seconds text, or a timestamp → timestamp (null if neither)."""
    s = c.cast("string")
    # 7+ digit strings can never be a timestamp literal (years stop at 6
    # digits), so they skip the failing text parse and go straight to epoch.
    epoch_only = s.rlike(r"^-?[0-9]{7,}$")
    return (F.when(F.length(s) == 0, F.lit(None).cast("timestamp"))
            .when(epoch_only, F.timestamp_seconds(s.try_cast("bigint")))
            .otherwise(F.coalesce(s.try_cast("timestamp"), F.timestamp_seconds(s.try_cast("bigint")))))


# Run-time formats written by the count collectors.
RUN_TS_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'",
                  "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd HH:mm:ss")


def run_timestamp(text: Column, fallback: Column | None = None,
                  formats: Sequence[str] = RUN_TS_FORMATS) -> Column:
    cols = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    if fallback is not None:
        cols.append(fallback)
    return F.coalesce(*cols)


def share_pct(x: Column, total: Column, digits: int = 1) -> Column:
    """Percentage of a total, half-even rounded (as pandas/Python round)."""
    return F.bround(x / total * 100.0, digits)


def discount_pct(price: Column, retail: Column) -> Column:
    """Discount vs retail clamped to 0..99; 0 when there is no price."""
    d = F.bround((F.lit(1.0) - price / retail) * 100.0, 0)
    return F.when(price.isNull() | retail.isNull() | (retail == 0), F.lit(0.0))\
            .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(99.0), d)))


def ordinal(n: Column) -> Column:
    """1 → '1st', 2 → '2nd', 11 → '11th', 23 → '23rd'."""
    suffix = (F.when((n % 100 >= 11) & (n % 100 <= 13), F.lit("th"))
              .when(n % 10 == 1, F.lit("st")).when(n % 10 == 2, F.lit("nd"))
              .when(n % 10 == 3, F.lit("rd")).otherwise(F.lit("th")))
    return F.concat(n.cast("string"), suffix)


def truncate(text: Column, n: int, marker: str = "…") -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit(marker))).otherwise(text)
