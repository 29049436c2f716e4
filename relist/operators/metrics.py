"""Market metrics over cleaned/gold listings.

Each metric is ``metric(listings, **params) -> DataFrame``.  Grouped results
are computed with partial (map-side) aggregation; grand totals needed for
shares come from a scalar subquery (``DataFrame.scalar()``), never from a
global window over the input rows, so no step funnels the data through one
task.  Windows appear only over already-aggregated, bounded results
(bands, sources).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.bitmaps import distinct_count
from ..functions.clean import discount_pct, mixed_timestamp, share_pct
from ..functions.geo import city_label


def _price_ok():
    return F.col("price").isNotNull() & (F.col("price") > 0) & (F.col("price") < 500)


def _avg_under_500() -> Column:
    return F.round(F.avg(F.when(F.col("price") < 500, F.col("price"))), 2)


def _never_worn_sum() -> Column:
    return F.sum(F.when(F.col("is_never_worn"), 1).otherwise(0)).cast("bigint")


def _sum_of(agg: DataFrame, col: str) -> Column:
    """Grand total from an aggregate whose groups partition the input, as a
    scalar subquery over the aggregate (for results with many groups)."""
    return agg.select(F.sum(col)).scalar()


def _band_total(col: str) -> Column:
    """Grand total over an aggregated result with a small, fixed number of
    groups (bands, labels, allow-listed sources): a window over those few
    rows, no second pass over the input."""
    return F.sum(col).over(Window.partitionBy())


def category_stats(listings: DataFrame, rules=C.CATEGORY_RULES,
                   default=C.CATEGORY_DEFAULT) -> DataFrame:
    """Per category: listings, avg price (< 500), never-worn count."""
    return (listings
            .select(C.category(F.col("title"), rules, default).getField("label").alias("category"),
                    "price", "is_never_worn")
            .groupBy("category")
            .agg(F.count(F.lit(1)).alias("count"), _avg_under_500().alias("avg_price"),
                 _never_worn_sum().alias("never_worn")))


def source_stats(listings: DataFrame) -> DataFrame:
    """Per source: total, avg price, never-worn count and their shares."""
    agg = (listings.groupBy("source")
           .agg(F.count(F.lit(1)).alias("total"), _avg_under_500().alias("avg_price"),
                _never_worn_sum().alias("never_worn")))
    return (agg
            .withColumn("share_pct", share_pct(F.col("total"), _band_total("total")))
            .withColumn("never_worn_pct", share_pct(F.col("never_worn"), F.col("total"))))


def popular_items(listings: DataFrame, min_count: int = 2, k: int = 20) -> DataFrame:
    """Most repeated (title, source) with more than ``min_count`` listings; top k."""
    return (listings.filter(F.col("price").isNotNull() & (F.col("price") < 500))
            .groupBy("title", "source")
            .agg(F.count(F.lit(1)).alias("occurrences"), _avg_under_500().alias("avg_price"))
            .filter(F.col("occurrences") > min_count)
            .orderBy(F.col("occurrences").desc(), F.col("title"), F.col("source"))
            .limit(k))


def top_expensive(listings: DataFrame, k: int = 10) -> DataFrame:
    """Top k priced listings in the 0 < price < 500 band (ties by source, id)."""
    return (listings.filter(_price_ok())
            .select("source", "title", "price", "url", "location",
                    F.col("external_id").alias("seller_id"))
            .orderBy(F.col("price").desc(), F.col("source"), F.col("seller_id"))
            .limit(k))


def price_histogram(listings: DataFrame, bands=C.PRICE_BANDS) -> DataFrame:
    """Price bands with count, share and cumulative share (e.g. 'under 10')."""
    ok = listings.filter(_price_ok())
    b = C.bucketize(F.col("price"), bands)
    agg = (ok.select(b.getField("label").alias("price_range"), b.getField("ord").alias("sort_order"))
           .groupBy("price_range", "sort_order").agg(F.count(F.lit(1)).alias("cnt")))
    total = _band_total("cnt")
    running = Window.orderBy("sort_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (agg.withColumn("pct", share_pct(F.col("cnt"), total))
               .withColumn("cum_pct", share_pct(F.sum("cnt").over(running), total)))


def price_range(value: Column) -> Column:
    """Number of the range a value falls into: ranges grow with the value
    (about 0.3 % each, some 2,300 below 500) and never fall with it."""
    return F.floor(F.signum(value) * F.log2(F.abs(value) + 1) * 256).cast("int")


def exact_median(counts: DataFrame, group: str, value: str = "price", n: str = "n") -> DataFrame:
    """(group, cnt, median): the exact, interpolated median of ``value`` per
    group, from ``counts`` (group, value, n), a row per distinct value.

    A first pass counts the ranges of a group and finds the one or two that
    hold the middle ranks; a second one sorts the values of these only, so a
    task holds one range and never the values of a whole group.  ``counts`` is
    read twice, as one exchange; null groups are a group."""
    rows = counts.where(F.col(value).isNotNull()).select(F.col(group).alias("_g"), F.col(value).alias("_v"), F.col(n).alias("_n"))
    ranged = rows.withColumn("_r", price_range(F.col("_v")))
    whole = Window.partitionBy("_g")
    before = Window.partitionBy("_g").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    hist = ranged.groupBy("_g", "_r").agg(F.sum("_n").alias("_c")).select(
        "_g", "_r", "_c", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_before"), F.sum("_c").over(whole).alias("_total"))

    def holds(rank: str, start: Column, size: Column) -> Column:
        return (start <= F.expr(rank)) & (F.expr(rank) < start + size)

    low, high = "(_total - 1) div 2", "_total div 2"
    start, size = F.col("_before"), F.col("_c")
    middle = hist.where(holds(low, start, size) | holds(high, start, size))
    inside = Window.partitionBy("_g", "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    same = (F.col("a._g").eqNullSafe(F.col("b._g"))) & (F.col("a._r") == F.col("b._r"))
    near = ranged.alias("a").join(middle.alias("b"), same).select("a._g", "a._r", "_v", "_n", "_before", "_total")
    near = near.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    start, size = F.col("_at"), F.col("_n")
    return (near.groupBy("_g").agg(F.max("_total").alias("cnt"),
                                   ((F.max(F.when(holds(low, start, size), F.col("_v"))) + F.max(F.when(holds(high, start, size), F.col("_v")))) / 2).alias("median"))
            .select(F.col("_g").alias(group), "cnt", "median"))


def never_worn_median(listings: DataFrame) -> DataFrame:
    """Exact (interpolated) median price by never-worn flag."""
    counts = (listings.filter(_price_ok()).groupBy("is_never_worn", F.col("price").cast("double").alias("price"))
              .agg(F.count(F.lit(1)).alias("n")))
    return exact_median(counts, "is_never_worn").withColumnRenamed("median", "median_price")


def never_worn_premium(listings: DataFrame, nw_default: float = 8.0, used_default: float = 5.0,
                       share_default: float = 17.0, premium_default: float = 60.0) -> DataFrame:
    """One row: medians, never-worn share, premium % and uplift, with the
    dashboard defaults when a side is missing."""
    counts = (listings.filter(_price_ok()).groupBy(F.coalesce(F.col("is_never_worn"), F.lit(False)).alias("nw"), F.col("price").cast("double").alias("price"))
              .agg(F.count(F.lit(1)).alias("n")))
    per_side = exact_median(counts, "nw")
    row = per_side.agg(
        F.max(F.when(F.col("nw"), F.col("median"))).alias("nw_median_raw"),
        F.max(F.when(~F.col("nw"), F.col("median"))).alias("used_median_raw"),
        F.coalesce(F.max(F.when(F.col("nw"), F.col("cnt"))), F.lit(0)).alias("nw_cnt"),
        F.coalesce(F.max(F.when(~F.col("nw"), F.col("cnt"))), F.lit(0)).alias("used_cnt"))
    nw = F.when(F.col("nw_cnt") > 0, F.col("nw_median_raw")).otherwise(F.lit(nw_default))
    used = F.when(F.col("used_cnt") > 0, F.col("used_median_raw")).otherwise(F.lit(used_default))
    total = F.col("nw_cnt") + F.col("used_cnt")
    return row.select(
        nw.alias("nw_median"), used.alias("used_median"), "nw_cnt", "used_cnt",
        F.round(F.when(total > 0, F.col("nw_cnt") / total * 100).otherwise(F.lit(share_default)), 4).alias("nw_share"),
        F.round(F.when(used > 0, (nw / used - 1) * 100).otherwise(F.lit(premium_default)), 4).alias("premium_pct"),
        F.round(nw - used, 4).alias("uplift"))


def top_cities(listings: DataFrame, k: int = 12) -> DataFrame:
    """Top k city labels among located, priced listings, with share of all of them."""
    located = listings.filter(F.col("location").isNotNull() & (F.trim(F.col("location")) != "")
                              & F.col("price").isNotNull() & (F.col("price") > 0))
    per_city = (located.groupBy(city_label(F.col("location")).alias("city"))
                .agg(F.count(F.lit(1)).alias("cnt")))
    top = per_city.orderBy(F.col("cnt").desc(), F.col("city")).limit(k)
    total = F.lit(_sum_of(per_city, "cnt"))
    # rank and top-5 share over the k result rows only (bounded window)
    rank = F.row_number().over(Window.orderBy(F.col("cnt").desc(), F.col("city")))
    return (top.withColumn("share_pct", share_pct(F.col("cnt"), total))
               .withColumn("_rk", rank)
               .withColumn("top5_share_pct", share_pct(
                   F.sum(F.when(F.col("_rk") <= 5, F.col("cnt"))).over(Window.partitionBy()), total))
               .drop("_rk"))


def age_histogram(listings: DataFrame, as_of=None, bands=C.AGE_BANDS, unknown: bool = False) -> DataFrame:
    """Listing age bands (days from publication to ``as_of``); unparsable
    dates fall into the last band.  ``as_of=None`` measures against the
    latest publication day in the data.  With ``unknown``, listings without a
    readable date (or any) are a band of that name behind the others.

    One pass over the listings: counts per publication day (a calendar-
    bounded aggregate), then the reference day, bands and shares are
    computed on those few daily rows."""
    src = listings if unknown else listings.filter(F.col("published_at").isNotNull())
    daily = (src.groupBy(F.to_date(_timestamp(src, "published_at")).alias("day"))
             .agg(F.count(F.lit(1)).alias("n")))
    ref = (F.max("day").over(Window.partitionBy()) if as_of is None
           else (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date"))
    b = C.bucketize(F.datediff(ref, F.col("day")), bands, inclusive=True)
    if unknown:
        none = F.struct(F.lit(len(bands) + 1).alias("ord"), F.lit("unknown").alias("label"))
        b = F.when(F.col("day").isNull(), none).otherwise(F.struct(b.getField("ord").alias("ord"), b.getField("label").alias("label")))
    old = F.col("sort_order").between(4, len(bands))
    agg = (daily.select(b.getField("label").alias("age_bucket"), b.getField("ord").alias("sort_order"), "n")
           .groupBy("age_bucket", "sort_order").agg(F.sum("n").alias("cnt")))
    bands_w = Window.partitionBy()
    # fresh = share of the first band, old = shares of the bands from the
    # fourth on (sums of the rounded shares, as displayed)
    return (agg.withColumn("pct", share_pct(F.col("cnt"), _band_total("cnt")))
               .withColumn("fresh_pct", F.coalesce(F.max(F.when(F.col("sort_order") == 1, F.col("pct")))
                                                    .over(bands_w), F.lit(0.0)))
               .withColumn("old_pct", F.round(F.coalesce(F.sum(F.when(old, F.col("pct")))
                                                         .over(bands_w), F.lit(0.0)), 4)))


def seller_profiles(listings: DataFrame, bands=C.SELLER_BANDS) -> DataFrame:
    """Two-level aggregate: listings per (location, source) = one seller,
    then sellers and mean listings per activity band."""
    sellers = (listings.filter(F.col("location").isNotNull() & (F.col("location") != ""))
               .groupBy("location", "source").agg(F.count(F.lit(1)).alias("listing_count")))
    b = C.bucketize(F.col("listing_count"), bands, inclusive=True)
    agg = (sellers.select(b.getField("label").alias("profile"), b.getField("ord").alias("sort_order"),
                          "listing_count")
           .groupBy("profile", "sort_order")
           .agg(F.count(F.lit(1)).alias("seller_count"),
                F.round(F.avg("listing_count"), 1).alias("avg_listings")))
    return agg.withColumn("seller_pct", share_pct(F.col("seller_count"), _band_total("seller_count")))


def condition_histogram(listings: DataFrame, rules=C.CONDITION_RULES,
                        default=C.CONDITION_DEFAULT) -> DataFrame:
    c = C.condition(F.col("title"), F.col("description"), rules, default)
    agg = (listings.select(c.getField("label").alias("condition_label"),
                           c.getField("ord").alias("sort_order"), "price")
           .groupBy("condition_label", "sort_order")
           .agg(F.count(F.lit(1)).alias("cnt"), _avg_under_500().alias("avg_price")))
    return agg.withColumn("pct", share_pct(F.col("cnt"), _band_total("cnt")))


def category_deep(listings: DataFrame, category: str | None = None, rules=C.CATEGORY_RULES,
                  default=C.CATEGORY_DEFAULT, bands=C.PRICE_BANDS) -> DataFrame:
    """Price band × source counts, optionally for one category (a column
    predicate, not string interpolation)."""
    df = listings.filter(_price_ok())
    if category is not None:
        df = df.filter(C.category(F.col("title"), rules, default).getField("label") == F.lit(category))
    b = C.bucketize(F.col("price"), bands)
    return (df.select(b.getField("label").alias("price_range"), b.getField("ord").alias("sort_order"),
                      "source")
            .groupBy("price_range", "sort_order", "source").agg(F.count(F.lit(1)).alias("cnt")))


def _timestamp(df: DataFrame, name: str):
    """The column itself if it is a timestamp already, else its text parsed."""
    c = F.col(name)
    return c if dict(df.dtypes)[name].startswith("timestamp") else mixed_timestamp(c)


def weekly_trend(listings: DataFrame, ts_col: str = "published_at") -> DataFrame:
    """Listings per (Monday-start week, source); undated rows dropped."""
    week = F.date_trunc("WEEK", _timestamp(listings, ts_col))
    return (listings.select(week.alias("week"), "source").filter(F.col("week").isNotNull())
            .groupBy("week", "source").agg(F.count(F.lit(1)).alias("cnt")))


def bulk_stats(listings: DataFrame) -> DataFrame:
    return (listings.filter(_price_ok())
            .groupBy(C.is_bulk(F.col("title")).alias("is_bulk"))
            .agg(F.count(F.lit(1)).alias("cnt"), F.round(F.avg("price"), 4).alias("avg_price")))


def headline_kpis(listings: DataFrame) -> DataFrame:
    """Single row of headline numbers.

    The listings are read once and summed up per (source, location, price);
    everything else comes from these sums: averages, the exact median and the
    distinct sources and places, counted by bitmaps over their dictionaries."""
    price = F.col("price").cast("double")
    sums = (listings.filter(_price_ok()).groupBy("source", "location", price.alias("price"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(C.is_bulk(F.col("title")).cast("int")).alias("bulk"),
                 F.sum(F.coalesce(F.col("is_never_worn"), F.lit(False)).cast("int")).alias("worn"), F.count("latitude").alias("located")))
    prices = sums.groupBy(F.lit(0).alias("all"), "price").agg(F.sum("n").alias("n"))
    total = F.sum("n")
    return sums.agg(
        F.coalesce(total, F.lit(0)).alias("rows"),
        F.round(F.sum(F.col("price") * F.col("n")) / total, 4).alias("avg_price"),
        F.round(F.sum("bulk") / total * 100, 4).alias("bulk_pct"),
        F.round(F.sum("worn") / total * 100, 4).alias("never_worn_pct"),
        F.coalesce(F.sum("located"), F.lit(0)).alias("located_rows")).select(
        "rows", distinct_count(sums, "source").alias("sources"), "avg_price", "bulk_pct", "never_worn_pct", "located_rows",
        distinct_count(sums, "location").alias("unique_locations"),
        exact_median(prices, "all").select("median").scalar().alias("median_price"))


def retail_price(category: Column, prices: dict[str, float] = C.RETAIL_PRICES,
                 default: float = C.RETAIL_PRICE_DEFAULT) -> Column:
    """Category → retail price lookup as a literal map (no join needed)."""
    m = F.create_map(*[x for k, v in prices.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(F.try_element_at(m, category), F.lit(default))


def category_discounts(listings: DataFrame) -> DataFrame:
    """Discount vs new retail price per category, with tier counts."""
    cat = C.category(F.col("title")).getField("label")
    df = (listings.filter(_price_ok())
          .select(cat.alias("category"), "price")
          .withColumn("retail_price", retail_price(F.col("category")))
          .withColumn("discount_pct", discount_pct(F.col("price"), F.col("retail_price")))
          .withColumn("tier", C.discount_tier(F.col("discount_pct"))))
    return (df.groupBy("category", "tier")
            .agg(F.count(F.lit(1)).alias("cnt"),
                 F.round(F.avg("discount_pct"), 4).alias("avg_discount_pct"),
                 F.max("retail_price").alias("retail_price")))
