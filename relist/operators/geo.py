"""Geo operators: postal centroids, geocoding cascade (postal code →
gazetteer), and exact nearest store by a tree of cells over the sphere.

No Python UDF: everything is joins and built-in expressions.  Work is done
per *distinct* location / coordinate and joined back, so repeated values
(a hot city holding a third of all rows) cost one evaluation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, fold_accents, haversine_km, postal_code
from .containment import contains_join


def postal_centroids(raw: DataFrame, code: str = "code_postal", lat: str = "latitude",
                     lon: str = "longitude") -> DataFrame:
    """Postal file rows (strings, several per code) → (code, avg_lat, avg_lon)."""
    return (raw.select(F.col(code).alias("code_postal"), F.col(lat).try_cast("double").alias("_lat"),
                       F.col(lon).try_cast("double").alias("_lon"))
            .filter(F.col("code_postal").isNotNull() & F.col("_lat").isNotNull())
            .groupBy("code_postal")
            .agg(F.avg("_lat").alias("avg_lat"), F.avg("_lon").alias("avg_lon")))


def gazetteer_frame(spark, entries: Sequence[tuple[str, float, float]]) -> DataFrame:
    """Ordered (name, lat, lon) entries → DataFrame with ``ord`` (list order)."""
    return spark.createDataFrame([(n, float(a), float(b), i) for i, (n, a, b) in enumerate(entries)],
                                 "name string, lat double, lon double, ord int")


def geocode(df: DataFrame, centroids: DataFrame, gazetteer: DataFrame, loc_col: str = "location",
            lat_col: str = "latitude", lon_col: str = "longitude", prefer_source_coords: bool = False) -> DataFrame:
    """Coordinates from free-text location: the 5-digit postal code's
    centroid if known, else the first gazetteer name (in ``ord`` order)
    contained in the accent-folded text, else null.  Existing coordinate
    columns are replaced; with ``prefer_source_coords`` a pair that the source
    gave stays."""
    if prefer_source_coords:
        own = F.when(F.col(lat_col).isNotNull() & F.col(lon_col).isNotNull(), F.struct(F.col(lat_col).alias("lat"), F.col(lon_col).alias("lon")))
        found = geocode(df.withColumn("_own", own), centroids, gazetteer, loc_col, lat_col, lon_col)
        return found.withColumns({lat_col: F.coalesce("_own.lat", lat_col), lon_col: F.when(F.col("_own").isNotNull(), F.col("_own.lon")).otherwise(F.col(lon_col))}) \
            .drop("_own")
    locs = (df.select(F.col(loc_col).alias("_loc"))
            .filter(F.col("_loc").isNotNull() & (F.col("_loc") != "")).distinct()
            .select("_loc", postal_code(F.col("_loc")).alias("_code"),
                    fold_accents(F.col("_loc")).alias("_fold")))
    by_code = (locs.join(centroids.select(F.col("code_postal").alias("_code"), "avg_lat", "avg_lon"),
                         "_code", "left")
               .select("_loc", "_fold", F.col("avg_lat").isNotNull().alias("_hit"), "avg_lat", "avg_lon"))
    gz = gazetteer.select(F.col("name").alias("_gname"), F.col("lat").alias("_glat"),
                          F.col("lon").alias("_glon"), F.col("ord").alias("_gord"))
    hits = contains_join(locs.select("_loc", "_fold"), "_fold", gz, "_gname")
    first = (hits.groupBy("_loc")
             .agg(F.min_by(F.struct(F.col("_glat").alias("lat"), F.col("_glon").alias("lon")),
                           F.col("_gord")).alias("_g")))
    coords = (by_code.join(first, "_loc", "left")
              .select("_loc",
                      F.when(F.col("_hit"), F.col("avg_lat")).otherwise(F.col("_g.lat")).alias("_lat"),
                      F.when(F.col("_hit"), F.col("avg_lon")).otherwise(F.col("_g.lon")).alias("_lon")))
    base = df.drop(lat_col, lon_col)
    told = F.col(loc_col).isNotNull() & (F.col(loc_col) != "")
    named = base.where(told)
    found = (named.join(coords, named[loc_col] == coords["_loc"], "left")
             .withColumnRenamed("_lat", lat_col).withColumnRenamed("_lon", lon_col).drop("_loc"))
    # rows without a location stay out of the join, where they would all share one key
    none = F.lit(None).cast("double")
    return found.unionByName(base.where(~F.coalesce(told, F.lit(False))).withColumns({lat_col: none, lon_col: none}))


# Bits of a cell's coordinates, level by level: the cube around the earth is
# cut into 2**bits cells along each axis (1,600 km, then 400, 100, 25 and 6).
SPHERE_LEVELS = (3, 5, 7, 9, 11)
#: distances are compared rounded to 0.1 km
ROUNDING_KM = 0.1


def _with_cell(rows: DataFrame, lat: str, lng: str, bits: int) -> DataFrame:
    """``rows`` with the cell of the finest level, ``cx``, ``cy``, ``cz``:
    places on the unit sphere in a grid of cubes, so poles and the
    antimeridian are places like any other."""
    phi, lam = F.radians(lat), F.radians(lng)
    axes = {"cx": F.cos(phi) * F.cos(lam), "cy": F.cos(phi) * F.sin(lam), "cz": F.sin(phi)}
    top = (1 << bits) - 1
    return rows.withColumns({c: F.least(F.floor((v + 1) * (1 << (bits - 1))), F.lit(top)).cast("long") for c, v in axes.items()})


def _coarser(cells: DataFrame, shift: int, by: dict[str, str]) -> DataFrame:
    """Distinct cells of a level: the finest coordinates without their last bits."""
    return cells.select(*[F.shiftright(c, shift).alias(name) for c, name in by.items()]).distinct()


def _cell_km(bits: int, farthest: bool) -> Column:
    """Least or greatest great-circle distance between the points of a point
    cell (px, py, pz) and a store cell (sx, sy, sz).  The chord of two points
    is bounded by the gaps between their cubes, and grows with the arc."""
    total = F.lit(0.0)
    for axis in "xyz":
        gap = F.abs(F.col(f"p{axis}") - F.col(f"s{axis}"))
        edge = (gap + 1 if farthest else F.greatest(gap - 1, F.lit(0))) * (2.0 / (1 << bits))
        total = total + edge * edge
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.sqrt(total) / 2, F.lit(1.0)))


def _cell_pairs(points: DataFrame, stores: DataFrame, levels: Sequence[int]) -> DataFrame:
    """(px, py, pz, sx, sy, sz): for every cell of the finest level that holds
    points, the store cells that may hold the nearest store of one of them.

    Both sides descend together.  A point cell keeps a store cell only if its
    least distance is not beyond the best greatest distance of any store cell
    it has (and the rounding), so a level starts from the few pairs the level
    above has left, whatever the number of points and stores."""
    finest = levels[-1]
    pairs = None
    above = 0
    for bits in levels:
        shift = finest - bits
        p = _coarser(points, shift, {"cx": "px", "cy": "py", "cz": "pz"})
        s = _coarser(stores, shift, {"cx": "sx", "cy": "sy", "cz": "sz"})
        up = bits - above
        p = p.select("*", *[F.shiftright(f"p{a}", up).alias(f"_p{a}") for a in "xyz"])
        s = s.select("*", *[F.shiftright(f"s{a}", up).alias(f"_s{a}") for a in "xyz"])
        if pairs is None:      # the first level hangs below one cell, 0
            met = p.join(s, [F.col(f"_p{a}") == F.col(f"_s{a}") for a in "xyz"])
        else:
            met = p.join(pairs, [f"_p{a}" for a in "xyz"]).join(s, [f"_s{a}" for a in "xyz"])
        met = met.select(*[f"p{a}" for a in "xyz"], *[f"s{a}" for a in "xyz"])
        best = F.min(_cell_km(bits, True)).over(Window.partitionBy("px", "py", "pz"))
        kept = met.withColumn("_reach", best).where(_cell_km(bits, False) <= F.col("_reach") + ROUNDING_KM + 1e-6)
        pairs = kept.select(*[F.col(f"{k}{a}").alias(f"_{k}{a}") for k in "ps" for a in "xyz"])
        above = bits
    return pairs.select(*[F.col(f"_{k}{a}").alias(f"{k}{a}") for k in "ps" for a in "xyz"])


def nearest(points: DataFrame, stores: DataFrame, lat: str = "lat", lng: str = "lng",
            store_name: str = "name", store_lat: str = "lat", store_lng: str = "lng",
            levels: Sequence[int] = SPHERE_LEVELS) -> DataFrame:
    """For each row of ``points``: the nearest store (name, km rounded to
    0.1) by haversine distance; ties on the rounded distance go to the first
    store by name; null when the point has no coordinates.

    Points and stores are cells of a tree over the sphere.  Going down the
    levels every point cell drops the store cells that can't hold a nearest
    store; at the end a distinct coordinate is compared with the stores of
    the cells its own cell has left.  Exact, and no level compares all with
    all.  Coordinates outside the usual ranges are taken as angles."""
    finest = levels[-1]
    has_place = F.col(lat).isNotNull() & F.col(lng).isNotNull()
    pts = points.where(has_place).select(F.col(lat).alias("_plat"), F.col(lng).alias("_plng")).distinct()
    st = (stores.select(F.col(store_name).alias("_sname"), F.col(store_lat).alias("_slat"), F.col(store_lng).alias("_slng"))
          .where(F.col("_slat").isNotNull() & F.col("_slng").isNotNull()))
    pts, st = _with_cell(pts, "_plat", "_plng", finest), _with_cell(st, "_slat", "_slng", finest)
    pairs = _cell_pairs(pts, st, levels)
    near = pts.join(pairs, [F.col(f"c{a}") == F.col(f"p{a}") for a in "xyz"]).select("_plat", "_plng", "sx", "sy", "sz")
    cand = near.join(st, [F.col(f"s{a}") == F.col(f"c{a}") for a in "xyz"])
    km = haversine_km(F.col("_plat"), F.col("_plng"), F.col("_slat"), F.col("_slng"), None)
    best = (cand.groupBy("_plat", "_plng")
            .agg(F.min(F.struct(F.bround(km, 1).alias("store_km"), F.col("_sname").alias("store_name"))).alias("_b"))
            .select("_plat", "_plng", "_b.store_name", "_b.store_km"))
    placed = points.where(has_place)
    found = placed.join(best, (placed[lat] == best["_plat"]) & (placed[lng] == best["_plng"]), "left").drop("_plat", "_plng")
    # rows without a place stay out of the join, where they would all share one key
    rest = points.where(~has_place).withColumns({"store_name": F.lit(None).cast("string"), "store_km": F.lit(None).cast("double")})
    return found.unionByName(rest)
