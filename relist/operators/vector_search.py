"""Exact top-k cosine search over cells, both sides DataFrames.

Unit vectors are dealt to the nearest of some pivots, a bounded sample of the
corpus; a cell is known by its pivot, its radius (the farthest member) and
its size.  By the triangle inequality no member of a cell is nearer to a
query than the distance to the pivot less the radius.

1. Two upper bounds on a query's k-th best distance are known beforehand: the
   k-th nearest pivot, as pivots are corpus rows, and the reach (distance to
   the pivot plus radius) within which cells hold k vectors.
2. The query visits the cells whose least distance is not beyond the bound.
3. Visits and vectors meet in tiles: cells with many vectors or visitors are
   cut on both sides into parts of some ``tile`` rows, so no task holds more
   than two such parts whatever the size of a cell.  A tile is one matrix
   product; k rows per query leave it.

Nothing runs while the plan is built: pivots and cell statistics (one row
each, bounded by ``cells``) are scalar subqueries that meet packs of vectors,
which are made batch by batch without a shuffle.

Scores are compared at ``EVEN`` digits and ties go to the smaller corpus id,
so equal vectors rank by id wherever they were multiplied.  A zero vector, or
one with a component that is not finite, has no similarity: the score is null
and ranks last, by id.  Rows without a vector take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 1024
#: corpus rows a cell should hold on average
CELL_ROWS = 2048
TILE = 4096
EVEN = 9
#: what rounding may add to a distance
MARGIN = 1e-6
#: vectors of a pack, rows whose distances a task holds at a time, visits that leave it at a time
PACK_ROWS = 1024
BLOCK_ROWS = 256
VISITS = 1024


def _matrix(column) -> np.ndarray:
    """An Arrow column of equally long lists as rows of doubles."""
    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return values.reshape(len(flat), -1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by id."""
    if len(scores) > k:
        level = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= level)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def _vectors(df: DataFrame, ident: str, vec: str) -> DataFrame:
    """(id, v, flat): unit vectors; ``flat`` ones have no direction."""
    rows = df.where(F.col(f"`{vec}`").isNotNull()).select(F.col(f"`{ident}`").alias("id"), F.col(f"`{vec}`").cast("array<double>").alias("x"))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))
    sized = rows.withColumn("norm", norm)
    finite = F.coalesce((F.col("norm") > 0) & (F.col("norm") < float("inf")) & ~F.isnan("norm"), F.lit(False))
    return sized.select("id", F.when(finite, F.transform("x", lambda c: c / F.col("norm"))).alias("v"), (~finite).alias("flat"))


def _packed(rows: DataFrame, id_type: str) -> DataFrame:
    """Rows (id, v) in packs of ``PACK_ROWS`` at most."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for lo in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(lo, PACK_ROWS)
                rows = pa.StructArray.from_arrays(part.columns, names=part.schema.names)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)], names=["rows"])

    return rows.select("id", "v").mapInArrow(run, f"rows array<struct<id: {id_type}, v: array<double>>>")


def _pivots(rows: DataFrame, cells: int, cell_rows: int) -> Column:
    """Up to ``cells`` unit vectors of the corpus: the rows whose hash is a
    multiple of ``cell_rows``, one at least."""
    h = F.xxhash64(F.lit(11), "id")
    sample = rows.select((F.pmod(h, F.lit(cell_rows)) != 0).alias("spare"), h.alias("h"), "v").orderBy("spare", "h").limit(cells)
    listed = sample.agg(F.array_sort(F.collect_list(F.struct("spare", "h", "v"))).alias("s"), F.count_if(~F.col("spare")).alias("n"))
    return listed.select(F.slice("s.v", F.lit(1), F.greatest("n", F.lit(1)).cast("int"))).scalar()


def _deal(packs: DataFrame, pivots: Column, id_type: str) -> DataFrame:
    """(id, v, cell, far): every vector with its nearest pivot."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                rows, piv = batch.column("rows")[i].values, _matrix(batch.column("pivots")[i].values)
                ids, v = rows.field("id"), rows.field("v")
                d = _distances(_matrix(v), piv)          # a pack means a corpus, so there is a pivot
                cell = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([ids, v, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(cell)), cell])],
                                                 names=["id", "v", "cell", "far"])

    return packs.select("rows", pivots.alias("pivots")).mapInArrow(run, f"id {id_type}, v array<double>, cell int, far double")


def _visits(packs: DataFrame, pivots: Column, cells: Column, id_type: str, k: int) -> DataFrame:
    """(id, v, cell): the cells that may hold one of the k nearest of a query."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            for i in range(batch.num_rows):
                rows, known = batch.column("rows")[i].values, batch.column("cells")[i].values
                if not len(known):       # an empty corpus
                    continue
                ids, v = rows.field("id"), rows.field("v")
                x, pivots_ = _matrix(v), _matrix(batch.column("pivots")[i].values)
                cell = known.field("cell").to_numpy(zero_copy_only=False)
                radius, size = (known.field(c).to_numpy(zero_copy_only=False) for c in ("radius", "size"))
                for lo in range(0, len(x), BLOCK_ROWS):
                    every = _distances(x[lo:lo + BLOCK_ROWS], pivots_)
                    d = every[:, cell]
                    reach = d + radius
                    order = np.argsort(reach, axis=1, kind="stable")
                    enough = np.cumsum(size[order], axis=1) >= k
                    last = np.where(enough.any(axis=1), enough.argmax(axis=1), len(cell) - 1)
                    at = np.arange(len(d))
                    bound = reach[at, order[at, last]]
                    bound[~enough.any(axis=1)] = np.inf
                    if every.shape[1] >= k:
                        bound = np.minimum(bound, np.partition(every, k - 1, axis=1)[:, k - 1])
                    q, c = np.nonzero(d - radius <= bound[:, None] + MARGIN)
                    for at in range(0, len(q), VISITS):       # a visit carries its vector
                        own = pa.array(q[at:at + VISITS] + lo)
                        yield pa.RecordBatch.from_arrays([ids.take(own), v.take(own), pa.array(cell[c[at:at + VISITS]], pa.int32())], names=["id", "v", "cell"])

    return (packs.select("rows", pivots.alias("pivots"), cells.alias("cells"))
            .mapInArrow(run, f"id {id_type}, v array<double>, cell int"))


def _scored(visits: DataFrame, dealt: DataFrame, sizes: DataFrame, k: int, tile: int, types: tuple[str, str]) -> DataFrame:
    """(q, c, s): the k best of every tile for each of its visitors."""
    asked = visits.groupBy("cell").agg(F.count("*").alias("visitors"))
    cut = sizes.join(asked, "cell").select("cell", F.expr(f"size div {tile} + 1").alias("parts"), F.expr(f"visitors div {tile} + 1").alias("shares"))
    part, share = F.pmod(F.xxhash64(F.lit(13), "id"), F.col("parts")), F.pmod(F.xxhash64(F.lit(17), "id"), F.col("shares"))

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    # one row per cell, at most ``cells``
    left = visits.join(F.broadcast(cut), "cell").select("cell", share.alias("share"), every("parts").alias("part"), F.col("id").alias("q"), "v")
    right = dealt.join(F.broadcast(cut), "cell").select("cell", part.alias("part"), every("shares").alias("share"), F.col("id").alias("c"), "v")

    def run(a, b):
        import pyarrow as pa
        if not a.num_rows or not b.num_rows:
            return pa.table({"q": pa.array([], a.schema.field("q").type), "c": pa.array([], b.schema.field("c").type), "s": pa.array([], pa.float64())})
        ids = np.array(b.column("c").to_pylist())
        x, y = _matrix(a.column("v")), _matrix(b.column("v")).T
        picked, scores = [], []
        for lo in range(0, len(x), BLOCK_ROWS):
            for row in np.round(x[lo:lo + BLOCK_ROWS] @ y, EVEN):
                picked.append(_best(row, ids, k))
                scores.append(row[picked[-1]])
        q = np.repeat(np.arange(len(picked)), [len(p) for p in picked])
        c = np.concatenate(picked)
        return pa.table({"q": a.column("q").take(pa.array(q)), "c": b.column("c").take(pa.array(c)), "s": pa.array(np.concatenate(scores))})

    keys = ("cell", "share", "part")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, f"q {types[0]}, c {types[1]}, s double")


def _first(rows: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.col("s").desc_nulls_last(), "c")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def search(queries: DataFrame, corpus: DataFrame, k: int, qid: str, qvec: str, cid: str, cvec: str,
           cells: int = CELLS, cell_rows: int = CELL_ROWS, tile: int = TILE) -> DataFrame:
    """(q, c, s, rank): the k nearest corpus rows of every query."""
    types = dict(queries.dtypes)[qid], dict(corpus.dtypes)[cid]
    asked, known = _vectors(queries, qid, qvec), _vectors(corpus, cid, cvec)
    lively = known.where("not flat")
    pivots = _pivots(lively, cells, cell_rows)
    dealt = _deal(_packed(lively, types[1]), pivots, types[1])
    sizes = dealt.groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("size"))
    listed = sizes.agg(F.array_sort(F.collect_list(F.struct("cell", "radius", "size")))).scalar()
    visits = _visits(_packed(asked.where("not flat"), types[0]), pivots, listed, types[0], k)
    found = _scored(visits, dealt, sizes, k, tile, types)
    # of the vectors without a direction the k smallest ids can matter, and to a query without one all vectors are alike
    ends = known.select("flat", F.col("id").alias("c"))
    flat, any_row = (e.orderBy("c").limit(k).agg(F.array_sort(F.collect_list("c"))).scalar() for e in (ends.where("flat"), ends))
    beside = asked.select(F.col("id").alias("q"), F.explode(F.when(F.col("flat"), any_row).otherwise(flat)).alias("c"),
                          F.lit(None).cast("double").alias("s"))
    return _first(found.unionByName(beside), k)


def topk_similar(queries: DataFrame, corpus: DataFrame, k: int = 3, qid: str = "qid", qvec: str = "qvec", cid: str = "cid",
                 cvec: str = "vec", digits: int = 4, **layout) -> DataFrame:
    """Exact top-k cosine neighbours in ``corpus`` for each query vector:
    (qid, cid, score, rank).  ``layout``: ``cells``, ``cell_rows``, ``tile``."""
    found = search(queries, corpus, k, qid, qvec, cid, cvec, **layout)
    return found.select(F.col("q").alias(qid), F.col("c").alias(cid), F.round("s", digits).alias("score"), "rank")


def match_to_corpus(queries: DataFrame, corpus: DataFrame, k: int = 3, qid: str = "qid", qvec: str = "qvec", cid: str = "cid",
                    cvec: str = "vec", digits: int = 4, **layout) -> DataFrame:
    """Batch matching of many query vectors (every listing, say) against a
    catalog: one row per match, (qid, rank, cid, score)."""
    return topk_similar(queries, corpus, k, qid, qvec, cid, cvec, digits, **layout).select(qid, "rank", cid, "score")
