"""Approximate nearest neighbours by inner product: NN-descent and greedy search.

Index.  Equal vectors are one node (its id the smallest ``vec_id``), so a
vector that a third of the rows share costs one node.  A first graph comes
from ``trees`` random partitions: signs against random hyperplanes give
buckets of about ``leaf`` nodes (larger ones are split by a hash), in which
all inner products are taken; a node keeps its best partners and some random
ones, without which groups of near copies would fill each other's lists and
never meet the rest.  NN-descent then joins neighbours of neighbours:
every node gathers the vectors of its ``k`` best neighbours and of the ``k``
best nodes that list it, compares them with one another, and proposes pairs
that beat an end's worst neighbour; the best ``k`` of old and proposed edges
stay.  Rounds go on until few edges change (``settled``).  Scores here use
vectors rounded to 8 bits a component, which a quarter of the traffic suffices
for; every node is indexed, and only the hyperplanes' centre is fitted, on at
most ``sample`` vectors.

Search.  A query starts from its own node's neighbours and keeps a beam of the
``beam`` best nodes met.  In each of ``steps`` Spark joins the ``expand`` best
nodes of the beam not yet expanded hand over their neighbours and the best
``BACK * k`` nodes that list them (a long vector is listed by most nodes).  The nodes left are scored again on the original vectors in
double precision and opened into their rows.

Vectors that are null, zero, of another length than most, or hold a null or
non-finite component take no part, neither as queries nor as candidates.
Repeated rows with one ``vec_id`` count once; rows with a null ``vec_id`` take
no part; ties go to the smaller ``vec_id``; with fewer candidates than
``top`` all are returned; empty tables give an empty result; columns other
than ``vec_id``, ``embedding`` and those of the condition are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

EDGE = "u long, v long, s float"
#: nodes that list a node, of which the best so many times ``k`` are ways back from it
BACK = 4


def _dense(column, dim: int) -> np.ndarray:
    """An Arrow list column of equal lengths as float32[rows, dim]."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(-1, dim)


def _doubles(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _coded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """8-bit components and the scale of each vector."""
    scale = np.abs(v).max(1) / 127
    return np.rint(v / scale[:, None]).astype(np.int8), scale.astype(np.float32)


def _decoded(codes: list[bytes], scales: np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.int8).reshape(len(codes), -1).astype(np.float32) * scales[:, None]


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(nodes: node, vec, code, scale; rows: node, vec_id; dimension)."""
    v = F.col("embedding")
    ok = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = vectors.where("vec_id is not null and embedding is not null").where(ok) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("vec"))
    sizes = usable.groupBy(F.size("vec").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 1
    usable = usable.where(F.size("vec") == dim)
    # components that compare equal hash alike (-0.0 + 0.0 is 0.0)
    plain = F.transform("vec", lambda x: x + F.lit(0.0))
    named = usable.select("vec_id", plain.alias("vec")).select(
        "vec_id", "vec", F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), F.col("vec")).alias("h2"))
    heads = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("node"))
    rows = materialise(named.select("vec_id", "h1", "h2").join(heads, ["h1", "h2"]).select("node", "vec_id").distinct(), "rows")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            code, scale = _coded(_doubles(b.column("vec"), dim))
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("vec"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(scale)],
                names=["node", "vec", "code", "scale"])

    own = named.join(heads.select(F.col("node").alias("vec_id")), "vec_id", "left_semi")
    own = own.select(F.col("vec_id").alias("node"), "vec").dropDuplicates(["node"])
    nodes = materialise(own.mapInArrow(run, "node long, vec array<double>, code binary, scale float"), "nodes")
    return nodes, rows, dim


def _groups(batches: Iterator, names: tuple[str, ...], rows: int = 20_000) -> Iterator:
    """Sorted rows as numpy columns, in stretches that hold whole groups of
    the first column."""
    held: dict = {}

    def join(parts: list):
        return sum(parts, []) if isinstance(parts[0], list) else np.concatenate(parts)

    for b in batches:
        got = {n: (b.column(n).to_pylist() if n == "code" else b.column(n).to_numpy(zero_copy_only=False)) for n in names}
        held = {n: join([held[n], got[n]]) for n in names} if held else got
        key = held[names[0]]
        if len(key) < rows:
            continue
        cut = int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        if cut:
            yield {n: x[:cut] for n, x in held.items()}
            held = {n: x[cut:] for n, x in held.items()}
    if held and len(held[names[0]]):
        yield held


def _edges(u: np.ndarray, v: np.ndarray, s: np.ndarray):
    """Edge rows, each pair once."""
    import pyarrow as pa
    order = np.lexsort((v, u))
    u, v, s = u[order], v[order], s[order]
    new = np.concatenate([[True], (u[1:] != u[:-1]) | (v[1:] != v[:-1])]) if len(u) else np.zeros(0, bool)
    return pa.RecordBatch.from_arrays([pa.array(u[new]), pa.array(v[new]), pa.array(s[new])], names=["u", "v", "s"])


def _best_pairs(ids: np.ndarray, x: np.ndarray, floor: np.ndarray, most: int, chance: int = 0) -> tuple:
    """For every row of a group, its ``most`` best partners above ``floor``
    and ``chance`` random ones; 512 rows at a time, so a group's products never
    lie in memory as a whole."""
    most = min(most, len(ids) - 1)
    u, v, w = [], [], []
    rng = np.random.default_rng([len(ids), int(ids[0]) & 0xFFFFFFFF])
    for lo in range(0, len(ids), 512):
        own = ids[lo:lo + 512]
        s = x[lo:lo + 512] @ x.T
        s[own[:, None] == ids[None, :]] = -np.inf
        at = np.argpartition(-s, most - 1, axis=1)[:, :most]
        if chance:
            at = np.concatenate([at, rng.integers(0, len(ids), (len(own), chance))], axis=1)
        top = np.take_along_axis(s, at, 1)
        ok = (top > floor[lo:lo + 512, None]) & np.isfinite(top)
        u.append(np.broadcast_to(own[:, None], at.shape)[ok])
        v.append(ids[at[ok]])
        w.append(top[ok])
    return np.concatenate(u), np.concatenate(v), np.concatenate(w).astype(np.float32)


def _compare(batches: Iterator, most: int, group: str, has_floor: bool, chance: int = 0) -> Iterator:
    names = (group, "node", "code", "scale") + (("floor",) if has_floor else ())
    for part in _groups(batches, names):
        x = _decoded(part["code"], part["scale"])
        floor = part["floor"] if has_floor else np.full(len(x), -np.inf, np.float32)
        key, ids = part[group], part["node"].astype(np.int64)
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        out = [_best_pairs(ids[a:b], x[a:b], floor[a:b], most, chance) for a, b in zip(cuts, cuts[1:]) if b - a > 1]
        if out:
            yield _edges(*(np.concatenate(c) for c in zip(*out)))


def _top(edges: DataFrame, k: int, by: str = "u") -> DataFrame:
    other = "v" if by == "u" else "u"
    w = Window.partitionBy(by).orderBy(F.desc("s"), other)
    return edges.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).drop("place")


def first_graph(nodes: DataFrame, dim: int, k: int, trees: int, leaf: int, per_tree: int, chance: int, sample: int) -> DataFrame:
    n = nodes.count()
    bits = max(0, ceil(log2(max(n, 1) / leaf)))
    rng = np.random.default_rng(11)
    planes = rng.normal(size=(trees, dim, bits)).astype(np.float32)
    centre = np.zeros(dim, np.float32)
    some = nodes.orderBy(F.xxhash64("node")).limit(sample).select("vec").toPandas()["vec"]
    if len(some):
        centre = np.mean(np.stack(some.to_list()), axis=0, dtype=np.float64).astype(np.float32)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            v = _dense(b.column("vec"), dim) - centre
            for t in range(trees):
                sign = (v @ planes[t] > 0).astype(np.int64)
                bucket = sign @ (1 << np.arange(bits, dtype=np.int64)) * trees + t
                yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(bucket), b.column("code"), b.column("scale")],
                                                 names=["node", "bucket", "code", "scale"])

    dealt = nodes.select("node", "vec", "code", "scale").mapInArrow(run, "node long, bucket long, code binary, scale float")
    dealt = materialise(dealt, "buckets")
    parts = dealt.groupBy("bucket").agg(F.ceil(F.count("*") / (2 * leaf)).alias("parts"))
    split = dealt.join(parts, "bucket").select(
        F.xxhash64("bucket", F.pmod(F.xxhash64("node", "bucket"), F.col("parts"))).alias("part"), "node", "code", "scale")
    pairs = split.repartition("part").sortWithinPartitions("part").mapInArrow(
        lambda b: _compare(b, per_tree, "part", False, chance), EDGE)
    return materialise(_top(pairs.groupBy("u", "v").agg(F.max("s").alias("s")), k), "graph")


def descend(graph: DataFrame, nodes: DataFrame, k: int, rounds: int, settled: float, propose: int) -> DataFrame:
    """NN-descent: rounds of neighbours of neighbours."""
    light = nodes.select("node", "code", "scale")
    for _ in range(rounds):
        back = _top(graph, k, "v").select(F.col("v").alias("x"), F.col("u").alias("node"))
        near = graph.select(F.col("u").alias("x"), F.col("v").alias("node")).unionByName(back).distinct()
        worst = graph.groupBy("u").agg(F.min("s").alias("floor"), F.count("*").alias("n"))
        worst = worst.select(F.col("u").alias("node"), F.when(F.col("n") >= k, F.col("floor"))
                             .otherwise(F.lit(float("-inf"))).cast("float").alias("floor"))
        gathered = near.join(light.join(worst, "node"), "node").select("x", "node", "code", "scale", "floor")
        pairs = gathered.repartition("x").sortWithinPartitions("x").mapInArrow(
            lambda b: _compare(b, propose, "x", True), EDGE)
        # a proposed edge that is there already stays an old one
        both = graph.withColumn("new", F.lit(0)).unionByName(pairs.withColumn("new", F.lit(1)))
        best = both.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
        graph = materialise(_top(best, k), "graph")
        changed, total = graph.agg(F.sum("new"), F.count("*")).head()
        graph = graph.drop("new")
        if not total or changed <= settled * total:
            break
    return graph


NODE, QUERY, PAIR = 0, 1, 2


def _score_blocks(batches: Iterator) -> Iterator:
    """Blocks of node rows, query rows and pair rows → inner products of the
    pairs.  A query's vector travels once to each block it has pairs in."""
    import pyarrow as pa
    for part in _groups(batches, ("block", "kind", "a", "b", "code", "scale")):
        kind, block = part["kind"], part["block"]

        def side(k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            at = np.flatnonzero(kind == k)
            order = np.lexsort((part["a"][at], block[at]))
            at = at[order]
            return block[at], part["a"][at], _decoded([part["code"][i] for i in at], part["scale"][at]) if len(at) else np.zeros((0, 1))

        n_block, n_id, n_vec = side(NODE)
        q_block, q_id, q_vec = side(QUERY)
        pairs = kind == PAIR
        cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        for lo, hi in zip(cuts, cuts[1:]):
            here = block[lo]
            q, node = part["a"][lo:hi][pairs[lo:hi]], part["b"][lo:hi][pairs[lo:hi]]
            nodes, queries = (slice(*np.searchsorted(x, [here, here + 1])) for x in (n_block, q_block))
            for at in range(0, len(q), 50_000):
                qs, ns = q[at:at + 50_000], node[at:at + 50_000]
                x = n_vec[nodes][np.searchsorted(n_id[nodes], ns)]
                y = q_vec[queries][np.searchsorted(q_id[queries], qs)]
                yield pa.RecordBatch.from_arrays([pa.array(qs), pa.array(ns), pa.array(np.einsum("ij,ij->i", x, y).astype(np.float32))],
                                                 names=["q", "node", "s"])


def score_pairs(pairs: DataFrame, nodes: DataFrame, queries: DataFrame, blocks: int) -> DataFrame:
    """(q, node, s) for rows (q, node)."""
    def block(c: str):
        return F.pmod(F.xxhash64(c), F.lit(blocks)).alias("block")

    none, nil = F.lit(None).cast("binary").alias("code"), F.lit(0.0).cast("float").alias("scale")
    zero = F.lit(0).cast("long").alias("b")
    sided = pairs.select(block("node"), F.lit(PAIR).alias("kind"), F.col("q").alias("a"), F.col("node").alias("b"), none, nil)
    needed = pairs.select(block("node"), "q").distinct().join(queries, "q").select(
        "block", F.lit(QUERY).alias("kind"), F.col("q").alias("a"), zero, F.col("q_code").alias("code"), F.col("q_scale").alias("scale"))
    held = nodes.select(block("node"), F.lit(NODE).alias("kind"), F.col("node").alias("a"), zero, "code", "scale")
    dealt = held.unionByName(needed).unionByName(sided).repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(_score_blocks, "q long, node long, s float")


def _score_exactly(batches: Iterator, dim: int) -> Iterator:
    import pyarrow as pa
    for b in batches:
        if not b.num_rows:
            continue
        x, y = (_doubles(b.column(c), dim) for c in ("vec", "q_vec"))
        yield pa.RecordBatch.from_arrays([b.column("q"), b.column("node"), pa.array((x * y).sum(1))], names=["q", "node", "score"])


def greedy_search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int, steps: int, expand: int, graph_width: int) -> DataFrame:
    """(q, node, s): the beam of every query node after ``steps`` steps."""
    light = nodes.select("node", "code", "scale")
    asked = materialise(queries.join(nodes, queries["q"] == nodes["node"]).select(
        "q", F.col("code").alias("q_code"), F.col("scale").alias("q_scale")), "queries")
    back = _top(graph, BACK * graph_width, "v").select(F.col("v").alias("u"), F.col("u").alias("v"))
    ways = materialise(graph.select("u", "v").unionByName(back).distinct(), "ways")
    by_score = Window.partitionBy("q").orderBy(F.desc("s"), "node")
    blocks = max(1, ceil(light.count() / 4096))
    state = asked.select("q").join(graph, F.col("q") == F.col("u")).select("q", F.col("v").alias("node"), "s", F.lit(False).alias("done"))
    for _ in range(steps):
        todo = Window.partitionBy("q", "done").orderBy(F.desc("s"), "node")
        state = materialise(state.withColumn("go", ~F.col("done") & (F.row_number().over(todo) <= expand)), "beam")
        met = state.where("go").join(ways, F.col("node") == F.col("u")).select("q", F.col("v").alias("node")).distinct()
        met = met.where("q != node").join(state.select("q", "node"), ["q", "node"], "left_anti")
        scored = score_pairs(materialise(met, "met"), light, asked, blocks)
        state = (state.select("q", "node", "s", (F.col("done") | F.col("go")).alias("done"))
                 .unionByName(scored.withColumn("done", F.lit(False))))
        state = state.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= beam).drop("place")
    return state.select("q", "node", "s")


def nearest(vectors: DataFrame, is_query, top: int = 20, k: int = 28, trees: int = 32, leaf: int = 1000, per_tree: int = 6, chance: int = 2, rounds: int = 3,
            settled: float = 0.01, propose: int = 14, beam: int = 160, steps: int = 4, expand: int = 32, sample: int = 2000) -> DataFrame:
    """query_id, rank, vec_id, score: the ``top`` nearest rows found for each
    row for whose ``vec_id`` the condition ``is_query`` holds."""
    nodes, rows, dim = nodes_of(vectors)
    graph = descend(first_graph(nodes, dim, k, trees, leaf, per_tree, chance, sample), nodes, k, rounds, settled, propose)
    asking = materialise(rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")), "asking")
    found = greedy_search(asking.select("q").distinct(), graph, nodes, beam, steps, expand, k)
    best = Window.partitionBy("q").orderBy(F.desc("s"), "node")
    few = (found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= 2 * top).select("q", "node")
           .unionByName(asking.select("q", F.col("q").alias("node")).distinct()))       # rows equal to the query
    pairs = few.join(nodes.select("node", "vec"), "node").join(
        nodes.select(F.col("node").alias("q"), F.col("vec").alias("q_vec")), "q")
    scored = pairs.mapInArrow(lambda b: _score_exactly(b, dim), "q long, node long, score double")
    # of equal vectors only the smallest ids can be among the first, one of them being the query
    members = rows.withColumn("place", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))) \
        .where(F.col("place") <= top + 1).drop("place")
    opened = scored.join(members, "node")
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    opened = materialise(opened.withColumn("place", F.row_number().over(first)).where(F.col("place") <= top + 1).drop("place"), "answers")
    answers = asking.join(opened, "q").where("query_id != vec_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top) \
        .select("query_id", "rank", "vec_id", "score")
