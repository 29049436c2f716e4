"""Merkle manifest of a dataset: per row a digest, a proof and one root.

A row's leaf is the SHA-256 of its fields.  Rows of one group (source) in the
order of their ids are the leaves of a tree in which every ``FAN``
consecutive nodes make a parent, until one is left, the subroot.  The
subroots in the order of their groups make the root in the same way.  Digests
are lowercase hex and are hashed as that text.

Levels are concatenated strings.  An aligned block holds ``FAN ** LEVELS``
consecutive nodes of one group, and each level of it is one string of 64
characters a node: the parents are the hashes of fixed-width substrings of
192 characters, and the siblings of a node are the substrings that flank it
within its run.  What a block comes to is one node of the next layer of
blocks, so roots recurse: layer after layer until every group has one node.
Proofs come back down the same way, each layer putting its own segments
before those of the block it belongs to.

A block is a bounded group, however large its source is, places within a
source come from sorted partitions (``ordered``), and every layer is a
written table.  Only the root, one string, and the row count of the largest
group reach the driver.

Defined cases: a null field is hashed as ``-``; a null source is a group of
its own and comes first; rows without an id come first in their group and are
never tampered with by the query; rows that share an id are ordered by their
leaf, so repeated rows are leaves of their own with one digest; an empty
table gives an empty result; texts of any length are hashed whole; columns
other than the named ones are not read, so their names may clash with any
here.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise
from .ordered import lay_out, place, starts

FAN = 3
LEVELS = 5
BLOCK = FAN ** LEVELS
DIGEST = 64
#: upper estimate of a node's proof, for the check before a broadcast
PROOF_BYTES = 4096


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """How a field enters a leaf: its length in bytes, a colon, its text."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    return _sha(F.concat(*[field(v) for v in values]))


def group_key(source: Column) -> Column:
    """A key that is never null and sorts as the source does, null first."""
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("="), source.cast("string")))


def _parents(level: str) -> Column:
    """The level above: one hash for every run of ``FAN`` nodes."""
    width = FAN * DIGEST
    runs = F.sequence(F.lit(0), F.expr(f"cast((octet_length({level}) - 1) div {width} as int)"))
    hashed = F.transform(runs, lambda k: F.sha2(F.substring(F.col(level), k * width + 1, F.lit(width)), 256))
    return F.array_join(hashed, "").cast("binary")


def blocks(nodes: DataFrame, carry: list[str], name: str) -> DataFrame:
    """Aligned blocks of ``nodes`` (g, pos, n, digest and ``carry``): the
    levels ``lv0`` up to the block's own node, ``top``."""
    rows = nodes.select("g", "n", F.expr(f"pos div {BLOCK}").alias("block"), F.struct("pos", "digest", *carry).alias("node"))
    met = rows.groupBy("g", "block").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("node")).alias("nodes"))
    # a group with more nodes than one block hashes every level of it, a smaller one until a single node is left
    depth = reduce(Column.__add__, [F.when(F.col("n") > FAN ** i, 1).otherwise(0) for i in range(LEVELS)])
    met = met.withColumn("depth", depth).withColumn("lv0", F.array_join("nodes.digest", "").cast("binary"))
    for i in range(LEVELS):
        met = met.withColumn(f"lv{i + 1}", F.when(F.col("depth") > i, _parents(f"lv{i}")))
    top = F.coalesce(*[F.col(f"lv{i}") for i in range(LEVELS, -1, -1)]).cast("string")
    carried = F.transform("nodes", lambda x: F.struct(x["pos"].alias("pos"), *[x[c].alias(c) for c in carry]))
    return materialise(met.select("g", "block", "n", carried.alias("nodes"), *[f"lv{i}" for i in range(LEVELS + 1)], top.alias("top")), name)


def _segments(place_in_block: Column) -> Column:
    """The siblings of a node on every level of its block, each as what
    stands left and right of it in its run."""
    def flanks(i: int) -> Column:
        node = F.expr(f"cast(spot div {FAN ** i} as int)")
        inside = node % FAN
        left = F.substring(F.col(f"lv{i}"), (node - inside) * DIGEST + 1, inside * DIGEST)
        right = F.substring(F.col(f"lv{i}"), (node + 1) * DIGEST + 1, (FAN - 1 - inside) * DIGEST)
        return F.when(F.col(f"lv{i + 1}").isNotNull(), F.struct(left.cast("string").alias("left"), right.cast("string").alias("right")))

    return F.filter(F.array(*[flanks(i) for i in range(LEVELS)]), lambda s: s.isNotNull())


def layers(nodes: DataFrame, carry: list[str], most: int, name: str) -> list[DataFrame]:
    """Block tables from the leaves up, until the largest group, of ``most``
    nodes, has one block."""
    out = [blocks(nodes, carry, f"{name}-blocks")]
    while most > BLOCK:
        most = -(-most // BLOCK)
        above = out[-1].select("g", F.col("block").alias("pos"), F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"), F.col("top").alias("digest"))
        out.append(blocks(above, [], f"{name}-blocks"))
    return out


def subroots(tree: list[DataFrame]) -> DataFrame:
    return tree[-1].select("g", F.col("top").alias("subroot"))


def descend(tree: list[DataFrame], rest: DataFrame, carry: list[str], name: str) -> DataFrame:
    """(g, carry, digest, path) of every leaf, with the other columns of
    ``rest`` (g, path, ...), in which ``path`` is what follows a subroot."""
    more = [c for c in rest.columns if c not in ("g", "path")]
    above = tree[-1].join(broadcast_if_small(rest, PROOF_BYTES), "g")
    for i in range(len(tree) - 1, -1, -1):
        each = above.select(*above.columns, F.explode("nodes").alias("node")).withColumn("spot", F.col("node.pos") - F.col("block") * BLOCK)
        path = F.concat(_segments(F.col("spot")), F.col("path"))
        if i == 0:
            digest = F.substring(F.col("lv0"), (F.col("spot") * DIGEST + 1).cast("int"), F.lit(DIGEST)).cast("string")
            return each.select("g", *[F.col(f"node.{c}").alias(c) for c in carry], digest.alias("digest"), path.alias("path"), *more)
        known = materialise(each.select("g", F.col("node.pos").alias("block"), path.alias("path"), *more), f"{name}-paths")
        above = tree[i - 1].join(broadcast_if_small(known, PROOF_BYTES), ["g", "block"])


def manifest(rows: DataFrame, carry: list[str]) -> DataFrame:
    """``rows`` (g, id, leaf and the columns of ``carry``) with ``subroot``,
    ``root`` and ``path``, the segments of the proof from the leaf to the
    root: an array of what stands left and right of the node on its level."""
    kept = ["id", *carry]
    rows = materialise(rows.select("g", *kept, F.col("leaf").alias("digest")), "merkle-leaves")
    order = [F.col("g").asc(), F.col("id").asc_nulls_first(), F.col("digest").asc()]
    laid = lay_out(rows, order, "merkle-order")
    begun = starts(laid, "g", "merkle-starts")
    most = begun.agg(F.max("n")).first()[0] or 0
    tree = layers(place(laid, begun, "g"), kept, most, "merkle")
    # the subroots are the leaves of one more tree
    tops = subroots(tree).select(F.lit("").alias("all"), "g", "subroot")
    listed = lay_out(tops, [F.col("g").asc()], "merkle-sources")
    known = starts(listed, "all", "merkle-source-starts")
    groups = known.agg(F.max("n")).first()[0] or 0
    sources = place(listed, known, "all").select(F.col("all").alias("g"), "pos", "n", F.col("subroot").alias("digest"), F.col("g").alias("source"))
    crown = layers(sources, ["source"], groups, "merkle-crown")
    start = crown[-1].select("g", F.array().cast("array<struct<left:string,right:string>>").alias("path"), F.col("top").alias("root"))
    rest = materialise(descend(crown, start, ["source"], "merkle-crown")
                       .select(F.col("source").alias("g"), "path", F.col("digest").alias("subroot"), "root"), "merkle-rest")
    return descend(tree, rest, kept, "merkle").select("g", *kept, F.col("digest").alias("leaf"), "subroot", "root", "path")


def proof_text(path: Column) -> Column:
    """The siblings of a proof, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(first: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its proof come to."""
    return F.aggregate(path, first, lambda node, s: _sha(F.concat(s["left"], node, s["right"])))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_manifest(docs: DataFrame, tampered: Column, change: Column) -> DataFrame:
    """The manifest of documents, one tree per source, checked against a copy
    of them: where ``tampered`` holds, the copy's text is ``change``.
    ``folded_root`` is what the copy's leaf and the original proof come to."""
    fields = docs.select(*[F.col(f"`{c}`") for c in FIELDS])
    other = F.when(F.coalesce(tampered, F.lit(False)), leaf([change if c == "text" else F.col(c) for c in FIELDS]))
    rows = fields.select(group_key(F.col("source")).alias("g"), F.col("doc_id").alias("id"),
                         leaf([F.col(c) for c in FIELDS]).alias("leaf"), other.alias("copy_leaf"))
    found = manifest(rows, ["copy_leaf"])
    return found.withColumn("folded_root", fold(F.coalesce("copy_leaf", "leaf"), F.col("path"))) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
