"""SimHash near-duplicates by a self-join of binary tries.

A text's fingerprint has 64 bits: word shingles are hashed with XXH64 (seed
42), a bit is 1 if set in over half the hashes.  Fingerprints that differ in
at most ``radius`` bits are linked; a document's class is its connected
component.

The join walks a binary trie of the distinct fingerprints in pairs of nodes
of equal depth, starting with (root, root).  Going down one bit, a pair has
up to four child pairs, two of which differ in one more bit; pairs beyond the
error budget are pruned.  To prune early at any number of fingerprints, four
tries are used, one per rotation by 16 bits.  The differing bits of two
linked fingerprints, counted block by block round the circle, have a start
from which no prefix of i blocks holds more than ``i * radius / 4`` of them
(rounded down), so with that budget per depth no link is lost, and at depth
16 only pairs (node, itself) are alive: the key by which Spark deals the
tries out.

A trie whose depth-16 node holds more than ``leaf`` fingerprints is split at
depth 32 into the node pairs still alive there, and if a node is still that
large, at depth 48, where a node can hold 2**16 fingerprints at most.  So no
task ever holds an unbounded group.  Inside a task a node is a stretch of the
sorted fingerprints and all node pairs of a depth advance together in numpy,
in chunks.  A pair of nodes whose members are all linked already is pruned
too, and only a spanning forest of the links leaves the task, so a large
group of near copies costs no quadratic output.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; repeated rows and ties share a class; an empty table gives an
empty result; a null ``doc_id`` takes part and never names a class unless the
class has no other id (then the class id is null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, as_bytes, byte_chunks, materialise
from .components import components
from .ordered import lay_out

BLOCK = 16
CHUNK = 200_000      # node pairs that advance together
LEAF_PAIRS = 48      # node pairs with at most so many member pairs are compared directly


# ---- fingerprints ---------------------------------------------------------

def fingerprints_of(texts: list[bytes], words: int = 3) -> np.ndarray:
    """uint64 fingerprint of each text; ``bytes.lower`` touches A-Z only and
    ``bytes.split`` cuts at exactly space and 0x09-0x0D."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in byte_chunks(texts, 1_000_000):
        hashes, counts = [], []
        for t in texts[lo:hi]:
            w = t.lower().split()
            if len(w) > words:
                n = len(w) - words + 1
                shingles = map(b" ".join, zip(*(w[k:] for k in range(words))))
            else:
                n = min(len(w), 1)
                shingles = [b" ".join(w)][:n]
            hashes.append(np.fromiter(map(xxh64_intdigest, shingles, repeat(42)), np.uint64, n))
            counts.append(n)
        n = np.array(counts)
        h = np.concatenate(hashes)
        some = np.flatnonzero(n)
        if not len(some):
            continue
        votes = np.zeros((len(some), 64), np.int64)
        starts = (np.cumsum(n) - n)[some]
        for at in range(0, len(h), 1 << 16):              # bits of a bounded stretch at a time
            part = np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            first = int(np.searchsorted(starts, at, side="right")) - 1
            last = int(np.searchsorted(starts, at + len(part), side="left"))
            cuts = np.maximum(starts[first:last] - at, 0)
            votes[first:last] += np.add.reduceat(part, cuts, axis=0, dtype=np.int32)
        bits = votes * 2 > n[some][:, None]
        out[lo + some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            fp = fingerprints_of(as_bytes(b.column("text")), words)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


# ---- trie self-join inside a task ------------------------------------------

def _budget(depth: int, radius: int) -> int:
    return -(-depth // BLOCK) * radius // 4


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of linked places; label[i] stays the smallest place known."""
    while True:
        la, lb = label[a], label[b]
        different = la != lb
        if not different.any():
            return
        a, b, la, lb = a[different], b[different], la[different], lb[different]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:                                       # shorten the ways to the roots
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def trie_classes(r: np.ndarray, pairs: tuple, depth: int, radius: int) -> np.ndarray:
    """Class (a place in ``r``) of each of the sorted fingerprints ``r``, as
    linked through the given node pairs (lo1, hi1, lo2, hi2, differing bits)
    of the given depth."""
    label = np.arange(len(r))
    ones: dict[int, np.ndarray] = {}
    turns = np.zeros(len(r), np.int64)                    # changes of label so far, to see whether a stretch is one class

    def count_turns() -> None:
        turns[1:] = np.cumsum(label[1:] != label[:-1])

    count_turns()
    stack = [(depth, pairs)]
    while stack:
        depth, (lo1, hi1, lo2, hi2, diff) = stack.pop()
        if len(lo1) > CHUNK:
            stack.append((depth, tuple(x[CHUNK:] for x in (lo1, hi1, lo2, hi2, diff))))
            lo1, hi1, lo2, hi2, diff = (x[:CHUNK] for x in (lo1, hi1, lo2, hi2, diff))
        one = (turns[hi1 - 1] == turns[lo1]) & (turns[hi2 - 1] == turns[lo2]) & (label[lo1] == label[lo2])
        lo1, hi1, lo2, hi2, diff = (x[~one] for x in (lo1, hi1, lo2, hi2, diff))
        if not len(lo1):
            continue
        n1, n2 = hi1 - lo1, hi2 - lo2
        leaf = (n1 * n2 <= LEAF_PAIRS) | (depth == 64)
        if leaf.any():
            size = (n1 * n2)[leaf]
            owner = np.repeat(np.arange(len(size)), size)
            k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            i = lo1[leaf][owner] + k // n2[leaf][owner]
            j = lo2[leaf][owner] + k % n2[leaf][owner]
            near = (i < j) & (np.bitwise_count(r[i] ^ r[j]) <= radius)
            if near.any():
                _union(label, i[near], j[near])
                count_turns()
        lo1, hi1, lo2, hi2, diff = (x[~leaf] for x in (lo1, hi1, lo2, hi2, diff))
        if not len(lo1):
            continue
        if depth not in ones:
            ones[depth] = np.concatenate([[0], np.cumsum((r >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)])
        c = ones[depth]
        mid1, mid2 = hi1 - (c[hi1] - c[lo1]), hi2 - (c[hi2] - c[lo2])
        same = lo1 == lo2
        kids = [np.concatenate(x) for x in zip(
            (lo1, mid1, lo2, mid2, diff), (mid1, hi1, mid2, hi2, diff), (lo1, mid1, mid2, hi2, diff + 1),
            tuple(x[~same] for x in (mid1, hi1, lo2, mid2, diff + 1)))]
        ok = (kids[0] < kids[1]) & (kids[2] < kids[3]) & (kids[4] <= _budget(depth + 1, radius))
        if ok.any():
            stack.append((depth + 1, tuple(x[ok] for x in kids)))
    return label


def _join_groups(depth: np.ndarray, k1: np.ndarray, k2: np.ndarray, rot: np.ndarray, r: np.ndarray, radius: int):
    """(place, root place) of linked fingerprints in whole groups."""
    new = np.flatnonzero(np.concatenate([[True], (rot[1:] != rot[:-1]) | (depth[1:] != depth[:-1])
                                         | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]))
    stop = np.append(new[1:], len(r))
    out_a, out_b = [], []
    for d in np.unique(depth[new]):
        g = depth[new] == d
        lo, hi, a, b = new[g], stop[g], k1[new[g]], k2[new[g]]
        prefix = (r >> np.uint64(64 - int(d))).astype(np.int64)
        second = np.concatenate([[0], np.cumsum(prefix == k2)])     # members of the second node stand last
        mid = np.where(a == b, lo, hi - (second[hi] - second[lo]))
        lo1, hi1, lo2, hi2 = lo, np.where(a == b, hi, mid), mid, hi
        diff = np.bitwise_count((a ^ b).astype(np.uint64)).astype(np.int64)
        ok = (lo1 < hi1) & (lo2 < hi2)
        label = trie_classes(r, tuple(x[ok] for x in (lo1, hi1, lo2, hi2, diff)), int(d), radius)
        moved = np.flatnonzero(label != np.arange(len(r)))
        out_a.append(moved)
        out_b.append(label[moved])
    return np.concatenate(out_a), np.concatenate(out_b)


def _links_of_partition(batches: Iterator, radius: int) -> Iterator:
    """Sorted (rot, depth, k1, k2, r) rows → links; a group never straddles a call."""
    import pyarrow as pa
    held = None

    def emit(cols: list[np.ndarray]):
        rot, depth, k1, k2, r = cols
        r = r.view(np.uint64)
        a, b = _join_groups(depth, k1, k2, rot, r, radius)
        turn = (rot[a] * BLOCK).astype(np.uint64)
        back = [((x >> turn) | (x << ((np.uint64(64) - turn) & np.uint64(63)))).view(np.int64) for x in (r[a], r[b])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in back], names=["a", "b"])

    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        if not len(cols[0]):
            continue
        last = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield emit([c[:cut] for c in cols])
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield emit(held)


# ---- the join in Spark -------------------------------------------------------

def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def _masks(depth: int, radius: int) -> list[int]:
    """Differences, below depth 16, of the node pairs alive at ``depth``."""
    bits = depth - BLOCK
    out = [0]
    for n in range(1, _budget(depth, radius) + 1):
        for where in combinations(range(bits), n):        # 0 is the first bit below depth 16
            if all(sum(w < d - BLOCK for w in where) <= _budget(d, radius) for d in range(BLOCK, depth + 1, BLOCK)):
                out.append(sum(1 << (bits - 1 - w) for w in where))
    return out


def links(fps: DataFrame, radius: int = 3, leaf: int = 20_000) -> DataFrame:
    """(a, b): edges with the same components as all pairs of distinct
    fingerprints (column ``fp``) at most ``radius`` (0 to 3) bits apart."""
    if not 0 <= radius <= 3:
        raise ValueError("four blocks serve a radius of 3 at most")
    turns = F.explode(F.array(*[F.struct(F.lit(k).alias("rot"), _rotated(F.col("fp"), BLOCK * k).alias("r"))
                                for k in range(4)]))
    rows = fps.select("fp").distinct().select(turns.alias("t")).select("t.*")
    at = {d: F.shiftrightunsigned("r", 64 - d) for d in (16, 32, 48)}
    rows = rows.withColumn("p16", at[16])
    # nodes that must be split: at most 4 * 2**16 rows exist at depth 16
    heavy = rows.groupBy("rot", "p16", at[32].alias("p32")).agg(F.count("*").alias("n32"))
    heavy = (heavy.groupBy("rot", "p16").agg(F.sum("n32").alias("n"), F.max("n32").alias("top"))
             .where(F.col("n") > leaf)
             .select("rot", "p16", F.when(F.col("top") > leaf, 48).otherwise(32).alias("deep")))
    rows = rows.join(F.broadcast(heavy), ["rot", "p16"], "left").withColumn("depth", F.coalesce("deep", F.lit(BLOCK)))
    own = F.when(F.col("depth") == 48, at[48]).when(F.col("depth") == 32, at[32]).otherwise(F.col("p16"))
    masks = F.when(F.col("depth") == 48, F.array(*[F.lit(m).cast("long") for m in _masks(48, radius)])) \
        .when(F.col("depth") == 32, F.array(*[F.lit(m).cast("long") for m in _masks(32, radius)])) \
        .otherwise(F.array(F.lit(0).cast("long")))
    keyed = (rows.withColumn("own", own).withColumn("m", F.explode(masks))
             .withColumn("other", F.col("own").bitwiseXOR(F.col("m")))
             .select(F.col("rot").cast("long").alias("rot"), F.col("depth").cast("long").alias("depth"),
                     F.least("own", "other").alias("k1"), F.greatest("own", "other").alias("k2"), "r"))
    dealt = keyed.repartition("rot", "depth", "k1", "k2").sortWithinPartitions("rot", "depth", "k1", "k2", "r")
    return dealt.mapInArrow(lambda batches: _links_of_partition(batches, radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fp, component_id of every row."""
    fps = materialise(fingerprints(docs, words), "fingerprints")
    labels = components(links(fps, radius))
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    classed = first.join(labels.select(F.col("node").alias("fp"), "component"), "fp", "left") \
        .select("fp", "first", F.coalesce("component", "fp").alias("component"))
    classed = materialise(classed, "classes")
    named = classed.groupBy("component").agg(F.min("first").alias("component_id"))
    by_fp = classed.join(named, "component").select("fp", "component_id")
    return fps.join(by_fp, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """The rows with the smallest id of each class; rows without an id can't
    be told apart and stay.  Rows with one id and one text are one document,
    of which one row stays; with another text they are documents of their own,
    and of those in one class the first by its text's hash stays."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        found = near_duplicates(docs, words, radius)
        gone = materialise(found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "gone")
        return docs.join(broadcast_if_small(gone, 48), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    named = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__tag"), F.struct("*").alias("__row"))
    places = lay_out(named.select("__id", "__tag").distinct(), [F.col("__id").asc(), F.col("__tag").asc()], "row-names")
    rows = named.join(places.select("__id", "__tag", "seq"), ["__id", "__tag"])
    found = near_duplicates(rows.select(F.col("seq").alias("doc_id"), F.col("__row.text").alias("text")), words, radius)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("seq")).distinct()
    kept = rows.join(gone, "seq", "left_anti").dropDuplicates(["seq"]).select("__row.*")
    return kept.unionByName(docs.where("doc_id is null"))
