"""Benchmark decontamination by SimHash windows.

A document is contaminated by a benchmark item if one of its windows of as
many words as the item (all of it, if it has fewer) has a weighted shingle similarity (Jaccard over
shingle counts, five words a shingle) of 0.8 or more with it.

1. Texts become words: ASCII letters in lower case, cut at ASCII white space
   and punctuation.  An item of under five words is one shingle as a whole.
2. Of every document, the windows of each item length are taken at every
   word.  Windows too few of whose shingles occur in any item are skipped
   first; the similarity could not reach the threshold, so none is lost.  A
   document shorter than the item is one window as a whole.
3. Each window gets a 128-bit SimHash of its shingles.  The items' SimHashes
   lie in a multi-index: 8 blocks of 16 bits, each listed under all values
   up to 3 bits away.  Two SimHashes up to 31 bits apart agree that well in
   some block, so looking up 8 blocks finds all items within that radius
   (4 standard deviations beyond what a similarity of 0.8 leads to).
4. Candidates within the radius are verified on the words themselves.

The benchmark is taken in blocks of at most ``block_items`` items and
``block_bytes`` of text, so what is broadcast is bounded; every block is held
against all documents.  Documents are never shuffled, so hot passages and
sources do no harm.

Defined cases: null and empty texts and items match nothing; items with equal
texts each match; repeated document rows each report; ties between windows →
the first; empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, byte_chunks, materialise

WORDS = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_RADIUS = 8, 3
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1        # 31 of 128 bits
_CUT = bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\x7f"
_TABLE = bytes(32 if c in _CUT else c for c in range(256))
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
RESULT = "doc_id long, item_id long, similarity double, start_word long, n_words long, distance int"


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TABLE).split()


def _hash_words(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    a = np.full(n, k, np.uint64)
    for i in range(k):
        a = (a ^ h[i:n + i]) * _MIX[0]
        a ^= a >> np.uint64(29)
    return a


def _bits(shingles: np.ndarray) -> np.ndarray:
    """128 bits of each shingle hash."""
    second = (shingles ^ _MIX[2]) * _MIX[1]
    second ^= second >> np.uint64(32)
    pair = np.stack([shingles, second], 1)
    return np.unpackbits(pair.view(np.uint8), axis=1, bitorder="little")


def _simhashes(bits: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """uint64[windows, 2]: SimHash of ``count`` shingles from each start on."""
    total = np.zeros((len(bits) + 1, 128), np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    votes = total[starts + count] - total[starts]
    return np.packbits(votes * 2 > count, axis=1, bitorder="little").view(np.uint64)


def similarity(a: list[bytes], b: list[bytes]) -> float:
    """Weighted Jaccard of two word sequences' shingle counts."""
    def count(w: list[bytes]) -> Counter:
        k = min(WORDS, len(w))
        return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if w else Counter()
    x, y = count(a), count(b)
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both) if both else 0.0


@dataclass
class ItemIndex:
    ids: list
    words: list[list[bytes]]
    lengths: list[int]                  # distinct word counts
    known: dict[int, np.ndarray]        # shingle width → sorted shingle hashes of the items
    prints: np.ndarray                  # uint64[items, 2]
    offsets: np.ndarray                 # int32[BLOCKS, 2**16 + 1]
    listed: np.ndarray                  # int32[BLOCKS, entries]: items by block value


def build_index(items: list[tuple]) -> ItemIndex | None:
    """Index of (item_id, text) rows; None if no item has a word."""
    kept = [(i, w) for i, w in ((i, words_of((t or "").encode())) for i, t in items) if w]
    if not kept:
        return None
    ids, words = [i for i, _ in kept], [w for _, w in kept]
    known: dict[int, list] = {}
    prints = []
    for w in words:
        k = min(WORDS, len(w))
        s = _shingles(_hash_words(w), k)
        known.setdefault(k, []).append(s)
        prints.append(_simhashes(_bits(s), np.array([0]), len(s))[0])
    prints = np.array(prints)
    flips = [sum(1 << b for b in c) for n in range(BLOCK_RADIUS + 1) for c in combinations(range(16), n)]
    values = prints.view(np.uint16).reshape(len(prints), BLOCKS).astype(np.int64)
    offsets, listed = np.zeros((BLOCKS, (1 << 16) + 1), np.int32), []
    for b in range(BLOCKS):
        near = (values[:, b][:, None] ^ np.array(flips)[None, :]).ravel()
        order = np.argsort(near, kind="stable")
        listed.append((order // len(flips)).astype(np.int32))
        offsets[b] = np.searchsorted(near[order], np.arange((1 << 16) + 1))
    return ItemIndex(ids, words, sorted({len(w) for w in words}),
                     {k: np.unique(np.concatenate(v)) for k, v in known.items()}, prints, offsets, np.array(listed))


def _lookup(index: ItemIndex, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, item, distance) of all pairs within the radius."""
    values = prints.view(np.uint16).reshape(len(prints), BLOCKS).astype(np.int64)
    pairs = []
    for b in range(BLOCKS):
        lo, hi = index.offsets[b][values[:, b]], index.offsets[b][values[:, b] + 1]
        n = (hi - lo).astype(np.int64)
        window = np.repeat(np.arange(len(prints)), n)
        item = index.listed[b][np.repeat(lo, n) + np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n)]
        pairs.append(window * len(index.ids) + item)
    pair = np.unique(np.concatenate(pairs))
    window, item = pair // len(index.ids), pair % len(index.ids)
    distance = np.bitwise_count(prints[window] ^ index.prints[item]).sum(1)
    ok = distance <= RADIUS
    return window[ok], item[ok], distance[ok]


def _whole(index: ItemIndex, h: np.ndarray, hits: dict[int, np.ndarray]) -> list[tuple]:
    """(distance, 0, words, item) of the longer items that a whole document
    may be like: it has 0.8 of their shingles at least."""
    n, k = len(h), min(WORDS, len(h))
    count = n - k + 1
    longer = [m for m in index.lengths if m > n and SIMILARITY * (m - min(WORDS, m) + 1) <= count + 1e-9]
    if not longer or k < WORDS or k not in hits:          # under five words an item is one shingle and needs them all
        return []
    if hits[k][:count].sum() < SIMILARITY * (longer[0] - k + 1) - 1e-9:
        return []
    _, item, distance = _lookup(index, _simhashes(_bits(_shingles(h, k)), np.array([0]), count))
    return [(d, 0, n, i) for d, i in zip(distance.tolist(), item.tolist()) if len(index.words[i]) in longer]


def match_words(index: ItemIndex, words: list[bytes], h: np.ndarray, hits: dict[int, np.ndarray]) -> list[tuple]:
    """(item number, similarity, start, words, distance) of a document's best
    window per item.  ``hits``: which places start a shingle of some item."""
    candidates = []
    for n in index.lengths:
        k = min(WORDS, n)
        count = n - k + 1
        hit = hits.get(k)
        if hit is None or len(h) < n:                     # too short for a window of n words
            continue
        sums = np.concatenate([[0], np.cumsum(hit)])
        whole = len(h) - n + 1
        places = np.flatnonzero(sums[count:count + whole] - sums[:whole] >= SIMILARITY * count - 1e-9)
        for at in range(0, len(places), 4096):            # windows in bounded stretches
            starts = places[at:at + 4096]
            first, last = int(starts[0]), int(starts[-1]) + n
            prints = _simhashes(_bits(_shingles(h[first:last], k)), starts - first, count)
            window, item, distance = _lookup(index, prints)
            candidates += zip(distance.tolist(), starts[window].tolist(), [n] * len(window), item.tolist())
    candidates += _whole(index, h, hits)
    best: dict[int, tuple] = {}
    for distance, start, n, i in sorted(candidates):      # an exact copy comes first and settles its item
        had = best.get(i)
        if had and had[0] >= 1.0:
            continue
        s = similarity(words[start:start + n], index.words[i])
        if s >= SIMILARITY and (had is None or (-s, start, n) < (-had[0], had[1], had[2])):
            best[i] = (s, start, n, distance)
    return [(i, *v) for i, v in sorted(best.items())]


def _scan(index: ItemIndex, ids: list, texts: list[bytes]) -> list[tuple]:
    """Result rows of some documents, hashed together."""
    words = [words_of(t) for t in texts]
    lens = np.array([len(w) for w in words])
    h = _hash_words([x for w in words for x in w])
    starts = np.cumsum(lens) - lens
    hits: dict[int, np.ndarray] = {}
    with_hit = np.zeros(len(texts), bool)
    for k, known in index.known.items():
        s = _shingles(h, k)
        at = np.searchsorted(known, s)
        hit = known[np.minimum(at, len(known) - 1)] == s
        if len(hit) < len(h):
            hit = np.concatenate([hit, np.zeros(len(h) - len(hit), bool)])
        for e in range(1, k):                             # shingles that would run into the next text
            ends = (starts + lens - e)[lens >= e]
            hit[ends] = False
        hits[k] = hit
        for p in np.flatnonzero(hit):
            with_hit[np.searchsorted(starts, p, side="right") - 1] = True
    out = []
    for d in np.flatnonzero(with_hit):
        lo, hi = int(starts[d]), int(starts[d] + lens[d])
        found = match_words(index, words[d], h[lo:hi], {k: v[lo:hi] for k, v in hits.items()})
        out += [(ids[d], index.ids[i], s, start, n, dist) for i, s, start, n, dist in found]
    return out


def _against(docs: DataFrame, items: list[tuple]) -> DataFrame:
    index = build_index(items)
    if index is None:
        return docs.sparkSession.createDataFrame([], RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(index)     # bounded by the block of items

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), as_bytes(b.column("text"))
            rows = [r for lo, hi in byte_chunks(texts) for r in _scan(shared.value, ids[lo:hi], texts[lo:hi])]
            cols = list(zip(*rows)) if rows else [()] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", "item_id", "similarity", "start_word", "n_words", "distance"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def matches(docs: DataFrame, benchmark: DataFrame, block_items: int = 2000, block_bytes: int = 8 << 20) -> DataFrame:
    """One row per document row and item it leaks, with its best window."""
    done, block, size = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").orderBy("item_id", "text")
    for r in rows.toLocalIterator():
        if block and (len(block) >= block_items or size + len(r["text"] or "") > block_bytes):
            done.append(materialise(_against(docs, block), "matches"))
            block, size = [], 0
        block.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
    return reduce(DataFrame.unionByName, [*done, _against(docs, block)])


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that leak no item; rows without ``doc_id`` can't be named and stay."""
    leaked = materialise(matches(docs, benchmark).where("doc_id is not null").select("doc_id").distinct(), "leaked")
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)
