"""Maximal runs of repeated words, by a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are identical) that no neighbouring word extends keeping the
period, of at least ``LEAST`` words and ``TIMES`` periods.

For every power of two, L, the factors of L words get a name: equal factors
of one document share it, and a factor that occurs once has none (neither
has any longer one that begins there).  The names of 2L words come from pairs
of names of L words.  The successor of a place is the next one with its name;
those within twice that length are looked at.  Consecutive places with the
same distance ``d`` to their successors are terms of arithmetic progressions
with that difference and propose the period ``d``.  Where ``d <= L`` the
factor and its successor meet or overlap, all words from the first place to
the end of the last successor are ``d``-periodic, and such a stretch can't be
extended (a nearer successor beyond it would give the whole stretch a smaller
period).  Where ``d > L`` there must be a third term, and the stretch is
extended word by word on both sides.  Equal stretches are one run, with the
smallest period.  No run is missed: let L be the first power of two that is
``q`` or more; L < 2q, so a run of 3q words holds factors of L words with a
copy ``q`` further on, and none nearer, or ``q`` would not be its smallest period.

A task names the factors of some 1.5 MB of documents at a time, each document
apart; only names of the last length are kept, so memory is a few numbers a
word.  Documents are judged one by one: nothing is shuffled.

Defined cases: a null or empty text has no words and no run, its collapsed
text is empty; of equal exponents the run with the smallest start counts,
then the smallest period; repeated rows and rows without ``doc_id`` are
judged like any other; texts are read whole; an empty table gives an empty
result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, byte_chunks

LEAST, TIMES = 24, 3
RESULT = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def _number(words: list[bytes]) -> np.ndarray:
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))


def _shared(places: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose key occurs again, sorted by key, then place, and the
    number of each one's key; ``places`` ascend."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(len(k) + 1, bool)
    np.not_equal(k[1:], k[:-1], out=new[1:-1])
    again = ~(new[:-1] & new[1:])
    return places[order[again]], np.cumsum(new[:-1])[again]


def _grow(words: np.ndarray, lo: int, hi: int, first: int, last: int, d: int) -> tuple[int, int]:
    """The widest range of places within ``lo`` to ``hi`` around ``first`` to
    ``last`` at which the word ``d`` further on is the same."""
    step = 8
    while last < hi:
        to = min(last + step, hi)
        bad = np.flatnonzero(words[last:to] != words[last + d:to + d])
        if len(bad):
            last += int(bad[0])
            break
        last, step = to, step * 2
    step = 8
    while first > lo:
        to = max(first - step, lo)
        bad = np.flatnonzero(words[to:first] != words[to + d:first + d])
        if len(bad):
            first = to + int(bad[-1]) + 1
            break
        first, step = to, step * 2
    return first, last


def find_runs(words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs in the documents that begin and end at
    ``bounds`` of ``words``, word numbers; by start, then period."""
    n = len(words)
    sizes = np.diff(bounds)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    best: dict[tuple[int, int], int] = {}
    places, key = _shared(np.arange(n), doc * (int(words.max()) + 1 if n else 1) + words)
    length = 1
    while len(places):
        nxt, same = places[1:], key[1:] == key[:-1]
        step = np.where(same, nxt - places[:-1], 0)
        near = (step > 0) & (step <= 2 * length)
        succ = np.zeros(n, np.int64)
        succ[places[:-1][near]] = step[near]
        at = np.sort(places[:-1][near])
        d = succ[at]
        # stretches of consecutive places with one distance to their successors
        cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (d[1:] != d[:-1]) | (doc[at[1:]] != doc[at[:-1]])) + 1
        first = np.concatenate([[0], cut]).astype(np.int64) if len(at) else np.zeros(0, np.int64)
        last = np.concatenate([cut, [len(at)]]).astype(np.int64)[:len(first)] - 1
        a, b, q = at[first], at[last] + length, d[first]
        whole = b + q - a
        done = (q <= length) & (whole >= LEAST) & (whole >= TIMES * q)
        for s, e, p in zip(a[done].tolist(), (b + q)[done].tolist(), q[done].tolist()):
            best[s, e] = min(p, best.get((s, e), p))
        # a third term of the progression, then the words around it
        third = (q > length) & (succ[np.minimum(a + q, n - 1)] == q)
        reached: dict[int, int] = {}
        for s, e, p in zip(a[third].tolist(), b[third].tolist(), q[third].tolist()):
            if e <= reached.get(p, -1):
                continue
            lo, hi = int(bounds[doc[s]]), int(bounds[doc[s] + 1]) - p
            s, e = _grow(words, lo, hi, s, e, p)
            reached[p] = e
            if e + p - s >= max(LEAST, TIMES * p):
                best[s, e + p] = min(p, best.get((s, e + p), p))
        # names of twice the length: both halves must occur again
        name = np.zeros(n + length, np.int64)
        name[places] = key
        at = np.sort(places)
        at = at[(at + length < n) & (name[at + length] > 0)]
        at = at[doc[at] == doc[at + length]]
        places, key = _shared(at, name[at] * (int(key.max()) + 1 if len(key) else 1) + name[at + length])
        length *= 2
    return sorted((s, e, p) for (s, e), p in best.items())


def summary(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The result of one document from its runs."""
    keep = np.ones(len(words) + 1, np.int64)
    gone = np.zeros(len(words) + 1, np.int64)
    for s, e, q in runs:
        gone[s + q] += 1
        gone[e] -= 1
    keep = np.cumsum(gone)[:len(words)] == 0
    kept = words if not runs else [w for w, k in zip(words, keep) if k]
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    top: tuple = (None, None, None, None)
    if runs:
        s, e, q = min(runs, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]))
        top = (s, e - s, q, 1000 * (e - s) // q)
    return (len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of the query's documents: for one id in ten the words from
    some place on repeat with a period."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a:a + p]
    return words[:a] + (period * ((n - a) // p + 1))[:n - a]


def judge(texts: list[bytes], ids: list, change=None) -> Iterator[tuple]:
    """One result per text; ``change`` may replace the words of a text by its id."""
    for lo, hi in byte_chunks(texts):
        docs = [t.split() for t in texts[lo:hi]]     # bytes split at the six ASCII spaces only
        if change is not None:
            docs = [change(w, i) for w, i in zip(docs, ids[lo:hi])]
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in docs])]).astype(np.int64)
        found: list[list] = [[] for _ in docs]
        runs = find_runs(_number([w for words in docs for w in words]), bounds)
        owner = np.searchsorted(bounds, [s for s, _, _ in runs], side="right") - 1
        for k, (s, e, q) in zip(owner.tolist(), runs):
            found[k].append((s - int(bounds[k]), e - int(bounds[k]), q))
        for words, mine in zip(docs, found):
            yield summary(words, mine)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change=None) -> DataFrame:
    """One row per row of ``docs``: its runs counted, the one with the
    greatest exponent, and digests of all runs and of the collapsed text (no
    word that a run holds after its first period).  ``change`` (words, id)
    gives the words to judge where they are not those of the text."""
    names = [f.split()[0] for f in RESULT.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            ids = batch.column(0).to_pylist()
            cols = list(zip(*judge(as_bytes(batch.column(1)), ids, change))) or [()] * 7
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, RESULT)
