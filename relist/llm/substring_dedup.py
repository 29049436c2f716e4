"""Exact substring deduplication with suffix automata of reference shards.

A window is ``WINDOW`` consecutive words of one document.  A word goes if it
is covered by a window whose word sequence also starts in a document with a
smaller id; windows are judged on the input.

The reference of a document is every document before it, so whole-corpus
automata would have to be broadcast once per shard and every document run
through all of them: quadratic work.  Shards are made by content instead, and
documents go only to the shards that can match:

1. Documents that are word for word equal are one content; all but the
   smallest id lose everything (from ``WINDOW`` words on).
2. Of each window the smallest hash of its 5-word sequences is its key
   (minimizer): equal windows have equal keys.  Keys that occur in one
   document only are dropped; their windows can't repeat.
3. Runs of windows with a surviving key become snippets, dealt out by key.  A
   shard is the snippets of one key in order of document id.  Its suffix
   automaton grows as the documents stream past: a snippet is first matched
   against the automaton of the documents before it (matching statistics:
   the longest suffix at each word that they hold), and every place with
   ``WINDOW`` words or more closes a span to remove; then the snippet is added
   unless all of it was known.  A key in more than ``HOT`` documents is dealt
   out by single windows instead, so the automaton of one task stays small
   whatever the key: it holds distinct content only.
4. The spans of a document meet its text, the kept words are joined.

Defined cases: null and empty texts have no words; documents under ``WINDOW``
words lose nothing; a repeat inside one document is no repeat; rows with one
``doc_id`` are no reference for one another, each is judged by the rows of
smaller ids (a row is known by its id and its text); rows without ``doc_id``
lose nothing and are nobody's reference; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, broadcast_if_small, byte_chunks, materialise

WINDOW = 13
SEED_WORDS = 5
HOT = 5000
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _hash_words(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _sequences(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    a = np.zeros(n, np.uint64)
    for i in range(k):
        a = (a ^ h[i:n + i]) * _MIX[0]
        a ^= a >> np.uint64(29)
    return a * _MIX[1]


def window_keys(h: np.ndarray) -> np.ndarray:
    """Key of the window from each place on: the smallest seed hash in it."""
    g = _sequences(h, SEED_WORDS)
    need = WINDOW - SEED_WORDS + 1
    size = 1
    while size < need and len(g):
        step = min(size, need - size)
        if len(g) <= step:
            return np.zeros(0, np.uint64)
        g = np.minimum(g[:-step], g[step:])
        size += step
    return g


class SuffixAutomaton:
    """Of several word sequences; a state stands for substrings with equal ends."""

    def __init__(self):
        self.step: list[dict] = [{}]
        self.link = [-1]
        self.longest = [0]

    def _state(self, longest: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, p: int, word, q: int) -> int:
        """A copy of ``q`` for the shorter substrings that come through ``p``."""
        copy = self._state(self.longest[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p != -1 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        return copy

    def add(self, words: list) -> None:
        step, link, longest = self.step, self.link, self.longest
        last = 0
        for word in words:
            q = step[last].get(word)
            if q is not None:
                last = q if longest[q] == longest[last] + 1 else self._split(last, word, q)
                continue
            new = self._state(longest[last] + 1, {}, 0)
            p = last
            while p != -1 and word not in step[p]:
                step[p][word] = new
                p = link[p]
            if p != -1:
                q = step[p][word]
                link[new] = q if longest[q] == longest[p] + 1 else self._split(p, word, q)
            last = new

    def matches(self, words: list) -> list[int]:
        """At each word, the length of the longest known sequence ending there."""
        step, link, longest = self.step, self.link, self.longest
        out, state, size = [], 0, 0
        for word in words:
            while state and word not in step[state]:
                state = link[state]
                size = longest[state]
            if word in step[state]:
                state = step[state][word]
                size += 1
            else:
                size = 0
            out.append(size)
        return out


class Shard:
    """The snippets of one key, fed in order of document id."""

    def __init__(self):
        self.known: set[bytes] = set()      # snippets that lie in the automaton as a whole
        self.automaton: SuffixAutomaton | None = None
        self.doc = None
        self.waiting: list[bytes] = []      # of the current document: no reference for itself

    def feed(self, doc: int, text: bytes) -> list[tuple[int, int]]:
        """Spans (first word, end) of the snippet that earlier documents hold."""
        if doc != self.doc:
            for w in self.waiting:
                self.known.add(w)
                if self.automaton is None:
                    self.automaton = SuffixAutomaton()
                self.automaton.add(w.split())
            self.waiting.clear()
            self.doc = doc
        if text in self.known:
            return [(0, text.count(b" ") + 1)]
        words = text.split()
        spans: list[tuple[int, int]] = []
        if self.automaton is not None:
            for i, size in enumerate(self.automaton.matches(words)):
                if size >= WINDOW:
                    lo = i + 1 - WINDOW
                    if spans and lo <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], i + 1)
                    else:
                        spans.append((lo, i + 1))
        if spans != [(0, len(words))]:
            self.waiting.append(text)
        return spans


# ---- tasks ----------------------------------------------------------------

def _profile(batches: Iterator) -> Iterator:
    """doc_id, tag, two content hashes, n_words, SHA-256 of all words, window keys."""
    import pyarrow as pa
    from xxhash import xxh3_128_digest
    for b in batches:
        ids, texts = b.column("doc_id"), as_bytes(b.column("text"))
        content, counts, shas, keys = [], [], [], []
        for lo, hi in byte_chunks(texts):
            words = [t.split() for t in texts[lo:hi]]
            h = _hash_words([w for ws in words for w in ws])
            g = window_keys(h)
            at = 0
            for ws in words:
                whole = b" ".join(ws)
                content.append(np.frombuffer(xxh3_128_digest(whole), np.int64))
                shas.append(hashlib.sha256(whole).hexdigest())
                counts.append(len(ws))
                own = g[at:at + max(0, len(ws) - WINDOW + 1)]
                keys.append(np.unique(own).view(np.int64))
                at += len(ws)
        pair = np.array(content, np.int64).reshape(-1, 2)
        offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [ids, b.column("tag"), pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(counts, pa.int64()), pa.array(shas, pa.string()),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *keys])))],
            names=["doc_id", "tag", "c1", "c2", "n_words", "sha", "keys"])


def _snippets(batches: Iterator) -> Iterator:
    """(key, doc_id, tag, start, text) of the windows whose key is wanted."""
    import pyarrow as pa
    for b in batches:
        ids, tags, texts = b.column("doc_id").to_pylist(), b.column("tag").to_pylist(), as_bytes(b.column("text"))
        wanted, hot = b.column("wanted").to_pylist(), b.column("hot").to_pylist()
        for lo, hi in byte_chunks(texts, 400_000):
            out_key, out_id, out_tag, out_start, out_text = [], [], [], [], []
            for d in range(lo, hi):
                words = texts[d].split()
                h = _hash_words(words)
                g = window_keys(h)
                keys = np.array(wanted[d], np.int64).view(np.uint64)
                hits = np.flatnonzero(np.isin(g, keys))
                if not len(hits):
                    continue
                hot_at = np.isin(g, np.array(hot[d], np.int64).view(np.uint64))
                alone = _sequences(h, WINDOW) if hot_at.any() else None
                cut = np.flatnonzero((np.diff(hits) != 1) | (g[hits][1:] != g[hits][:-1]) | hot_at[hits][1:]) + 1
                for run in np.split(hits, cut):
                    first, last = int(run[0]), int(run[-1])
                    out_key.append((alone if hot_at[first] else g)[first])
                    out_id.append(ids[d])
                    out_tag.append(tags[d])
                    out_start.append(first)
                    out_text.append(b" ".join(words[first:last + WINDOW]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(out_key, np.uint64).view(np.int64)), pa.array(out_id, pa.int64()), pa.array(out_tag, pa.int64()),
                 pa.array(out_start, pa.int64()), pa.array(out_text, pa.binary())], names=["key", "doc_id", "tag", "start", "text"])


def _spans(batches: Iterator) -> Iterator:
    """Snippets sorted by key and document → (doc_id, tag, first word, end) to remove."""
    import pyarrow as pa
    key, shard = None, Shard()
    for b in batches:
        ids, tags, los, his = [], [], [], []
        for k, doc, tag, start, text in zip(*(b.column(c).to_pylist() for c in ("key", "doc_id", "tag", "start", "text"))):
            if k != key:
                key, shard = k, Shard()
            for lo, hi in shard.feed(doc, text):
                ids.append(doc)
                tags.append(tag)
                los.append(start + lo)
                his.append(start + hi)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (ids, tags, los, his)], names=["doc_id", "tag", "lo", "hi"])


def kept_words(words: list[bytes], spans: list[dict]) -> list[bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for s in spans:
        gone[s["lo"]] += 1
        gone[s["hi"]] -= 1
    left = np.cumsum(gone[:-1]) == 0
    return [words[i] for i in np.flatnonzero(left)]


def _cut(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        ids = b.column("doc_id")
        texts = as_bytes(b.column("text"))
        kept = [kept_words(t.split(), s) for t, s in zip(texts, b.column("spans").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [ids, b.column("tag"), pa.array([len(k) for k in kept], pa.int64()), pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string())],
            names=["doc_id", "tag", "n_kept", "text"])


# ---- the job ----------------------------------------------------------------

def _tagged(docs: DataFrame) -> DataFrame:
    """Rows by id and text: an id may stand on several texts."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), "text")


def _profiled(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile of every row, removal spans of the documents that stand for their content)."""
    texts = _tagged(docs)
    profile = materialise(texts.mapInArrow(
        _profile, "doc_id long, tag long, c1 long, c2 long, n_words long, sha string, keys array<long>"), "profile")
    named = profile.where("doc_id is not null")
    heads = materialise(named.groupBy("c1", "c2").agg(F.min("doc_id").alias("head")), "contents")
    rows = named.select("doc_id", "tag", F.explode("keys").alias("key")).repartition("key")
    several = (rows.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("n"))
               .where("lo < hi").select("key", (F.col("n") > HOT).alias("hot")))
    per_doc = (rows.join(several.hint("shuffle_hash"), "key").groupBy("doc_id", "tag")
               .agg(F.collect_set("key").alias("wanted"), F.collect_set(F.when(F.col("hot"), F.col("key"))).alias("hot"))
               .join(heads.select(F.col("head").alias("doc_id")), "doc_id", "left_semi"))
    wanted = materialise(per_doc, "wanted-keys")
    ids = wanted.select("doc_id").distinct()
    some = texts.join(broadcast_if_small(ids, 48), "doc_id", "left_semi")
    snippets = (some.join(wanted.hint("shuffle_hash"), ["doc_id", "tag"]).select("doc_id", "tag", "text", "wanted", "hot")
                .mapInArrow(_snippets, "key long, doc_id long, tag long, start long, text binary"))
    spans = (snippets.repartition("key").sortWithinPartitions("key", "doc_id", "start")
             .mapInArrow(_spans, "doc_id long, tag long, lo long, hi long"))
    per_doc = spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return profile.join(heads, ["c1", "c2"], "left").drop("keys"), materialise(per_doc, "spans")


def _parts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(profile, doc_id/n_kept/text of the documents that lose some words)."""
    profile, spans = _profiled(docs)
    texts = _tagged(docs)
    some = texts.join(broadcast_if_small(spans.select("doc_id").distinct(), 48), "doc_id", "left_semi")
    cut = some.join(spans.hint("shuffle_hash"), ["doc_id", "tag"]).select("doc_id", "tag", "text", "spans").mapInArrow(
        _cut, "doc_id long, tag long, n_kept long, text string")
    return profile, cut


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by
    one space) of every row."""
    profile, cut = _parts(docs)
    cut = materialise(cut.select("doc_id", "tag", "n_kept", F.sha2(F.col("text").cast("binary"), 256).alias("cut_sha"))
                      .dropDuplicates(["doc_id", "tag"]), "cut")
    copy = F.coalesce((F.col("doc_id") > F.col("head")) & (F.col("n_words") >= WINDOW), F.lit(False))
    return profile.join(cut, ["doc_id", "tag"], "left").select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce(F.col("n_words") - F.col("n_kept"), F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY_SHA)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


def cut_texts(docs: DataFrame) -> DataFrame:
    """The rows whose text changes: doc_id and what is kept of it, words
    joined by one space."""
    profile, cut = _parts(docs)
    copies = profile.where(F.col("doc_id") > F.col("head")).where(F.col("n_words") >= WINDOW)
    return cut.select("doc_id", "text").unionByName(copies.select("doc_id", F.lit("").alias("text")))
