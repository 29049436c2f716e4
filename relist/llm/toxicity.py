"""Toxicity scores from a small convolutional text classifier.

Words are hashed into an embedding table (a word's vector is the sum of its
own and those of its first letters); filters of several widths slide
over the word sequence, each keeps its maximum over the whole text, and a
logistic layer turns the maxima into a probability.  Only the places that
won a maximum receive a gradient, so training in numpy is cheap.

The network learns from every labelled row with its whole text.  The rows are
dealt to partitions by a hash; in each pass every partition learns on from the
common state over all its rows, and the states (of a fixed size) are averaged.
A quarter of the texts is set aside to choose one threshold per language; the
language of a text is guessed from its own words (hashed-word Bayes learnt
from all labelled rows), never read from a column.  The logit is shifted so
that each language's threshold falls on ``THRESHOLD``.

Scoring folds embedding and filters into one table per filter tap
(``bucket → filters``), so a text costs a few table look-ups per word, in
bounded blocks.

Defined cases: null and empty texts get the score of a text without words;
without any labelled row, or with one class only, every score is the share
of label 1 (0 when there is none); repeated labels of an id count once, with
the highest value.
"""

from __future__ import annotations

import copy
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, byte_chunks, fold, materialise, small_enough

THRESHOLD = 0.3
#: labelled rows of a partition, and rows learnt from before two passes do
PART_ROWS = 16384
PASS_ROWS = 100_000
#: thresholds are chosen among logits to 1/256 within +-60
LOGIT_STEPS, LOGIT_END = 256, 60
#: bytes of states that the driver adds up by itself, and tasks per core that send one
SUM_BYTES, SUM_TASKS = 32 << 20, 4
_SEPARATORS = bytes(range(33)) + b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\x7f"
_TABLE = bytes(32 if c in _SEPARATORS else c for c in range(256))


@dataclass
class Settings:
    buckets: int = 1 << 15
    dim: int = 12
    widths: tuple = (1, 2, 3)
    filters: int = 8
    epochs: int = 5
    batch: int = 48
    rate: float = 0.01
    decay: float = 1e-4
    seed: int = 7


@dataclass
class ToxicityModel:
    taps: list              # per width: float32[width, buckets, filters]
    bias: np.ndarray        # filter biases, widths in order
    out: np.ndarray         # logistic weights
    out_bias: float
    langs: list             # learnt language values
    words: np.ndarray       # float32[buckets, languages], log-probabilities
    shift: np.ndarray       # logit shift per language (last: no language)
    prior: float | None = None


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_TABLE).split()


def hashed(words: list[bytes], buckets: int) -> np.ndarray:
    """Buckets of each word: of the whole word and of its first 4 and 5
    bytes, whose embeddings are added (inflected forms share the latter)."""
    n = len(words)
    out = np.empty((n, 3), np.int64)
    out[:, 0] = np.fromiter(map(zlib.crc32, words), np.int64, n)
    out[:, 1] = np.fromiter((zlib.crc32(w[:4], 4) for w in words), np.int64, n)
    out[:, 2] = np.fromiter((zlib.crc32(w[:5], 5) for w in words), np.int64, n)
    return out & (buckets - 1)


def number(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Texts as numbers of their distinct words."""
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    ids = [np.array([put(w, len(seen)) for w in words_of(t)], np.int64) for t in texts]
    return ids, list(seen)


def _pool(taps: list, bias: np.ndarray, ids: np.ndarray, starts: np.ndarray, lens: np.ndarray, where: bool = False):
    """Maxima (after ReLU) of every filter over every text; with ``where``
    also the place of each maximum (-1: none above zero).  ``ids`` holds the
    texts one after the other, each followed by padding that no filter
    crosses into another text with: taps past a text's end add nothing."""
    n_texts = len(starts)
    maxima, places = [], []
    at = 0
    total = len(ids)
    for tap in taps:
        width, _, filters = tap.shape
        z = tap[0][ids]
        left = np.repeat(starts + lens, lens) - np.arange(total)    # words left in the text, own included
        for k in range(1, width):
            z[:total - k] += np.where((left[:total - k] > k)[:, None], tap[k][ids[k:]], 0)
        z += bias[at:at + filters]
        at += filters
        some = lens > 0
        top = np.zeros((n_texts, filters), np.float32)
        if some.any():
            top[some] = np.maximum.reduceat(z, starts[some], axis=0)
        if where:
            place = np.full((n_texts, filters), -1)
            for i in np.flatnonzero(some):
                part = z[starts[i]:starts[i] + lens[i]]
                place[i] = np.where(top[i] > 0, part.argmax(0) + starts[i], -1)
            places.append(place)
        maxima.append(np.maximum(top, 0))
    return np.concatenate(maxima, 1), places


@dataclass
class State:
    """What a pass begins with: parameters and Adam's two moments of each."""
    emb: list               # embedding and its moments: float32[buckets, dim]
    rest: list              # kernels, filter biases, logistic weights and bias; then their moments
    step: float = 0.0


def fresh_state(s: Settings, share: float) -> State:
    """The state before the first pass; ``share``: of toxic rows."""
    rng = np.random.default_rng(s.seed)
    n_f = s.filters * len(s.widths)
    emb = rng.normal(0, 0.05, (s.buckets, s.dim)).astype(np.float32)
    kernels = [rng.normal(0, 0.5, (w, s.dim, s.filters)).astype(np.float32) for w in s.widths]
    out = rng.normal(0, 0.3, n_f).astype(np.float32)
    share = np.clip(share, 0.01, 0.99)
    params = [*kernels, np.full(n_f, 0.02, np.float32), out, np.array([np.log(share / (1 - share))], np.float32)]
    return State([emb, np.zeros_like(emb), np.zeros_like(emb)], params + [np.zeros_like(p) for p in params * 2])


def learn(state: State, texts: list[bytes], labels: np.ndarray, rate: float, s: Settings) -> np.ndarray:
    """One step of Adam on the log loss of a few texts, in place; returns the
    buckets it moved."""
    n_k = len(s.widths)
    emb, e1, e2 = state.emb
    n = len(state.rest) // 3
    params, m1, m2 = state.rest[:n], state.rest[n:2 * n], state.rest[2 * n:]
    kernels, (bias, out, out_bias) = params[:n_k], params[n_k:]
    numbers, words = number(texts)
    lens = np.array([len(t) for t in numbers])
    local = np.concatenate(numbers)
    starts = np.cumsum(lens) - lens
    used, place_of = np.unique(hashed(words, s.buckets), return_inverse=True)
    place_of = place_of.reshape(-1, 3)
    own = emb[used]
    rows = own[place_of].sum(1)
    taps = [np.einsum("ud,kdf->kuf", rows, k) for k in kernels]
    pooled, places = _pool(taps, bias, local, starts, lens, where=True)
    p = 1 / (1 + np.exp(-np.clip(pooled @ out + out_bias[0], -80, 80)))
    err = ((p - labels) / len(texts)).astype(np.float32)
    grads = [np.zeros_like(k) for k in kernels] + [np.zeros_like(bias), pooled.T @ err, err.sum(keepdims=True)]
    g_rows = np.zeros_like(rows)
    back = err[:, None] * out[None, :]
    ends = starts + lens
    for j, (kernel, place) in enumerate(zip(kernels, places)):
        text, filt = np.nonzero(place >= 0)
        spot, g = place[text, filt], back[text, j * s.filters + filt]
        np.add.at(grads[n_k], j * s.filters + filt, g)
        for k in range(kernel.shape[0]):
            ok = spot + k < ends[text]
            word = local[spot[ok] + k]
            np.add.at(grads[j][k].T, filt[ok], g[ok, None] * rows[word])
            np.add.at(g_rows, word, g[ok, None] * kernel[k].T[filt[ok]])
    state.step += 1
    fix = np.sqrt(1 - 0.999 ** state.step) / (1 - 0.9 ** state.step)
    for i, (param, g) in enumerate(zip(params, grads)):
        g = g + s.decay * param * (i < n_k)
        m1[i] += 0.1 * (g - m1[i])
        m2[i] += 0.001 * (g * g - m2[i])
        param -= rate * fix * m1[i] / (np.sqrt(m2[i]) + 1e-8)
    g = s.decay * own
    touched = np.flatnonzero(g_rows.any(1))
    for k in range(3):
        np.add.at(g, place_of[touched, k], g_rows[touched])
    e1[used] += 0.1 * (g - e1[used])
    e2[used] += 0.001 * (g * g - e2[used])
    emb[used] = own - rate * fix * e1[used] / (np.sqrt(e2[used]) + 1e-8)
    return used


def _batches(texts: list[bytes], order: np.ndarray, s: Settings) -> Iterator[np.ndarray]:
    """``order`` in runs of ``batch`` rows, fewer where the texts are long."""
    for lo in range(0, len(order), s.batch):
        pick = order[lo:lo + s.batch]
        for a, b in byte_chunks([texts[i] for i in pick]):
            yield pick[a:b]


def _summed(told: RDD, size: int) -> list[np.ndarray]:
    """The sum of the states (of ``size`` bytes each) in all partitions.  A
    task adds up those of several partitions, so as many are sent as there are
    cores for, not as the rows have partitions; a few need no shuffle."""
    told = told.coalesce(SUM_TASKS * told.context.defaultParallelism).map(lambda r: pickle.loads(r[0]))
    reduce = told.reduce if told.getNumPartitions() * size <= SUM_BYTES else told.treeReduce
    return reduce(lambda a, b: [x + y for x, y in zip(a, b)])


def _one_pass(rows: DataFrame, state: State, turn: int, s: Settings) -> State:
    """Every row once: each partition learns on from ``state`` over its own
    rows, then the partitions' states are averaged by their rows (a bucket of
    the embedding over the partitions that met its words)."""
    shared = rows.sparkSession.sparkContext.broadcast(state)     # fixed size: Settings
    rate = s.rate * (1 - turn / s.epochs)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        mine, n = copy.deepcopy(shared.value), 0
        met = np.zeros(s.buckets, bool)
        rng = np.random.default_rng([s.seed, turn])
        for b in batches:
            texts, y = as_bytes(b.column("text")), b.column("toxic").to_numpy(zero_copy_only=False).astype(np.float64)
            n += len(texts)
            for pick in _batches(texts, rng.permutation(len(texts)), s):
                met[learn(mine, [texts[i] for i in pick], y[pick], rate, s)] = True
        if n:
            weight = (n * met).astype(np.float32)
            told = [np.array([n, n * mine.step]), weight, *[weight[:, None] * a for a in mine.emb], *[np.float32(n) * a for a in mine.rest]]
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(told)], pa.binary())], names=["told"])

    told = rows.select("text", "toxic").mapInArrow(run, "told binary").rdd
    (n, steps), weight, *sums = _summed(told, sum(a.nbytes for a in state.emb + state.rest))      # of fixed size as well
    shared.destroy()
    some = weight > 0
    for old, new in zip(state.emb, sums):
        old[some] = new[some] / weight[some, None]
    return State(state.emb, [np.float32(1 / n) * a for a in sums[3:]], float(steps / n))


def network(rows: DataFrame, share: float, s: Settings):
    """Filter taps, biases and logistic layer learnt from all rows (text, toxic)."""
    state = fresh_state(s, share)
    for turn in range(s.epochs):
        state = _one_pass(rows, state, turn, s)
    n_k = len(s.widths)
    kernels, (bias, out, out_bias) = state.rest[:n_k], state.rest[n_k:n_k + 3]
    taps = [np.einsum("ud,kdf->kuf", state.emb[0], k).astype(np.float32) for k in kernels]
    return taps, bias, out, float(out_bias[0])


def _words_of_languages(rows: DataFrame, s: Settings) -> tuple[list, np.ndarray]:
    """(languages, log-probability of every bucket in each) over all rows."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = as_bytes(b.column("text")), b.column("lang").to_pylist()
            for lo, hi in byte_chunks(texts):
                numbers, words = number(texts[lo:hi])
                bucket = hashed(words, s.buckets)[:, 0]
                for ids, g in zip(numbers, langs[lo:hi]):
                    if g not in counts:
                        counts[g] = np.zeros(s.buckets, np.int64)
                    np.add.at(counts[g], bucket[ids], 1)
        for g, found in counts.items():
            at = np.append(np.flatnonzero(found), -1)      # -1: the language was there
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(at), pa.string()), pa.array(at, pa.int64()),
                                              pa.array(np.append(found[at[:-1]], 1), pa.int64())], names=["lang", "bucket", "n"])

    told = rows.where("lang is not null").select("text", "lang").mapInArrow(run, "lang string, bucket long, n long")
    got = told.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()        # languages * buckets rows at most
    known = sorted(set(got["lang"]))
    words = np.full((s.buckets, len(known)), 0.1)
    got = got[got["bucket"] >= 0]
    words[got["bucket"], got["lang"].map({g: i for i, g in enumerate(known)})] += got["n"]
    return known, np.log(words / words.sum(0)).astype(np.float32)


def _logits(m: ToxicityModel, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(logit, guessed language) of each text."""
    numbers, words = number(texts)
    of_word = hashed(words, m.words.shape[0])
    taps = [np.stack([t[of_word].sum(1) for t in tap]) for tap in m.taps]
    lens = np.array([len(t) for t in numbers])
    ids = np.concatenate(numbers) if len(numbers) else np.zeros(0, np.int64)
    starts = np.cumsum(lens) - lens
    pooled, _ = _pool(taps, m.bias, ids, starts, lens)
    lang = np.full(len(texts), len(m.langs))
    some = lens > 0
    if some.any() and m.langs:
        lang[some] = np.add.reduceat(m.words[of_word[:, 0]][ids], starts[some], axis=0, dtype=np.float64).argmax(1)
    return pooled @ m.out + m.out_bias, lang


def _best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best weighted F1, in the middle of the gap it falls into."""
    order = np.argsort(-logit, kind="stable")
    z, hits, taken = logit[order], np.cumsum((y * weight)[order]), np.cumsum(weight[order])
    f1 = 2 * hits / (taken + (y * weight).sum())
    f1[:-1][z[:-1] == z[1:]] = -1
    k = int(f1.argmax())
    return float((z[k] + z[k + 1]) / 2) if k + 1 < len(z) else float(z[k] - 0.5)


def _shift_thresholds(model: ToxicityModel, rows: DataFrame, least_positives: int) -> None:
    """Set ``shift`` from the logits of all rows: rows are counted by guessed
    language, label and logit (to 1/LOGIT_STEPS, cut at LOGIT_END)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            texts = as_bytes(b.column("text"))
            z, lang = np.zeros(len(texts)), np.zeros(len(texts), np.int32)
            for lo, hi in byte_chunks(texts, 400_000):
                z[lo:hi], lang[lo:hi] = _logits(shared.value, texts[lo:hi])
            z = np.rint(np.clip(z, -LOGIT_END, LOGIT_END) * LOGIT_STEPS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(z), b.column("toxic")], names=["lang", "z", "toxic"])

    told = rows.select("text", "toxic").mapInArrow(run, "lang int, z int, toxic int")
    got = told.groupBy("lang", "z", "toxic").agg(F.count("*").alias("n")).orderBy("lang", "z", "toxic").toPandas()    # languages * steps rows at most
    lang, z, y, n = got["lang"].to_numpy(), got["z"].to_numpy(float) / LOGIT_STEPS, got["toxic"].to_numpy(float), got["n"].to_numpy(float)
    common = _best_threshold(z, y, n)
    level = np.log(THRESHOLD / (1 - THRESHOLD))
    for j in range(len(model.langs) + 1):
        mine = lang == j
        bad, every = (y * n)[mine].sum(), n[mine].sum()
        own = least_positives <= bad < every
        model.shift[j] = level - (_best_threshold(z[mine], y[mine], n[mine]) if own else common)


def train(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, least_positives: int = 15) -> ToxicityModel:
    """Learn ``labels.toxic`` (0/1 by ``doc_id``) from every labelled row."""
    s = settings or Settings()
    marked = (labels.where("toxic in (0, 1) and doc_id is not null").groupBy("doc_id")
              .agg(F.max("toxic").cast("int").alias("toxic")))
    marked = materialise(marked, "labelled")
    # copies of a text are all learnt from, on one side of the split
    whole = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang")
    whole = whole.withColumn("aside", F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(4)) == 3)
    rows = whole.select("doc_id", "aside").join(marked, "doc_id")
    counts = {(r["toxic"], r["aside"]): r["n"] for r in rows.groupBy("toxic", "aside").agg(F.count("*").alias("n")).collect()}    # four at most
    n = {side: (counts.get((0, side), 0), counts.get((1, side), 0)) for side in (False, True)}
    good, bad = (n[False][y] + n[True][y] for y in (0, 1))
    if not good or not bad:
        return ToxicityModel([], np.zeros(0), np.zeros(0), 0.0, [], np.zeros((0, 0)), np.zeros(1), prior=float(bad > 0))
    split = all(n[False]) and all(n[True])
    learnt = sum(n[False]) if split else good + bad
    # many rows need fewer passes; each pass is over all of them
    s = replace(s, epochs=int(np.clip(-(-PASS_ROWS // learnt), min(2, s.epochs), s.epochs)))
    parts = (good + bad) // PART_ROWS + 1
    # texts cross the network once, those of labelled rows alone if the labels are few
    rows = whole.join(F.broadcast(marked), "doc_id").repartition("doc_id") if small_enough(marked, 40) else whole.join(marked, "doc_id")
    rows = (rows.withColumn("h", F.xxhash64(F.lit(7), "doc_id", "text")).coalesce(parts).sortWithinPartitions("h", "doc_id")
            .select("text", "lang", "toxic", "aside").persist(StorageLevel.DISK_ONLY))
    try:
        taps, bias, out, out_bias = network(rows.where("not aside") if split else rows, n[False][1] / learnt if split else bad / learnt, s)
        known, words = _words_of_languages(rows, s)
        model = ToxicityModel(taps, bias, out, out_bias, known, words, np.zeros(len(known) + 1))
        _shift_thresholds(model, rows.where("aside") if split else rows, least_positives)
    finally:
        rows.unpersist()
    return model


def scores(model: ToxicityModel, texts: list[bytes]) -> np.ndarray:
    if model.prior is not None:
        return np.full(len(texts), model.prior)
    out = np.zeros(len(texts))
    for lo, hi in byte_chunks(texts, 400_000):
        z, lang = _logits(model, texts[lo:hi])
        out[lo:hi] = 1 / (1 + np.exp(-np.clip(z + model.shift[lang], -500, 500)))
    return out


def predict(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every row with ``score`` and ``predicted`` appended, from ``text`` alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)     # fixed size: Settings.buckets
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            s = scores(shared.value, as_bytes(b.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))],
                names=[*keep, "score", "predicted"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text")).mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted: learns outside the held fold."""
    held_out = F.coalesce(fold(F.col("doc_id"), folds) == held_fold, F.lit(True))
    model = train(docs.where(~held_out), labels.where(~held_out))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "score", "predicted")
