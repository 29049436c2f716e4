"""Language identification by prediction by partial matching (PPM).

For every language a byte context tree of order 3 holds, per context, how
often each byte followed it.  The probability of a byte is taken from the
longest context that has seen it; every shorter step costs the escape
probability of method C, ``distinct / (total + distinct)``, and the step
below order 0 is uniform over 256 bytes.  Statistics are frozen after
training, so a text's code length under a language is a plain sum of table
entries, and the predicted language is the one with the shortest code.

Training looks at a bounded sample (``rows_per_lang`` whole texts per
language, chosen by a hash of the id); Spark counts the contexts.  The four
orders are then compiled into one table ``cost[state, byte, language]``
whose states are the contexts any language has seen (longest suffix wins),
which tasks index with numpy.

Defined cases: null or letterless text → ``und`` with score 0; a tie between
languages → the alphabetically first; an empty training set → ``und`` for
all; repeated rows are scored alike; extra columns pass through ``predict``
untouched and are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import as_bytes, byte_chunks, fold

ORDER = 3
PAD = b"\n" * ORDER
UNDETERMINED = "und"
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


@dataclass
class PPMModel:
    langs: list[str]
    symbol: np.ndarray   # uint8[256] → symbol, 0 = byte never seen in training
    state: np.ndarray    # int32[A**3] → state of the longest known context
    cost: np.ndarray     # float32[states * A, languages], bits

    @property
    def size(self) -> int:
        return self.cost.nbytes + self.state.nbytes


def _grams(symbols: np.ndarray, base: int) -> np.ndarray:
    """Code of the (context, byte) pair that ends at each place from ORDER on."""
    s = symbols.astype(np.int64)
    return ((s[:-3] * base + s[1:-2]) * base + s[2:-1]) * base + s[3:]


def _count_batches(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        langs = b.column("lang").to_pylist()
        texts = as_bytes(b.column("text"))
        for lo, hi in byte_chunks(texts):
            for lang in sorted(set(langs[lo:hi])):
                parts = [_grams(np.frombuffer(PAD + t, np.uint8), 256)
                         for t, g in zip(texts[lo:hi], langs[lo:hi]) if g == lang and t]
                if not parts:
                    continue
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(gram), pa.string()),
                                                  "gram": pa.array(gram, pa.int64()), "n": pa.array(n, pa.int64())})


def train(docs: DataFrame, rows_per_lang: int = 200) -> PPMModel:
    """Fit on ``rows_per_lang`` labelled rows (``text``, ``lang``, ``doc_id``)
    per language; the sample bounds what reaches the driver."""
    known = docs.select("doc_id", "lang", "text").where("lang is not null and text is not null")
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = (known.select("lang", "doc_id").withColumn("rank", F.row_number().over(w))
           .where(F.col("rank") <= rows_per_lang).select("doc_id").distinct())
    sample = known.join(F.broadcast(ids), "doc_id", "left_semi")   # rows_per_lang ids per language
    counts = (sample.select("lang", "text").mapInArrow(_count_batches, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    return compile_model(counts["lang"].to_numpy(object), counts["gram"].to_numpy(np.int64),
                         counts["n"].to_numpy(np.float64))


def _escape_mix(counts: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Method C: seen bytes by count, unseen ones through the escape; a
    context this language never met costs nothing to leave."""
    total = counts.sum(1, keepdims=True)
    distinct = (counts > 0).sum(1, keepdims=True)
    whole = np.maximum(total + distinct, 1)
    return np.where(total == 0, shorter, np.where(counts > 0, counts / whole, distinct / whole * shorter))


def compile_model(lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> PPMModel:
    """Context counts → the table of code lengths (see the module docstring)."""
    langs = sorted(set(lang))
    if not langs:
        return PPMModel([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((1, 0), np.float32))
    byte = np.stack([gram >> 24, gram >> 16 & 255, gram >> 8 & 255, gram & 255])
    seen = np.unique(byte)
    symbol = np.zeros(256, np.uint8)
    symbol[seen] = np.arange(1, len(seen) + 1) if len(seen) < 256 else np.arange(256)
    a = int(symbol.max()) + 1
    c1, c2, c3, sym = symbol[byte].astype(np.int64)
    three, two = (c1 * a + c2) * a + c3, c2 * a + c3
    keys3, keys2 = np.unique(three), np.unique(two)
    # states: order 3, order 2, order 1, order 0
    first2, first1, last = len(keys3), len(keys3) + len(keys2), len(keys3) + len(keys2) + a
    cost = np.empty((last + 1, a, len(langs)), np.float32)
    row3, row2 = np.searchsorted(keys3, three), np.searchsorted(keys2, two)
    for j, g in enumerate(langs):
        m = lang == g

        def table(rows: np.ndarray, height: int) -> np.ndarray:
            t = np.zeros((height, a))
            np.add.at(t, (rows[m], sym[m]), n[m])
            return t

        p0 = _escape_mix(table(np.zeros_like(sym), 1), np.full((1, a), 1 / 256))
        p1 = _escape_mix(table(c3, a), p0)
        p2 = _escape_mix(table(row2, len(keys2)), p1[keys2 % a])
        p3 = _escape_mix(table(row3, len(keys3)), p2[np.searchsorted(keys2, keys3 % (a * a))])
        for at, p in ((0, p3), (first2, p2), (first1, p1), (last, p0)):
            cost[at:at + len(p), :, j] = -np.log2(p)
    known1 = np.zeros(a, bool)
    known1[c3] = True
    by1 = np.where(known1, first1 + np.arange(a), last)
    by2 = np.tile(by1, a)
    by2[keys2] = first2 + np.arange(len(keys2))
    state = np.tile(by2, a).astype(np.int32)
    state[keys3] = np.arange(len(keys3))
    return PPMModel(langs, symbol, state, cost.reshape(-1, len(langs)))


def code_lengths(model: PPMModel, texts: list[bytes], block: int = 400_000) -> np.ndarray:
    """Bits of each text under each language, float64[texts, languages]."""
    out = np.zeros((len(texts), len(model.langs)))
    a = int(model.symbol.max()) + 1
    joined = model.symbol[np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)]
    ends = np.cumsum([len(t) + ORDER for t in texts])
    owner_from = ends - np.array([len(t) for t in texts])   # first own byte of each text
    for lo in range(ORDER, len(joined), block):             # places whose byte is charged
        hi = min(lo + block, len(joined))
        s = joined[lo - ORDER:hi].astype(np.int32)
        idx = model.state[(s[:-3] * a + s[1:-2]) * a + s[2:-1]].astype(np.int64) * a + s[3:]
        bits = model.cost[idx]
        i, last = np.searchsorted(ends, [lo, hi - 1], side="right")
        rows = np.arange(i, last + 1)
        start = np.clip(owner_from[rows], lo, hi) - lo
        stop = np.clip(ends[rows], lo, hi) - lo
        full = stop > start
        if full.any():
            cuts = np.stack([start[full], stop[full]], 1).ravel()
            tail = cuts[-1] == len(bits)
            sums = np.add.reduceat(bits, cuts[:-1] if tail else cuts, axis=0, dtype=np.float64)[::2]
            out[rows[full]] += sums
    return out


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def _judge(model: PPMModel, texts: list[bytes]) -> tuple[list[str], list[float]]:
    langs, scores = [], []
    for lo, hi in byte_chunks(texts):
        part = texts[lo:hi]
        if not model.langs:
            langs += [UNDETERMINED] * len(part)
            scores += [0.0] * len(part)
            continue
        bits = code_lengths(model, part)
        best = bits.argmin(1)
        gap = np.minimum(bits - bits.min(1, keepdims=True), 1000.0)
        score = 1 / np.exp2(-gap).sum(1)
        for t, k, s in zip(part, best, score):
            ok = has_letter(t)
            langs.append(model.langs[k] if ok else UNDETERMINED)
            scores.append(float(s) if ok else 0.0)
    return langs, scores


def predict(docs: DataFrame, model: PPMModel) -> DataFrame:
    """Every row with ``lang_pred`` and ``score`` (posterior of the best
    language under equal priors) appended; only ``text`` is looked at."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)   # bounded by the training sample
    keep = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            langs, scores = _judge(shared.value, as_bytes(b.column("__text")))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text")).mapInArrow(run, schema)


def identify(docs: DataFrame, rows_per_lang: int = 200, folds: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learns from the rows outside fold 0
    and predicts all."""
    held_out = fold(F.col("doc_id"), folds) == 0
    model = train(docs.where(~F.coalesce(held_out, F.lit(True))), rows_per_lang)
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(True)).alias("held_out"), "text")
    return predict(rows, model).select("doc_id", "held_out", "lang_pred", "score")
