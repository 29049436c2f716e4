"""SentencePiece encoding and decoding by unigram Viterbi.

Pieces and their scores are read from a public model file; scores are taken
as log scores.  A word is segmented into the pieces with the largest total
score, found by Viterbi over a double-array trie of the pieces' UTF-8 bytes.
A character that no piece covers falls back to its byte pieces ``<0xHH>``.
Spaces become the marker U+2581 and a text starts with one, as the model
demands; decoding turns markers back into spaces, bytes into characters, and
drops the first marker.  A literal U+2581 in a text is written as bytes, so
that decoding returns every text exactly.

No piece has a marker behind another character, so the best segmentation of
a text is that of its marker-led words one by one; this is checked when a
model is loaded.  Words of a batch are segmented together in numpy: the trie
is walked one byte at a time from all start places at once, then the best
scores are filled in place by place over all words.

Ties: the longer last piece wins.  Null texts have no ids (null) and decode
to null; the empty text has none (an empty list).
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_bytes, byte_chunks

MARK = "\u2581"
_MARK = MARK.encode()
_LITERAL = b"\xff"           # stands for a literal marker; no UTF-8 text holds this byte
_RUNS = re.compile(rb" +[^ ]*")
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: added to the worst piece's score for a character written in bytes, per byte
BYTE_PENALTY = 10.0
CACHE_WORDS = 250_000    # words a task remembers, twice (see Encoder._remember)
SEGMENT_BYTES = 60_000   # bytes of words that are segmented together
BATCH_ROWS = 512         # rows a task holds as Python objects at a time


@dataclass
class PieceModel:
    pieces: list[str]
    scores: np.ndarray      # float64[pieces]
    byte_ids: np.ndarray    # int32[256]
    base: np.ndarray        # int32: double array
    check: np.ndarray
    leaf: np.ndarray        # int32: piece that ends in a state, or -1
    longest: int            # bytes of the longest piece
    cut_lines: bool         # no piece but a byte piece holds a line end

    @property
    def size(self) -> int:
        return self.base.nbytes * 3 + self.scores.nbytes + sum(map(len, self.pieces))


def build_trie(pieces: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Double array of the given byte strings: the child of state ``s`` by
    byte ``c`` is ``base[s] + c`` if ``check`` there is ``s``."""
    children: list[dict[int, int]] = [{}]
    ends = [-1]
    for word, number in pieces:
        at = 0
        for c in word:
            if c not in children[at]:
                children[at][c] = len(children)
                children.append({})
                ends.append(-1)
            at = children[at][c]
        ends[at] = number
    # branching states take fresh stretches one after the other; states with
    # one child then fill the holes, so no search is needed
    place, offset = np.zeros(len(children), np.int64), np.zeros(len(children), np.int64)
    taken, top = {0}, 1
    single = []
    for node, kids in enumerate(children):
        if len(kids) == 1:
            single.append(node)
        elif kids:
            offset[node] = max(top - min(kids), 1)
            slots = [int(offset[node]) + c for c in kids]
            taken.update(slots)
            top = max(slots) + 1
    holes = (k for k in itertools.count(257) if k not in taken)
    for node in single:
        offset[node] = next(holes) - next(iter(children[node]))
    for node, kids in enumerate(children):
        for c, child in kids.items():
            place[child] = offset[node] + c
    size = int(place.max()) + 257
    base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    base[place] = offset
    leaf[place] = ends
    for node, kids in enumerate(children):
        for c in kids:
            check[offset[node] + c] = place[node]
    return base, check, leaf


def load_model(path: str = MODEL_PATH) -> PieceModel:
    """Pieces and scores of a SentencePiece file (read on the driver)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = [(sp.id_to_piece(i), sp.get_score(i), sp.is_byte(i), sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))
            for i in range(sp.get_piece_size())]
    return make_model(rows)


def make_model(rows: list[tuple[str, float, bool, bool]]) -> PieceModel:
    """From (piece, score, is a byte piece, is special) rows in id order."""
    byte_ids = np.full(256, -1, np.int32)
    plain = []
    for i, (piece, _, is_byte, special) in enumerate(rows):
        if is_byte:
            byte_ids[int(piece[3:5], 16)] = i
        elif not special:
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} crosses a word: words can't be segmented one by one")
            plain.append((piece.encode(), i))
    if (byte_ids < 0).any():
        raise ValueError("the model has no byte fallback")
    base, check, leaf = build_trie(plain)
    return PieceModel([r[0] for r in rows], np.array([r[1] for r in rows], np.float64), byte_ids, base, check, leaf,
                      max((len(p) for p, _ in plain), default=1), not any(b"\n" in p for p, _ in plain))


class Encoder:
    """Segments words with a model; remembers frequent ones (bounded)."""

    def __init__(self, model: PieceModel):
        self.m = model
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.piece_len = [len(p.encode()) for p in model.pieces]
        # byte pieces of a byte; a literal marker is spelt as its three bytes
        self.spell = [(int(i),) for i in model.byte_ids]
        self.spell[_LITERAL[0]] = tuple(int(model.byte_ids[c]) for c in _MARK)
        plain = np.ones(len(model.pieces), bool)
        plain[model.byte_ids] = False
        self.worst = float(model.scores[plain].min()) - BYTE_PENALTY
        self.char_len = np.ones(256, np.int64)      # UTF-8 length by first byte
        self.char_len[0xC0:0xE0], self.char_len[0xE0:0xF0], self.char_len[0xF0:] = 2, 3, 4
        self.char_len[_LITERAL[0]] = 1

    def _segment(self, words: list[bytes]) -> list[np.ndarray]:
        """Viterbi over words of at most a few hundred bytes, all at once."""
        m = self.m
        lens = np.array([len(w) for w in words])
        text = np.frombuffer(b"".join(words) + bytes(m.longest), np.uint8).astype(np.int64)
        starts = np.cumsum(lens) - lens
        n = int(lens.sum())
        first = (text[:n] & 0xC0) != 0x80                 # character starts
        width = int(lens.max())
        # pieces by (start, length): walk the trie from all character starts at once
        left = np.repeat(starts + lens, lens) - np.arange(n)
        at = np.flatnonzero(first)
        state = np.zeros(len(at), np.int64)
        found_at, found_len, found_id = [], [], []
        for k in range(m.longest):
            ok = left[at] > k
            at, state = at[ok], state[ok]
            if not len(at):
                break
            nxt = m.base[state] + text[at + k]
            ok = m.check[nxt] == state
            at, state = at[ok], nxt[ok].astype(np.int64)
            piece = m.leaf[state]
            hit = piece >= 0
            found_at.append(at[hit])
            found_len.append(np.full(int(hit.sum()), k + 1))
            found_id.append(piece[hit])
        begin = np.concatenate(found_at) if found_at else np.zeros(0, np.int64)
        length = np.concatenate(found_len) if found_len else np.zeros(0, np.int64)
        ident = np.concatenate(found_id) if found_id else np.zeros(0, np.int32)
        gain = m.scores[ident]
        # a character in bytes is always possible where it is no piece itself
        spots = np.flatnonzero(first)
        own = self.char_len[text[spots]]
        single = np.zeros(n, bool)
        single[begin[length == self.char_len[text[begin]]]] = True
        spots, own = spots[~single[spots]], own[~single[spots]]
        begin = np.concatenate([begin, spots])
        length = np.concatenate([length, own])
        ident = np.concatenate([ident, np.full(len(spots), -1)])
        gain = np.concatenate([gain, own * self.worst])
        # fill the best scores end by end; edges are grouped by their end within the word
        word = np.repeat(np.arange(len(words)), lens)
        end = begin - starts[word[begin]] + length
        # edges stand in order of length already, and a stable sort keeps that
        order = np.argsort(end.astype(np.uint16 if width < 1 << 16 else np.int64), kind="stable")
        begin, length, ident, gain, end = (x[order] for x in (begin, length, ident, gain, end))
        cuts = np.searchsorted(end, np.arange(width + 2))
        slot = starts + np.arange(len(words))             # a slot per place and one for the end of each word
        to_all = begin + word[begin] + length
        best = np.full(n + len(words), -np.inf)
        best[slot] = 0
        back_len, back_id = np.zeros(n + len(words), np.int64), np.full(n + len(words), -1)
        for e in range(1, width + 1):
            lo, hi = cuts[e], cuts[e + 1]
            if lo == hi:
                continue
            to, size = to_all[lo:hi], length[lo:hi]
            total = best[to - size] + gain[lo:hi]
            np.maximum.at(best, to, total)
            won = total == best[to]                       # of equal ones the longest is written last
            back_len[to[won]], back_id[to[won]] = size[won], ident[lo:hi][won]
        # walk back from all ends at once; step t of a word is its t-th last token
        alive, e = np.arange(len(words)), lens.copy()
        steps, many = [], np.zeros(len(words), np.int64)
        spelt = set()
        while len(alive):
            at = slot[alive] + e
            steps.append((alive, back_id[at]))
            many[alive] += 1
            spelt.update(alive[back_id[at] < 0].tolist())
            e = e - back_len[at]
            alive, e = alive[e > 0], e[e > 0]
        stop = np.cumsum(many)
        flat = np.zeros(int(stop[-1]), "<i4")
        for t, (w, ident) in enumerate(steps):
            flat[stop[w] - 1 - t] = ident
        raw = flat.tobytes()
        cut = [0, *(stop * 4).tolist()]
        out = [raw[cut[i]:cut[i + 1]] for i in range(len(words))]
        for i in spelt:
            ids, w, place = [], words[i], 0
            for k in np.frombuffer(out[i], "<i4").tolist():
                if k >= 0:
                    size = self.piece_len[k]
                    ids.append(k)
                else:
                    size = int(self.char_len[w[place]])
                    ids += [b for c in w[place:place + size] for b in self.spell[c]]
                place += size
            out[i] = np.array(ids, "<i4").tobytes()
        return out

    def _remember(self, words: set[bytes]) -> None:
        """Put the given words into the cache; words not met since the cache
        was last full are forgotten when it is full again."""
        if len(self.cache) > CACHE_WORDS:
            self.older, self.cache = self.cache, {}
        new = []
        for w in words:
            if w not in self.cache:
                if w in self.older:
                    self.cache[w] = self.older[w]
                else:
                    new.append(w)
        new.sort(key=len)                                 # words of like length share the loop over ends
        lo = size = 0
        for i, w in enumerate(new):
            size += len(w)
            if size > SEGMENT_BYTES or i + 1 == len(new):
                self.cache.update(zip(new[lo:i + 1], self._segment(new[lo:i + 1])))
                lo, size = i + 1, 0

    def words_of(self, text: bytes) -> list[bytes]:
        """Marker-led words, cut at line ends too where no piece holds one."""
        if not text:
            return []
        text = b" " + text.replace(_MARK, _LITERAL)
        out = []
        for i, line in enumerate(text.split(b"\n") if self.m.cut_lines else [text]):
            if i:
                out.append(b"\n")
            if b"  " in line:
                lead = line[:len(line) - len(line.lstrip(b" "))]
                if not lead:
                    head, _, line = line.partition(b" ")
                    out.append(head)
                    line = b" " + line
                out += [w.replace(b" ", _MARK) for w in _RUNS.findall(line)]
            else:
                head, *rest = line.split(b" ")
                if head:
                    out.append(head)
                out += [_MARK + w for w in rest]
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, as little-endian int32 bytes."""
        out: list[bytes] = []
        for lo, hi in byte_chunks(texts, 4_000_000):
            split = [self.words_of(t) for t in texts[lo:hi]]
            self._remember({w for ws in split for w in ws})
            get = self.cache.__getitem__
            out += [b"".join(map(get, ws)) for ws in split]
        return out


class Decoder:
    def __init__(self, model: PieceModel):
        self.parts = [p.replace(MARK, " ").encode() for p in model.pieces]
        for c, i in enumerate(model.byte_ids):
            self.parts[i] = bytes([c])

    def decode(self, ids: bytes) -> bytes:
        raw = b"".join(map(self.parts.__getitem__, np.frombuffer(ids, "<i4").tolist()))
        return raw[1:] if raw[:1] == b" " else raw


def _share(df: DataFrame, model: PieceModel | None, path: str):
    model = model or load_model(path)
    if model.size > 64 << 20:
        raise ValueError("the model is too large to broadcast")
    return df.sparkSession.sparkContext.broadcast(model)


def _plus(df: DataFrame, without: tuple, *more: T.StructField) -> tuple[list[str], T.StructType]:
    keep = [c for c in df.columns if c not in without]
    return keep, T.StructType([df.schema[c] for c in keep] + list(more))


def encode(docs: DataFrame, path: str = MODEL_PATH, model: PieceModel | None = None) -> DataFrame:
    """Every row with ``ids`` (array<int>) appended."""
    shared = _share(docs, model, path)
    keep, schema = _plus(docs, ("ids",), T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        encoder = Encoder(shared.value)
        for b in batches:
            texts = b.column("__text").cast(pa.binary()).to_pylist()
            got = encoder.encode([t or b"" for t in texts])
            ids = pa.array([None if t is None else np.frombuffer(g, "<i4") for t, g in zip(texts, got)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [ids], names=[*keep, "ids"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text")).mapInArrow(run, schema)


def decode(rows: DataFrame, path: str = MODEL_PATH, model: PieceModel | None = None) -> DataFrame:
    """Every row with ``text`` decoded from ``ids``."""
    shared = _share(rows, model, path)
    keep, schema = _plus(rows, ("text", "ids"), T.StructField("text", T.StringType()))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        decoder = Decoder(shared.value)
        for b in batches:
            texts = [None if i is None else decoder.decode(np.array(i, "<i4").tobytes()).decode("utf-8", "replace")
                     for i in b.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in keep] + [pa.array(texts, pa.string())],
                                             names=[*keep, "text"])

    return rows.select(*[F.col(f"`{c}`") for c in keep], F.col("ids").alias("__ids")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str = MODEL_PATH, model: PieceModel | None = None) -> DataFrame:
    """Encode and decode in one pass, for corpora whose ids need not be kept:
    every row with ``n_tokens``, ``n_byte_tokens``, ``ids_sha256`` (over
    little-endian int32), and ``text`` replaced by the decoded text."""
    shared = _share(docs, model, path)
    more = (T.StructField("n_tokens", T.LongType()), T.StructField("n_byte_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()), T.StructField("text", T.StringType()))
    names = [f.name for f in more]
    keep, schema = _plus(docs, tuple(names), *more)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        encoder, decoder = Encoder(shared.value), Decoder(shared.value)
        is_byte = np.zeros(len(shared.value.pieces), bool)
        is_byte[shared.value.byte_ids] = True
        for b in (whole.slice(k, BATCH_ROWS) for whole in batches for k in range(0, whole.num_rows, BATCH_ROWS)):
            texts = b.column("__text").cast(pa.binary()).to_pylist()
            ids = encoder.encode([t or b"" for t in texts])
            back = pa.array([None if t is None else decoder.decode(i) for t, i in zip(texts, ids)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in keep] + [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([int(is_byte[np.frombuffer(i, "<i4")].sum()) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    back.cast(pa.string())],
                names=[*keep, *names])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("__text")).mapInArrow(run, schema)
