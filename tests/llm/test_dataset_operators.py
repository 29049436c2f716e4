"""Merkle manifest, source mixing and periodic runs against plain re-statements."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from relist.llm import merkle, mixing, periodic
from relist.llm import queries as Q
from relist.llm.common import fold

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [(-5, None, None, None, None), (-4, "", "en", None, 0), (None, "text without id", "en", "s", 1), (-2, "same row", "en", "s", 8),
       (-2, "same row", "en", "s", 8), (-1, "word " * 60_000, "en", "s", 300_000), (7, "a\nb", "en", "é", 3), (8, "a\nb", None, "z", 3)]


def docs(spark, rows):
    return spark.createDataFrame(rows, DOC)


def clash(df):
    """The same rows with columns named like intermediate ones."""
    for c in ("g", "id", "leaf", "pos", "n", "seq", "part", "size", "block", "path", "start", "length"):
        df = df.withColumn(c, F.lit("x"))
    return df


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- Merkle -----------------------------------------------------------------

def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)))


def grow(leaves):
    """Levels of one tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    return levels


def siblings(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1:run + 3]))
        i //= 3
    return out


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
        trees[s] = grow([leaf_of(r, r.text) for r in by[s]])
    crown = grow([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(by[s]):
            path = siblings(trees[s], i) + siblings(crown, k)
            bad = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            node = leaf_of(r, r.text.replace("\n", "") if bad and r.text is not None else r.text)
            for left, right in path:
                node = h("".join(left) + node + "".join(right))
            root = crown[-1][0]
            out.append((r.doc_id, leaf_of(r, r.text), trees[s][-1][0], root, h("".join("".join(a + b) for a, b in path)), node, node == root))
    return sorted(out, key=repr)


def manifest(df):
    done = merkle.document_manifest(df, fold(F.col("doc_id"), 2) == 0, F.translate("text", "\n", ""))
    return bag(done.select("id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")).cast("binary"), 256), "folded_root", "verified"))


def test_manifest_query_equals_plain_trees(spark):
    got = bag(Q.op11_merkle_manifest(spark, SF).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))
    assert got == plain_manifest(spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_manifest_of_many_blocks_and_sources(spark):
    """A source of several blocks and layers, one of a single row, more sources than one block holds."""
    rows = [(i, f"t\n{i}", "en", "hot", 3) for i in range(2000)] + [(5000 + i, "x", "en", f"s{i % 300}", 1) for i in range(301)]
    df = docs(spark, rows).repartition(7)
    assert manifest(df) == plain_manifest(df.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 243, 244])
def test_manifest_sizes(spark, n):
    df = docs(spark, [(i, "x", "en", "s", 1) for i in range(n)])
    assert manifest(df) == plain_manifest(df.collect())


def test_manifest_odd_rows(spark):
    df = docs(spark, ODD)
    assert manifest(clash(df)) == manifest(df) == plain_manifest(df.collect())
    assert manifest(docs(spark, [])) == []


# ---- mixing -----------------------------------------------------------------

def plain_targets(sizes):
    """Targets by the rule itself: share, cap, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    cap = {s: Fraction(2 * n) for s, n in sizes.items()}
    budget, full = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        rest = budget - sum(cap[s] for s in full)
        open_ = [s for s in order if s not in full]
        each = {s: rest * weight[s] / sum(weight[t] for t in open_) for s in open_}
        over = {s for s in open_ if each[s] > cap[s]}
        if not over:
            return {s: float(cap[s] if s in full else each[s]) for s in order}
        full |= over


def mixed(df):
    return mixing.mix_documents(df).collect()


def words(text):
    return len((text or "").encode().split())


def test_mix_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = Q.op12_source_mixing(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in rows)
    check_mix(rows, got)
    assert bag(Q.op12_source_mixing(spark, SF)) == sorted((tuple(r) for r in got), key=repr)


def check_mix(rows, got):
    size = {}
    for r in rows:
        size[r.source] = size.get(r.source, 0) + words(r.text)
    want = plain_targets(size)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    taken, largest = {}, {}
    for r in got:
        src = by_id[r.doc_id][0].source
        assert r.size == words(by_id[r.doc_id][0].text) and r.source_size == size[src] and abs(r.target - want[src]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        taken[src] = taken.get(src, 0) + r.taken
        largest[src] = max(largest.get(src, 0), r.size)
    for s, n in taken.items():
        assert abs(n - want[s]) <= 2 * largest[s] + 1, (s, n, want[s])


def test_mix_with_a_hot_source(spark):
    rnd = random.Random(3)
    rows = [(i, "w " * rnd.randint(0, 60), "en", "hot" if i % 3 == 0 else f"s{i % 11}", 0) for i in range(3000)] + [(9000, None, "en", None, 0), (9001, "one", "en", None, 0)]
    df = docs(spark, rows).repartition(6)
    got = mixed(df)
    check_mix(df.collect(), got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixed(df.repartition(3).sortWithinPartitions("text"))), key=repr)
    out = mixing.emit(df, mixing.mix_documents(df))
    assert out.columns == df.columns
    assert out.count() == sum(r.copies for r in got)


def test_mix_odd_rows(spark):
    df = docs(spark, ODD)
    got = mixed(clash(df))
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixed(df)), key=repr) and len(got) == len(ODD)
    assert {r.size for r in got if r.doc_id == -1} == {60_000}
    assert mixed(docs(spark, [])) == []
    none = mixed(docs(spark, [(1, None, None, "a", 0), (2, "", None, "b", 0)]))
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": int(10 ** rnd.uniform(0, 4)) for i in range(rnd.randint(1, 12))} | ({None: 5} if seed % 2 else {})
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "s string, source_size long")
    got = {r.g: r.target for r in mixing.targets(df.select(mixing.source_key(F.col("s")).alias("g"), "source_size"), mixing.WEIGHTS, 1.5, 2).collect()}
    for s, t in plain_targets(sizes).items():
        assert abs(got["~" if s is None else f"={s}"] - t) < 1e-6 * max(t, 1)


# ---- runs -------------------------------------------------------------------

def plain_runs(w):
    """All pairs of equal words, period by period; equal stretches keep the smallest."""
    best = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                best.setdefault((i, j + q), q)
            i = j
    return sorted((s, e, q) for (s, e), q in best.items())


def found(texts):
    w = [t.split() for t in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in w])])
    runs = periodic.find_runs(periodic._number([x.encode() for y in w for x in y]), bounds)
    return [[(s - a, e - a, q) for s, e, q in runs if a <= s < b] for a, b in zip(bounds, bounds[1:])]


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rnd = random.Random(seed)
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            unit = [rnd.choice("ab" if rnd.random() < 0.6 else "abcdefg") for _ in range(rnd.randint(1, 14))]
            k = rnd.choice([1, 2, 3, 5, 9])
            parts += (unit * (k + 1))[:len(unit) * k + rnd.randint(0, len(unit))]
        texts.append(" ".join(parts))
    texts += ["a " * 200, "a b " * 100 + "a", "", "a", "x " * 24, "x " * 23]
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    texts += [" ".join(fib[-1]), " ".join(bin(i)[2:].count("1") % 2 * "a" or "b" for i in range(400))]
    assert found(texts) == [plain_runs(t.split()) for t in texts]


def test_runs_query(spark):
    got = {r.doc_id: r for r in Q.op13_periodic_runs(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = [x.decode() for x in periodic.planted((r.text or "").encode().split(), r.doc_id)]
        runs = plain_runs(w)
        drop = {i for s, e, q in runs for i in range(s + q, e)}
        top = min(runs, key=lambda x: (-Fraction(x[1] - x[0], x[2]), x[0], x[2]), default=None)
        want = (r.doc_id, len(runs), *((top[0], top[1] - top[0], top[2], 1000 * (top[1] - top[0]) // top[2]) if top else (None,) * 4),
                h("".join(f"{s},{e - s},{q}\n" for s, e, q in runs)), h(" ".join(x for i, x in enumerate(w) if i not in drop)))
        assert tuple(got[r.doc_id]) == want


def test_runs_odd_rows(spark):
    df = docs(spark, ODD)
    got = bag(periodic.periodic_runs(clash(df)))
    assert got == bag(periodic.periodic_runs(df)) and len(got) == len(ODD)
    assert next(r for r in got if r[0] == -1)[1:6] == (1, 0, 60_000, 1, 60_000_000)
    empty = h("")
    assert next(r for r in got if r[0] == -5) == (-5, 0, None, None, None, None, empty, empty)
    assert bag(periodic.periodic_runs(docs(spark, []))) == []
