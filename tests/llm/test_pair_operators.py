"""Near-duplicates, neighbours, decontamination, substrings, lines and the
pipeline against brute force."""

import hashlib
import itertools
import os
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from relist.llm import ann, common, components, decontaminate, linededup, simhash_dedup, substring_dedup
from relist.llm import queries as Q
from tests.oracle_harness import duck

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["w%d" % i for i in range(400)]


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC)


def clash(df):
    for c in ("h", "key", "fp", "id", "a", "b", "u", "v", "gone_", "line_no", "item_id", "words", "head", "n", "depth"):
        df = df.withColumn(c, F.lit("x"))
    return df


def classes(n, pairs):
    p = list(range(n))

    def root(x):
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        p[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def sentence(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        j = rng.randrange(len(w))
        w[j:j + 1] = rng.choice([["new%d" % rng.randrange(99)], [], [w[j], "more"]])
    return w


# ---- components ---------------------------------------------------------------

def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + \
        [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5), (None, 3)]
    want = classes(300, [e for e in edges if None not in e])
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(i, i) == want[i] for i in range(300))


# ---- SimHash ------------------------------------------------------------------

def plain_fingerprint(t):
    w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    sh = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "É Ab\x0bC", "é ab\x0bc", "one", "One"]
    for _ in range(12):
        w = sentence(rng, 200)
        texts += [" ".join(edited(rng, w, rng.randrange(4))) for _ in range(8)]
    texts += texts[10:14] + ["long " * 50_000 + "end", "Long " * 50_000 + "end"]
    fp = [plain_fingerprint(t) for t in texts]
    want = classes(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 3])
    df = clash(docs(spark, texts))
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(df.unionByName(df.limit(3))).collect()}
    for i in range(len(texts)):
        assert got[i].fp % (1 << 64) == fp[i] and got[i].component_id == want[i]
    kept = simhash_dedup.keep_one(df.unionByName(df.limit(3)))
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))
    assert simhash_dedup.near_duplicates(docs(spark, [])).collect() == []


@pytest.mark.parametrize("leaf", [20_000, 25, 1])
def test_split_tries_lose_no_link(spark, leaf):
    rng = np.random.default_rng(5)
    fps = [rng.integers(0, 2**63, 60, dtype=np.uint64)]
    for c in fps[0][:3]:
        x = np.full(120, c)
        for _ in range(6):
            x = x ^ np.where(rng.random(120) < .6, np.uint64(1) << rng.integers(0, 64, 120, dtype=np.uint64), np.uint64(0))
        fps.append(x)
    fp = np.unique(np.concatenate(fps))
    near = np.argwhere(np.triu(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3, 1))
    want = classes(len(fp), near.tolist())
    df = spark.createDataFrame([(int(v),) for v in fp.view(np.int64)], "fp long")
    label = {r.node: r.component for r in components.components(simhash_dedup.links(df, 3, leaf)).collect()}
    seen = {}
    got = [label.get(int(v), int(v)) for v in fp.view(np.int64)]
    assert all(seen.setdefault(g, w) == w for g, w in zip(got, want)) and len(set(got)) == len(set(want))


# ---- neighbours ---------------------------------------------------------------

def test_neighbours_recall_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(1500, 16)).astype(np.float32)
    v[300:700] = v[300]                                   # a vector that many rows share
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] + [1.0] * 15), (2060, [None] + [1.0] * 15), (2080, [1.0]),
             (2100, [float("inf")] * 16), (None, [1.0] * 16), rows[0]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("x")).withColumn("label", F.lit(1))
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).toPandas()
    assert set(got.query_id) == set(range(0, 1500, 20))
    hit = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        s = v.astype(float) @ v[q].astype(float)
        assert list(g["rank"]) == list(range(1, 21)) and q not in set(g.vec_id)
        assert np.allclose(s[g.vec_id], g.score, atol=1e-12)
        assert list(zip(-g.score, g.vec_id)) == sorted(zip(-g.score, g.vec_id))
        s[q] = -np.inf
        hit += len(set(np.lexsort((np.arange(len(s)), -s))[:20]) & set(g.vec_id))
    assert hit / (20 * 75) >= 0.9
    few = ann.nearest(df.where("vec_id < 5"), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_neighbour_query_recall(spark):
    got = Q.QUERIES["op2_nearest_neighbours"](spark, SF).toPandas()
    t = spark.read.parquet(f"{SF}/embeddings.parquet").toPandas()
    v, ids = np.stack(t.embedding.to_list()).astype(float), t.vec_id.to_numpy()
    place = {x: i for i, x in enumerate(ids)}
    hit = 0
    for q, g in got.groupby("query_id"):
        s = v @ v[place[q]]
        s[place[q]] = -np.inf
        hit += len(set(ids[np.lexsort((ids, -s))[:20]]) & set(g.vec_id))
    assert set(got.query_id) == {x for x in ids if x % 20 == 0} and hit / len(got) >= 0.9


# ---- decontamination ------------------------------------------------------------

@pytest.mark.parametrize("groups, long_one", [(90, False), (90, True), (1000, True)])
def test_groups_of_near_copies_meet_the_rest(spark, groups, long_one):
    """Groups of ten near copies, and a vector so long that all lists hold it."""
    rng = np.random.default_rng(5)
    v = np.repeat(rng.normal(size=(groups, 64)), 10, axis=0)
    v = (v + 0.01 * rng.normal(size=v.shape)).astype(np.float32)
    if long_one:
        v[3] *= 50
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    rows = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    x = v.astype(np.float64)
    hits, per_query = [], {}
    for r in rows:
        per_query.setdefault(r.query_id, []).append(r)
    assert len(per_query) == len(v) // 20 and all(len(q) == 20 for q in per_query.values())
    for q, found in per_query.items():
        s = x @ x[q]
        s[q] = -np.inf
        order = np.lexsort((np.arange(len(s)), -s))[:20]
        hits.append(len(set(order) & {r.vec_id for r in found}) / 20)
        assert all(abs(r.score - float(x[q] @ x[r.vec_id])) < 1e-9 * max(1, abs(r.score)) for r in found)
    assert np.mean(hits) >= 0.9


def test_double_vectors_are_scored_as_they_are(spark):
    v = [[1.0, 0.0], [1.0 + 1e-12, 0.0], [1.0 + 3e-12, 0.0], [0.5, 1e-300]]
    df = spark.createDataFrame(list(enumerate(v)), "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()]
    assert got == [(2, 1.0 + 3e-12), (1, 1.0 + 1e-12), (3, 0.5)]


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(7)
    items = [(i, " ".join(sentence(rng, rng.randrange(9, 20)))) for i in range(8)]
    items += [(20, items[0][1]), (21, None), (22, ""), (23, "Four words, just here")]
    texts = [None, "", "clean " * 300]
    for k in range(24):
        leak = edited(rng, items[k % 8][1].split(), k % 4)
        texts.append(" ".join(sentence(rng, rng.randrange(30)) + [w.upper() if k % 5 == 0 else w + "," * (k % 3 == 0) for w in leak] + sentence(rng, 9)))
    texts.append("and FOUR words - just here")
    parsed = [(i, decontaminate.words_of((t or "").encode())) for i, t in items]
    want = {}
    for d, t in enumerate(texts):
        w = decontaminate.words_of((t or "").encode())
        for n in sorted({len(x) for _, x in parsed} - {0}):
            for s in range(len(w) - n + 1):
                for i, x in parsed:
                    sim = decontaminate.similarity(w[s:s + n], x)
                    if sim >= 0.8:
                        want[d, i] = max(want.get((d, i), 0), sim)
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = clash(docs(spark, texts))
    for block in (2000, 3):
        got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(df, bench, block_items=block).collect()}
        assert got == pytest.approx(want)
    left = decontaminate.clean(df, bench)
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(range(len(texts))) - {d for d, _ in want}) and left.columns == df.columns
    assert decontaminate.matches(df, bench.limit(0)).collect() == [] and decontaminate.matches(df.limit(0), bench).collect() == []


def test_decontamination_of_documents_shorter_than_the_item(spark):
    rng = random.Random(8)
    items = [(i, " ".join(sentence(rng, n))) for i, n in enumerate([16, 24, 31, 46, 59, 46])] + [(9, "one two three four five six")]
    texts = []
    for _, t in items:
        w = t.split()
        texts += [" ".join(x) for gone in range(1, 12) for x in (w[:-gone], w[gone:]) if x] + [" ".join(w[:j] + w[j + 1:]) for j in range(0, len(w), 5)]
    parsed = [(i, decontaminate.words_of(t.encode())) for i, t in items]
    want = {}
    for d, t in enumerate(texts):
        w = decontaminate.words_of(t.encode())
        for i, x in parsed:
            sim = max([decontaminate.similarity(w[s:s + len(x)], x) for s in range(max(1, len(w) - len(x) + 1))])
            if sim >= 0.8:
                want[d, i] = sim
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.matches(docs(spark, texts), bench).collect()
    assert len(want) > 40 and {(r.doc_id, r.item_id): r.similarity for r in found} == pytest.approx(want)
    assert all((r.start_word, r.n_words) == (0, len(texts[r.doc_id].split())) for r in found)


def test_decontamination_query_finds_exact_passages(spark):
    got = {(r.doc_id, r.item_id) for r in Q.QUERIES["op3_decontamination"](spark, SF).collect()}
    flat = {r.doc_id: " " + " ".join(map(bytes.decode, decontaminate.words_of((r.text or "").encode()))) + " "
            for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {(d, r.item_id) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() for d, t in flat.items()
            if " " + " ".join(map(bytes.decode, decontaminate.words_of(r.text.encode()))) + " " in t}
    assert held <= got


# ---- substrings -----------------------------------------------------------------

def plain_substrings(rows):
    words = [(d, [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x]) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            if d is not None:
                k = tuple(w[i:i + 13])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i:i + 13])] < d:
                gone.update(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot", [5000, 1])
def test_substrings_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT", hot)
    rng = random.Random(9)
    shared = [sentence(rng, n) for n in (12, 13, 14, 40, 60)]
    rows = [(-7, None), (-6, ""), (None, "x " * 40), (None, "x " * 40), (-5, "x " * 40), (-4, "x " * 41), (-3, "  x " * 40)]
    for d in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            w += sentence(rng, rng.randrange(20)) + rng.choice(shared)
        rows.append((d, " ".join(w)))
    rows += [(70, rows[20][1]), (72, "Y\x0b" + rows[30][1]), (80, "x " * 40), rows[20], (90, " ".join("z%d" % (i % 3000) for i in range(40_000)))]
    df = clash(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC)).drop("head")
    got = sorted((tuple(r) for r in substring_dedup.dedup_substrings(df).collect()), key=repr)
    assert got == plain_substrings(rows)
    cut = {r.doc_id: r.text for r in substring_dedup.cut_texts(df).collect()}
    assert cut[80] == "" and -7 not in cut
    assert substring_dedup.dedup_substrings(df.limit(0)).collect() == []


def test_one_id_on_several_texts(spark):
    """Rows are known by id and text: nothing fails, and no text is lost."""
    rng = random.Random(21)
    a, b, c = (" ".join(sentence(rng, 40)) for _ in range(3))
    rows = [(1, a), (5, "x y " + a), (5, b), (5, b), (7, b + " end"), (7, c), (7, "short\n" + c)]
    df = clash(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC))
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.dedup_substrings(df).collect())
    assert got == [(1, 40, 0), (5, 40, 0), (5, 40, 0), (5, 42, 40), (7, 40, 0), (7, 41, 0), (7, 41, 40)]
    lines = sorted((r.doc_id, r.text) for r in linededup.dedup_lines(df).collect())
    assert lines == sorted([(1, a), (5, "x y " + a), (5, b), (5, b), (7, b + " end"), (7, c), (7, "short\n" + c)]) or \
        [t for d, t in lines if d == 7 and "short" in t] == ["short"]
    kept = sorted((r.doc_id, r.text) for r in simhash_dedup.keep_one(df).collect())
    assert {(1, a), (5, b), (7, c)} <= set(kept) and len([k for k in kept if k == (5, b)]) == 1


def test_substring_query_equals_sql(spark):
    got = sorted(tuple(r) for r in Q.QUERIES["op5_substring_dedup"](spark, SF).collect())
    assert got == sorted(duck(SF).execute(Q.ORACLE["op5_substring_dedup"]).fetchall())


def test_automaton_matching_statistics():
    rng = random.Random(2)
    for _ in range(60):
        known = [[rng.choice("abc") for _ in range(rng.randrange(9))] for _ in range(3)]
        text = [rng.choice("abcd") for _ in range(12)]
        a = substring_dedup.SuffixAutomaton()
        for k in known:
            a.add(k)
        subs = {tuple(k[i:j]) for k in known for i in range(len(k)) for j in range(i + 1, len(k) + 1)}
        assert a.matches(text) == [max((n for n in range(i + 2) if tuple(text[i + 1 - n:i + 1]) in subs), default=0) for i in range(len(text))]


# ---- lines ------------------------------------------------------------------------

def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, up = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(up[j] + 1, row[-1] + 1, up[j - 1] + (x != y)))
    return row[-1]


def line_simhash(w):
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in set(w)]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def plain_lines(rows, radius=2):
    found = [(d, k, l.lower().split()) for d, t in rows if t is not None and d is not None for k, l in enumerate(t.split("\n"))]
    found = sorted((d, k, " ".join(w)) for d, k, w in found if w)
    texts = sorted({t for _, _, t in found})
    hashes = [line_simhash(t.split()) for t in texts]
    links = [(i, j) for i in range(len(texts)) for j in range(i) if bin(hashes[i] ^ hashes[j]).count("1") <= radius
             and edit_distance(texts[i], texts[j]) <= 0.2 * max(len(texts[i]), len(texts[j])) + 1e-6]
    group = dict(zip(texts, classes(len(texts), links)))
    first, gone = {}, set()
    for d, k, t in found:
        if first.setdefault(group[t], (d, k)) != (d, k):
            gone.add((d, k))
    return sorted(((d, None if t is None else t if d is None else "\n".join(l for k, l in enumerate(t.split("\n")) if (d, k) not in gone))
                   for d, t in rows), key=repr)


def test_lines_equal_brute_force(spark):
    rng = random.Random(11)
    base = [sentence(rng, n) for n in (3, 8, 20, 45, 90)]
    rows = [(-9, None), (-8, ""), (-7, "\n\n"), (None, " ".join(base[0])), (-6, "Same\tLine  here\nsame line HERE\n\n x"), (-5, "same line here")]
    for d in range(30):
        rows.append((d, "\n".join(" ".join(edited(rng, rng.choice(base), rng.choice([0, 0, 1, 1, 2]))) for _ in range(rng.randrange(1, 5)))))
    df = clash(spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOC))
    done = linededup.dedup_lines(df).collect()
    assert sorted(((r.doc_id, r.text) for r in done), key=repr) == plain_lines(rows)
    by = {r.doc_id: r for r in done}
    assert (by[-9].n_lines, by[-9].kept_lines) == (0, 0) and by[-5].kept_lines == 0 and by[-6].kept_lines == 3
    assert linededup.dedup_lines(df.limit(0)).collect() == []
    one = linededup.dedup_lines(df.where("doc_id = 3").unionByName(df.where("doc_id = 3"))).collect()
    assert len(one) == 2 and one[0].text == one[1].text   # rows of one document don't remove each other


def test_line_recall_by_edit_similarity_alone(spark):
    rng = random.Random(12)
    syllables = [a + b for a in "bcdfglmnprst" for b in ("a", "en", "i", "or", "u")]
    letters = "abcdefgh"

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 5)))

    pairs = [["cat sat", "cat sit"], ["total", "totals"], ["abcde", "abxde"]]
    for n in (4, 6, 8, 10, 14, 20, 27, 50) * 8:
        w = [word() for _ in range(n)]
        v, at = list(w), rng.randrange(n)
        if rng.random() < .5:
            v[at] = word()
        else:
            k = rng.randrange(len(v[at]))
            v[at] = v[at][:k] + rng.choice(letters) + v[at][k + 1:]
        a, b = " ".join(w), " ".join(v)
        if a != b and edit_distance(a, b) <= 0.2 * max(len(a), len(b)):
            pairs.append([a, b])
    df = docs(spark, [t for p in pairs for t in p])
    kept = {r.doc_id: r.kept_lines for r in linededup.dedup_lines(df, sketch=6).collect()}
    found = [kept[2 * i + 1] == 0 for i in range(len(pairs))]
    assert len(pairs) > 50 and all(found[:3]) and np.mean(found) >= 0.95 and all(kept[2 * i] == 1 for i in range(len(pairs)))


def near_texts(rng, n):
    """Texts of all lengths, some with many edits, some with another start or end."""
    out = []
    for _ in range(n):
        w = "".join(rng.choice("abcdé ") for _ in range(rng.randrange(1, 400)))
        v = list(w)
        for _ in range(rng.randrange(0, 2 + len(w) // 3)):
            at = rng.randrange(len(v) + 1)
            v[at:at + rng.randrange(2)] = rng.choice(["", "x", "ab"])
        cut = rng.randrange(len(w) + 1)
        v = "".join(v) if rng.random() < .6 else rng.choice([w[:cut] + "z" * rng.randrange(60), "z" * rng.randrange(60) + w[cut:], w[cut:] + w[:cut]])
        out += [(w, v or "x")]
    return out


@pytest.mark.parametrize("likely", [True, False])
def test_bounds_decide_as_the_whole_distance(spark, likely):
    pairs = near_texts(random.Random(13), 300)
    df = spark.createDataFrame([(i, x, y, len(x), len(y)) for i, (x, y) in enumerate(pairs)], "i int, tx string, ty string, nx int, ny int")
    got = {r.i for r in df.where(linededup._alike(0.8, likely, piece=16)).collect()}
    due = {i for i, (x, y) in enumerate(pairs) if edit_distance(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-6)}
    assert got == due and 30 < len(due) < 270


def test_pieces_link_long_texts_without_the_whole_distance(spark):
    """Longer texts alike, with runs and stretches in one of them only: the pieces decide."""
    rng = random.Random(15)
    w = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(1500))
    run = "blest " * 400
    pairs = [(w, w[:3000] + "other words here " + w[3000:]), (w + run + w, w + run[:1800] + w), (w, w[:2000] + w[2900:]),
             (w + run + w[:900], w[:500] + w[530:] + "x" + run + run[:300] + w[:900])]
    df = spark.createDataFrame([(i, x, y, len(x), len(y)) for i, (x, y) in enumerate([*pairs, *[(y, x) for x, y in pairs]])],
                               "i int, tx string, ty string, nx int, ny int")
    alike = linededup._alike(0.8, True)
    pieces = alike[alike.index("and (") + 5:alike.index(" or (")]
    assert df.where(pieces).count() == 8 == df.where(alike).count()


def test_shuffle_files_go_with_the_step(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with linededup._shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
    assert spark.conf.get(name) == before


def test_tables_go_once_nothing_reads_them(spark, tmp, monkeypatch):
    rng = random.Random(17)
    base = [sentence(rng, n) for n in (3, 8, 20)]
    df = docs(spark, ["\n".join(" ".join(edited(rng, rng.choice(base), rng.choice([0, 1, 2]))) for _ in range(3)) for _ in range(20)])
    monkeypatch.setattr(common, "shared_dir", lambda spark: tmp)
    done = linededup.dedup_lines(df, sketch=6)
    left = {re.sub("-[0-9a-f]{32}$", "", n) for n in os.listdir(f"{tmp}/relist-llm")}
    assert "removals" in left
    assert not left & {"lines", "distinct-lines", "sketches", "sketch-keys", "shared-blocks", "near-simhashes", "busy-simhashes", "busy-lines",
                       "holders", "busy-texts", "keys-below", "open-lines", "groups", "kept-places"}
    assert done.count() == 20


def test_copies_of_a_line_grow_by_the_root(spark, monkeypatch):
    """Lines of one length under one key: few copies of each, and each pair meets once."""
    rng = random.Random(19)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(20)) for _ in range(40)]
    texts += [t[:-1] + "x" for t in texts[:20]]
    rows = spark.createDataFrame([(f"{i:03}", t, len(t)) for i, t in enumerate(texts)], "id string, text string, size int")
    placed = spark.createDataFrame([(0, f"{i:03}", f"g{i}") for i in range(60)], "key long, id string, g string")
    made = []
    materialise = linededup.materialise
    monkeypatch.setattr(linededup, "materialise", lambda df, name, past=(): made.append((name, materialise(df, name))) or made[-1][1])
    monkeypatch.setattr(linededup, "drop", lambda *tables: None)
    got = sorted((*sorted((int(r.x), int(r.y))),) for r in linededup._similar_under_keys(placed, rows, 0.8, 2).collect())
    assert got == [(i, j) for i in range(60) for j in range(i + 1, 60) if edit_distance(texts[i], texts[j]) <= 4] and len(got) >= 20
    assert dict(made)["open-lines"].selectExpr("explode(at) a").selectExpr("sum(a.cells + a.up)").first()[0] == 60 * 6     # ceil(sqrt(60 / 2)) copies; 30 when all cells were met


@pytest.mark.parametrize("passes", [1, 3])
def test_texts_of_a_common_key_go_along_few_times(spark, passes, monkeypatch):
    """Lines of one key meet those of like length only, in any number of passes."""
    rng = random.Random(18)
    sizes = [round(4 * 1.03 ** i) for i in range(120)]
    texts = ["".join(rng.choice("ab") for _ in range(n)) for n in sizes]
    rows = spark.createDataFrame([(f"{i:03}", t, len(t)) for i, t in enumerate(texts)], "id string, text string, size int")
    placed = spark.createDataFrame([(k, f"{i:03}", f"g{i}") for i in range(len(texts)) for k in (0, 1 + i % 2)], "key long, id string, g string")
    seen = {}

    def kept(df, name, past=()):
        seen[name] = df = materialise(df, name)
        return df

    materialise = linededup.materialise
    monkeypatch.setattr(linededup, "materialise", kept)
    monkeypatch.setattr(linededup, "drop", lambda *tables: None)
    got = sorted((*sorted((int(r.x), int(r.y))),) for r in linededup._similar_under_keys(placed, rows, 0.8, 4, passes).collect())
    due = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if sizes[j] <= 1.26 * sizes[i] + 1
           and edit_distance(texts[i], texts[j]) <= int(0.2 * sizes[j] + 1e-6)]
    assert got == due and due
    copies = seen["open-lines"].selectExpr("explode(at) a").selectExpr("sum(2 * a.cells + a.up + a.down)").first()[0]
    assert copies < 2 * (120 * 30 + 2 * 60 * 15) / 4     # every line to all cells of its keys: 120 / 4 and 60 / 4, on both sides


def test_shared_keys_equal_brute_force(spark):
    """Keys are made of hashes that several lines have; no shared key is lost."""
    rng = random.Random(16)
    base = [sentence(rng, n) for n in (1, 2, 3, 5, 6, 8, 20)]
    texts = sorted({" ".join(edited(rng, rng.choice(base), rng.choice([0, 1, 1, 2]))) for _ in range(60)} | {"x x x x x x", "x x x x x", "a b a b a b a", "ab", "abc"})
    named = linededup._named(spark.createDataFrame([(t.split(),) for t in texts if t.split()], "words array<string>"))
    distinct = named.select(linededup._line_id().alias("id"))
    got = {}
    for r in linededup.sketch_keys(named, distinct, 6).collect():
        got.setdefault(r.key, set()).add(r.id)
    # every key of every line, without any hash taken away first
    text = F.array_join("words", " ")
    pairs = linededup._smallest(linededup._grams(F.col("words"), 2, linededup._rare_first), 6)
    grams = linededup._smallest(linededup._grams(F.split(text, ""), 4, lambda c: F.xxhash64(F.lit(4), *c)), 8)
    rows = named.select(linededup._line_id().alias("id"), text.alias("t"), F.size("words").alias("n"), pairs.alias("p"), grams.alias("g")).collect()
    due = {}
    for r in rows:
        keys = [("p", c) for c in (itertools.combinations(r.p, 2) if len(r.p) > 1 else [tuple(r.p)])] if r.n >= 5 else []
        keys += [("g", c) for c in (itertools.combinations(sorted(r.g), 3) if len(r.g) > 2 else [tuple(r.g)])] if r.n <= 6 else []
        keys += [("gap", r.t[:i] + r.t[i + 1:]) for i in range(len(r.t) + 1)] if r.n <= 12 and len(r.t) <= 12 else []
        for k in keys:
            due.setdefault(k, set()).add(r.id)
    groups = sorted(sorted(v) for v in due.values() if len(v) > 1)
    assert sorted(sorted(v) for v in got.values()) == groups and groups


@pytest.mark.parametrize("side", [4, 128])
def test_lines_of_a_common_key_meet_once(spark, side):
    rng = random.Random(14)
    texts = [t for p in near_texts(rng, 30) for t in p]
    keys = [{0} | {rng.randrange(1, 9) for _ in range(2)} if i % 5 else {rng.randrange(1, 9)} for i in range(len(texts))]
    group = ["g%d" % (i % 17) for i in range(len(texts))]
    rows = spark.createDataFrame([(f"{i:03}", t, len(t)) for i, t in enumerate(texts)], "id string, text string, size int")
    placed = spark.createDataFrame([(k, f"{i:03}", group[i]) for i in range(len(texts)) for k in keys[i]], "key long, id string, g string")
    got = sorted((*sorted((int(r.x), int(r.y))),) for r in linededup._similar_under_keys(placed, rows, 0.8, side).collect())
    due = [(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if keys[i] & keys[j] and group[i] != group[j]
           and edit_distance(texts[i], texts[j]) <= int(0.2 * max(len(texts[i]), len(texts[j])) + 1e-6)]
    assert got == due and due


def test_long_lines(spark):
    w = ["w%d" % (i % 997) for i in range(40_000)]
    texts = [" ".join(w), " ".join(w[:20_000] + ["changed"] + w[20_001:]), "other " * 33_000]
    kept = {r.doc_id: r.kept_lines for r in linededup.dedup_lines(docs(spark, texts)).collect()}
    assert kept == {0: 1, 1: 0, 2: 1}


def test_simhash_of_word_arrays(spark):
    ws = [["a"], ["a", "b"], ["x"] * 100 + ["y"] * 27, ["w%d" % i for i in range(200)], ["w%d" % i for i in range(33_000)]]
    df = spark.createDataFrame(list(enumerate(ws)), "k long, words array<string>")
    assert {r.k: r.h % (1 << 64) for r in linededup.with_simhash(df, ["k"]).collect()} == {i: line_simhash(w) for i, w in enumerate(ws)}


def check_lines(rows, left):
    """The registered setting against edit similarity alone, over all pairs
    of lines: what is gone has an earlier line of its group that stays, all
    equal lines are gone, and of the lines that have an earlier one alike nine
    in ten are gone."""
    con = duck(SF)
    found = [(d, k, " ".join(w)) for d, t in rows for k, l in enumerate(t.split("\n")) if (w := l.lower().split())]
    texts = sorted({t for _, _, t in found})
    con.execute("create table l as select unnest(?) as t, unnest(?) as i", [texts, list(range(len(texts)))])
    pairs = con.execute("""select a.i, b.i from l a join l b on a.i < b.i and abs(length(a.t) - length(b.t)) <= 0.2 * greatest(length(a.t), length(b.t)) + 1e-6
        and levenshtein(a.t, b.t) <= floor(0.2 * greatest(length(a.t), length(b.t)) + 1e-6)""").fetchall()
    group = dict(zip(texts, classes(len(texts), pairs)))
    kept = set()
    for d, t in rows:
        rest = iter(left.get(d, "").split("\n"))
        nxt = next(rest, None)
        for k, l in enumerate(t.split("\n")):
            if l == nxt:
                kept.add((d, k))
                nxt = next(rest, None)
        assert nxt is None or not left.get(d, "").strip()
    first, exact = {}, {}
    due, gone = 0, 0
    for d, k, t in sorted(found):
        if exact.setdefault(t, (d, k)) != (d, k):
            assert (d, k) not in kept
        elif group[t] in first:
            due += 1
            gone += (d, k) not in kept
        else:
            assert (d, k) in kept, t
        first.setdefault(group[t], (d, k))
    assert gone >= 0.9 * due, (gone, due)


def test_line_query(spark):
    """op8 itself, on its table."""
    docs_ = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    done = {r.doc_id: r for r in Q.op8_line_dedup(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in linededup.dedup_lines(spark.read.parquet(f"{SF}/documents.parquet"), sketch=6).collect()}
    check_lines([(r.doc_id, r.text) for r in docs_], texts)
    assert {i: r.text_sha256 for i, r in done.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items()}


# ---- pipeline ---------------------------------------------------------------------

def test_pipeline_stages_equal_their_parts(spark):
    start = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in start.collect()]
    d = corpus_pipeline.materialise(corpus_pipeline.language_id(spark, start, SF), "t1")
    assert d.columns == start.columns and {r.doc_id for r in d.collect()} == {i for i, t in rows if t and any(c.isalpha() for c in t)}
    e = corpus_pipeline.materialise(corpus_pipeline.line_dedup(spark, d, SF), "t2")
    assert all(r.n_chars == len(r.text) for r in e.collect())
    check_lines([(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()], {r.doc_id: r.text for r in e.collect()})
    fp = sorted((r.doc_id, plain_fingerprint(r.text)) for r in e.collect())
    group = classes(len(fp), [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i][1] ^ fp[j][1]).count("1") <= 3])
    f = corpus_pipeline.materialise(corpus_pipeline.simhash(spark, e, SF), "t3")
    assert sorted(r.doc_id for r in f.collect()) == sorted({fp[g][0] for g in group}) and f.columns == start.columns
    g = corpus_pipeline.materialise(corpus_pipeline.decontamination(spark, f, SF), "t4")
    leaked = {r.doc_id for r in decontaminate.matches(f, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert {r.doc_id for r in g.collect()} == {r.doc_id for r in f.collect()} - leaked and g.columns == start.columns
    h = {r.doc_id: r for r in corpus_pipeline.encoding(spark, g, SF).collect()}
    assert {i: r.text for i, r in h.items()} == {r.doc_id: r.text for r in g.collect()}
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF).collect()) == sorted(h)


def test_pipeline_stages_on_odd_rows(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "the same words here", "en", "s", 19),
            (3, "the same words here", "en", "s", 19), (None, "no id at all", None, "s", 12), (5, "12 - 34", "en", "s", 7)]
    df = spark.createDataFrame(rows, DOC).withColumn("fp", F.lit(1)).withColumn("gone", F.lit("x"))
    for table, left in ((df, {None: 1, 3: 1}), (df.limit(0), {})):
        d = table
        for name, stage in corpus_pipeline.STAGES:
            d = corpus_pipeline.materialise(stage(spark, d, SF), "odd")
            assert name == "encoding" or d.columns == df.columns
        got = [r.doc_id for r in d.collect()]
        assert {i: got.count(i) for i in got} == left
