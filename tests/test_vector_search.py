"""Cell search against all pairs: clustered vectors, hot copies, ties, odd rows."""

import numpy as np
import pytest

from relist.operators import vector_search as VS


def frame(spark, vectors, ident, vec):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in vectors], f"{ident} long, {vec} array<double>")


def by_hand(queries, corpus, k):
    """(query, rank) -> (id, score) over all pairs."""
    out = {}
    for q, x in queries:
        if x is None:
            continue
        scored = []
        for c, y in corpus:
            if y is None:
                continue
            den = np.linalg.norm(x) * np.linalg.norm(y)
            s = float(np.dot(x, y) / den) if den > 0 and np.isfinite(den) else None
            scored.append((-round(s, 9) if s is not None else 9.0, c, s))
        for rank, (_, c, s) in enumerate(sorted(scored)[:k], 1):
            out[q, rank] = (c, s)
    return out


def clustered(seed, n, groups=6, dim=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return [(i, centres[i % groups] + 0.1 * rng.normal(size=dim)) for i in range(n)]


@pytest.mark.parametrize("layout", [{}, {"cells": 8, "cell_rows": 20, "tile": 25}])
def test_equal_to_all_pairs(spark, layout):
    corpus = clustered(1, 300)
    corpus += [(i, corpus[0][1] * (1 + i % 3)) for i in range(300, 420)]          # a hot group: one direction
    corpus += [(500, np.zeros(8)), (501, None), (502, np.full(8, np.inf))]
    queries = [(i, v) for i, v in clustered(2, 60, dim=8)] + [(90, corpus[0][1]), (91, np.zeros(8)), (92, None)]
    got = VS.search(frame(spark, queries, "qid", "qvec"), frame(spark, corpus, "cid", "vec"), 5, "qid", "qvec", "cid", "vec", **layout)
    got = {(r.q, r["rank"]): (r.c, r.s) for r in got.collect()}
    want = by_hand(queries, corpus, 5)
    assert got.keys() == want.keys()
    for key, (c, s) in want.items():
        assert got[key][0] == c and (s is None) == (got[key][1] is None) and (s is None or abs(got[key][1] - s) < 1e-8), key


def test_few_rows(spark):
    q = frame(spark, [(1, [1.0, 0.0])], "qid", "qvec")
    two = frame(spark, [(7, [0.0, 0.0]), (8, [1.0, 1.0])], "cid", "vec")
    assert [(r.cid, r.score, r["rank"]) for r in VS.topk_similar(q, two, k=5).orderBy("rank").collect()] == [(8, 0.7071, 1), (7, None, 2)]
    none = frame(spark, [], "cid", "vec")
    assert VS.topk_similar(q, none).count() == 0 and VS.topk_similar(frame(spark, [], "qid", "qvec"), two).count() == 0


def test_no_job_while_the_plan_is_built(spark):
    q, c = frame(spark, clustered(3, 20), "qid", "qvec"), frame(spark, clustered(4, 50), "cid", "vec")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "no job may run")
    VS.match_to_corpus(q, c)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
