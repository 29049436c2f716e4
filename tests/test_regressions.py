"""Losses that must not come back: old files, drifting types, null moves,
multi-line cards, broken replies, deep JSON, large vector sets."""

import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from relist.operators import extraction as X
from relist.operators import vectors as V
from relist.session import path_exists
from relist.sources.sinks import snapshot_diff
from relist.streaming.ingest import backfill, ingest, read_table


def _land(path, rows, age_s=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    t = time.time() - age_s
    os.utime(path, (t, t))


def test_old_files_new_columns_and_drifting_types_survive(spark, tmp):
    land, out, ck = f"{tmp}/land", f"{tmp}/bronze", f"{tmp}/ck"
    uri = f"file://{land}"
    _land(f"{land}/a.json", [{"id": 1, "count": 3, "n": {"x": 1}}])
    ingest(spark, uri, out, ck, glob="*.json")
    _land(f"{land}/b.json", [{"id": 2, "count": 4, "late": "kept", "n": {"x": 2, "y": "deep"}}], age_s=5 * 3600)
    _land(f"{land}/c.json", [{"id": 3, "count": "7 items"}, {"id": 4, "count": 7.5}], age_s=40 * 86400)
    ingest(spark, uri, out, ck, glob="*.json")
    ingest(spark, uri, out, ck, glob="*.json")
    got = {r.id: r for r in read_table(spark, out).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert got[2].late == "kept" and got[2].n.y == "deep" and got[1].late is None and got[1].n.y is None
    assert got[3]["count"] is None and "7 items" in got[3]._rescued_data
    assert "7.5" in got[4]._rescued_data and got[1]._rescued_data is None
    again = backfill(spark, uri, out, ck, "r2", glob="*.json")
    assert again.count() == 4 and read_table(spark, out).count() == 4


def test_damaged_table_raises_and_absent_one_is_empty(spark, tmp):
    assert read_table(spark, f"{tmp}/none").columns == [] and not path_exists(spark, f"{tmp}/none")
    spark.range(3).write.parquet(f"{tmp}/t")
    for name in os.listdir(f"{tmp}/t"):
        if name.startswith("part-"):
            with open(f"{tmp}/t/{name}", "wb") as f:
                f.write(b"damaged")
    with pytest.raises(Exception):
        read_table(spark, f"{tmp}/t").count()


def test_change_feed_sees_a_null_that_moves(spark):
    schema = "k int, a string, b string"
    old = spark.createDataFrame([(1, None, "x"), (2, "s", "t"), (3, "gone", None), (5, None, None)], schema)
    new = spark.createDataFrame([(1, "x", None), (2, "s", "t"), (4, None, None), (5, None, None)], schema)
    got = {r.k: (r.change, r.a, r.b) for r in snapshot_diff(old, new, ["k"]).collect()}
    assert got == {1: ("update", "x", None), 3: ("delete", "gone", None), 4: ("insert", None, None)}


def test_cards_over_several_lines(spark):
    html = ("<a\n class='c' href='/fr/robe-12/'>\n  <b>Robe &amp; jupe</b>\n  rouge\n</a>" + " " * 400 + "\n<span>9,00 €</span>"
            '<a href="/fr/pull-13/">Pull</a><i>1,50 €</i>')
    df = spark.createDataFrame([(1, "https://s.example/x", html)], "page_id int, url string, html string")
    got = {r.external_id: (r.title, r.url, r.price) for r in X.page_cards(df).collect()}
    assert got["12"] == ("Robe & jupe rouge", "https://s.example/fr/robe-12/", 9.0)
    assert got["13"][0] == "Pull"


def test_broken_reply_keeps_its_text(spark):
    df = spark.createDataFrame([("{broken reply",), ('```json\n{"category": "robe"}\n```',), ("plain",)], "t string")
    got = [r.p.asDict() for r in df.select(X.parse_reply(F.col("t")).alias("p")).collect()]
    assert got[0]["search_text"] == "{broken reply" and got[1]["category"] == "robe" and got[2]["search_text"] == "plain"


def test_counts_of_the_other_pattern_families(spark):
    pages = ['{"totalResults": 41, "nbHits": 7}', 'x \\"nbHits\\": 52 y "nbHits": 9', '{"nbHits":63}', "nbHits = '74'", "85 resultats", "96 articles", "none"]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, t string")
    got = df.select("k", X.count_from_text(F.col("t"), X.SEARCH_COUNT_PATTERNS).alias("a"),
                    X.count_from_text(F.col("t"), X.HITS_COUNT_PATTERNS).alias("b")).orderBy("k").collect()
    assert [r.a for r in got] == [41, 9, 63, None, 85, 96, None]
    assert [r.b for r in got] == [7, 52, 63, 74, 85, None, None]


def test_json_totals_never_abort(spark):
    page = '<script id="__NEXT_DATA__">{}</script>'
    rows = [(1, page.format('{"total": 99999999999999999999}')), (2, page.format("[" * 30000 + "]" * 30000)),
            (3, page.format('{"a": {"total": 0, "nbHits": true}, "b": [{"total": 5}]}')), (4, page.format('{"total": '))]
    df = spark.createDataFrame(rows, "page_id int, html string")
    got = {r.page_id: r.total for r in X.total_from_json(df).collect()}
    assert got[2] is None and got[3] == 5 and got[4] is None and 1 in got


def test_totals_in_document_order(spark):
    """The walk against the definition, written as a recursion here."""
    def plain(value, depth, most, head):
        if most is not None and depth > most:
            return None
        if isinstance(value, dict):
            for k in X.TOTAL_KEYS:
                if type(value.get(k)) is int and value[k] > 0:
                    return value[k]
            inner = list(value.values())
        else:
            inner = value[:head] if isinstance(value, list) else []
        return next((t for t in (plain(v, depth + 1, most, head) for v in inner) if t is not None), None)

    rnd = random.Random(9)

    def document(depth):
        kind = rnd.random()
        if depth == 0 or kind < 0.3:
            return rnd.choice([0, -3, 7, 2.5, "5", "{\"total\": 8}", "[1]", None, True, "x", 41])
        if kind < 0.6:
            return [document(depth - 1) for _ in range(rnd.randint(0, 8))]
        return {rnd.choice(["total", "nbHits", "z", "b", "a", "totalCount", "m"]): document(depth - 1) for _ in range(rnd.randint(0, 4))}

    docs = [document(rnd.randint(1, 11)) for _ in range(300)]
    docs += [{"a": [0, {"total": 3}], "totalItems": 7}, [[[{"total": 2}]]], {"z": {"total": 1}, "a": {"total": 2}}, {"a": [1, 2, 3, 4, 5, {"total": 6}]}]
    df = spark.createDataFrame([(i, json.dumps(d, indent=rnd.choice([None, 1]))) for i, d in enumerate(docs)], "i int, j string")
    for most, head in ((8, 5), (2, 1), (None, None)):
        got = {r.i: r.t for r in df.select("i", X.first_total(F.col("j"), most, head).alias("t")).collect()}
        for i, d in enumerate(docs):
            want = plain(d, 0, most, head)
            assert got[i] == (None if want is None else str(want)), (docs[i], got[i], most)


def test_vector_sets_of_any_size(spark):
    rng = np.random.default_rng(3)
    q, c = rng.normal(size=(130, 6)), rng.normal(size=(70, 6))
    c[5] = 0
    qd = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "qid int, qvec array<double>")
    cd = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(c)] + [(99, None)], "cid int, vec array<double>")
    s = (q / np.linalg.norm(q, axis=1, keepdims=True)) @ (c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300)).T
    s[:, 5] = -9
    want = {(i, r): int(j) for i in range(130) for r, j in enumerate(np.argsort(-s[i], kind="stable")[:3], 1)}
    for got in (V.topk_similar(qd, cd, tile=40), V.match_to_corpus(qd, cd, cell_rows=5, tile=30)):
        assert {(r.qid, r.rank): r.cid for r in got.collect()} == want
    every = V.match_to_corpus(qd.limit(1), cd, k=70).collect()
    assert {r.cid: r.score for r in every}[5] is None and max(every, key=lambda r: r.rank).cid == 5
