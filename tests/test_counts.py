"""Exact medians and distinct counts against plain Python."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from relist.functions import bitmaps as B
from relist.operators import competition as C
from relist.operators import metrics as M


def _medians(spark, rows):
    df = spark.createDataFrame(rows, "g string, price double").groupBy("g", "price").agg(F.count("*").alias("n"))
    return {r.g: (r.cnt, r["median"]) for r in M.exact_median(df, "g").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_median_equals_sorting(spark, seed):
    rnd = random.Random(seed)
    rows = [("even", float(x)) for x in (1, 2, 3, 10)] + [("one", 7.5)] + [("far", 0.01), ("far", 400000.0)] + [(None, 3.0), (None, 5.0), (None, None)]
    rows += [("hot", 5.0)] * 2000 + [("hot", rnd.uniform(0, 10)) for _ in range(1500)]
    rows += [("narrow", 100 + rnd.random() * 1e-6) for _ in range(999)] + [("below", -rnd.random() * 50) for _ in range(40)]
    want = {}
    for g in {g for g, _ in rows}:
        values = [v for k, v in rows if k == g and v is not None]
        want[g] = (len(values), statistics.median(values))
    got = _medians(spark, rows)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g][0] == want[g][0] and abs(got[g][1] - want[g][1]) < 1e-12, g


def test_median_of_nothing(spark):
    assert _medians(spark, []) == {}


def test_no_task_holds_all_prices(spark):
    """The plan has no percentile buffer and no Expand."""
    rows = spark.createDataFrame([("a", "x", 1.0, True, "t", 1.0)], "source string, location string, price double, is_never_worn boolean, title string, latitude double")
    for df in (M.never_worn_median(rows), M.never_worn_premium(rows), M.headline_kpis(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "percentile(" not in plan and "Expand" not in plan


def test_bitmaps_count_and_merge(spark):
    rnd = random.Random(4)
    rows = [(rnd.choice("abc"), f"v{rnd.randint(0, 70000)}") for _ in range(60_000)] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, v string").repartition(5)
    ids = df.distinct().join(B.dictionary(df, "v"), "v")
    sets = B.bitmaps(ids.select("g", "id"), ["g"])
    assert {r.g: r.n for r in B.counted(sets, ["g"]).collect()} == {g: len({v for k, v in rows if k == g and v}) for g in "abc"}
    whole = len({v for _, v in rows if v})
    assert B.counted(B.merged(sets)).first().n == whole
    assert spark.range(1).select(B.distinct_count(df, "v").alias("n"), B.distinct_count(df.limit(0), "v").alias("z")).first() == (whole, 0)


def test_ranks_equal_sorting(spark):
    rnd = random.Random(6)
    rows = [(f"b{i}", rnd.choice([0, 0, 0, 1, 5, 5, rnd.randint(0, 10 ** 12)])) for i in range(900)] + [("é", None), (None, 5), ("b1", 5)]
    df = spark.createDataFrame(rows, "brand string, total long")
    got = C.ranked(df, "total", "brand").collect()
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), (r[0] is not None, (r[0] or "").encode())))
    assert [(r.brand, r.total) for r in sorted(got, key=lambda r: r["rank"])] == order
    assert sorted(r["rank"] for r in got) == list(range(1, len(rows) + 1))
    plan = C.brand_rank(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert windows and all("], []" not in line and ", [_" in line for line in windows)          # every window has a key
