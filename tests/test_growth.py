"""What keeps time, disk and memory of the plans in proportion to the input:
the form of the plans and files, on a few rows built here."""

import datetime

import numpy as np
import pytest

from relist.operators import vector_search as VS
from relist.plans import adapter as A
from relist.plans import flow_queries as FQ
from relist.plans import payload_queries as PQ
from relist.plans import queries as Q


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    day = datetime.date(2024, 3, 1)

    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")

    put("lineitem", [(o, 1 + (o + n) % 9, 1 + (o * n) % 11, n, float(o % 50), "NRA"[o % 3], "OF"[n % 2], day) for o in range(1, 40) for n in range(1, 4)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate date")
    put("orders", [(o, 1 + o % 7, day) for o in range(1, 40)], "o_orderkey long, o_custkey long, o_orderdate date")
    put("customer", [(c, c % 3) for c in range(1, 8)], "c_custkey long, c_nationkey long")
    put("nation", [(n, f"NATION{n}") for n in range(3)], "n_nationkey long, n_name string")
    put("part", [(p, f"part {'x' * p}", "SMALL TIN") for p in range(1, 10)], "p_partkey long, p_name string, p_type string")
    return d


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["listings", "leboncoin", "ebay", "export"])
def test_a_payload_is_written_in_one_go(spark, tables, name, monkeypatch):
    seen = []
    monkeypatch.setattr(PQ, "listings_from_payload", lambda rows, source: seen.append(rows) or A.raw_listings(spark, tables).selectExpr("*", "'' AS seller_id"))
    getattr(PQ, f"q_payload_{name}")(spark, tables)
    assert _plan(seen[0]).count("StructsToJsonEvaluator(") == 1
    assert seen[0].where("payload is null or payload not like '{%}'").count() == 0 and seen[0].count() == 117


def test_customers_join_the_orders_before_the_lines(spark, tables):
    plan = _plan(A.raw_listings(spark, tables).select("title", "location"))
    assert plan.index("= o_orderkey") < plan.index("= c_custkey")      # the upper join is printed first
    assert A.raw_listings(spark, tables).count() == 117


def test_landed_files_are_compressed(spark, tables):
    assert Q.q_ingest_roundtrip(spark, tables).count() == 117
    rows = {r["run"]: r for r in FQ.q_ingest_lineage(spark, tables).collect()}
    assert sum(r["landed_rows"] for r in rows.values()) == 117 and all(r["whole"] for r in rows.values())
    base = spark.conf.get("spark.checkpoint.dir")
    landed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*.{json,txt}*").load(base).select("path")
    names = [r[0] for r in landed.collect() if "/landing/" in r[0] and ("/ingest-" in r[0] or "/lineage-" in r[0])]
    assert names and all(n.endswith(".gz") for n in names)


def test_gold_is_computed_once_for_the_exports(spark, tables, monkeypatch):
    sources, real = [], FQ.write_view
    monkeypatch.setattr(FQ, "write_view", lambda df, *a: sources.append(_plan(df).count("l_orderkey") > 0) or real(df, *a))
    got = {r["source"]: r for r in FQ.q_export_roundtrip(spark, tables).collect()}
    assert sources == [True, False, False]
    assert got and all(r["run_rows"] == 2 * r["view_rows"] and r["csv_rows"] == r["table_rows"] == r["view_rows"] for r in got.values())


def test_search_in_small_pieces_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v array<double>")

    def found():
        return {(r["q"], r["c"], r["rank"]) for r in VS.search(df, df, 4, "id", "v", "id", "v", cells=8, cell_rows=40).collect()}

    whole = found()
    for name, n in (("PACK_ROWS", 7), ("BLOCK_ROWS", 3), ("VISITS", 5)):
        monkeypatch.setattr(VS, name, n)
    assert found() == whole and len(whole) == 1600
    assert VS._packed(df, "bigint").selectExpr("max(size(rows))").first()[0] == 7


def test_listing_tasks_follow_the_rows(spark, tables, monkeypatch):
    """A task's rows, half a kilobyte of text each, are bounded however few bytes it reads."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(A, "LISTINGS_PER_TASK", 12)
    monkeypatch.setattr(A, "MANY_PARTS", 5)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in A.raw_listings(spark, tables).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert sum(sizes) == 117 and max(sizes) <= 60


@pytest.mark.parametrize("name", ["gold_listings", "image_manifest", "image_manifest_new"])
def test_gold_tasks_follow_the_rows(spark, tables, monkeypatch, name):
    """So are those that sort the listings by key, and the images by path, however few partitions the session shuffles to."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(A, "LISTINGS_PER_TASK", 6)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("-1", "2")):
        spark.conf.set(k, v)
    try:
        parts = getattr(Q, f"q_{name}")(spark, tables).select(F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len({r["p"] for r in parts}) > 2
