"""Session helpers: a tuned local session for tests/bench and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app: str = "relist") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RELIST_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> None:
    """Session settings the operators rely on: UTC timestamps, and a
    whole-stage codegen method limit of 8000 bytecodes – the JVM does not
    JIT-compile larger methods, so a wide cleaning stage (many regex rules)
    is better run as expression-level codegen than interpreted."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must name one.  Only a local session that names none (tests)
    gets a scratch folder.
    """
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not d:
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="relist-ckpt-"))
        d = context.getCheckpointDir()
    return d


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's own file systems know the path, wherever it lies."""
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True
