"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: bytes of text a Python worker turns into arrays at a time
CHUNK_BYTES = 1_500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as named by
    ``spark.checkpoint.dir``.  Only a local session that names none gets a
    scratch folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        d = context.getCheckpointDir()
        if not d:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="relist-llm-"))
            d = context.getCheckpointDir()
    return d.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/relist-llm/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, past: tuple[DataFrame, ...] | list[DataFrame] = ()) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives
    lost executors, and later readers see columns and pruning.  ``past``:
    materialised tables that nothing reads after this one; they are deleted."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.materialised_at = path
    drop(*past)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete materialised tables that nothing reads any more, so the shared
    folder holds what is in use and not all that was."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.materialised_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_enough(df: DataFrame, row_bytes: int, bound: int = 32 << 20) -> bool:
    """Size check before a broadcast: rows of a *materialised* table (a count
    over parquet footers) times an upper estimate of a row."""
    return df.count() * row_bytes <= bound


def broadcast_if_small(df: DataFrame, row_bytes: int, bound: int = 32 << 20) -> DataFrame:
    return F.broadcast(df) if small_enough(df, row_bytes, bound) else df


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Project the named columns only, whatever else the table carries."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def byte_chunks(texts: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes (one longer text
    is a range of its own), so arrays stay small for any batch."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def as_bytes(column) -> list[bytes]:
    """An Arrow string column as UTF-8 bytes; null becomes empty."""
    import pyarrow as pa
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
