"""Batch sinks: materialized recompute, run-stamped exports, change feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_view(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full recompute of a derived table (overwrite), optionally partitioned
    (e.g. by source, for pruning)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), path: str | None = None) -> None:
    """Create-or-replace a catalog table as select (schema replaced too);
    ``path`` makes it an external table at that location."""
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_run(df: DataFrame, path: str, run_id: str, fmt: str = "json",
              partition_by: Sequence[str] = ("source",), append: bool = True) -> None:
    """Run-stamped export (JSON lines or CSV with header) per partition value."""
    out = df.withColumn("run_id", F.lit(run_id))
    w = out.write.mode("append" if append else "overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.json(path)


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """Change rows between two snapshots of a table: 'insert', 'update' (some
    column differs, null being a value like any other) or 'delete', with the
    new row (old row for deletes).  One full outer join on the key; unchanged
    rows are dropped."""
    key = list(key)
    cols = [c for c in new.columns if c not in key]

    def side(df: DataFrame, name: str) -> DataFrame:
        values = [(F.col(c) if c in df.columns else F.lit(None).cast(new.schema[c].dataType)).alias(c) for c in cols]
        return df.select(*key, F.struct(F.lit(True).alias("there"), *values).alias(name))

    j = side(old, "_o").join(side(new, "_n"), key, "full")
    op = (F.when(F.col("_o").isNull(), F.lit("insert"))
          .when(F.col("_n").isNull(), F.lit("delete"))
          .when(~F.col("_o").eqNullSafe(F.col("_n")), F.lit("update")))
    row = F.coalesce("_n", "_o")
    return (j.withColumn("_op", op).filter(F.col("_op").isNotNull())
            .select(*key, F.col("_op").alias("change"), *[row.getField(c).alias(c) for c in cols]))
