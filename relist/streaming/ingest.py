"""Incremental file ingest with Structured Streaming.

``ingest`` runs a file-source stream with ``trigger(availableNow=True)``:
every file landed since the last run is read exactly once, however old its
time stamp (the checkpoint tracks processed files), lineage columns are
added, and rows are appended to a Parquet table.  Schema evolution without a
proprietary loader: the stream's schema is the union of a schema registry
kept beside the checkpoint and the schema inferred from the files the
registry has not seen yet; new columns and new fields of nested structs are
added (old rows read back as null through ``mergeSchema``), known types are
kept, and values that do not fit their type are kept as they were landed, by
field, in ``_rescued_data`` (the rest of the record is read).
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from ..operators.dedupe import union_by_name
from ..session import path_exists

RESCUED = "_rescued_data"


def _read_registry(spark: SparkSession, path: str) -> str | None:
    """The registered schema (JSON text), or None before the first run.
    Kept as a one-line text dataset so any shared file system works."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.text(path).collect()       # a single line
    return rows[0][0] if rows else None


def _write_registry(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _merge_types(old: DataType, new: DataType) -> DataType:
    """The known type, with fields of nested structs seen for the first time."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        return merge_schemas(old, new)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return ArrayType(_merge_types(old.elementType, new.elementType), True)
    return old


def merge_schemas(old: StructType | None, new: StructType) -> StructType:
    """Keep every known field (and its type); append fields seen for the first
    time, at any depth."""
    if old is None:
        return new
    fresh = {f.name.lower(): f for f in new.fields}
    kept = [StructField(f.name, _merge_types(f.dataType, fresh[f.name.lower()].dataType)
                        if f.name.lower() in fresh else f.dataType, True) for f in old.fields]
    names = {f.name.lower() for f in old.fields}
    return StructType(kept + [f for f in new.fields if f.name.lower() not in names])


def _options(reader, fmt: str, glob: str | None, multiline: bool, header: bool):
    reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if fmt == "json":
        reader = reader.option("multiLine", str(multiline).lower())
    elif fmt == "csv":
        reader = reader.option("header", str(header).lower())
    return reader


def _landed(spark: SparkSession, path: str, glob: str | None) -> DataFrame:
    """Paths of the landed files (a listing; no file is opened)."""
    return _options(spark.read, "binaryFile", glob, False, False).format("binaryFile").load(path).select("path")


def evolve_schema(spark: SparkSession, path: str, fmt: str, registry: str, glob: str | None = None,
                  multiline: bool = False, header: bool = True, sampling_ratio: float = 1.0) -> StructType:
    """Union of the registered schema and the schema inferred from the files
    no earlier run has inferred from; the result is written back.

    The registry lists the files it has seen, so the cost follows the
    increment, and a file's time stamp plays no part."""
    stored = _read_registry(spark, registry)
    old = StructType.fromJson(json.loads(stored)["schema"]) if stored else None
    seen_path = registry.rstrip("/") + "_files"
    landed = _landed(spark, path, glob)
    if path_exists(spark, seen_path):
        landed = landed.join(spark.read.schema("path string").parquet(seen_path), "path", "left_anti")
    new = sorted(r[0] for r in landed.collect())             # names of one run's files
    if not new:
        return old if old is not None else StructType([])
    reader = _options(spark.read, fmt, None, multiline, header)
    if sampling_ratio < 1.0 and fmt == "json":
        reader = reader.option("samplingRatio", str(sampling_ratio))
    inferred = reader.format(fmt).load(new).schema
    fields = [StructField(f.name, f.dataType, True) for f in inferred.fields
              if f.name not in ("_corrupt_record", RESCUED)]
    merged = merge_schemas(old, StructType(fields))
    _write_registry(spark, registry, json.dumps({"schema": json.loads(merged.json())}))
    spark.createDataFrame([(p,) for p in new], "path string").write.mode("append").parquet(seen_path)
    return merged


def rescued_fields(df: DataFrame, known: list[str]) -> Column:
    """What of a record did not fit, as JSON: the fields that have a value in
    the landed text but none in their column (the others were read).  The whole
    text stays where that tells nothing: broken JSON, or a misfit deeper inside."""
    landed = F.from_json(F.col(RESCUED), "map<string,string>")
    empty = F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in known]))
    lost = F.map_filter(landed, lambda k, v: v.isNotNull() & F.array_contains(empty, k))
    return F.when(F.size(lost) > 0, F.to_json(lost)).otherwise(F.col(RESCUED))


def stream_files(spark: SparkSession, path: str, fmt: str, schema: StructType, glob: str | None = None,
                 multiline: bool = False, header: bool = True) -> DataFrame:
    """Streaming DataFrame over a landing folder (recursive, filtered by glob)
    with ingest time and source file lineage."""
    if RESCUED not in schema.fieldNames():
        schema = StructType([*schema.fields, StructField(RESCUED, StringType(), True)])
    # the checkpoint gives exactly-once; no file is too old to be new
    r = _options(spark.readStream.schema(schema), fmt, glob, multiline, header).option("maxFileAge", "36500d")
    if fmt in ("json", "csv"):
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    df = r.format(fmt).load(path)
    if fmt == "json":
        df = df.withColumn(RESCUED, rescued_fields(df, [f.name for f in schema.fields if f.name != RESCUED]))
    return (df.withColumn("_ingested_at", F.current_timestamp())
              .withColumn("_source_file", F.col("_metadata.file_path")))


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str, fmt: str = "json",
           schema: StructType | None = None, glob: str | None = None, multiline: bool = False,
           header: bool = True) -> int:
    """Append the files landed since the last run to the Parquet table at
    ``out`` (exactly once per file) and return the number of micro-batches
    run.  With ``schema=None`` the schema evolves (see module doc); CSV files
    are read by their own headers then (``_ingest_csv``)."""
    if fmt == "csv" and header and schema is None:
        return _ingest_csv(spark, path, out, checkpoint, glob)
    if schema is None:
        schema = evolve_schema(spark, path, fmt, checkpoint.rstrip("/") + "/_schema", glob,
                               multiline, header)
        if not schema.fields:
            return 0
    df = stream_files(spark, path, fmt, schema, glob, multiline, header)
    q = (df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint.rstrip("/") + "/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)


def _ingest_csv(spark: SparkSession, path: str, out: str, checkpoint: str, glob: str | None) -> int:
    """CSV files whose columns differ from file to file, by name.

    The stream finds the files; of every micro-batch those with one header
    are read together, all columns as text (a type is for the cleaning to
    find, and text keeps leading zeros), and joined by column name.  Rows with
    more or fewer values than the header keep their text in
    ``_rescued_data``.  A batch is one folder, written over if it is run again,
    so a file's rows are in the table once."""
    lines = _options(spark.readStream, "text", glob, False, False).option("maxFileAge", "36500d").format("text").load(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))

    def land(batch: DataFrame, number: int) -> None:
        ordered = batch.withColumn("n", F.monotonically_increasing_id())
        heads = ordered.groupBy("file").agg(F.min_by("value", F.struct("start", "n")).alias("head"))
        alike = heads.groupBy("head").agg(F.collect_list("file").alias("files")).collect()     # names of one batch's files
        session, parts = batch.sparkSession, []
        for group in alike:
            names = session.read.option("header", "true").csv(group["files"]).columns
            schema = StructType([StructField(n, StringType(), True) for n in [*names, RESCUED]])
            part = (session.read.option("header", "true").schema(schema).option("mode", "PERMISSIVE")
                    .option("columnNameOfCorruptRecord", RESCUED).csv(group["files"]))
            parts.append(part.withColumn("_source_file", F.col("_metadata.file_path")))
        if parts:
            landed = union_by_name(*parts).withColumn("_ingested_at", F.current_timestamp())
            landed.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    q = (lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint.rstrip("/") + "/stream")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return len(q.recentProgress)


def backfill(spark: SparkSession, path: str, out: str, checkpoint: str, run: str, **options) -> DataFrame:
    """Read the whole landing history again, into a table and a checkpoint of
    their own (``<out>_<run>``, ``<checkpoint>_<run>``); the caller switches
    readers over when it is complete.  Returns the new table."""
    ingest(spark, path, f"{out}_{run}", f"{checkpoint}_{run}", **options)
    return read_table(spark, f"{out}_{run}")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read an ingested table back (schemas of all runs merged); empty before
    the first run.  A damaged table raises."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema or StructType([]))
    r = spark.read.option("mergeSchema", "true")
    if schema is not None:
        return r.schema(schema).parquet(path)
    try:
        return r.parquet(path).withColumnRenamed("batch", "_batch")
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":     # a stream that has not written a row yet
            raise
        return spark.createDataFrame([], StructType([]))
