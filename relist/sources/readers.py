"""Batch sources: reference CSVs read as strings, upstream tables, text
documents, listed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv_strings(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """CSV with header, every column kept as string (cast later with try_cast)."""
    r = spark.read.option("header", "true").option("inferSchema", "false")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(path)


def read_documents(spark: SparkSession, path: str, glob: str = "*.md") -> DataFrame:
    """Whole text files (one row per file), hidden files skipped, with the
    file name as ``source``."""
    df = (spark.read.option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").text(path, wholetext=True)
          .select(F.col("value").alias("text"), F.col("_metadata.file_name").alias("source")))
    return df.filter(~F.col("source").startswith("."))


def route_files(files: DataFrame, name_col: str = "name") -> DataFrame:
    """Route landed file names to a target table by name
    (catalog_a / catalog_b / manual listings / skipped)."""
    n = F.lower(F.col(name_col))
    route = (F.when(n.contains("essentials_bebe"), F.lit("catalog_a"))
             .when(n.contains("essentials_femme"), F.lit("catalog_b"))
             .when(n.contains("ebay") | n.contains("vestiaire"), F.lit("manual_listings"))
             .otherwise(F.lit("skip")))
    return files.withColumn("route", route)
