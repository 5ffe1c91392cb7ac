"""Batch readers. A table reference is a catalog name, or a path when it contains a slash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.sources import versions


def is_path(reference: str) -> bool:
    return "/" in reference


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    header: bool = True,
    infer_schema: bool = True,
    **options,
) -> DataFrame:
    """CSV with header. A given schema wins; inference costs an extra pass over the files."""
    reader = spark.read.options(header=header, **options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.csv(path, inferSchema=infer_schema)


def read_csv_by_name(spark: SparkSession, path: str, **options) -> DataFrame:
    """CSV files with headers that may differ in order or columns, as text, matched by name.

    One look at the first lines groups the files by header; each group is read by its own
    header, and a column that a file lacks is NULL. Rows keep `_metadata.file_path` as `_path`.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"), "value")
    headers = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups = headers.groupBy("header").agg(F.collect_list("file").alias("files")).orderBy("header").collect()
    merged = None
    for group in groups:
        files = spark.read.options(**{"header": True, "inferSchema": False} | options).csv(sorted(group.files))
        named = files.select("*", F.col("_metadata.file_path").alias("_path"))
        merged = named if merged is None else merged.unionByName(named, allowMissingColumns=True)
    if merged is None:
        raise ValueError(f"no CSV file with a header at {path}")
    return merged


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multiline: bool = False,
    **options,
) -> DataFrame:
    """JSON lines (splittable), or one document per file with multiline."""
    reader = spark.read.options(multiLine=multiline, **options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(**options).parquet(path)


def read_table(spark: SparkSession, reference: str) -> DataFrame:
    """A layer table by catalog name or by path.

    A path that holds commits, or links to a table of such a store, is read as its newest version. Files of any other path may differ in columns, because appends may add some: their schemas are
    merged, and a column with two types that do not fit is an error.
    """
    if not is_path(reference):
        return spark.table(reference)
    if (found := versions.resolve(spark, reference)) is not None:
        return versions.read(spark, versions.version(spark, found[0]), found[1])
    return spark.read.option("mergeSchema", True).parquet(reference)


def as_of(
    log: DataFrame, timestamp: str | None = None, up_to_batch: str | None = None
) -> DataFrame:
    """State of an append-only raw log at a batch or at a moment; the batch wins if both are given."""
    if up_to_batch is not None:
        return log.filter(F.col("_batch_id") <= up_to_batch)
    if timestamp is not None:
        return log.filter(F.col("_ingestion_timestamp") <= F.to_timestamp(F.lit(timestamp)))
    return log


def read_as_of(
    spark: SparkSession, reference: str, timestamp: str | None = None, up_to_batch: str | None = None
) -> DataFrame:
    return as_of(read_table(spark, reference), timestamp, up_to_batch)
