"""Raw-layer loads: a delivery becomes a load of the raw table in one commit, returning the row count.

A load is a batch and a named delivery (a source file). It replaces itself, so a retry changes nothing and a corrected file
takes the place of the wrong one. Its fingerprint, kept with its files, tells a correction from a retry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.ingest import to_raw
from ledgerloom.session import shuffles_removed
from ledgerloom.sources import versions
from ledgerloom.sources.readers import is_path, read_csv_by_name, read_json, read_table
from ledgerloom.sources.sinks import overwrite_partitions

PARTITION = ["_load"]


def contents(columns: list[str]) -> list[str]:
    """Columns that make up what was delivered: all but the clock of the load."""
    return [c for c in columns if c not in ("_ingestion_timestamp", "_load_date", "_source_file", *PARTITION)]


def load_change(rows: DataFrame) -> versions.Change:
    """The loads of raw rows with `_load`, each in the place of its earlier self. Tasks write what they read: a task reads few loads."""
    return versions.Change(rows, partition_by=tuple(PARTITION), fingerprint=tuple(contents(rows.columns)), replace=PARTITION[0], rebalance=False)


def _store(spark: SparkSession, rows: DataFrame, target: str) -> int:
    file = F.substring(F.md5(F.coalesce("_source_file", F.lit(""))), 1, 12)
    load = F.concat(F.lit("load_"), F.coalesce("_batch_id", F.lit("")), F.lit("_"), file)
    rows = rows.withColumn("_load", load)
    if not is_path(target):
        return overwrite_partitions(spark, rows, target, PARTITION)
    return versions.publish(spark, target, {versions.MAIN: load_change(rows)})[1][versions.MAIN]


def load_dataframe(
    df: DataFrame,
    source: str,
    target: str,
    batch_id: str,
    source_file: str | Column | None = None,
    source_system: str = "dataframe",
    ingested_at: Column | None = None,
) -> int:
    """Add a delivery to the raw table of a source (transactions, customers, accounts, merchants).

    A delivery of the same batch and source file replaces the one before. A delivery without a name is
    named by its contents, at the price of one more pass over it: the same one again changes nothing, and a different one
    is a further load, never a silent replacement.
    """
    if source_file is None:
        with shuffles_removed(df.sparkSession):
            h1, h2 = df.agg(*versions.fingerprints(sorted(df.columns))).first()
        source_file = f"dataframe:{h1}:{h2}"
    rows = to_raw(df, source, source_file, source_system, batch_id, ingested_at)
    return _store(df.sparkSession, rows, target)


def load_csv(
    spark: SparkSession, path: str, source: str, target: str, batch_id: str,
    source_system: str = "file_ingest", ingested_at: Column | None = None, **options,
) -> int:
    """CSV with header; columns are matched by name, file by file, and kept as text."""
    delivery = read_csv_by_name(spark, path, **options)
    return _load_files(delivery, source, target, batch_id, source_system, ingested_at)


def load_json(
    spark: SparkSession, path: str, source: str, target: str, batch_id: str,
    source_system: str = "file_ingest", ingested_at: Column | None = None, **options,
) -> int:
    """JSON with the declared text schema, so the files are read once."""
    delivery = read_json(spark, path, schema=schemas.delivered(source), **options)
    named = delivery.select("*", F.col("_metadata.file_path").alias("_path"))
    return _load_files(named, source, target, batch_id, source_system, ingested_at)


def _load_files(named, source, target, batch_id, source_system, ingested_at) -> int:
    rows = to_raw(named, source, F.col("_path"), source_system, batch_id, ingested_at)
    return _store(named.sparkSession, rows, target)


def record_count(spark: SparkSession, target: str) -> int:
    return read_table(spark, target).count()
