"""Raw ingest as a stream of files: the batch projection, fed by readStream."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerloom.functions import reference_data as ref
from ledgerloom.operators.ingest import to_raw
from ledgerloom.plans.bronze import PARTITION, load_change
from ledgerloom.sources import versions


def file_stream(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet",
    environment: str = "prod", **options,
) -> DataFrame:
    """New files below a path, rate-limited per trigger by the environment's setting."""
    return (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", ref.FILES_PER_TRIGGER[environment])
        .options(**options)
        .load(path)
    )


def raw_stream(
    delivery: DataFrame, source: str, source_system: str, batch_id: str | Column,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Delivery stream to raw-table rows; each row names its file."""
    named = delivery.select("*", F.col("_metadata.file_path").alias("_path"))
    return to_raw(named, source, F.col("_path"), source_system, batch_id, ingested_at)


def with_trigger(writer, environment: str | None):
    """Continuous micro-batches on the environment's interval, or drain what is there and stop."""
    if environment is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=ref.TRIGGER_INTERVAL[environment])


def append_stream(
    rows: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None,
    environment: str | None = None,
) -> StreamingQuery:
    """Exactly-once append to a file table. Keep `checkpoint` in shared storage."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return with_trigger(writer, environment).start(target)


def run_name(checkpoint: str) -> str:
    """Short name of a query's run, told by its checkpoint: epochs count from zero in each."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def ingest_stream(rows: DataFrame, target: str, checkpoint: str, environment: str | None = None) -> StreamingQuery:
    """Each micro-batch becomes a load of the raw table, beside those of the batch runs, in one commit.

    A repeated epoch replaces its own load, and only new loads are work for the next silver run.
    """
    run = run_name(checkpoint)

    def process(batch: DataFrame, epoch: int) -> None:
        load = batch.withColumn(PARTITION[0], F.lit(f"stream_{run}_{epoch}"))
        versions.publish(batch.sparkSession, target, {versions.MAIN: load_change(load)})

    writer = rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return with_trigger(writer, environment).start()


def deduplicated(rows: DataFrame, keys: list[str], time_column: str, delay: str) -> DataFrame:
    """Drop repeated keys that arrive within the watermark delay; state is bounded by it."""
    return rows.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(keys)
