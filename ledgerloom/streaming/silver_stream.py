"""Raw stream to fact and quarantine, and late data by upsert.

foreachBatch may run an epoch again after a failure. An epoch of the fact is a load that replaces itself; an epoch of
an upsert is entered in the same commit as its rows, and a repeat that finds its entry does nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.plans.silver import QUARANTINE, fact_changes, transform
from ledgerloom.sources import versions
from ledgerloom.sources.sinks import latest_per_key
from ledgerloom.streaming.bronze_stream import run_name, with_trigger

EPOCHS = "epochs"


def fact_stream(
    raw: DataFrame, fact_target: str, quarantine_target: str, checkpoint: str,
    at: Column | None = None, environment: str | None = None,
) -> StreamingQuery:
    """Split, type and key each micro-batch, which is a load like those of the batch runs, and commit both sides
    together. The batch is kept for its two writes.
    """
    run = run_name(checkpoint)

    def process(batch: DataFrame, epoch: int) -> None:
        spark, load = batch.sparkSession, f"stream_{run}_{epoch}"
        batch.persist()
        try:
            fact, rejected = transform(batch.withColumn("load", F.lit(load)), at=at)
            versions.link(spark, quarantine_target, fact_target, QUARANTINE)
            versions.publish(spark, fact_target, fact_changes(fact, rejected, spark.range(1).select(F.lit(load).alias("load"))))
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return with_trigger(writer, environment).start()


def upsert_stream(
    rows: DataFrame, keys: list[str], order: list[str], target: str, checkpoint: str,
    environment: str | None = None, keep_versions: int = 3,
) -> StreamingQuery:
    """Keep the newest row per key, whatever order the rows arrive in.

    An epoch writes anew only the files that hold one of its keys, and in the same commit enters its run and number,
    which a repeat finds. A new checkpoint over an existing table is another run and goes on from the newest version. Versions
    beyond `keep_versions` are removed with the files that only they name, so the table does not grow with its epochs.
    """
    run, newest = run_name(checkpoint), [F.desc_nulls_last(c) for c in order]

    def process(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        latest = latest_per_key(batch, keys, newest).persist()
        try:
            now = versions.version(spark, target)
            if now is not None and not versions.read(spark, now, EPOCHS).filter((F.col("run") == run) & (F.col("epoch") == epoch)).isEmpty():
                return
            # of each run the last epoch: a repeat is never of an earlier one
            entry = spark.range(1).select(F.lit(run).alias("run"), F.lit(epoch).cast("bigint").alias("epoch"))
            if now is not None:
                entry = versions.read(spark, now, EPOCHS).filter(F.col("run") != run).unionByName(entry)
            also = {EPOCHS: versions.Change(entry.coalesce(1))}
            if now is None:
                order_of = [*[F.col(k) for k in keys], F.xxhash64(*latest.columns)]
                spread = latest.repartitionByRange(*order_of).sortWithinPartitions(*keys)
                versions.publish(spark, target, {versions.MAIN: versions.Change(spread, zones=tuple(keys))} | also)
            elif not latest.isEmpty():
                versions.merge(spark, target, latest, keys, lambda old, new: latest_per_key(old.unionByName(new), keys, newest), also=also)
            if keep_versions:
                versions.vacuum(spark, target, keep_versions)
        finally:
            latest.unpersist()

    writer = rows.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return with_trigger(writer, environment).start()


def current_rows(spark: SparkSession, target: str, before: int | None = None) -> DataFrame:
    """The newest row per key, optionally as of before a version."""
    known = [n for n in versions.numbers(spark, target) if before is None or n < before]
    if not known:
        raise ValueError(f"no upserted rows at {target}")
    return versions.read(spark, versions.version(spark, target, known[-1]))
