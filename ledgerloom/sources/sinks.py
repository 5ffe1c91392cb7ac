"""Writers, and the row-level changes (upsert, delete, archive, retention, layout).

Parquet has no row-level updates. Changes of rows go to tables with commits (`versions`): files that hold
a changed row are written anew beside the old ones, and a commit names the new set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.sources import versions
from ledgerloom.sources.readers import is_path


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "append",
    partition_by: list[str] | None = None,
    rebalance: bool = True,
    location: str | None = None,
) -> None:
    """Write to a path or a catalog table; `location` keeps a new catalog table's files there.

    Partitioned writes first pass through a rebalance on the partition columns: adaptive
    execution gathers each partition value into few files, and still splits a value that
    is too large for one task.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_path(target):
        # overwrite replaces everything, whatever the session's default is
        writer.option("partitionOverwriteMode", "static").parquet(target)
    else:
        named = writer.format("parquet")
        (named.option("path", location) if location else named).saveAsTable(target)


def write_counted(df: DataFrame, target: str, partition_by: list[str] | None = None, **options) -> int:
    """Write and return the number of rows, counted in the writing stage itself.

    Counting before the exchange of the rebalance would count again what a lost executor's
    map tasks repeat.
    """
    seen = Observation()
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    write_table(counted, target, partition_by=partition_by, rebalance=False, **options)
    return seen.get["rows"]


def append(df: DataFrame, target: str, **options) -> int:
    return write_counted(df, target, mode="append", **options)


def overwrite(df: DataFrame, target: str, **options) -> int:
    return write_counted(df, target, mode="overwrite", **options)


def location_of(spark: SparkSession, table: str) -> str:
    """Folder of a catalog table's files."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first().data_type


def overwrite_partitions(
    spark: SparkSession, df: DataFrame, target: str, partition_by: list[str]
) -> int:
    """Replace only the partitions present in df and return its row count; a rerun of the
    same batch changes nothing.

    Partitions that df does not mention are kept, so this is not a delete.
    """
    seen = Observation()
    df = df.hint("rebalance", *partition_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if is_path(target):
        writer.option("partitionOverwriteMode", "dynamic").parquet(target)
    elif spark.catalog.tableExists(target):
        # inserts take the mode from the session only, which other threads use too; files go to the table's own folder instead
        columns = spark.table(target).columns
        df.select(columns).write.mode("overwrite").partitionBy(*partition_by).option(
            "partitionOverwriteMode", "dynamic").parquet(location_of(spark, target))
        spark.catalog.recoverPartitions(target)
        spark.catalog.refreshTable(target)
    else:
        writer.format("parquet").saveAsTable(target)
    return seen.get["rows"]


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by a total order.

    Catalyst limits each map task to one row per key before the shuffle
    (WindowGroupLimit), so a key with a third of all rows shrinks before it moves.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def same_key(left: str, right: str, keys: list[str], null_safe: bool = False) -> Column:
    """Equality of all keys of two aliased frames; null-safe treats NULL as a value."""
    condition = None
    for key in keys:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        part = a.eqNullSafe(b) if null_safe else a == b
        condition = part if condition is None else condition & part
    return condition


def duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys without NULL that occur more than once, with their row count `n`."""
    whole = source.dropna(subset=keys)
    return whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | list[str],
    update_columns: list[str] | None = None,
    insert_columns: list[str] | None = None,
) -> DataFrame:
    """Contents of the target after an upsert: matched rows take the update columns
    (default all non-key), unmatched source rows are inserted (columns left out are NULL).

    The source must have one row per key: a repeated one is an error, found by a look at the
    keys before the join is built. NULL keys never match and may repeat. The update is a left
    join and the insert a semi and an anti join: with a small source all of them broadcast
    it and the target is not shuffled, with a large one adaptive execution can split a hot
    key. A full outer join could do neither.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    updates = [c for c in (update_columns or source.columns) if c not in keys]
    inserts = insert_columns or source.columns
    columns = target.columns + [c for c in source.columns if c not in target.columns]
    repeated = duplicate_keys(source, keys).limit(5).collect()
    if repeated:
        raise ValueError(f"upsert source repeats keys, for example {[tuple(r)[:-1] for r in repeated]}")

    incoming = source.withColumn("_matched", F.lit(True)).alias("s")
    joined = target.alias("t").join(incoming, same_key("t", "s", keys), "left")

    def updated(name: str) -> Column:
        old = F.col(f"t.{name}") if name in target.columns else F.lit(None)
        if name in updates:
            return F.when(F.col("s._matched"), F.col(f"s.{name}")).otherwise(old).alias(name)
        return old.alias(name)

    kept = joined.select([updated(c) for c in columns])
    offered = source.select(keys).alias("s")
    matched = target.select(keys).alias("t").join(offered, same_key("t", "s", keys), "left_semi")
    known = matched.distinct().alias("t")
    new = source.alias("s").join(known, same_key("t", "s", keys), "left_anti")
    inserted = new.select(
        [(F.col(c) if c in inserts else F.lit(None).cast(kept.schema[c].dataType)).alias(c)
         for c in columns]
    )
    return kept.unionByName(inserted)


def upsert_to(
    spark: SparkSession, target: str, source: DataFrame, keys: str | list[str],
    update_columns: list[str] | None = None, insert_columns: list[str] | None = None,
) -> versions.Version:
    """Upsert into a table with commits: only files that hold a key of the source are written anew."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    root, table = versions.resolve(spark, target) or (target, versions.MAIN)
    return versions.merge(
        spark, root, source, keys, lambda old, new: merge_upsert(old, new, keys, update_columns, insert_columns), table)


def removal_condition(
    source_table: str | None = None,
    batch_id: str | None = None,
    older_than_days: int | None = None,
    as_of: Column | None = None,
) -> Column | None:
    """AND of the given quarantine predicates; None when none is given."""
    parts = []
    if source_table is not None:
        parts.append(F.col("source_table") == source_table)
    if batch_id is not None:
        parts.append(F.col("batch_id") == batch_id)
    if older_than_days is not None:
        today = as_of if as_of is not None else F.current_date()
        parts.append(F.col("quarantine_date") < F.date_sub(today, older_than_days))
    condition = None
    for part in parts:
        condition = part if condition is None else condition & part
    return condition


def delete_where(df: DataFrame, condition: Column | None) -> DataFrame:
    """Rows that survive the delete. No condition deletes nothing; NULL is not a match."""
    if condition is None:
        return df
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_from(spark: SparkSession, target: str, condition: Column | None, archive: str | None = None) -> int:
    """Delete from a table with commits, or move to its archive, which `archive` then means; how many rows went.

    No condition deletes nothing. Files without a doomed row are not touched.
    """
    if condition is None:
        return 0
    root, table = versions.resolve(spark, target) or (target, versions.MAIN)
    into = None if archive is None else f"{table}_archive"
    gone = versions.remove(spark, root, condition, table, into)
    if gone and archive is not None:
        versions.link(spark, archive, root, into)
    return gone


def older_than(day_column: str, days: int, as_of: Column) -> Column:
    """Whether a row is past its days; one without a day is not."""
    return F.coalesce(F.col(day_column) < F.date_sub(as_of, days), F.lit(False))


def prune(spark: SparkSession, targets: dict[str, tuple[str, str, int]], as_of: Column) -> dict[str, int]:
    """Delete from every table (path, day column, days to keep) what is past its days; rows deleted by name."""
    return {name: delete_from(spark, path, older_than(column, days, as_of)) for name, (path, column, days) in targets.items()}


def archive_split(df: DataFrame, day_column: str, days: int, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """(rows to archive, rows to keep) by age; a row without a day is kept."""
    old = older_than(day_column, days, as_of)
    return df.filter(old), df.filter(~old)


def retention_prune(df: DataFrame, day_column: str, days: int, as_of: Column) -> DataFrame:
    """Rows within the retention period. On a table partitioned by the day column this
    only lists and reads the partitions that stay."""
    return archive_split(df, day_column, days, as_of)[1]


def clustered_layout(df: DataFrame, columns: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the columns, so row-group statistics skip well.

    Append further columns as tie-breaks when one value may fill a partition: the ranges
    are cut on the whole column list.
    """
    spread = (
        df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    )
    return spread.sortWithinPartitions(*columns)
