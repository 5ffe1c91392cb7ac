"""Quarantine: rejected rows as JSON with their reason, reports on them, and replay.

A record that breaks several rules has a row for each. Where rows carry `record`, the number of the record, and `first`, whether
the row is of its first reason, those of the first reason are the deliveries, each once: nothing is grouped to find them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions import reference_data as ref
from ledgerloom.functions.columns import pct
from ledgerloom.operators.joins import orphan_keys
from ledgerloom.operators.rules import REASON, REASONS, strict_reason
from ledgerloom.operators.validation import record_of
from ledgerloom.session import new_location
from ledgerloom.sources import versions


def to_quarantine(
    rejected: DataFrame,
    source_table: str,
    reason_column: str = REASON,
    batch_id: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Quarantine rows. The batch id defaults to the row's own `_batch_id`, where it has one."""
    now = at if at is not None else F.current_timestamp()
    told = ("record", "first", "load")
    record = [c for c in rejected.columns if c not in (reason_column, REASONS, "_load", *told)]
    load = [F.col(c) for c in told if c in rejected.columns]
    if batch_id is not None or "_batch_id" not in record:
        batch = F.lit(batch_id).cast("string")
    else:
        batch = F.col("_batch_id")
    reason = F.col(reason_column) if reason_column in rejected.columns else F.lit("unknown")
    return rejected.select(
        now.alias("quarantine_timestamp"),
        F.lit(source_table).alias("source_table"),
        reason.alias("rejection_reason"),
        batch.alias("batch_id"),
        F.to_date(now).alias("quarantine_date"),
        F.to_json(F.struct(*record)).alias("original_record"),
        *load,
    )


def by_reason(records: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected records with the array of their reasons, as rows by reason with `record` and `first`; `columns` make up a record."""
    told = records.withColumn("record", record_of(columns))
    rows = told.withColumn(REASON, F.explode(REASONS))
    return rows.withColumn("first", F.col(REASON) == F.array_min(REASONS)).drop(REASONS)


def write(spark: SparkSession, target: str, rejected: DataFrame, source_table: str, batch_id: str | None = None, at: Column | None = None) -> int:
    """Add rejected rows to the quarantine, a table with commits; how many there are. Nothing rejected writes nothing.

    Days are zones, not directories: a day's rejects are few, and a delivery may hold very many days.
    """
    if rejected.isEmpty():
        return 0
    rows = to_quarantine(rejected, source_table, batch_id=batch_id, at=at)
    return versions.append(spark, target, rows.repartitionByRange("quarantine_date"), zones=["quarantine_date"])


def to_quarantine_nb(
    invalid: DataFrame, currencies: list[str] = ref.STRICT_CURRENCIES, at: Column | None = None
) -> DataFrame:
    """Scheduled-job variant: record id and first reason only."""
    return invalid.select(
        F.col("transaction_id").alias("record_id"),
        F.lit("transactions_raw").alias("source_table"),
        strict_reason(currencies).alias("rejection_reason"),
        F.to_json(F.struct("*")).alias("original_data"),
        (at if at is not None else F.current_timestamp()).alias("_quarantine_timestamp"),
    )


def stats(quarantine: DataFrame) -> DataFrame:
    """Totals, then counts by reason and by source, from one scan by grouping sets.

    `level` is total, reason or source.
    """
    reason, source = F.col("rejection_reason"), F.col("source_table")
    sets = quarantine.groupingSets(
        [[], [reason], [source]], reason, source
    ).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("batch_id").alias("batches"),
        F.min("quarantine_timestamp").alias("earliest"),
        F.max("quarantine_timestamp").alias("latest"),
    )
    level = F.when(F.col("_set") == 3, "total").when(F.col("_set") == 1, "reason").otherwise("source")
    return sets.select(
        level.alias("level"),
        F.coalesce("rejection_reason", "source_table").alias("label"),
        "n", "batches", "earliest", "latest",
    )


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """Rows per reason, most frequent first."""
    counts = quarantine.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "rejection_reason")


def lookup(
    quarantine: DataFrame,
    source_table: str | None = None,
    reason: str | None = None,
    batch_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Quarantined rows by optional filters; a limit is for looking at a few of them."""
    for column, value in (
        ("source_table", source_table), ("rejection_reason", reason), ("batch_id", batch_id)
    ):
        if value is not None:
            quarantine = quarantine.filter(F.col(column) == value)
    return quarantine if limit is None else quarantine.limit(limit)


def replay(
    quarantine: DataFrame,
    schema: StructType,
    source_table: str | None = None,
    batch_id: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rejected records as raw columns, with their first rejection; `load` and `record` where the rows have them.

    The declared schema restores fields the JSON dropped because they were NULL. A record
    quarantined under several reasons comes back once per delivery of it. Where rows do not say which is of the first reason, that
    is found by hashes of the records, and a record's text moves only with the row that stays.
    """
    rows = lookup(quarantine, source_table, None, batch_id, limit)
    if "first" in rows.columns:
        deliveries = rows.filter("first")
    else:
        told = [F.xxhash64(F.lit(i), F.col("original_record")).alias(f"_h{i}") for i in (1, 2)]
        hashed = rows.select("*", *told)
        least = hashed.groupBy("_h1", "_h2").agg(F.min("rejection_reason").alias("_least"))
        deliveries = hashed.join(least, ["_h1", "_h2"]).filter(F.col("rejection_reason") == F.col("_least"))
    kept = [c for c in ("load", "record") if c in rows.columns]
    return deliveries.select(
        F.from_json("original_record", schema).alias("_fields"), *kept,
        F.col("quarantine_timestamp").alias("_original_quarantine_timestamp"),
        F.col("rejection_reason").alias("_original_rejection_reason"),
    ).select("_fields.*", *kept, "_original_quarantine_timestamp", "_original_rejection_reason")


def daily_trend(quarantine: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Rejections per day and reason over the last days."""
    recent = quarantine.filter(F.col("quarantine_date") >= F.date_sub(as_of, days))
    counts = recent.groupBy("quarantine_date", "rejection_reason").agg(F.count(F.lit(1)).alias("rejections"))
    return counts.orderBy("quarantine_date", F.desc("rejections"), "rejection_reason")


def rate_alert(total_rows: DataFrame, rejected_records: DataFrame, limit_pct: float = ref.QUARANTINE_ALERT_PCT) -> DataFrame:
    """One row: rejected share in percent and whether it passes the alert limit.

    Both inputs are one-row, one-column counts.
    """
    total, rejected = total_rows.scalar(), rejected_records.scalar()
    one = total_rows.sparkSession.range(1)
    rate = pct(rejected, total)
    return one.select(
        total.alias("total_rows"), rejected.alias("rejected_rows"),
        rate.alias("rate_pct"), (rate > limit_pct).alias("alert"),
    )


def orphan_quarantine(rows: DataFrame, references: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows with an unknown foreign key, once per broken key, tagged by the key's name.

    One scan finds the unknown values of all keys, which are written to the shared folder; one more finds their rows. Few
    values are broadcast; many are joined by shuffle, in which adaptive execution splits a hot one.
    """
    spark, place = rows.sparkSession, new_location(rows.sparkSession, "orphan_keys")
    orphan_keys(rows, references).select("name", "value").write.parquet(place)
    broken = spark.read.schema("name string, value string").parquet(place)
    each = F.array(*[F.struct(F.lit(c).alias("_name"), F.col(c).cast("string").alias("_value")) for c, _, _ in references])
    keyed = rows.select("*", F.inline(each)).filter(F.col("_value").isNotNull())
    found = keyed.join(broken, (F.col("_name") == F.col("name")) & (F.col("_value") == F.col("value")))
    return found.select(*rows.columns, F.concat(F.lit("orphan_"), "name").alias(REASON))
