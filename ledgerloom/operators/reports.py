"""Reports on finished tables: roll-ups, counts per layer, freshness, run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import reference_data as ref
from ledgerloom.functions.columns import pct


def segment_distribution(customers: DataFrame) -> DataFrame:
    groups = customers.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.round(F.sum("lifetime_value_usd").cast("double") / F.count("lifetime_value_usd"), 2).alias("avg_lifetime_value"),
        F.round(F.sum("total_transactions") / F.count("total_transactions"), 0).alias("avg_transactions"),
    )
    return groups.orderBy(F.desc("avg_lifetime_value"), "customer_segment")


def channel_revenue_breakdown(channels: DataFrame) -> DataFrame:
    totals = channels.groupBy("channel").agg(
        F.sum("total_revenue_usd").alias("total_revenue"),
        F.sum("transaction_count").alias("total_transactions"),
    )
    return totals.orderBy(F.desc("total_revenue"), "channel")


def monthly_revenue_trend(monthly: DataFrame) -> DataFrame:
    return monthly.orderBy("year", "month").select(
        "year", "month_name", "total_revenue", "transaction_count", "unique_customers"
    )


def layer_record_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table. Counting a file-backed table reads no columns."""
    counts = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def freshness(
    tables: dict[str, tuple[DataFrame, str]], as_of: Column, alert_hours: int = ref.FRESHNESS_ALERT_HOURS
) -> DataFrame:
    """Newest moment per table, its lag behind `as_of` in hours, and the alert."""
    report = None
    for name, (table, column) in tables.items():
        one = table.agg(F.max(column).cast("timestamp").alias("latest")).select(
            F.lit(name).alias("table_name"), "latest"
        )
        report = one if report is None else report.unionByName(one)
    lag = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds("latest")) / 3600
    return report.withColumn("lag_hours", lag).withColumn("alert", F.col("lag_hours") > alert_hours)


def newest_facts(fact: DataFrame, n: int = 10) -> DataFrame:
    """Top n by creation time, by a per-task top-n rather than a full sort."""
    return fact.orderBy(F.desc("_created_timestamp"), "transaction_id", "amount_usd").limit(n)


def run_metrics(step: str, rows: DataFrame, valid: Column) -> DataFrame:
    """Input, output, rejected rows and success rate of a step in one aggregate."""
    counts = rows.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count(F.when(valid, F.lit(1))).alias("output_rows"),
    )
    return counts.select(
        F.lit(step).alias("step"), "input_rows", "output_rows",
        (F.col("input_rows") - F.col("output_rows")).alias("rejected_rows"),
        pct(F.col("output_rows"), F.col("input_rows")).alias("success_rate"),
    )
