"""Checks on finished tables. Each returns one row: check_name, actual, passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import count_if
from ledgerloom.operators.joins import orphan_counts


def _verdict(name: str, rows: DataFrame, actual: Column, passed) -> DataFrame:
    shown = rows.select(F.lit(name).alias("check_name"), actual.cast("double").alias("actual"))
    return shown.withColumn("passed", passed(F.col("actual")))


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(whole, F.lit(1)).cast("double")


def null_keys(fact: DataFrame, key: str) -> DataFrame:
    counts = fact.agg(count_if(F.col(key).isNull()).alias("bad"), F.count(F.lit(1)).alias("n"))
    return _verdict("null_keys", counts, _share(F.col("bad"), F.col("n")), lambda a: a == 0)


def duplicate_keys(fact: DataFrame, key: str, limit: float = 0.01) -> DataFrame:
    """Key values that occur more than once, relative to all rows."""
    groups = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    counts = groups.agg(count_if(F.col("_n") > 1).alias("bad"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"))
    return _verdict("dup_keys", counts, _share(F.col("bad"), F.col("n")), lambda a: a < limit)


def amount_range(fact: DataFrame, low: int = 0, high: int = 1_000_000) -> DataFrame:
    amount = F.col("amount_usd")
    counts = fact.agg(count_if((amount < low) | (amount > high)).alias("bad"))
    return _verdict("amount_range", counts, F.col("bad"), lambda a: a == 0)


def orphan_rate(fact: DataFrame, column: str, dimension: DataFrame, dimension_column: str, limit: float = 0.05) -> DataFrame:
    counts = orphan_counts(fact, column, dimension, dimension_column, include_null=False)
    return _verdict(
        f"orphan_rate_{column}", counts, _share(F.col("orphan_rows"), F.col("keyed_rows")), lambda a: a < limit
    )


def amount_coverage(fact: DataFrame, limit: float = 0.95) -> DataFrame:
    counts = fact.agg(F.count("amount_usd").alias("filled"), F.count(F.lit(1)).alias("n"))
    return _verdict("amount_coverage", counts, _share(F.col("filled"), F.col("n")), lambda a: a > limit)


def _row_count(df: DataFrame) -> Column:
    return df.select(F.count(F.lit(1))).scalar()


def record_of(columns: list[str]) -> Column:
    """Number of a record: a hash of its columns in which NULL differs from any text. Equal deliveries share it."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns])


def _bucket_gaps(left: DataFrame, right: DataFrame, buckets: int) -> DataFrame:
    """(bucket, left_n, right_n) of the hash buckets whose records differ between two frames with `record`."""
    bucket = F.pmod("record", F.lit(buckets)).cast("int").alias("bucket")
    both = left.select(bucket, "record", F.lit(1).alias("side")).unionByName(right.select(bucket, "record", F.lit(-1).alias("side")))
    told = [F.sum(F.col("side") * F.xxhash64(F.lit(i), "record").cast("decimal(20,0)")).alias(f"h{i}") for i in (1, 2)]
    sums = both.groupBy("bucket").agg(count_if(F.col("side") == 1).alias("left_n"), count_if(F.col("side") == -1).alias("right_n"), *told)
    return sums.filter("left_n != right_n OR h1 != 0 OR h2 != 0").drop("h1", "h2")


def record_differences(left: DataFrame, right: DataFrame, buckets: int = 4096) -> DataFrame:
    """(record, left_n, right_n) of the records that two frames hold in different numbers.

    Counts and hash sums of buckets are compared first, a few numbers a bucket; only records of differing buckets
    are then looked at one by one. What is shuffled is numbers, never texts.
    """
    gaps = F.broadcast(_bucket_gaps(left, right, buckets).select("bucket"))  # at most `buckets` rows
    opened = [
        side.select("record", F.pmod("record", F.lit(buckets)).cast("int").alias("bucket"), F.lit(n).alias("side")).join(gaps, "bucket", "left_semi")
        for side, n in ((left, 1), (right, -1))
    ]
    counts = opened[0].unionByName(opened[1]).groupBy("record").agg(
        count_if(F.col("side") == 1).alias("left_n"), count_if(F.col("side") == -1).alias("right_n"))
    return counts.filter("left_n != right_n")


def reconcile(raw: DataFrame, fact: DataFrame, rejected_records: DataFrame, limit: float = 0.05) -> DataFrame:
    """Raw records against those of the fact and the rejected ones, as multisets: how many are lost or too many.

    Each side has a `record` column, a row for every delivery. Equal deliveries count each; a lost record is not made up for by one too many.
    """
    accounted = fact.select("record").unionByName(rejected_records.select("record"))
    gap = record_differences(raw, accounted).select(F.coalesce(F.sum(F.abs(F.col("left_n") - F.col("right_n"))), F.lit(0))).scalar()
    return _verdict("reconcile", raw.sparkSession.range(1), _share(gap, _row_count(raw)), lambda a: a < limit)


def dimension_coverage(raw: DataFrame, dimension: DataFrame, limit: float = 0.95) -> DataFrame:
    one = raw.sparkSession.range(1)
    return _verdict(
        "dim_coverage", one, _share(_row_count(dimension), _row_count(raw)), lambda a: a > limit
    )


def labels_present(table: DataFrame, column: str) -> DataFrame:
    counts = table.agg(F.count_distinct(column).alias("n"))
    return _verdict(f"labels_{column}", counts, F.col("n"), lambda a: a > 0)
