"""Join shapes of the star schema.

Hints are given only to tables with a fixed bound (the calendar). Everything else is
left to Catalyst and adaptive execution, which broadcast by measured size and otherwise
sort-merge with skewed partitions split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DATE_ATTRIBUTES = [
    "full_date", "year", "quarter", "month", "month_name",
    "week_of_year", "day_of_week", "day_name", "is_weekend",
]


def with_date(fact: DataFrame, dim_date: DataFrame, attributes: list[str]) -> DataFrame:
    """Left join to the calendar. A calendar has 366 rows per year at most, so it is
    broadcast whatever the size of the fact."""
    return fact.join(F.broadcast(dim_date.select("date_key", *attributes)), "date_key", "left")


def with_dimension(rows: DataFrame, dimension: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Left join to a dimension that has one row per key."""
    return rows.join(dimension.select(key, *attributes), key, "left")


def with_date_and_merchant(
    fact: DataFrame, dim_date: DataFrame, dim_merchant: DataFrame,
    date_attributes: list[str], merchant_attributes: list[str],
) -> DataFrame:
    dated = with_date(fact, dim_date, date_attributes)
    return with_dimension(dated, dim_merchant, "merchant_key", merchant_attributes)


def accounts_with_customer(accounts: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Accounts with the key of their customer."""
    return with_dimension(accounts, dim_customer, "customer_id", ["customer_key"])


def with_business_keys(
    rows: DataFrame, dim_customer: DataFrame, dim_account: DataFrame, dim_merchant: DataFrame
) -> DataFrame:
    """Business ids swapped for dimension keys by three left joins."""
    for dimension, ident, key in (
        (dim_customer, "customer_id", "customer_key"),
        (dim_account, "account_id", "account_key"),
        (dim_merchant, "merchant_id", "merchant_key"),
    ):
        rows = with_dimension(rows, dimension, ident, [key])
    return rows


def foreign_key_counts(rows: DataFrame, column: str) -> DataFrame:
    """Rows per foreign-key value. Map-side combine collapses a hot value before the
    shuffle, so the anti joins below never move the fact rows."""
    return rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))


def orphan_counts(
    rows: DataFrame, column: str, reference: DataFrame, reference_column: str, include_null: bool
) -> DataFrame:
    """One row: rows whose foreign key has no partner, non-NULL keys, all rows.

    A NULL key is an orphan only with `include_null`.
    """
    keys = foreign_key_counts(rows, column)
    known = reference.select(F.col(reference_column).alias("_known")).distinct()
    flagged = keys.join(known, keys[column] == known["_known"], "left")
    orphan = F.col("_known").isNull()
    if not include_null:
        orphan = orphan & F.col(column).isNotNull()
    return flagged.agg(
        F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).alias("orphan_rows"),
        F.coalesce(F.sum(F.when(F.col(column).isNotNull(), F.col("_n"))), F.lit(0)).alias("keyed_rows"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
    )


def orphan_rows(rows: DataFrame, column: str, reference: DataFrame, reference_column: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no partner."""
    known = reference.select(F.col(reference_column).alias("_known")).distinct()
    keyed = rows.filter(F.col(column).isNotNull())
    return keyed.join(known, F.col(column) == F.col("_known"), "left_anti")


def foreign_keys(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(name, value, n) of all foreign keys of the rows, from one scan: values are counted before they move."""
    each = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    return rows.select(F.inline(each)).groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def _known_keys(references: list[tuple[str, DataFrame, str]]) -> DataFrame:
    known = None
    for name, reference, column in references:
        one = reference.select(F.lit(name).alias("name"), F.col(column).cast("string").alias("value")).distinct()
        known = one if known is None else known.unionByName(one)
    return known


def orphan_keys(rows: DataFrame, references: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """(name, value, n) of the values, not NULL, that no reference (foreign key, table, its column) has. One scan of the rows."""
    used = foreign_keys(rows, [name for name, _, _ in references]).filter(F.col("value").isNotNull())
    return used.join(_known_keys(references), ["name", "value"], "left_anti")


def orphan_summary(rows: DataFrame, references: list[tuple[str, DataFrame, str]], include_null: bool) -> DataFrame:
    """Per foreign key: rows without a partner, rows with a key, all rows. One scan of the rows for all keys."""
    used = foreign_keys(rows, [name for name, _, _ in references])
    known = _known_keys(references).withColumn("known", F.lit(True))
    told = used.join(known, ["name", "value"], "left")
    orphan = F.col("known").isNull() & (F.lit(include_null) | F.col("value").isNotNull())
    some = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    sums = told.groupBy("name").agg(some(orphan).alias("orphan_rows"), some(F.col("value").isNotNull()).alias("keyed_rows"), F.sum("n").alias("total_rows"))
    # a table without rows has its line too
    names = rows.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n, _, _ in references])).alias("name"))
    whole = F.broadcast(names).join(sums, "name", "left")
    return whole.select(F.col("name").alias("check_name"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orphan_rows", "keyed_rows", "total_rows")])


def without_listed(rows: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the list; NULL keys match nothing and stay."""
    return rows.join(listed.select(key).distinct(), key, "left_anti")
