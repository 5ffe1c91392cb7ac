"""Row rules: named predicates that mark a row as invalid.

All rules are evaluated in one projection over one scan. A row is valid when no rule
fires; the verdict of a row never depends on another row.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import reference_data as ref
from ledgerloom.functions.columns import count_if, day, money

Rule = tuple[str, Column]
REASONS = "_rejection_reasons"
REASON = "_rejection_reason"


def outside(column: str, allowed: list[str]) -> str:
    """A present value outside the allowed set; NULL passes, the empty text does not."""
    listed = ", ".join(f"'{v}'" for v in allowed)
    return f"{column} NOT IN ({listed})"


def transaction_rules(
    currencies: list[str] = ref.CURRENCIES,
    statuses: list[str] = ref.STATUSES,
    types: list[str] = ref.TRANSACTION_TYPES,
    channels: list[str] = ref.CHANNELS,
) -> list[Rule]:
    """The nine standard rules."""
    conditions = {
        "null_transaction_id": "transaction_id IS NULL",
        "null_amount": "amount IS NULL",
        "invalid_amount": f"NOT (amount RLIKE r'{ref.AMOUNT_PATTERN}')",
        "negative_amount": "try_cast(amount AS DOUBLE) < 0",
        "invalid_currency": outside("currency", currencies),
        "invalid_status": outside("status", statuses),
        "invalid_transaction_type": outside("transaction_type", types),
        "invalid_channel": outside("channel", channels),
        "invalid_date": f"transaction_date IS NOT NULL AND try_to_date(transaction_date, '{ref.DATE_FORMAT}') IS NULL",
    }
    return [(name, F.expr(condition)) for name, condition in conditions.items()]


def negative_unless_refund() -> Rule:
    refund = F.coalesce(F.col("transaction_type") == "REFUND", F.lit(False))
    return "negative_unless_refund", (F.col("amount").try_cast("double") < 0) & ~refund


def date_out_of_range(first: str, last: str) -> Rule:
    """Parseable date outside the accepted period."""
    parsed = day(F.col("transaction_date"))
    return "date_out_of_range", ~parsed.between(F.lit(first).cast("date"), F.lit(last).cast("date"))


def fires(condition: Column) -> Column:
    """A rule fires only when its condition is true, not when it is unknown."""
    return F.coalesce(condition, F.lit(False))


def any_fires(rules: list[Rule]) -> Column:
    return reduce(operator.or_, [fires(condition) for _, condition in rules])


def reasons(rules: list[Rule]) -> Column:
    """One entry per rule: its name where it fires, NULL elsewhere."""
    return F.array(*[F.when(condition, F.lit(name)) for name, condition in rules])


def valid_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows on which no rule fires. Plain boolean logic, so it stays in generated code and
    stops at the first rule that fires."""
    return df.filter(~any_fires(rules))


def invalid_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rejected record and fired rule."""
    rejected = df.filter(any_fires(rules)).withColumn(REASON, F.explode(reasons(rules)))
    return rejected.filter(F.col(REASON).isNotNull())


def invalid_records(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rejected record, with the array of its reasons."""
    return df.filter(any_fires(rules)).withColumn(REASONS, F.array_compact(reasons(rules)))


def rule_split(df: DataFrame, rules: list[Rule] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a reason, one per fired rule)."""
    rules = rules if rules is not None else transaction_rules()
    return valid_rows(df, rules), invalid_rows(df, rules)


def verdicts(df: DataFrame, rules: list[Rule], valid_label: str = "valid") -> DataFrame:
    """Both sides of the split from one scan: rejected rows once per fired rule, valid rows
    once with the given label as reason."""
    label = F.when(~any_fires(rules), F.lit(valid_label))
    entries = F.array(label, *[F.when(condition, F.lit(name)) for name, condition in rules])
    return df.withColumn(REASON, F.explode(entries)).filter(F.col(REASON).isNotNull())


def rule_counts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows caught by each rule, and the valid rows, in one aggregate."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(~any_fires(rules)).alias("valid_rows"),
        *[count_if(condition).alias(name) for name, condition in rules],
    )


def duplicate_ids(df: DataFrame, key: str) -> DataFrame:
    """Ids that occur more than once, with their row count."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") > 1)


# --- strict variant of the scheduled job -------------------------------------------------


def strict_valid(currencies: list[str] = ref.STRICT_CURRENCIES) -> Column:
    """Id and customer present, amount above zero, currency in the narrow list."""
    return (
        F.col("transaction_id").isNotNull()
        & (money(F.col("amount")) > 0)
        & F.col("currency").isin(currencies)
        & F.col("customer_id").isNotNull()
    )


def strict_split(df: DataFrame, currencies: list[str] = ref.STRICT_CURRENCIES) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid): exact complements, so a NULL currency is invalid."""
    valid = F.coalesce(strict_valid(currencies), F.lit(False))
    return df.filter(valid), df.filter(~valid)


def strict_reason(currencies: list[str] = ref.STRICT_CURRENCIES) -> Column:
    """First matching reason in fixed order."""
    return F.coalesce(
        F.when(money(F.col("amount")) <= 0, "Negative/zero amount"),
        F.when(~F.col("currency").isin(currencies), "Invalid currency"),
        F.when(F.col("customer_id").isNull(), "Missing customer_id"),
        F.lit("Other validation failure"),
    )
