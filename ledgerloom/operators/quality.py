"""Data-quality checks.

A check is a description, not a job. All checks on a table run as one aggregate; a
uniqueness check runs as a second, id-only aggregate (its shuffle carries the id and a
count, not every counter of the suite); a reference check is an anti join of the
pre-counted keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import reference_data as ref
from ledgerloom.functions.columns import count_if, mean_of, pct
from ledgerloom.operators.joins import orphan_counts


@dataclass(frozen=True)
class Check:
    """A named condition on rows, with the tolerated share in percent."""

    name: str
    failing: Column | None = None
    threshold_pct: float = 0.0
    severity: str = "error"
    unique_on: list[str] = field(default_factory=list)
    reference: tuple[str, DataFrame, str] | None = None


def not_null(column: str, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    return Check(f"not_null_{column}", F.col(column).isNull(), threshold_pct, severity)


def unique(column: str, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    """Surplus rows among the non-NULL ones."""
    return Check(f"unique_{column}", None, threshold_pct, severity, unique_on=[column])


def no_duplicates(columns: list[str], threshold_pct: float = 0.0, severity: str = "error") -> Check:
    """Surplus rows over a list of columns, NULL being a value like any other."""
    return Check("duplicates_" + "_".join(columns), None, threshold_pct, severity, unique_on=columns)


def in_set(column: str, allowed: list, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    return Check(f"in_set_{column}", ~F.col(column).isin(allowed), threshold_pct, severity)


def positive(column: str, allow_zero: bool = True, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    value = F.col(column).try_cast("double")
    return Check(f"positive_{column}", value < 0 if allow_zero else value <= 0, threshold_pct, severity)


def in_range(column: str, low, high, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    value = F.col(column).try_cast("double")
    return Check(f"range_{column}", ~value.between(low, high), threshold_pct, severity)


def date_format(column: str, fmt: str = ref.DATE_FORMAT, threshold_pct: float = 0.0, severity: str = "error") -> Check:
    bad = F.col(column).isNotNull() & F.try_to_date(F.col(column), fmt).isNull()
    return Check(f"date_format_{column}", bad, threshold_pct, severity)


def ref_integrity(
    column: str, reference: DataFrame, reference_column: str, threshold_pct: float = 0.0, severity: str = "error"
) -> Check:
    """Non-NULL keys without a partner, among all rows."""
    return Check(f"ref_integrity_{column}", None, threshold_pct, severity,
                 reference=(column, reference, reference_column))


def _result(check: Check, failed: Column, of_rows: Column) -> Column:
    share = pct(failed, of_rows)
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.severity).alias("severity"),
        of_rows.cast("long").alias("checked_rows"),
        failed.cast("long").alias("failed_rows"),
        F.round(share, 2).alias("actual_pct"),
        F.lit(float(check.threshold_pct)).alias("threshold_pct"),
        (share <= check.threshold_pct).alias("passed"),
    )


def _surplus(df: DataFrame, check: Check) -> DataFrame:
    rows = df.select(check.unique_on)
    if len(check.unique_on) == 1:
        rows = rows.filter(F.col(check.unique_on[0]).isNotNull())
    groups = rows.groupBy(check.unique_on).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("failed"),
    )


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: checked and failed rows, share, threshold, verdict."""
    results = []
    on_rows = [c for c in checks if c.failing is not None]
    if on_rows:
        counts = df.agg(
            F.count(F.lit(1)).alias("rows"),
            *[count_if(c.failing).alias(f"f{i}") for i, c in enumerate(on_rows)],
        )
        structs = [_result(c, F.col(f"f{i}"), F.col("rows")) for i, c in enumerate(on_rows)]
        results.append(counts.select(F.inline(F.array(*structs))))
    for check in checks:
        if check.unique_on:
            results.append(_surplus(df, check).select(
                F.inline(F.array(_result(check, F.col("failed"), F.col("rows"))))))
        elif check.reference is not None:
            column, reference, reference_column = check.reference
            counted = orphan_counts(df.select(column), column, reference, reference_column, include_null=False)
            results.append(counted.select(
                F.inline(F.array(_result(check, F.col("orphan_rows"), F.col("total_rows"))))))
    report = results[0]
    for one in results[1:]:
        report = report.unionByName(one)
    return report


def transaction_suite() -> list[Check]:
    """The ten standard checks on raw transactions."""
    return [
        not_null("transaction_id"),
        unique("transaction_id"),
        not_null("customer_id", threshold_pct=1.0, severity="warning"),
        not_null("amount"),
        positive("amount", allow_zero=False),
        in_set("currency", ref.CURRENCIES, threshold_pct=1.0),
        in_set("status", ref.STATUSES, threshold_pct=0.5),
        in_set("transaction_type", ref.TRANSACTION_TYPES, threshold_pct=0.5),
        in_set("channel", ref.CHANNELS, threshold_pct=0.5),
        date_format("transaction_date", threshold_pct=1.0),
    ]


def report_summary(results: DataFrame) -> DataFrame:
    """One row: the report passes when no error-level check fails."""
    ok = F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("check_count"),
        count_if(ok).alias("passed_count"),
        count_if(~ok).alias("failed_count"),
        count_if(~ok & (F.col("severity") == "error")).alias("failed_errors"),
        (count_if(~ok & (F.col("severity") == "error")) == 0).alias("passed"),
    )


def threshold_gate(results: DataFrame, environment: str) -> DataFrame:
    """Not-null and uniqueness shares against the limits of an environment.

    `breach` marks a share above its limit, `blocks` a breach that must stop the run.
    """
    limits = ref.QUALITY_GATES[environment]
    limit = F.when(F.col("check_name").startswith("not_null_"), F.lit(limits["null_pct"])).when(
        F.col("check_name").startswith("unique_"), F.lit(limits["duplicate_pct"])
    )
    share = pct(F.col("failed_rows"), F.col("checked_rows"))
    return results.filter(limit.isNotNull()).select(
        F.lit(environment).alias("environment"),
        "check_name",
        "actual_pct",
        limit.alias("limit_pct"),
        (share > limit).alias("breach"),
        ((share > limit) & F.lit(limits["fail"])).alias("blocks"),
    )


class QualityGateError(Exception):
    """A run was stopped by a quality gate."""


def enforce_gate(gate: DataFrame) -> None:
    """Raise when a gate row blocks. Reads at most one small row per check."""
    blocked = [row.check_name for row in gate.filter("blocks").select("check_name").collect()]
    if blocked:
        raise QualityGateError("quality thresholds breached: " + ", ".join(sorted(blocked)))


def amount_profile(df: DataFrame, column: str = "amount") -> DataFrame:
    """Count, range, mean and sample standard deviation of the parseable amounts."""
    value = F.col(column).try_cast("decimal(18,2)")
    return df.agg(
        F.count(value).alias("n"),
        F.min(value).alias("min_amount"),
        F.max(value).alias("max_amount"),
        mean_of(value).alias("avg_amount"),
        F.stddev_samp(value).alias("stddev_amount"),
    )


def value_distribution(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each column, one scan by grouping sets."""
    cols = [F.col(c) for c in columns]
    counts = df.groupingSets([[c] for c in cols], *cols).agg(
        *[F.grouping(c).alias(f"_g_{name}") for name, c in zip(columns, cols)],
        F.count(F.lit(1)).alias("n"),
    )
    name = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.lit(c)) for c in columns])
    value = F.coalesce(*[F.when(F.col(f"_g_{c}") == 0, F.col(c)) for c in columns])
    return counts.select(name.alias("column_name"), value.alias("value"), "n")
