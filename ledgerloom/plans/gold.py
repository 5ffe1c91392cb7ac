"""Builders of the gold layer: tables by name, and their upkeep as the fact changes.

`analytics_tables` and `kpi_tables` compute each table from the fact. `refresh` keeps all eight up to date from one rollup: the
fact's entries tell which months have other files than last time; those months' rollup rows are made anew, and of the tables
only the months, quarters, customers and merchants that they touch. What is not touched keeps its files.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import gold, kpis, rollup
from ledgerloom.operators.joins import with_date
from ledgerloom.session import together
from ledgerloom.sources import versions
from ledgerloom.sources.sinks import overwrite, overwrite_partitions

PAIRS, SEEN, DAYS, MONTHS, CUSTOMERS, MERCHANTS = "pairs", "seen", "days", "months", "customers", "merchants"
TABLES = (
    "revenue_summary", "customer_analytics", "merchant_analytics", "channel_performance", "geographic_summary",
    "daily_kpis", "monthly_kpis", "executive_summary",
)
#: days of both periods of the executive summary, and one more because they end inside a day
SUMMARY_DAYS = 61


def analytics_tables(
    fact: DataFrame, dim_customer: DataFrame, dim_merchant: DataFrame, dim_date: DataFrame,
    as_of: Column | None = None,
) -> dict[str, DataFrame]:
    return {
        "revenue_summary": gold.revenue_summary(fact, dim_date),
        "customer_analytics": gold.customer_analytics(fact, dim_customer, as_of),
        "merchant_analytics": gold.merchant_analytics(fact, dim_merchant),
        "channel_performance": gold.channel_performance(fact, dim_date),
        "geographic_summary": gold.geographic_summary(fact, dim_date),
    }


def kpi_tables(fact: DataFrame, dim_date: DataFrame, report_date: Column | None = None) -> dict[str, DataFrame]:
    return {
        "daily_kpis": kpis.daily_kpis(fact, dim_date),
        "monthly_kpis": kpis.monthly_kpis(fact, dim_date),
        "executive_summary": kpis.executive_summary(fact, report_date),
    }


def stamped(table: DataFrame, at: Column | None = None) -> DataFrame:
    return table.withColumn("_created_timestamp", at if at is not None else F.current_timestamp())


def write_all(tables: dict[str, DataFrame], root: str, at: Column | None = None) -> dict[str, int]:
    """Overwrite each table below the root, and of the executive summary, which grows by a day, only
    the report's own day: a rerun replaces its row. Counts come from the write itself. Every table says
    when it was made."""
    counts = {}
    for name, table in tables.items():
        if name == "executive_summary":
            counts[name] = overwrite_partitions(table.sparkSession, stamped(table, at), f"{root}/{name}", ["report_date"])
        else:
            counts[name] = overwrite(stamped(table, at), f"{root}/{name}")
    return counts


def _month(part: str = "part_month_key") -> Column:
    """Month of an entry; of facts without a day -1."""
    return F.coalesce(F.col(part).cast("int"), F.lit(-1))


def touched_months(spark: SparkSession, fact_at: versions.Version, known: versions.Version | None, table: str) -> list[int]:
    """Months of which the fact has other files than when `known` was made: at most twelve a year."""
    now = versions.entries(spark, fact_at, table).select("file", _month().alias("month"))
    if known is None or SEEN not in known.tables:
        return sorted(r.month for r in now.select("month").distinct().collect())
    seen = versions.read(spark, known, SEEN)
    apart = now.join(seen, "file", "left_anti").unionByName(seen.join(now, "file", "left_anti"))
    return sorted(r.month for r in apart.select("month").distinct().collect())


def _months(months: list[int], part: str = "part_month_key") -> Callable[[DataFrame], DataFrame]:
    return lambda listed: listed.filter(_month(part).isin(months))


def _but_months(months: list[int], part: str = "part_month_key") -> Callable[[DataFrame], DataFrame]:
    return lambda listed: listed.filter(~_month(part).isin(months))


def _quarters(months: list[int]) -> list[int]:
    return sorted({m - (m - 1) % 100 % 3 if m > 0 else m for m in months})


def _month_list(quarters: list[int]) -> list[int]:
    return [m + k if m > 0 else m for m in quarters for k in range(3 if m > 0 else 1)]


def _keyed(
    spark: SparkSession, at: versions.Version, name: str, key: str, stats: Callable[[DataFrame], DataFrame], gone: DataFrame | None, first: bool,
) -> versions.Change:
    """Statistics per key: of the keys whose pairs changed, made anew from all their pairs; files of other keys stay."""
    rows = versions.read(spark, at, PAIRS)
    if first or name not in at.tables:
        made = stats(rows)
        return versions.Change(made.repartitionByRange(key).sortWithinPartitions(key), zones=(key,))
    hit = versions.touched_files(spark, at, gone, [key], name).select("file")
    # the row without a key is in no zone
    unnamed = versions.read(spark, at, name, named="file").filter(F.col(key).isNull()).select("file")
    files = {r.file for r in hit.union(unnamed).distinct().collect()}
    listed = lambda e: e.filter(F.col("file").isin(list(files)))
    same = F.col(f"r.{key}").eqNullSafe(F.col(f"g.{key}"))
    stay = versions.read(spark, at, name, listed).alias("r").join(gone.alias("g"), same, "left_anti") if files else None
    made = stats(rows.alias("r").join(gone.alias("g"), same, "left_semi"))
    both = made if stay is None else stay.unionByName(made)
    return versions.Change(
        both.repartitionByRange(key).sortWithinPartitions(key), lambda e: e.filter(~F.col("file").isin(list(files))) if files else e, zones=(key,))


def refresh(
    spark: SparkSession, fact_table: str, dim_customer: DataFrame, dim_merchant: DataFrame, dim_date: DataFrame, root: str,
    as_of: Column | None = None, at: Column | None = None,
) -> dict[str, int]:
    """Bring the eight tables below `root` up to date with a fact with commits; rows by table.

    The first time everything is made, later what changed. The calendar has to cover the fact's days. A run that died
    is run again: the months seen are entered last, in the commit of what was made of them. Labels that depend on the
    newest day are made for every customer, from the statistics; these are recomputed for touched customers only.
    """
    store, table = versions.resolve(spark, fact_table)
    fact_at = versions.version(spark, store)
    base = f"{root}/rollup"
    known = versions.version(spark, base)
    months = touched_months(spark, fact_at, known, table)
    if months:
        _roll_up(spark, fact_at, table, base, known, months, root, dim_date, at)
    now = versions.version(spark, base)
    if now is None:
        return {}
    listed = versions.entries(spark, fact_at, table)
    newest = listed.select(F.max("high_transaction_timestamp")).scalar()
    day = as_of if as_of is not None else F.to_date(newest)
    # files are left out by their zones, which hold the very column that the periods are cut by
    recent = versions.read(spark, fact_at, table, lambda e: e.filter(
        F.col("high_transaction_timestamp") >= newest - F.make_dt_interval(F.lit(SUMMARY_DAYS))))
    series = kpis.daily_series(with_date(versions.read(spark, now, DAYS).drop("month_key"), dim_date, kpis.DAY_ATTRIBUTES))
    monthly = rollup.with_month(versions.read(spark, now, MONTHS), dim_date, ["year", "month", "month_name"]).drop("month_key")
    whole = {
        "customer_analytics": gold.customer_labels(versions.read(spark, now, CUSTOMERS), dim_customer, day),
        "merchant_analytics": gold.merchant_labels(versions.read(spark, now, MERCHANTS), dim_merchant),
        "daily_kpis": series,
        "monthly_kpis": kpis.with_yoy_change(kpis.with_mom_change(kpis.with_daily_rates(monthly))),
    }
    summary = stamped(kpis.executive_summary(recent, as_of), at)
    report = {versions.MAIN: versions.Change(summary, partition_by=("report_date",), replace="report_date")}
    steps = {name: partial(versions.overwrite, spark, f"{root}/{name}", stamped(rows, at)) for name, rows in whole.items()}
    counts = together(steps | {"executive_summary": lambda: versions.publish(spark, f"{root}/executive_summary", report)[1][versions.MAIN]})
    for name in ("revenue_summary", "channel_performance", "geographic_summary"):
        counts[name] = versions.version(spark, f"{root}/{name}").tables[versions.MAIN].rows
    return counts


def _roll_up(
    spark: SparkSession, fact_at: versions.Version, table: str, base: str, known: versions.Version | None, months: list[int],
    root: str, dim_date: DataFrame, at: Column | None,
) -> None:
    """Make the rollup of some months anew, and of the tables what follows from it."""
    first = known is None or SEEN not in known.tables
    fresh = rollup.pairs(versions.read(spark, fact_at, table, _months(months)))
    # the one scan of the fact; what was there before tells which keys lose something
    before = None if first else versions.read(spark, known, PAIRS, _months(months))
    pairs_at, _ = versions.publish(spark, base, {
        PAIRS: versions.Change(fresh, None if first else _but_months(months), ("month_key",), ("date_key",), rebalance=False)})
    of_months = versions.read(spark, pairs_at, PAIRS, _months(months))
    quarters = _quarters(months)
    of_quarters = of_months if first else versions.read(spark, pairs_at, PAIRS, _months(_month_list(quarters)))

    def keys(name: str) -> DataFrame | None:
        return None if first else before.select(name).unionByName(of_months.select(name)).distinct()

    stay = None if first else _but_months(months)

    def beside(store: str, name: str, rows: DataFrame, part: str, groups: list[int]) -> versions.Change:
        """Rows of some groups beside those that a small table has of the others, in one file: it has a few rows a month."""
        old = None if first else versions.version(spark, store)
        if old is not None and name in old.tables:
            rows = versions.read(spark, old, name).filter(~F.coalesce(part, F.lit(-1)).isin(groups)).unionByName(rows)
        return versions.Change(rows.coalesce(1))

    revenue = rollup.revenue_summary(of_months, dim_date).withColumn("month_key", rollup.month_of_day())
    small = {
        "channel_performance": (rollup.channel_performance(of_months, dim_date), "month_key", months),
        "geographic_summary": (rollup.geographic_summary(of_quarters, dim_date), "quarter_key", quarters),
    }
    steps = {name: partial(versions.publish, spark, f"{root}/{name}", {
        versions.MAIN: beside(f"{root}/{name}", versions.MAIN, stamped(rows, at), part, groups)}) for name, (rows, part, groups) in small.items()}
    together(steps | {"revenue_summary": partial(versions.publish, spark, f"{root}/revenue_summary", {
        versions.MAIN: versions.Change(stamped(revenue, at), stay, ("month_key",))})})
    seen = versions.entries(spark, fact_at, table).select("file", _month().alias("month"))
    versions.publish(spark, base, {
        DAYS: beside(base, DAYS, rollup.daily_base(of_months).withColumn("month_key", rollup.month_of_day()), "month_key", months),
        MONTHS: beside(base, MONTHS, rollup.monthly_base(of_months), "month_key", months),
        CUSTOMERS: _keyed(spark, pairs_at, CUSTOMERS, "customer_key", rollup.customer_stats, keys("customer_key"), first),
        MERCHANTS: _keyed(spark, pairs_at, MERCHANTS, "merchant_key", rollup.merchant_stats, keys("merchant_key"), first),
        SEEN: versions.Change(seen.coalesce(1)),
    }, base=pairs_at)
