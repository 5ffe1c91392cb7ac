"""Analytics tables from one day-grain rollup of the fact.

The rollup has a row for each day, channel, type, status, country, customer and merchant, with sums that add up. It is at once
the exact distinct sets of customers and merchants of every coarser group: a set's members are rows, so sets of any size merge by
plain aggregation, spread over the cluster. Distinct counts are made of it in two steps, first (group, member), then
group; several kinds of members are several such aggregates whose results are added, where Spark's own plan would multiply every
row by the number of kinds before the shuffle. Only keys and members move for them: sums are added up in each task first, which leaves
little of them, because a task reads whole months.

Each function gives the rows of the one of the same name in `gold` or `kpis`, from rollup rows instead of facts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import pct
from ledgerloom.operators.joins import DATE_ATTRIBUTES, with_date

GROUP = ["date_key", "channel", "transaction_type", "status", "country_code"]
MONEY = "decimal(28,2)"


#: parts into which the members of a month are dealt
PARTS = 16


def pairs(fact: DataFrame) -> DataFrame:
    """The rollup with `month_key`: one scan of the fact, one shuffle that deals facts by month and part of the members.

    The same exchange serves the aggregate and a layout by month, so no row moves again for its file.
    """
    part = F.pmod(F.xxhash64("customer_key", "merchant_key"), F.lit(PARTS)).alias("part")
    used = fact.select(month_of_day().alias("month_key"), part, *GROUP, "customer_key", "merchant_key", "amount_usd", "transaction_timestamp")
    return used.repartition("month_key", "part").groupBy("month_key", "part", *GROUP, "customer_key", "merchant_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("amount_usd").alias("n_amount"),
        F.sum("amount_usd").cast(MONEY).alias("amount"),
        F.min("amount_usd").alias("least"),
        F.max("amount_usd").alias("most"),
        F.min("transaction_timestamp").alias("first_at"),
        F.max("transaction_timestamp").alias("last_at"),
        F.expr("bit_or(shiftleft(1, month(transaction_timestamp)))").alias("months"),
    ).select(*GROUP, "customer_key", "merchant_key", *ADDED, "month_key")


#: how a measure of rollup rows is added up, over rows and over the results of that
ADDED = {
    "n": lambda c: F.sum(c),
    "n_amount": lambda c: F.sum(c),
    "amount": lambda c: F.sum(c).cast(MONEY),
    "least": lambda c: F.min(c),
    "most": lambda c: F.max(c),
    "first_at": lambda c: F.min(c),
    "last_at": lambda c: F.max(c),
    "months": lambda c: F.bit_or(c),
}


def grouped(rows: DataFrame, keys: list[str], measures: list[str], distinct: dict[str, str], many: bool = False) -> DataFrame:
    """Measures and distinct counts by group; `distinct` names the column counted. NULL is no member, but a group like any other.

    With `many`, groups of few rows each, which a task cannot add up, the first kind of members carries the measures along.
    """
    sums = [ADDED[m](m).alias(m) for m in measures]
    parts = [] if many else [rows.groupBy(*keys).agg(*sums)]
    for i, (name, member) in enumerate(distinct.items()):
        carried = sums if many and i == 0 else []
        by_member = rows.groupBy(*keys, member).agg(*carried) if carried else rows.select(*keys, member).distinct()
        parts.append(by_member.groupBy(*keys).agg(F.count(member).alias(name), *carried))
    if len(parts) == 1:
        return parts[0]
    # one row a group and kind; adding them needs no join, in which NULL groups would be lost
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in distinct], *[F.max(m).alias(m) for m in measures])


def mean() -> Column:
    return F.col("amount").cast("double") / F.when(F.col("n_amount") > 0, F.col("n_amount"))


def completed(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("status") == "COMPLETED")


def _of_status(status: str) -> Column:
    """All rows of a group that has one status, or none of them."""
    return F.when(F.col("status") == status, F.col("transaction_count")).otherwise(F.lit(0))


def revenue_summary(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    sums = grouped(rows, GROUP, ["n", "n_amount", "amount", "least", "most"], {"unique_customers": "customer_key", "unique_merchants": "merchant_key"})
    summary = sums.select(
        *GROUP, F.col("n").alias("transaction_count"), F.col("amount").alias("total_revenue_usd"), mean().alias("avg_transaction_value"),
        F.col("least").alias("min_transaction_value"), F.col("most").alias("max_transaction_value"), "unique_customers", "unique_merchants",
    ).withColumns({f"{s.lower()}_count": _of_status(s) for s in ("COMPLETED", "FAILED", "REFUNDED")})
    return with_date(summary, dim_date, DATE_ATTRIBUTES)


def months_of(dim_date: DataFrame) -> DataFrame:
    """(month_key, year, quarter, month, month_name) of the calendar's months."""
    key = (F.col("year") * 100 + F.col("month")).alias("month_key")
    return dim_date.select(key, "year", "quarter", "month", "month_name").distinct()


def with_month(rows: DataFrame, dim_date: DataFrame, attributes: list[str]) -> DataFrame:
    """Left join to the calendar's months, twelve a year."""
    return rows.join(F.broadcast(months_of(dim_date).select("month_key", *attributes)), "month_key", "left")


def month_of_day() -> Column:
    return F.floor(F.col("date_key") / 100).cast("int")


def channel_performance(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    by_status = [F.sum(F.when(F.col("status") == s, F.col("n")).otherwise(F.lit(0))) for s in ("COMPLETED", "FAILED")]
    rows = rows.withColumn("month_key", month_of_day())
    sums = grouped(rows, ["month_key", "channel"], ["n", "n_amount", "amount"], {"unique_customers": "customer_key"})
    states = rows.groupBy("month_key", "channel").agg(by_status[0].alias("completed_count"), by_status[1].alias("failed_count"))
    same = sums["month_key"].eqNullSafe(states["month_key"]) & sums["channel"].eqNullSafe(states["channel"])
    # twelve rows a year and channel
    both = sums.join(F.broadcast(states), same).select(sums["*"], "completed_count", "failed_count")
    perf = with_month(both, dim_date, ["year", "month", "month_name"]).select(
        "month_key", "year", "month", "month_name", "channel", F.col("n").alias("transaction_count"), F.col("amount").alias("total_revenue_usd"),
        mean().alias("avg_transaction_value"), "unique_customers", "completed_count", "failed_count")
    return perf.withColumn("success_rate", F.round(pct(F.col("completed_count"), F.col("transaction_count")), 2))


def geographic_summary(rows: DataFrame, dim_date: DataFrame) -> DataFrame:
    """`quarter_key` is the first month of the quarter."""
    month = month_of_day()
    first = (month - (month - 1) % 100 % 3).cast("int")
    sums = grouped(
        rows.withColumn("quarter_key", first), ["quarter_key", "country_code"], ["n", "n_amount", "amount"],
        {"unique_customers": "customer_key", "unique_merchants": "merchant_key"})
    dated = with_month(sums.withColumn("month_key", F.col("quarter_key")), dim_date, ["year", "quarter"])
    return dated.select(
        "quarter_key", "year", "quarter", "country_code", F.col("n").alias("transaction_count"), F.col("amount").alias("total_revenue_usd"),
        mean().alias("avg_transaction_value"), "unique_customers", "unique_merchants")


def activity(rows: DataFrame, keys: list[str]) -> DataFrame:
    sums = grouped(rows, keys, ["n", "n_amount", "amount"], {"active_customers": "customer_key", "active_merchants": "merchant_key"})
    return sums.select(
        *keys, F.col("n").alias("transaction_count"), F.col("amount").alias("total_revenue"), mean().alias("avg_order_value"),
        "active_customers", "active_merchants")


def daily_base(rows: DataFrame) -> DataFrame:
    """Completed transactions per day, without the calendar."""
    return activity(completed(rows), ["date_key"])


def monthly_base(rows: DataFrame) -> DataFrame:
    """Completed transactions per month and its active days, without the calendar."""
    done = completed(rows).withColumn("month_key", month_of_day())
    days = done.groupBy("month_key").agg(F.count_distinct("date_key").alias("active_days"))
    monthly = activity(done, ["month_key"])
    return monthly.join(F.broadcast(days), monthly["month_key"].eqNullSafe(days["month_key"])).select(monthly["*"], "active_days")


def customer_stats(rows: DataFrame) -> DataFrame:
    """Statistics of completed transactions with the channel most used in all, per customer that completed any."""
    sums = grouped(
        completed(rows), ["customer_key"], ["n", "n_amount", "amount", "first_at", "last_at", "months"],
        {"unique_merchants_visited": "merchant_key"}, many=True)
    uses = rows.groupBy("customer_key", "channel").agg(F.sum("n").alias("n"))
    preferred = uses.groupBy("customer_key").agg(
        F.min_by("channel", F.struct((-F.col("n")).alias("n"), F.col("channel").alias("c"))).alias("preferred_channel"))
    stats = sums.select(
        "customer_key", F.col("n").alias("total_transactions"), F.col("amount").alias("lifetime_value_usd"), mean().alias("avg_transaction_value"),
        F.col("first_at").alias("first_transaction_date"), F.col("last_at").alias("last_transaction_date"), "unique_merchants_visited",
        F.coalesce(F.bit_count("months"), F.lit(0)).cast("long").alias("active_months"))
    return stats.join(preferred, "customer_key", "left")


def merchant_stats(rows: DataFrame) -> DataFrame:
    sums = grouped(completed(rows), ["merchant_key"], ["n", "n_amount", "amount", "first_at", "last_at"], {"unique_customers": "customer_key"})
    return sums.select(
        "merchant_key", F.col("n").alias("total_transactions"), F.col("amount").alias("total_revenue_usd"), mean().alias("avg_transaction_value"),
        "unique_customers", F.col("first_at").alias("first_transaction_date"), F.col("last_at").alias("last_transaction_date"))
