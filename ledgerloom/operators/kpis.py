"""Time-series indicators.

The windows here run over already aggregated rows: one per day, week or month. Their
number is bounded by the calendar, not by the data, which is why a window without a
partition key is safe. Rolling means divide an exact decimal sum once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ledgerloom.functions.columns import mean_of, pct_change, ratio, trend_label
from ledgerloom.operators.gold import completed, fraud_count, row_count
from ledgerloom.operators.joins import with_date


def by_day() -> WindowSpec:
    return W.orderBy("date_key")


def by_month() -> WindowSpec:
    return W.orderBy("year", "month")


def rolling_mean(column: str, rows: int) -> Column:
    """Mean over the current row and the rows before it (rows, not calendar days)."""
    frame = by_day().rowsBetween(1 - rows, 0)
    return F.sum(column).over(frame).cast("double") / F.count(column).over(frame)


DAY_ATTRIBUTES = ["full_date", "year", "month", "week_of_year", "day_of_week", "is_weekend"]


def with_members(rows: DataFrame, keys: list[str], measures: list[Column], distinct: dict[str, str]) -> DataFrame:
    """Measures and distinct counts by group; `distinct` names the column counted, of which NULL is no member.

    Each kind of members is an aggregate of its own that moves keys and members only, once a task. One aggregate of all
    kinds would multiply every row by their number before the shuffle.
    """
    sums = rows.groupBy(*keys).agg(*measures)
    counts = [
        rows.select(*keys, member).distinct().groupBy(*keys).agg(F.count(member).alias(name)) for name, member in distinct.items()]
    # one row a group and kind; adding them needs no join, in which NULL groups would be lost
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [sums, *counts])
    shown = [c for c in sums.columns if c not in keys]
    return union.groupBy(*keys).agg(*[F.max(c).alias(c) for c in shown], *[F.sum(c).alias(c) for c in distinct])


def activity(fact: DataFrame, keys: list[str], **more: str) -> DataFrame:
    """Transactions by group, with distinct customers, merchants and the columns of `more`."""
    measures = [row_count().alias("transaction_count"), F.sum("amount_usd").alias("total_revenue"), mean_of("amount_usd").alias("avg_order_value")]
    return with_members(fact, keys, measures, {"active_customers": "customer_key", "active_merchants": "merchant_key"} | more)


def daily_base(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Completed transactions per day with the calendar attributes of the day."""
    return with_date(activity(completed(fact), ["date_key"]), dim_date, DAY_ATTRIBUTES)


def with_rolling(daily: DataFrame, rows: int) -> DataFrame:
    return daily.withColumns({
        f"revenue_{rows}d_avg": rolling_mean("total_revenue", rows),
        f"transactions_{rows}d_avg": rolling_mean("transaction_count", rows),
    })


def with_dod_change(daily: DataFrame) -> DataFrame:
    previous = F.lag("total_revenue", 1).over(by_day())
    return daily.withColumn("revenue_dod_change", pct_change(F.col("total_revenue"), previous))


def with_trend(daily: DataFrame) -> DataFrame:
    return daily.withColumn("revenue_trend", trend_label(F.col("revenue_dod_change")))


def daily_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return daily_series(daily_base(fact, dim_date))


def daily_series(daily: DataFrame) -> DataFrame:
    """Days with their rolling means, change and trend."""
    return with_trend(with_dod_change(with_rolling(with_rolling(daily, 7), 30)))


def measures_nb() -> list[Column]:
    return [
        row_count().alias("transaction_count"),
        F.sum("amount_usd").cast("decimal(18,2)").alias("total_revenue"),
        F.avg("amount_usd").cast("decimal(18,2)").alias("avg_order_value"),
        fraud_count().alias("fraud_count"),
    ]


def daily_kpis_nb(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    daily = with_members(fact, ["date_key"], measures_nb(), {"unique_customers": "customer_key", "unique_merchants": "merchant_key"})
    daily = daily.select(
        "date_key", "transaction_count", "total_revenue", "avg_order_value", "unique_customers", "unique_merchants", "fraud_count")
    dated = with_date(
        daily, dim_date, ["full_date", "year", "month", "day_of_week", "day_name", "is_weekend"]
    )
    return dated.withColumn(
        "revenue_per_customer", ratio(F.col("total_revenue"), F.col("unique_customers"), 2)
    )


def monthly_base(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    rows = with_date(completed(fact), dim_date, ["year", "month", "month_name"])
    return with_daily_rates(activity(rows, ["year", "month", "month_name"], active_days="date_key"))


def with_daily_rates(monthly: DataFrame) -> DataFrame:
    return monthly.withColumns({
        "revenue_per_day": ratio(F.col("total_revenue").cast("decimal(18,2)"), F.col("active_days"), 2),
        "transactions_per_day": F.round(F.try_divide("transaction_count", "active_days"), 2),
    })


def with_mom_change(monthly: DataFrame) -> DataFrame:
    previous = F.lag("total_revenue", 1).over(by_month())
    return monthly.withColumn("revenue_mom_change", pct_change(F.col("total_revenue"), previous))


def with_yoy_change(monthly: DataFrame) -> DataFrame:
    """Against the row twelve rows earlier, whatever month that is."""
    previous = F.lag("total_revenue", 12).over(by_month())
    return monthly.withColumn("revenue_yoy_change", pct_change(F.col("total_revenue"), previous))


def with_yoy_change_by_calendar(monthly: DataFrame) -> DataFrame:
    """Against the same month of the year before; NULL when that month is missing."""
    before = monthly.select(
        (F.col("year") + 1).alias("year"), "month", F.col("total_revenue").alias("_before")
    )
    joined = monthly.join(before, ["year", "month"], "left")
    change = pct_change(F.col("total_revenue"), F.col("_before"))
    return joined.withColumn("revenue_yoy_change", change).drop("_before")


def monthly_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return with_yoy_change(with_mom_change(monthly_base(fact, dim_date)))


def monthly_kpis_nb(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    rows = with_date(fact, dim_date, ["year", "month", "month_name"])
    distinct = {"unique_customers": "customer_key", "active_merchants": "merchant_key", "active_days": "date_key"}
    monthly = with_members(rows, ["year", "month", "month_name"], measures_nb(), distinct)
    monthly = monthly.select(
        "year", "month", "month_name", "transaction_count", "total_revenue", "avg_order_value", "unique_customers", "active_merchants",
        "fraud_count", "active_days")
    return monthly.withColumns({
        "revenue_per_customer": ratio(F.col("total_revenue"), F.col("unique_customers"), 2),
        "avg_daily_revenue": ratio(F.col("total_revenue"), F.col("active_days"), 2),
        "fraud_rate": ratio(F.col("fraud_count"), F.col("transaction_count"), 4),
    })


def weekly_kpis(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Completed transactions per ISO week. The ISO year is the year of the week's Thursday."""
    dates = dim_date.withColumn("iso_year", F.year(F.date_add("full_date", 4 - F.col("day_of_week"))))
    return activity(with_date(completed(fact), dates, ["iso_year", "week_of_year"]), ["iso_year", "week_of_year"])


def new_vs_returning(fact: DataFrame) -> DataFrame:
    """Customers per day, split by whether the day is their first.

    First days come from an aggregate, not a window over the customer, so a customer with
    a third of all rows is reduced before the shuffle.
    """
    first_days = fact.groupBy("customer_key").agg(F.min("date_key").alias("date_key"))
    new = first_days.filter(F.col("customer_key").isNotNull()).groupBy("date_key").agg(
        row_count().alias("new_customers")
    )
    active = fact.groupBy("date_key").agg(F.count_distinct("customer_key").alias("active_customers"))
    counts = active.join(new, "date_key", "left")
    fresh = F.coalesce("new_customers", F.lit(0))
    return counts.select(
        "date_key", "active_customers", fresh.alias("new_customers"),
        (F.col("active_customers") - fresh).alias("returning_customers"),
    )


def channel_share(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Share of each channel in the revenue of its month. The window sees one row per
    month and channel."""
    rows = with_date(fact, dim_date, ["year", "month"])
    per_channel = rows.groupBy("year", "month", "channel").agg(F.sum("amount_usd").alias("total_revenue_usd"))
    total = F.sum("total_revenue_usd").over(W.partitionBy("year", "month"))
    return per_channel.withColumn(
        "revenue_share", F.col("total_revenue_usd").cast("double") / total.cast("double")
    )


def executive_summary(fact: DataFrame, report_date: Column | None = None, days: int = 30) -> DataFrame:
    """One row: the days up to the newest transaction against the same span before it.

    One conditional aggregate; the newest moment is a scalar subquery and also bounds the
    scan. The row at exactly `newest - days` belongs to the current period.
    """
    newest = fact.select(F.max("transaction_timestamp")).scalar()
    current_start = newest - F.make_dt_interval(F.lit(days))
    prior_start = newest - F.make_dt_interval(F.lit(2 * days))
    ts = F.col("transaction_timestamp")
    recent = completed(fact).filter(ts >= prior_start).withColumn("_current", ts >= current_start)

    def pair(name: str, aggregate) -> list[Column]:
        return [
            aggregate(F.col("_current")).alias(f"current_{name}"),
            aggregate(~F.col("_current")).alias(f"prior_{name}"),
        ]

    stats = recent.agg(
        *pair("n", lambda when: F.count(F.when(when, 1))),
        *pair("revenue", lambda when: F.coalesce(F.sum(F.when(when, F.col("amount_usd"))), F.lit(0))),
        *pair("customers", lambda when: F.count_distinct(F.when(when, F.col("customer_key")))),
    )
    for period in ("current", "prior"):
        mean = F.try_divide(F.col(f"{period}_revenue").cast("double"), F.col(f"{period}_n"))
        stats = stats.withColumn(f"{period}_aov", F.coalesce(mean, F.lit(0.0)))

    def change(name: str) -> Column:
        return pct_change(F.col(f"current_{name}"), F.col(f"prior_{name}"))

    summary = stats.select(
        (report_date if report_date is not None else F.current_date()).alias("report_date"),
        F.to_date(current_start).alias("period_start"),
        F.to_date(newest).alias("period_end"),
        F.col("current_revenue").cast("double").alias("total_revenue"),
        change("revenue").alias("revenue_change_pct"),
        F.col("current_n").alias("total_transactions"),
        change("n").alias("transactions_change_pct"),
        F.col("current_aov").alias("avg_order_value"),
        change("aov").alias("aov_change_pct"),
        F.col("current_customers").alias("active_customers"),
        change("customers").alias("customers_change_pct"),
    )
    return summary.filter(F.col("period_end").isNotNull())
