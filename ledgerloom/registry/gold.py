"""Registered queries: joins, aggregates, windows and reports over the fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import facts, gold, joins, kpis, reports
from ledgerloom.registry.base import query
from ledgerloom.registry.oracle import (
    AVG2, AVG_USD, CENTS, CUSTOMERS, FRAUDS, MERCHANTS, SEGMENT, SUM_USD, TIER,
    completed_count, dbl, half_up, pct_change, sql, ts,
)
from ledgerloom.sources import star

NEWEST = "(SELECT CAST(max(transaction_timestamp) AS DATE) FROM fact)"
SPAN = f"{ts('min(transaction_timestamp)')} AS first_transaction_date, {ts('max(transaction_timestamp)')} AS last_transaction_date"
RAW_SPAN = "min(transaction_timestamp) AS t1, max(transaction_timestamp) AS t2"
SHOWN_SPAN = f"{ts('t1')} AS first_transaction_date, {ts('t2')} AS last_transaction_date"


# --- joins -------------------------------------------------------------------------------


@query("join_left_fact_date", sql("""
SELECT transaction_id, f.date_key, year, month_name, day_name, CAST(amount_usd AS DOUBLE) AS amount_usd
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key""", "fact", "calendar"))
def join_left_fact_date(spark: SparkSession, d: str) -> DataFrame:
    rows = joins.with_date(star.fact(spark, d), star.calendar(spark), ["year", "month_name", "day_name"])
    return rows.select("transaction_id", "date_key", "year", "month_name", "day_name", "amount_usd")


@query("join_left_two_dims", sql("""
SELECT transaction_id, f.date_key, f.merchant_key, year, month, category AS merchant_category
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key LEFT JOIN merchants m ON f.merchant_key = m.merchant_key""",
    "fact", "calendar"))
def join_left_two_dims(spark: SparkSession, d: str) -> DataFrame:
    rows = joins.with_date_and_merchant(
        star.fact(spark, d), star.calendar(spark), star.dim_merchant_nb(spark, d), ["year", "month"], ["merchant_category"]
    )
    return rows.select("transaction_id", "date_key", "merchant_key", "year", "month", "merchant_category")


@query("join_left_agg_dim", sql(f"""
SELECT a.merchant_key, n, revenue, merchant_name, city
FROM (SELECT merchant_key, count(*) AS n, {SUM_USD} AS revenue FROM fact GROUP BY merchant_key) a
LEFT JOIN merchants m ON a.merchant_key = m.merchant_key""", "fact"))
def join_left_agg_dim(spark: SparkSession, d: str) -> DataFrame:
    per_merchant = star.fact(spark, d).groupBy("merchant_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_usd").alias("revenue")
    )
    return joins.with_dimension(per_merchant, star.merchants(spark, d), "merchant_key", ["merchant_name", "city"])


PREFERRED = """preferred AS (
  SELECT customer_key, channel AS preferred_channel FROM (
    SELECT customer_key, channel, row_number() OVER (PARTITION BY customer_key ORDER BY count(*) DESC, channel) AS rn
    FROM fact GROUP BY customer_key, channel) WHERE rn = 1)"""
CUSTOMER_STATS = f"""stats AS (
  SELECT customer_key, count(*) AS total_transactions, sum(amount_usd) AS lifetime_value_usd,
         {AVG_USD} AS avg_transaction_value, {RAW_SPAN}, {MERCHANTS} AS unique_merchants_visited,
         count(DISTINCT month(transaction_timestamp)) AS active_months
  FROM fact WHERE status = 'COMPLETED' GROUP BY customer_key)"""


@query("join_left_agg_agg", sql(f"""WITH {PREFERRED}, {CUSTOMER_STATS}
SELECT s.customer_key, total_transactions, CAST(lifetime_value_usd AS DOUBLE) AS lifetime_value_usd,
       avg_transaction_value, {SHOWN_SPAN}, unique_merchants_visited, active_months, preferred_channel
FROM stats s LEFT JOIN preferred p ON s.customer_key = p.customer_key""", "fact"))
def join_left_agg_agg(spark: SparkSession, d: str) -> DataFrame:
    return gold.stats_with_channel(star.fact(spark, d))


@query("join_left_account_customer", sql("""
SELECT account_id, a.customer_id, customer_key, opened_date
FROM accounts a LEFT JOIN customers c ON a.customer_id = c.customer_id""", "accounts", "customers"))
def join_left_account_customer(spark: SparkSession, d: str) -> DataFrame:
    rows = joins.accounts_with_customer(star.accounts(spark, d), star.customers(spark, d))
    return rows.select("account_id", "customer_id", "customer_key", "opened_date")


@query("join_anti_invalid", sql("""
SELECT transaction_id, amount FROM raw r
WHERE NOT EXISTS (SELECT 1 FROM rejected x WHERE x.transaction_id = r.transaction_id)""", "raw", "rejected"))
def join_anti_invalid(spark: SparkSession, d: str) -> DataFrame:
    from ledgerloom.operators import rules

    raw = star.raw_transactions(spark, d)
    _, rejected = rules.rule_split(raw)
    return joins.without_listed(raw, rejected, "transaction_id").select("transaction_id", "amount")


@query("join_anti_orphans", sql("""
SELECT transaction_id, customer_id, transaction_date FROM raw
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers)""", "raw", "customers"))
def join_anti_orphans(spark: SparkSession, d: str) -> DataFrame:
    raw = star.raw_transactions(spark, d).select("transaction_id", "customer_id", "transaction_date")
    return joins.orphan_rows(raw, "customer_id", star.customers(spark, d), "customer_id")


@query("join_left_null_orphans", sql("""
SELECT count(*) FILTER (WHERE c.customer_id IS NULL) AS orphan_rows,
       count(r.customer_id) AS keyed_rows, count(*) AS total_rows
FROM raw r LEFT JOIN customers c ON r.customer_id = c.customer_id""", "raw", "customers"))
def join_left_null_orphans(spark: SparkSession, d: str) -> DataFrame:
    return joins.orphan_counts(
        star.raw_transactions(spark, d), "customer_id", star.customers(spark, d), "customer_id", include_null=True
    )


# --- analytics tables ----------------------------------------------------------------------


@query("revenue_summary", sql(f"""
SELECT f.date_key, channel, transaction_type, status, country_code, count(*) AS transaction_count,
       {SUM_USD} AS total_revenue_usd, {AVG_USD} AS avg_transaction_value,
       {dbl('min(amount_usd)')} AS min_transaction_value, {dbl('max(amount_usd)')} AS max_transaction_value,
       {CUSTOMERS} AS unique_customers, {MERCHANTS} AS unique_merchants, {completed_count()} AS completed_count,
       {completed_count('FAILED')} AS failed_count, {completed_count('REFUNDED')} AS refunded_count,
       CAST(c.full_date AS VARCHAR) AS full_date, year, quarter, month, month_name, week_of_year, day_of_week,
       day_name, is_weekend
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key
GROUP BY f.date_key, c.full_date, year, quarter, month, month_name, week_of_year, day_of_week, day_name, is_weekend,
         channel, transaction_type, status, country_code""", "fact", "calendar"))
def revenue_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.revenue_summary(star.fact(spark, d), star.calendar(spark))


@query("revenue_summary_nb", sql(f"""
SELECT year, quarter, month, month_name, channel, category AS merchant_category, count(*) AS transaction_count,
       {SUM_USD} AS total_revenue_usd, {AVG2} AS avg_transaction_amount, {CUSTOMERS} AS unique_customers,
       count(DISTINCT f.merchant_key) AS unique_merchants, {FRAUDS} AS fraud_count
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key LEFT JOIN merchants m ON f.merchant_key = m.merchant_key
GROUP BY ALL""", "fact", "calendar"))
def revenue_summary_nb(spark: SparkSession, d: str) -> DataFrame:
    return gold.revenue_summary_nb(star.fact(spark, d), star.calendar(spark), star.dim_merchant_nb(spark, d))


@query("customer_analytics", sql(f"""WITH {PREFERRED}, {CUSTOMER_STATS}
SELECT s.customer_key, total_transactions, CAST(lifetime_value_usd AS DOUBLE) AS lifetime_value_usd,
       avg_transaction_value, {SHOWN_SPAN}, unique_merchants_visited, active_months, preferred_channel,
       customer_id, full_name, country_code, CAST(customer_since AS VARCHAR) AS customer_since,
       datediff('day', customer_since, {NEWEST}) AS days_as_customer,
       total_transactions / greatest(active_months, 1) AS avg_transactions_per_month,
       datediff('day', CAST(t2 AS DATE), {NEWEST}) AS days_since_last_transaction,
       {SEGMENT} AS customer_segment
FROM stats s LEFT JOIN preferred p ON s.customer_key = p.customer_key
     LEFT JOIN customers c ON s.customer_key = c.customer_key""", "fact", "customers"))
def customer_analytics(spark: SparkSession, d: str) -> DataFrame:
    return gold.customer_analytics(star.fact(spark, d), star.customers(spark, d))


CUSTOMER_NB = f"""nb AS (
  SELECT customer_key, count(*) AS total_transactions, sum(amount_usd) AS lifetime_value_usd,
         {AVG2} AS avg_transaction_amount, {RAW_SPAN}, {MERCHANTS} AS unique_merchants_visited, {FRAUDS} AS fraud_count
  FROM fact GROUP BY customer_key)"""


@query("customer_analytics_nb", sql(f"""WITH {CUSTOMER_NB}
SELECT s.customer_key, total_transactions, CAST(lifetime_value_usd AS DOUBLE) AS lifetime_value_usd,
       avg_transaction_amount, {SHOWN_SPAN}, unique_merchants_visited, fraud_count, customer_id, first_name, last_name,
       country_code, CAST(customer_since AS VARCHAR) AS customer_since, {SEGMENT} AS customer_segment,
       datediff('day', CAST(t1 AS DATE), {NEWEST}) AS days_since_first_transaction,
       datediff('day', CAST(t2 AS DATE), {NEWEST}) AS days_since_last_transaction
FROM nb s LEFT JOIN customers c ON s.customer_key = c.customer_key""", "fact", "customers"))
def customer_analytics_nb(spark: SparkSession, d: str) -> DataFrame:
    return gold.customer_analytics_nb(star.fact(spark, d), star.customers(spark, d))


@query("merchant_analytics", sql(f"""WITH stats AS (
  SELECT merchant_key, count(*) AS total_transactions, sum(amount_usd) AS total_revenue_usd,
         {AVG_USD} AS avg_transaction_value, {CUSTOMERS} AS unique_customers, {RAW_SPAN}
  FROM fact WHERE status = 'COMPLETED' GROUP BY merchant_key)
SELECT s.merchant_key, total_transactions, CAST(total_revenue_usd AS DOUBLE) AS total_revenue_usd,
       avg_transaction_value, unique_customers, {SHOWN_SPAN}, merchant_id, merchant_name, category, country_code, city,
       total_transactions / greatest(datediff('day', CAST(t1 AS DATE), CAST(t2 AS DATE)), 1) AS avg_daily_transactions,
       {TIER} AS merchant_tier
FROM stats s LEFT JOIN merchants m ON s.merchant_key = m.merchant_key""", "fact"))
def merchant_analytics(spark: SparkSession, d: str) -> DataFrame:
    return gold.merchant_analytics(star.fact(spark, d), star.merchants(spark, d))


@query("merchant_analytics_nb", sql(f"""WITH stats AS (
  SELECT merchant_key, count(*) AS total_transactions, sum(amount_usd) AS total_revenue_usd,
         {AVG2} AS avg_transaction_amount, {CUSTOMERS} AS unique_customers, {RAW_SPAN}, {FRAUDS} AS fraud_count
  FROM fact GROUP BY merchant_key)
SELECT s.merchant_key, total_transactions, CAST(total_revenue_usd AS DOUBLE) AS total_revenue_usd,
       avg_transaction_amount, unique_customers, {SHOWN_SPAN}, fraud_count, merchant_id, merchant_name,
       category AS merchant_category, city, country_code, {TIER} AS merchant_tier,
       {half_up('fraud_count', 'total_transactions', 4)} AS fraud_rate
FROM stats s LEFT JOIN merchants m ON s.merchant_key = m.merchant_key""", "fact"))
def merchant_analytics_nb(spark: SparkSession, d: str) -> DataFrame:
    return gold.merchant_analytics_nb(star.fact(spark, d), star.dim_merchant_nb(spark, d))


@query("channel_performance", sql(f"""
SELECT year, month, month_name, channel, count(*) AS transaction_count, {SUM_USD} AS total_revenue_usd,
       {AVG_USD} AS avg_transaction_value, {CUSTOMERS} AS unique_customers, {completed_count()} AS completed_count,
       {completed_count('FAILED')} AS failed_count,
       {half_up(completed_count() + ' * 100', 'count(*)', 2)} AS success_rate
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key
GROUP BY year, month, month_name, channel""", "fact", "calendar"))
def channel_performance(spark: SparkSession, d: str) -> DataFrame:
    return gold.channel_performance(star.fact(spark, d), star.calendar(spark))


@query("channel_performance_nb", sql(f"""
SELECT year, month, channel, count(*) AS transaction_count, {SUM_USD} AS total_revenue_usd,
       {AVG2} AS avg_transaction_amount, {CUSTOMERS} AS unique_customers, {FRAUDS} AS fraud_count,
       {half_up(FRAUDS, 'count(*)', 4)} AS fraud_rate
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key GROUP BY year, month, channel""", "fact", "calendar"))
def channel_performance_nb(spark: SparkSession, d: str) -> DataFrame:
    return gold.channel_performance_nb(star.fact(spark, d), star.calendar(spark))


BREAKDOWN = (
    f"count(*) AS transaction_count, {SUM_USD} AS total_revenue_usd, {AVG_USD} AS avg_transaction_value, "
    f"{CUSTOMERS} AS unique_customers, {MERCHANTS} AS unique_merchants"
)


@query("geographic_summary", sql(f"""
SELECT year, quarter, country_code, {BREAKDOWN}
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key GROUP BY year, quarter, country_code""", "fact", "calendar"))
def geographic_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.geographic_summary(star.fact(spark, d), star.calendar(spark))


@query("geographic_by_region", sql(f"""
SELECT year, quarter, CASE WHEN country_code IN ('US', 'CA', 'MX') THEN 'North America'
       WHEN country_code IN ('GB', 'DE', 'FR', 'IT', 'ES') THEN 'Europe'
       WHEN country_code IN ('JP', 'CN', 'IN', 'AU') THEN 'Asia Pacific'
       WHEN country_code = 'BR' THEN 'South America' END AS region, {BREAKDOWN}
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key GROUP BY 1, 2, 3""", "fact", "calendar"))
def geographic_by_region(spark: SparkSession, d: str) -> DataFrame:
    return gold.geographic_by_region(star.fact(spark, d), star.calendar(spark))


@query("channel_country_analytics", sql(f"""
SELECT channel, country_code, {BREAKDOWN} FROM fact GROUP BY channel, country_code""", "fact"))
def channel_country_analytics(spark: SparkSession, d: str) -> DataFrame:
    return gold.channel_country_analytics(star.fact(spark, d))


@query("fiscal_period_summary", sql(f"""
SELECT fiscal_year, fiscal_quarter, {BREAKDOWN}
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key GROUP BY fiscal_year, fiscal_quarter""", "fact", "calendar"))
def fiscal_period_summary(spark: SparkSession, d: str) -> DataFrame:
    return gold.fiscal_period_summary(star.fact(spark, d), star.calendar(spark))


# --- indicators ------------------------------------------------------------------------------

ACTIVITY = (
    f"count(*) AS transaction_count, sum(amount_usd) AS total_revenue, {AVG_USD} AS avg_order_value, "
    f"{CUSTOMERS} AS active_customers, {MERCHANTS} AS active_merchants"
)
DAILY = f"""daily AS (
  SELECT b.*, CAST(c.full_date AS VARCHAR) AS full_date, year, month, week_of_year, day_of_week, is_weekend
  FROM (SELECT date_key, {ACTIVITY} FROM fact WHERE status = 'COMPLETED' GROUP BY date_key) b
  LEFT JOIN calendar c ON b.date_key = c.date_key)"""
DAILY_COLUMNS = (
    "date_key, transaction_count, CAST(total_revenue AS DOUBLE) AS total_revenue, avg_order_value, active_customers, "
    "active_merchants, full_date, year, month, week_of_year, day_of_week, is_weekend"
)


def _rolling(column: str, rows: int) -> str:
    frame = f"OVER (ORDER BY date_key ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(sum({column}) {frame} AS DOUBLE) / count({column}) {frame}"


ROLLING = {
    n: f"{_rolling('total_revenue', n)} AS revenue_{n}d_avg, {_rolling('transaction_count', n)} AS transactions_{n}d_avg"
    for n in (7, 30)
}
DOD = pct_change("total_revenue", "(lag(total_revenue) OVER (ORDER BY date_key))")
TREND = "CASE WHEN revenue_dod_change > 5 THEN 'up' WHEN revenue_dod_change < -5 THEN 'down' ELSE 'stable' END"


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return kpis.daily_base(star.fact(spark, d), star.calendar(spark))


@query("daily_kpis_base", sql(f"WITH {DAILY} SELECT {DAILY_COLUMNS} FROM daily", "fact", "calendar"))
def daily_kpis_base(spark: SparkSession, d: str) -> DataFrame:
    return _daily(spark, d)


@query("daily_kpis", sql(f"""WITH {DAILY}
SELECT *, {TREND} AS revenue_trend FROM (
  SELECT {DAILY_COLUMNS}, {ROLLING[7]}, {ROLLING[30]}, {DOD} AS revenue_dod_change FROM daily)""", "fact", "calendar"))
def daily_kpis(spark: SparkSession, d: str) -> DataFrame:
    return kpis.daily_kpis(star.fact(spark, d), star.calendar(spark))


@query("win_rolling_7", sql(f"WITH {DAILY} SELECT date_key, {ROLLING[7]} FROM daily", "fact", "calendar"))
def win_rolling_7(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_rolling(_daily(spark, d), 7).select("date_key", "revenue_7d_avg", "transactions_7d_avg")


@query("win_rolling_30", sql(f"WITH {DAILY} SELECT date_key, {ROLLING[30]} FROM daily", "fact", "calendar"))
def win_rolling_30(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_rolling(_daily(spark, d), 30).select("date_key", "revenue_30d_avg", "transactions_30d_avg")


@query("win_dod_change", sql(f"WITH {DAILY} SELECT date_key, {DOD} AS revenue_dod_change FROM daily", "fact", "calendar"))
def win_dod_change(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_dod_change(_daily(spark, d)).select("date_key", "revenue_dod_change")


@query("win_trend_label", sql(f"""WITH {DAILY}
SELECT revenue_trend, count(*) AS days FROM (
  SELECT {TREND} AS revenue_trend FROM (SELECT {DOD} AS revenue_dod_change FROM daily)) GROUP BY 1""", "fact", "calendar"))
def win_trend_label(spark: SparkSession, d: str) -> DataFrame:
    labelled = kpis.with_trend(kpis.with_dod_change(_daily(spark, d)))
    return labelled.groupBy("revenue_trend").agg(F.count(F.lit(1)).alias("days"))


@query("daily_kpis_nb", sql(f"""
SELECT b.*, CAST(c.full_date AS VARCHAR) AS full_date, year, month, day_of_week, day_name, is_weekend FROM (
  SELECT date_key, count(*) AS transaction_count, {SUM_USD} AS total_revenue, {AVG2} AS avg_order_value,
         {CUSTOMERS} AS unique_customers, {MERCHANTS} AS unique_merchants, {FRAUDS} AS fraud_count,
         {half_up(CENTS, f'{CUSTOMERS} * 100', 2)} AS revenue_per_customer
  FROM fact GROUP BY date_key) b LEFT JOIN calendar c ON b.date_key = c.date_key""", "fact", "calendar"))
def daily_kpis_nb(spark: SparkSession, d: str) -> DataFrame:
    return kpis.daily_kpis_nb(star.fact(spark, d), star.calendar(spark))


MONTHLY = f"""monthly AS (
  SELECT year, month, month_name, {ACTIVITY}, count(DISTINCT f.date_key) AS active_days,
         {half_up(CENTS, 'count(DISTINCT f.date_key) * 100', 2)} AS revenue_per_day,
         {half_up('count(*)', 'count(DISTINCT f.date_key)', 2)} AS transactions_per_day
  FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key WHERE status = 'COMPLETED'
  GROUP BY year, month, month_name)"""
MONTHLY_COLUMNS = (
    "year, month, month_name, transaction_count, CAST(total_revenue AS DOUBLE) AS total_revenue, avg_order_value, "
    "active_customers, active_merchants, active_days, revenue_per_day, transactions_per_day"
)
MOM = pct_change("total_revenue", "(lag(total_revenue) OVER (ORDER BY year, month))")
YOY = pct_change("total_revenue", "(lag(total_revenue, 12) OVER (ORDER BY year, month))")


def _monthly(spark: SparkSession, d: str) -> DataFrame:
    return kpis.monthly_base(star.fact(spark, d), star.calendar(spark))


@query("monthly_kpis_base", sql(f"WITH {MONTHLY} SELECT {MONTHLY_COLUMNS} FROM monthly", "fact", "calendar"))
def monthly_kpis_base(spark: SparkSession, d: str) -> DataFrame:
    return _monthly(spark, d)


@query("monthly_kpis", sql(f"""WITH {MONTHLY}
SELECT {MONTHLY_COLUMNS}, {MOM} AS revenue_mom_change, {YOY} AS revenue_yoy_change FROM monthly""", "fact", "calendar"))
def monthly_kpis(spark: SparkSession, d: str) -> DataFrame:
    return kpis.monthly_kpis(star.fact(spark, d), star.calendar(spark))


@query("win_mom_change", sql(f"WITH {MONTHLY} SELECT year, month, {MOM} AS revenue_mom_change FROM monthly", "fact", "calendar"))
def win_mom_change(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_mom_change(_monthly(spark, d)).select("year", "month", "revenue_mom_change")


@query("win_yoy_change", sql(f"WITH {MONTHLY} SELECT year, month, {YOY} AS revenue_yoy_change FROM monthly", "fact", "calendar"))
def win_yoy_change(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_yoy_change(_monthly(spark, d)).select("year", "month", "revenue_yoy_change")


@query("win_yoy_change_by_calendar", sql(f"""WITH {MONTHLY}
SELECT a.year, a.month, {pct_change('a.total_revenue', 'b.total_revenue')} AS revenue_yoy_change
FROM monthly a LEFT JOIN monthly b ON b.year = a.year - 1 AND b.month = a.month""", "fact", "calendar"))
def win_yoy_change_by_calendar(spark: SparkSession, d: str) -> DataFrame:
    return kpis.with_yoy_change_by_calendar(_monthly(spark, d)).select("year", "month", "revenue_yoy_change")


MONTHLY_NB = f"""monthly_nb AS (
  SELECT year, month, month_name, count(*) AS transaction_count, {SUM_USD} AS total_revenue, {AVG2} AS avg_order_value,
         {CUSTOMERS} AS unique_customers, {MERCHANTS} AS active_merchants, {FRAUDS} AS fraud_count,
         count(DISTINCT f.date_key) AS active_days, {half_up(CENTS, f'{CUSTOMERS} * 100', 2)} AS revenue_per_customer,
         {half_up(CENTS, 'count(DISTINCT f.date_key) * 100', 2)} AS avg_daily_revenue,
         {half_up(FRAUDS, 'count(*)', 4)} AS fraud_rate
  FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key GROUP BY year, month, month_name)"""


@query("monthly_kpis_nb", sql(f"WITH {MONTHLY_NB} SELECT * FROM monthly_nb", "fact", "calendar"))
def monthly_kpis_nb(spark: SparkSession, d: str) -> DataFrame:
    return kpis.monthly_kpis_nb(star.fact(spark, d), star.calendar(spark))


@query("weekly_kpis", sql(f"""
SELECT iso_year, week_of_year, {ACTIVITY.replace('sum(amount_usd) AS', 'CAST(sum(amount_usd) AS DOUBLE) AS')}
FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key
WHERE status = 'COMPLETED' GROUP BY iso_year, week_of_year""", "fact", "calendar"))
def weekly_kpis(spark: SparkSession, d: str) -> DataFrame:
    return kpis.weekly_kpis(star.fact(spark, d), star.calendar(spark))


@query("new_vs_returning", sql("""
SELECT date_key, count(DISTINCT customer_key) AS active_customers,
       count(DISTINCT customer_key) FILTER (WHERE date_key = first_day) AS new_customers,
       count(DISTINCT customer_key) FILTER (WHERE date_key > first_day) AS returning_customers
FROM (SELECT *, min(date_key) OVER (PARTITION BY customer_key) AS first_day FROM fact) GROUP BY date_key""", "fact"))
def new_vs_returning(spark: SparkSession, d: str) -> DataFrame:
    return kpis.new_vs_returning(star.fact(spark, d))


@query("channel_share", sql("""WITH m AS (
  SELECT year, month, channel, sum(amount_usd) AS r FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key
  GROUP BY year, month, channel)
SELECT year, month, channel, CAST(r AS DOUBLE) AS total_revenue_usd,
       CAST(r AS DOUBLE) / CAST(sum(r) OVER (PARTITION BY year, month) AS DOUBLE) AS revenue_share
FROM m""", "fact", "calendar"))
def channel_share(spark: SparkSession, d: str) -> DataFrame:
    return kpis.channel_share(star.fact(spark, d), star.calendar(spark))


@query("win_preferred_channel", sql(f"WITH {PREFERRED} SELECT * FROM preferred", "fact"))
def win_preferred_channel(spark: SparkSession, d: str) -> DataFrame:
    return gold.preferred_channel(star.fact(spark, d))


@query("executive_summary", sql(f"""WITH edge AS (
  SELECT max(transaction_timestamp) AS t FROM fact), p AS (
  SELECT transaction_timestamp >= t - INTERVAL 30 DAY AS cur, amount_usd, customer_key
  FROM fact, edge WHERE status = 'COMPLETED' AND transaction_timestamp >= t - INTERVAL 60 DAY), s AS (
  SELECT coalesce(sum(amount_usd) FILTER (WHERE cur), 0) AS r1, coalesce(sum(amount_usd) FILTER (WHERE NOT cur), 0) AS r0,
         count(*) FILTER (WHERE cur) AS n1, count(*) FILTER (WHERE NOT cur) AS n0,
         count(DISTINCT customer_key) FILTER (WHERE cur) AS c1,
         count(DISTINCT customer_key) FILTER (WHERE NOT cur) AS c0 FROM p), v AS (
  SELECT *, coalesce(CAST(r1 AS DOUBLE) / n1, 0) AS a1, coalesce(CAST(r0 AS DOUBLE) / n0, 0) AS a0 FROM s)
SELECT '2002-01-01' AS report_date, CAST(CAST(t - INTERVAL 30 DAY AS DATE) AS VARCHAR) AS period_start,
       CAST(CAST(t AS DATE) AS VARCHAR) AS period_end, CAST(r1 AS DOUBLE) AS total_revenue,
       {pct_change('r1', 'r0')} AS revenue_change_pct, n1 AS total_transactions,
       {pct_change('n1', 'n0')} AS transactions_change_pct, a1 AS avg_order_value, {pct_change('a1', 'a0')} AS aov_change_pct,
       c1 AS active_customers, {pct_change('c1', 'c0')} AS customers_change_pct
FROM v, edge""", "fact"))
def executive_summary(spark: SparkSession, d: str) -> DataFrame:
    return kpis.executive_summary(star.fact(spark, d), F.lit(dt.date(2002, 1, 1)))


@query("executive_summary_orders", sql(f"""WITH edge AS (
  SELECT max(transaction_timestamp) AS t FROM order_fact), p AS (
  SELECT transaction_timestamp >= t - INTERVAL 30 DAY AS cur, amount_usd, customer_key
  FROM order_fact, edge WHERE status = 'COMPLETED' AND transaction_timestamp >= t - INTERVAL 60 DAY), s AS (
  SELECT sum(amount_usd) FILTER (WHERE cur) AS r1, sum(amount_usd) FILTER (WHERE NOT cur) AS r0,
         count(*) FILTER (WHERE cur) AS n1, count(*) FILTER (WHERE NOT cur) AS n0 FROM p)
SELECT CAST(r1 AS DOUBLE) AS total_revenue, {pct_change('r1', 'r0')} AS revenue_change_pct,
       n1 AS total_transactions, {pct_change('n1', 'n0')} AS transactions_change_pct FROM s""", "order_fact"))
def executive_summary_orders(spark: SparkSession, d: str) -> DataFrame:
    return kpis.executive_summary(star.order_fact(spark, d)).select(
        "total_revenue", "revenue_change_pct", "total_transactions", "transactions_change_pct"
    )


@query("daily_kpis_orders", sql(f"""WITH daily AS (
  SELECT date_key, count(*) AS transaction_count, sum(amount_usd) AS total_revenue
  FROM order_fact WHERE status = 'COMPLETED' GROUP BY date_key)
SELECT *, {TREND} AS revenue_trend FROM (
  SELECT date_key, transaction_count, CAST(total_revenue AS DOUBLE) AS total_revenue, {ROLLING[7]}, {ROLLING[30]},
         {DOD} AS revenue_dod_change FROM daily)""", "order_fact"))
def daily_kpis_orders(spark: SparkSession, d: str) -> DataFrame:
    return kpis.daily_kpis(star.order_fact(spark, d), star.calendar(spark)).select(
        "date_key", "transaction_count", "total_revenue", "revenue_7d_avg", "transactions_7d_avg", "revenue_30d_avg",
        "transactions_30d_avg", "revenue_dod_change", "revenue_trend",
    )


# --- statistics and reports --------------------------------------------------------------------


@query("fact_stats", sql(f"""
SELECT count(*) AS total_records, {SUM_USD} AS total_amount_usd, {AVG_USD} AS avg_amount_usd,
       {CUSTOMERS} AS unique_customers, {MERCHANTS} AS unique_merchants,
       {ts('min(transaction_timestamp)')} AS earliest_transaction, {ts('max(transaction_timestamp)')} AS latest_transaction
FROM fact""", "fact"))
def fact_stats(spark: SparkSession, d: str) -> DataFrame:
    return facts.fact_stats(star.fact(spark, d))


@query("fact_quality_metrics", sql(f"""
SELECT count(*) AS total_records, count(*) FILTER (WHERE customer_key IS NULL) AS null_customer_key,
       count(*) FILTER (WHERE amount_usd IS NULL) AS null_amount_usd, {CUSTOMERS} AS unique_customers,
       {MERCHANTS} AS unique_merchants, {ts('min(transaction_timestamp)')} AS earliest_txn,
       {ts('max(transaction_timestamp)')} AS latest_txn FROM fact""", "fact"))
def fact_quality_metrics(spark: SparkSession, d: str) -> DataFrame:
    return facts.fact_quality_metrics(star.fact(spark, d))


@query("segment_distribution", sql(f"""WITH {CUSTOMER_NB}
SELECT {SEGMENT} AS customer_segment, count(*) AS customer_count,
       round(CAST(sum(lifetime_value_usd) AS DOUBLE) / count(*), 2) AS avg_lifetime_value,
       round(CAST(sum(total_transactions) AS DOUBLE) / count(*), 0) AS avg_transactions
FROM nb GROUP BY 1""", "fact"))
def segment_distribution(spark: SparkSession, d: str) -> DataFrame:
    return reports.segment_distribution(gold.customer_analytics_nb(star.fact(spark, d), star.customers(spark, d)))


@query("channel_revenue_breakdown", sql(f"""
SELECT channel, {SUM_USD} AS total_revenue, count(*) AS total_transactions FROM fact GROUP BY channel""", "fact"))
def channel_revenue_breakdown(spark: SparkSession, d: str) -> DataFrame:
    monthly = gold.channel_performance_nb(star.fact(spark, d), star.calendar(spark))
    return reports.channel_revenue_breakdown(monthly)


@query("monthly_revenue_trend", sql(f"""WITH {MONTHLY_NB}
SELECT year, month_name, total_revenue, transaction_count, unique_customers FROM monthly_nb""", "fact", "calendar"))
def monthly_revenue_trend(spark: SparkSession, d: str) -> DataFrame:
    return reports.monthly_revenue_trend(kpis.monthly_kpis_nb(star.fact(spark, d), star.calendar(spark)))


@query("order_year_month", sql(f"""WITH {MONTHLY_NB}
SELECT row_number() OVER (ORDER BY year, month) AS place, year, month, total_revenue FROM monthly_nb""", "fact", "calendar"))
def order_year_month(spark: SparkSession, d: str) -> DataFrame:
    """Ordered months; the place makes the order part of the result. One row per month."""
    from pyspark.sql import Window as W

    ordered = kpis.monthly_kpis_nb(star.fact(spark, d), star.calendar(spark)).orderBy("year", "month")
    place = F.row_number().over(W.orderBy("year", "month"))
    return ordered.select(place.cast("long").alias("place"), "year", "month", "total_revenue")


@query("order_desc_metric", sql(f"""
SELECT row_number() OVER (ORDER BY sum(amount_usd) DESC, channel) AS place, channel, {SUM_USD} AS total_revenue
FROM fact GROUP BY channel""", "fact"))
def order_desc_metric(spark: SparkSession, d: str) -> DataFrame:
    """Channels by revenue, largest first, with their place. One row per channel."""
    from pyspark.sql import Window as W

    monthly = gold.channel_performance_nb(star.fact(spark, d), star.calendar(spark))
    ordered = reports.channel_revenue_breakdown(monthly)
    place = F.row_number().over(W.orderBy(F.desc("total_revenue"), "channel"))
    return ordered.select(place.cast("long").alias("place"), "channel", "total_revenue")


@query("latest_facts_top10", sql("""
SELECT transaction_id, strftime(transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS _created_timestamp,
       CAST(amount_usd AS DOUBLE) AS amount_usd
FROM fact ORDER BY transaction_timestamp DESC, transaction_id, fact.amount_usd LIMIT 10""", "fact"))
def latest_facts_top10(spark: SparkSession, d: str) -> DataFrame:
    rows = star.fact(spark, d).withColumn("_created_timestamp", F.col("transaction_timestamp"))
    return reports.newest_facts(rows.select("transaction_id", "_created_timestamp", "amount_usd"))
