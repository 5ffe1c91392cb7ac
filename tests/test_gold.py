from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions.columns import customer_segment, merchant_tier
from ledgerloom.operators import dimensions, gold, kpis, reports, validation

SCHEMA = (
    "transaction_key long, customer_key long, merchant_key long, t string, usd string, channel string, status string, "
    "country_code string, transaction_type string"
)


def fact(spark, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], SCHEMA)
    return df.select(
        "transaction_key", "customer_key", "merchant_key", "channel", "status", "country_code", "transaction_type",
        F.to_timestamp("t").alias("transaction_timestamp"), F.col("usd").cast("decimal(18,2)").alias("amount_usd"),
        F.date_format(F.to_timestamp("t"), "yyyyMMdd").cast("int").alias("date_key"),
        (F.col("usd").cast("double") > 10000).alias("is_fraud"),
    )


def row(c=1, m=1, t="2024-01-01 00:00:00", usd="10.00", ch="POS", st="COMPLETED"):
    return (c, m, t, usd, ch, st, "US", "PURCHASE")


def calendar(spark):
    return dimensions.dim_date(dimensions.calendar_days(spark, 2022, 2025))


def test_rolling_window_counts_rows_not_days(spark):
    days = [1, 2, 3, 5, 6, 7, 8, 9]  # the fourth is missing
    f = fact(spark, *[row(t=f"2024-01-{d:02d} 00:00:00", usd=f"{d}.00") for d in days])
    got = {r.date_key: r for r in kpis.daily_kpis(f, calendar(spark)).collect()}
    assert got[20240109].revenue_7d_avg == sum(days[1:]) / 7
    assert got[20240101].revenue_dod_change is None and got[20240101].revenue_trend == "stable"
    assert got[20240102].revenue_dod_change == 100.0 and got[20240102].revenue_trend == "up"
    assert got[20240105].revenue_dod_change == 66.67


def test_zero_previous_day_has_no_change(spark):
    f = fact(spark, row(usd="0.00"), row(t="2024-01-02 00:00:00"), row(t="2024-01-03 00:00:00", usd="1.00"))
    got = [r.revenue_dod_change for r in kpis.daily_kpis(f, calendar(spark)).orderBy("date_key").collect()]
    assert got == [None, None, -90.0]


def test_year_over_year_by_rows_and_by_calendar(spark):
    months = [(2023, m) for m in range(1, 13) if m != 6] + [(2024, 1), (2024, 2)]
    f = fact(spark, *[row(t=f"{y}-{m:02d}-01 00:00:00", usd=f"{100 + m + y - 2023}.00") for y, m in months])
    by_rows = {(r.year, r.month): r for r in kpis.monthly_kpis(f, calendar(spark)).collect()}
    assert by_rows[(2024, 1)].revenue_yoy_change is None  # only eleven rows before it
    assert by_rows[(2024, 2)].revenue_yoy_change == 1.98  # against January
    gap_safe = kpis.with_yoy_change_by_calendar(kpis.monthly_base(f, calendar(spark)))
    assert {(r.year, r.month): r.revenue_yoy_change for r in gap_safe.collect()}[(2024, 2)] == 0.98


def test_executive_summary_bounds(spark):
    f = fact(
        spark, row(t="2024-03-31 12:00:00", usd="30.00"), row(t="2024-03-01 12:00:00", usd="30.00", c=2),
        row(t="2024-03-01 11:59:59", usd="20.00"), row(t="2024-03-20 00:00:00", st="FAILED", usd="999.00"),
    )
    got = kpis.executive_summary(f, F.lit(dt.date(2024, 4, 1))).first()
    assert (got.total_transactions, got.total_revenue, got.active_customers) == (2, 60.0, 2)  # the edge row is current
    assert (got.revenue_change_pct, got.transactions_change_pct, got.customers_change_pct) == (200.0, 100.0, 100.0)
    assert (got.period_start, got.period_end) == (dt.date(2024, 3, 1), dt.date(2024, 3, 31))


def test_executive_summary_without_prior_or_rows(spark):
    only = kpis.executive_summary(fact(spark, row())).first()
    assert only.revenue_change_pct is None and only.total_transactions == 1
    assert kpis.executive_summary(fact(spark, row()).limit(0)).count() == 0


def test_customer_analytics(spark):
    f = fact(
        spark, row(usd="600.00", ch="POS"), row(usd="600.00", ch="ATM", t="2025-01-01 00:00:00"),
        row(st="FAILED", ch="ATM"), row(st="FAILED", ch="POS"), row(c=2, usd="1.00"), row(c=3, st="FAILED"),
    )
    people = spark.createDataFrame([(1, "C1", "Ann Lee", "US", dt.date(2024, 1, 1))],
                                   "customer_key long, customer_id string, full_name string, country_code string, customer_since date")
    got = {r.customer_key: r for r in gold.customer_analytics(f, people).collect()}
    assert set(got) == {1, 2}  # no completed transaction, no row
    one = got[1]
    assert one.preferred_channel == "ATM"  # tie by name, over all statuses
    assert (one.active_months, one.total_transactions, one.customer_segment) == (1, 2, "Silver")  # both in January
    assert (one.days_as_customer, one.days_since_last_transaction) == (366, 0)
    assert got[2].customer_id is None and got[2].customer_segment == "Bronze"


def test_label_bounds(spark):
    df = spark.createDataFrame([(999.99,), (1000.0,), (5000.0,), (10000.0,), (50000.0,), (100000.0,), (None,)], "v double")
    got = [(r[0], r[1]) for r in df.select(customer_segment(F.col("v")), merchant_tier(F.col("v"))).collect()]
    assert got == [("Bronze", "Small"), ("Silver", "Small"), ("Gold", "Small"), ("Premium", "Medium"),
                   ("Premium", "Large"), ("Premium", "Enterprise"), ("Bronze", "Small")]


def test_new_and_returning(spark, values):
    f = fact(spark, row(), row(), row(t="2024-01-02 00:00:00"), row(c=2, t="2024-01-02 00:00:00"))
    assert values(kpis.new_vs_returning(f)) == [(20240101, 1, 1, 0), (20240102, 2, 1, 1)]


def test_unknown_dates_keep_their_rows(spark):
    f = fact(spark, row(t=None), row(t="1999-01-01 00:00:00"))
    got = gold.channel_performance(f, calendar(spark)).collect()
    assert [(r.year, r.transaction_count) for r in got] == [(None, 2)]


def test_reports(spark, values):
    f = fact(spark, row(), row(m=2, usd="20000.00"))
    shops = spark.createDataFrame([(1, "M1", "A", "GAS", "X", "US"), (2, "M2", "B", "GAS", "X", "US")],
                                  "merchant_key long, merchant_id string, merchant_name string, merchant_category string, city string, country_code string")
    got = gold.merchant_analytics_nb(f, shops)
    assert values(got.withColumn("r", F.col("fraud_rate").cast("string")), "merchant_id", "merchant_tier", "r") == [
        ("M1", "Small", "0.0000"), ("M2", "Medium", "1.0000")]
    assert values(reports.layer_record_counts({"a": f, "b": f.limit(0)})) == [("a", 2), ("b", 0)]
    late = reports.freshness({"f": (f, "transaction_timestamp")}, F.lit("2024-01-02 01:00:00").cast("timestamp")).first()
    assert (late.lag_hours, late.alert) == (25.0, True)


def test_validation(spark):
    f = fact(spark, row(), row(c=None, usd="-1.00"), row(c=9))
    known = spark.createDataFrame([(1,)], "customer_key long")
    assert not validation.amount_range(f).first().passed
    assert validation.null_keys(f, "customer_key").first().actual == 1 / 3
    assert validation.orphan_rate(f, "customer_key", known, "customer_key").first().actual == 0.5
    told = f.withColumn("record", validation.record_of(f.columns))
    assert validation.reconcile(told, told.filter("customer_key IS NOT NULL"), told.filter("customer_key IS NULL")).first().passed
    assert not validation.reconcile(told, told.filter("customer_key IS NOT NULL"), told.limit(0)).first().passed
