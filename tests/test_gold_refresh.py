from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import dimensions, rollup
from ledgerloom.plans import gold as plan
from ledgerloom.plans import silver
from ledgerloom.sources import readers, versions

COLUMNS = (
    "transaction_id string, date_key int, channel string, transaction_type string, status string, country_code string, customer_key bigint, "
    "merchant_key bigint, amount_usd decimal(18,2), transaction_timestamp timestamp")


def day():
    return F.lit("2024-07-01").cast("date")


def facts(spark, seed, months, n):
    rng, rows = random.Random(seed), []
    for i in range(n):
        month, day = rng.choice(months), rng.randint(1, 28)
        rows.append((
            f"{seed}-{i}", 20240000 + month * 100 + day, rng.choice(["POS", "ATM", None]), rng.choice(["PURCHASE", "REFUND"]),
            rng.choice(["COMPLETED", "COMPLETED", "FAILED", "REFUNDED", None]), rng.choice(["US", "DE", None]), rng.choice([None, *range(12)]),
            rng.choice([None, *range(5)]), None if rng.random() < 0.05 else rng.randint(1, 10**6) / 100,
            f"2024-{month:02}-{day:02} {rng.randint(0, 23):02}:00:00"))
    told = spark.createDataFrame(rows, COLUMNS.replace("decimal(18,2)", "double").replace("transaction_timestamp timestamp", "transaction_timestamp string"))
    return told.withColumns({"amount_usd": F.col("amount_usd").cast("decimal(18,2)"), "transaction_timestamp": F.to_timestamp("transaction_timestamp")})


def dims(spark):
    customers = spark.range(12).selectExpr(
        "id AS customer_key", "concat('C', id) AS customer_id", "concat('Name ', id) AS full_name", "'US' AS country_code", "DATE '2020-01-01' AS customer_since")
    merchants = spark.range(5).selectExpr(
        "id AS merchant_key", "concat('M', id) AS merchant_id", "concat('Shop ', id) AS merchant_name", "'GAS' AS category", "'DE' AS country_code", "'x' AS city")
    return customers, merchants, dimensions.dim_date(dimensions.calendar_days(spark, 2024, 2024))


def publish(spark, table, load, rows):
    fact = rows.withColumns({"load": F.lit(load), "month_key": silver.month_key()})
    versions.publish(spark, table, {versions.MAIN: versions.Change(
        fact, partition_by=("load", "month_key"), zones=("date_key", "transaction_timestamp"), replace="load")})


def shown(df):
    kept = [c for c in sorted(df.columns) if c not in ("month_key", "quarter_key", "_created_timestamp")]
    return sorted((tuple(str(v) if not isinstance(v, float) else round(v, 6) for v in r) for r in df.select(*kept).collect()), key=repr)


def files(spark, root):
    return {r.file: r.part_month_key for r in versions.entries(spark, versions.version(spark, root)).collect()}


def test_a_new_load_rewrites_its_groups_only_and_equals_a_rebuild(spark, location):
    customers, merchants, dates = dims(spark)
    table, root = location("fact"), location("gold")
    first, second = facts(spark, 1, [1, 2, 3, 4, 5, 6], 600), facts(spark, 2, [2], 15)
    publish(spark, table, "a", first)
    plan.refresh(spark, table, customers, merchants, dates, root, day())
    before, pairs = files(spark, f"{root}/revenue_summary"), versions.entries(spark, versions.version(spark, f"{root}/rollup"), plan.PAIRS).collect()
    publish(spark, table, "b", second)
    counts = plan.refresh(spark, table, customers, merchants, dates, root, day())
    after = files(spark, f"{root}/revenue_summary")
    assert {m for f, m in before.items() if f not in after} == {"202402"} == {m for f, m in after.items() if f not in before}
    kept = {r.file for r in versions.entries(spark, versions.version(spark, f"{root}/rollup"), plan.PAIRS).collect()}
    assert {r.part_month_key for r in pairs if r.file not in kept} == {"202402"}

    both = first.unionByName(second)
    whole = plan.analytics_tables(both, customers, merchants, dates, day()) | plan.kpi_tables(both, dates, day())
    for name in plan.TABLES:
        made = readers.read_table(spark, f"{root}/{name}")
        assert shown(made) == shown(whole[name]), name
        assert counts[name] == made.count()

    # nothing new: the tables by month stay as they are
    at = versions.version(spark, f"{root}/revenue_summary").number
    assert plan.refresh(spark, table, customers, merchants, dates, root, day()) == counts
    assert versions.version(spark, f"{root}/revenue_summary").number == at


def test_a_load_that_shrinks_takes_its_groups_along(spark, location):
    customers, merchants, dates = dims(spark)
    table, root = location("fact"), location("gold")
    publish(spark, table, "a", facts(spark, 3, [1, 2, 3], 200))
    publish(spark, table, "b", facts(spark, 4, [5, 9], 80))
    plan.refresh(spark, table, customers, merchants, dates, root, day())
    left = facts(spark, 4, [5, 9], 80).filter("date_key < 20240600 AND customer_key < 4")
    publish(spark, table, "b", left)
    plan.refresh(spark, table, customers, merchants, dates, root, day())
    both = facts(spark, 3, [1, 2, 3], 200).unionByName(left)
    whole = plan.analytics_tables(both, customers, merchants, dates, day()) | plan.kpi_tables(both, dates, day())
    for name in plan.TABLES:
        assert shown(readers.read_table(spark, f"{root}/{name}")) == shown(whole[name]), name


@pytest.mark.parametrize("keys", [["channel"], ["date_key", "country_code"], ["status"]])
def test_grouped_counts_members_exactly(spark, values, keys):
    rows = rollup.pairs(facts(spark, 5, [1, 2], 400))
    got = rollup.grouped(rows, keys, ["n", "amount"], {"c": "customer_key", "m": "merchant_key"})
    want = rows.groupBy(*keys).agg(F.count_distinct("customer_key").alias("c"), F.count_distinct("merchant_key").alias("m"), F.sum("n").alias("n"), F.sum("amount").alias("amount"))
    assert values(got, *keys, "c", "m", "n") == values(want, *keys, "c", "m", "n")
    plan_text = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan_text and plan_text.count("Scan") >= 1


def test_one_scan_of_the_fact_without_expand(spark, location):
    facts(spark, 6, [1], 50).write.parquet(location("f"))
    text = rollup.pairs(spark.read.parquet(location("f")))._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Expand" not in text
