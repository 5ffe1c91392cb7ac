from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import reference_data as ref
from ledgerloom.operators import facts, rules


def reasons_of(transactions, change):
    _, invalid = rules.rule_split(transactions(change))
    return sorted(r[0] for r in invalid.select(rules.REASON).collect())


@pytest.mark.parametrize("change,expected", [
    ({}, []),
    ({"transaction_id": None}, ["null_transaction_id"]),
    ({"amount": None}, ["null_amount"]),
    ({"amount": "abc"}, ["invalid_amount"]),
    ({"amount": ".5"}, ["invalid_amount"]),
    ({"amount": "1e3"}, ["invalid_amount"]),
    ({"amount": "12."}, []),
    ({"amount": "0"}, []),
    ({"amount": "-5.00"}, ["negative_amount"]),
    ({"currency": "XXX"}, ["invalid_currency"]),
    ({"currency": ""}, ["invalid_currency"]),
    ({"currency": None}, []),
    ({"status": "UNKNOWN"}, ["invalid_status"]),
    ({"status": None}, []),
    ({"transaction_type": "FEE"}, ["invalid_transaction_type"]),
    ({"channel": "PHONE"}, ["invalid_channel"]),
    ({"transaction_date": "not-a-date"}, ["invalid_date"]),
    ({"transaction_date": "2024-02-30"}, ["invalid_date"]),
    ({"transaction_date": ""}, ["invalid_date"]),
    ({"transaction_date": None}, []),
    ({"customer_id": None}, []),
    ({"amount": "-1", "currency": "XXX"}, ["invalid_currency", "negative_amount"]),
])
def test_rule_verdicts(transactions, change, expected):
    assert reasons_of(transactions, change) == expected


def test_split_is_per_row_and_complete(transactions):
    df = transactions({}, {"amount": "-1"}, {"transaction_id": None}, {"transaction_id": "T2", "status": "X", "channel": "X"})
    valid, invalid = rules.rule_split(df)
    records = rules.invalid_records(df, rules.transaction_rules())
    # the good row that shares its id with a bad one stays valid, a NULL id does not
    assert [r.transaction_id for r in valid.collect()] == ["T1"]
    assert valid.count() + records.count() == df.count()
    assert invalid.count() == 4
    both = rules.verdicts(df, rules.transaction_rules())
    assert both.count() == valid.count() + invalid.count()


def test_rule_counts_and_duplicates(transactions, values):
    df = transactions({}, {}, {"transaction_id": "T2", "amount": None}, {"transaction_id": None}, {"transaction_id": None})
    counts = rules.rule_counts(df, rules.transaction_rules()).first()
    assert (counts.total_rows, counts.valid_rows, counts.null_amount, counts.null_transaction_id) == (5, 2, 1, 2)
    assert values(rules.duplicate_ids(df, "transaction_id")) == [("T1", 2)]


def test_optional_rules(transactions):
    df = transactions(
        {"amount": "-1"}, {"amount": "-1", "transaction_type": "REFUND"}, {"amount": "-1", "transaction_type": None},
        {"transaction_date": "1990-01-01"}, {"transaction_date": "bad"},
    )
    assert df.filter(rules.negative_unless_refund()[1]).count() == 2
    assert df.filter(rules.date_out_of_range("2000-01-01", "2030-01-01")[1]).count() == 1


def test_strict_split_is_complementary(transactions):
    df = transactions({}, {"currency": None}, {"currency": "AUD"}, {"amount": "0"}, {"amount": "abc"}, {"customer_id": None})
    valid, invalid = rules.strict_split(df)
    assert (valid.count(), invalid.count()) == (1, 5)
    shown = {r[0] for r in invalid.select(rules.strict_reason()).collect()}
    assert shown == {"Negative/zero amount", "Invalid currency", "Missing customer_id", "Other validation failure"}


@pytest.mark.parametrize("currency", list(ref.USD_RATES) + ["XXX", None])
def test_currency_rates(transactions, currency):
    row = facts.with_usd(facts.typed(transactions({"currency": currency, "amount": "100.125"}))).first()
    rate = ref.USD_RATES.get(currency, Decimal(1))
    expected = (row.amount * rate).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    assert row.amount_usd == expected


def test_keys(transactions):
    df = facts.with_hash_keys(facts.typed(transactions({}, {"transaction_id": "T2", "customer_id": None}, {"customer_id": ""})))
    got = {r.transaction_id + str(r.customer_id): r for r in df.collect()}
    assert got["T2None"].customer_key is None
    assert got["T1"].customer_key is not None  # empty text is a value
    assert got["T1C1" if "T1C1" in got else "T1"].date_key == 20240115
    again = facts.with_hash_keys(facts.typed(transactions({}))).first()
    assert again.transaction_key == got["T1"].transaction_key


def test_typed_tolerates_bad_text(transactions):
    row = facts.typed(transactions({"amount": "x", "transaction_date": "x", "transaction_timestamp": "x"})).first()
    assert (row.amount, row.transaction_date, row.transaction_timestamp) == (None, None, None)


def test_fact_schema(transactions):
    from ledgerloom import schemas

    fact = facts.build_fact(transactions({}))
    assert [(f.name, f.dataType) for f in fact.drop("_batch_id").schema] == [(f.name, f.dataType) for f in schemas.FACT]


def test_watermark(spark, transactions):
    raw = transactions({}, {"transaction_id": "T2"}).withColumn("_ingestion_timestamp", F.to_timestamp(
        F.when(F.col("transaction_id") == "T1", "2024-01-01 00:00:00").otherwise("2024-01-03 00:00:00")))
    fact = spark.createDataFrame([("2024-01-02 00:00:00",)], "t string").select(F.to_timestamp("t").alias("_created_timestamp"))
    assert [r.transaction_id for r in facts.after_watermark(raw, fact).collect()] == ["T2"]
    assert facts.after_watermark(raw, fact.limit(0)).count() == 2


def test_empty_input(transactions):
    empty = transactions({}).limit(0)
    valid, invalid = rules.rule_split(empty)
    assert (valid.count(), invalid.count(), facts.build_fact(valid).count()) == (0, 0, 0)
