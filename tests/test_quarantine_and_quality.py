from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import quality, quarantine, rules
from ledgerloom.sources import readers, sinks, versions

AT = "2024-02-01 00:00:00"


def rejected(transactions, *changes):
    _, invalid = rules.rule_split(transactions(*changes))
    return quarantine.to_quarantine(invalid, "transactions_raw", at=F.lit(AT).cast("timestamp"))


def test_replay_restores_null_fields_and_delivery_counts(transactions):
    from ledgerloom import schemas

    bad = [{"amount": None, "status": "X"}, {"amount": None, "status": "X"}, {"currency": "XXX", "description": None}]
    rows = rejected(transactions, *bad)
    assert rows.count() == 5
    again = quarantine.replay(rows, schemas.raw("transactions"))
    assert again.count() == 3
    assert {r.amount for r in again.collect()} == {None, "100.00"}
    assert set(schemas.raw("transactions").names) <= set(again.columns)
    first = again.filter("amount IS NULL").first()
    assert (first._original_rejection_reason, first.description) == ("invalid_status", "a purchase")


def test_stats_and_lookup(transactions, values):
    rows = rejected(transactions, {"amount": None}, {"amount": None, "_batch_id": "B2"}, {"status": "X"})
    assert values(quarantine.stats(rows), "level", "label", "n", "batches") == [
        ("reason", "invalid_status", 1, 1), ("reason", "null_amount", 2, 2),
        ("source", "transactions_raw", 3, 2), ("total", None, 3, 2),
    ]
    assert quarantine.lookup(rows, reason="null_amount", batch_id="B2").count() == 1
    assert quarantine.lookup(rows, limit=2).count() == 2
    assert [tuple(r) for r in quarantine.reason_counts(rows).collect()] == [("null_amount", 2), ("invalid_status", 1)]


def test_delete_needs_a_condition(spark, transactions, location):
    rows = rejected(transactions, {"amount": None}, {"amount": None, "_batch_id": "B2"})
    assert sinks.removal_condition() is None
    assert sinks.delete_where(rows, None).count() == 2
    versions.overwrite(spark, location("q"), rows)
    assert sinks.delete_from(spark, location("q"), None) == 0
    assert sinks.delete_from(spark, location("q"), sinks.removal_condition(batch_id="B2")) == 1
    assert [r.batch_id for r in readers.read_table(spark, location("q")).collect()] == ["B1"]
    old = sinks.removal_condition(older_than_days=30, as_of=F.lit("2024-03-03").cast("date"))
    assert sinks.delete_where(rows, old).count() == 0


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([("a", None), ("a", "b1"), ("a", "b2")], "source_table string, batch_id string")
    assert sinks.delete_where(df, sinks.removal_condition(batch_id="b1")).count() == 2


def test_reason_column_may_be_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    row = quarantine.to_quarantine(df, "t").first()
    assert (row.rejection_reason, row.batch_id, row.original_record) == ("unknown", None, '{"a":1}')


CHECKED = [("a", "1", "x"), ("a", "-1", "y"), (None, "0", None), ("b", "q", "x")]


@pytest.mark.parametrize("check,rows,failed,passed", [
    (quality.not_null, 4, 1, False),
    (lambda c: quality.not_null(c, threshold_pct=25.0), 4, 1, True),
    (quality.unique, 3, 1, False),
    (lambda c: quality.in_set(c, ["a"]), 4, 1, False),
    (lambda c: quality.in_set(c, ["a", "b"]), 4, 0, True),
    (lambda c: quality.no_duplicates([c]), 3, 1, False),
    (lambda c: quality.positive("v"), 4, 1, False),
    (lambda c: quality.positive("v", allow_zero=False), 4, 2, False),
    (lambda c: quality.in_range("v", 0, 10), 4, 1, False),
])
def test_checks(spark, check, rows, failed, passed):
    df = spark.createDataFrame(CHECKED, "k string, v string, w string")
    result = quality.run_checks(df, [check("k")]).first()
    assert (result.checked_rows, result.failed_rows, result.passed) == (rows, failed, passed)


def test_multi_column_duplicates_and_references(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("z", 2)], "k string, n int")
    known = spark.createDataFrame([("a",), ("a",)], "k2 string")
    report = {r.check_name: r for r in quality.run_checks(
        df, [quality.no_duplicates(["k", "n"]), quality.ref_integrity("k", known, "k2")]).collect()}
    assert report["duplicates_k_n"].failed_rows == 2
    assert (report["ref_integrity_k"].failed_rows, report["ref_integrity_k"].actual_pct) == (1, 20.0)


def test_empty_input_passes(spark):
    df = spark.createDataFrame([], "transaction_id string, amount string")
    report = quality.run_checks(df, [quality.not_null("amount"), quality.unique("transaction_id")])
    assert [(r.checked_rows, r.passed) for r in report.collect()] == [(0, True), (0, True)]


def test_summary_and_gate(transactions):
    report = quality.run_checks(transactions({}, {"amount": None}, {"transaction_id": "T2", "customer_id": None}),
                                quality.transaction_suite())
    summary = quality.report_summary(report).first()
    assert (summary.check_count, summary.failed_count, summary.failed_errors, summary.passed) == (10, 3, 2, False)
    quality.enforce_gate(quality.threshold_gate(report, "dev"))
    with pytest.raises(quality.QualityGateError, match="unique_transaction_id"):
        quality.enforce_gate(quality.threshold_gate(report, "prod"))


def test_value_distribution_keeps_null(spark, values):
    df = spark.createDataFrame([("a", "x"), ("a", None)], "c string, d string")
    assert values(quality.value_distribution(df, ["c", "d"])) == [("c", "a", 2), ("d", "x", 1), ("d", None, 1)] or \
        set(values(quality.value_distribution(df, ["c", "d"]))) == {("c", "a", 2), ("d", "x", 1), ("d", None, 1)}
