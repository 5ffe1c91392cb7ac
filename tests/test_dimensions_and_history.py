from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators import dimensions, history
from ledgerloom.sources import sinks


def test_calendar_edges(spark):
    days = dimensions.dim_date(dimensions.calendar_days(spark, 2020, 2030)).cache()
    assert days.count() == 4018
    by_key = {r.date_key: r for r in days.collect()}
    assert (by_key[20201231].week_of_year, by_key[20210103].week_of_year, by_key[20210104].week_of_year) == (53, 53, 1)
    assert (by_key[20230630].fiscal_year, by_key[20230630].fiscal_quarter) == (2022, 4)
    assert (by_key[20230701].fiscal_year, by_key[20230701].fiscal_quarter) == (2023, 1)
    leap = by_key[20240229]
    assert (leap.is_month_end, leap.day_name, leap.day_short, leap.month_name, leap.month_short) == (
        True, "Thursday", "Thu", "February", "Feb")
    assert (by_key[20240302].is_weekend, by_key[20240302].day_of_week, by_key[20240304].day_of_week) == (True, 6, 1)


CUSTOMER = ("C1", "Ann", "Lee", "e", "p", "1990-01-01", "US", "2024-01-01 00:00:00", None)
CUSTOMER_SCHEMA = (
    "customer_id string, first_name string, last_name string, email string, phone string, date_of_birth string, "
    "country_code string, created_at string, updated_at string"
)


def test_latest_customer_and_ties(spark):
    newer = CUSTOMER[:3] + ("new",) + CUSTOMER[4:7] + ("2024-02-01 00:00:00", None)
    tie = CUSTOMER[:3] + ("tie",) + CUSTOMER[4:7] + ("2024-02-01 00:00:00", None)
    nameless = ("C2", None) + CUSTOMER[2:]
    nobody = (None,) + CUSTOMER[1:]
    for _ in range(3):
        sample = [CUSTOMER, newer, tie, nameless, nobody]
        random.shuffle(sample)
        got = {r.customer_id: r for r in dimensions.dim_customer(spark.createDataFrame(sample, CUSTOMER_SCHEMA)).collect()}
        assert got["C1"].email == "tie" and got["C1"].full_name == "Ann Lee"
        assert got["C2"].full_name is None
        assert got[None].customer_key is None


def test_customer_dimension_by_type(spark, location):
    from ledgerloom.plans import silver
    from ledgerloom.sources import readers

    moved = CUSTOMER[:6] + ("CA", "2024-02-01 00:00:00", None)
    spark.createDataFrame([CUSTOMER, moved, CUSTOMER], CUSTOMER_SCHEMA).write.parquet(location("raw"))
    assert silver.build_dim_customer(spark, location("raw"), location("one"), scd_type=1) == 1
    assert silver.build_dim_customer(spark, location("raw"), location("two")) == 2
    versions = readers.read_table(spark, location("two")).orderBy("_effective_from").collect()
    assert [(v.country_code, v._is_current) for v in versions] == [("US", False), ("CA", True)]
    assert versions[0]._effective_to == versions[1]._effective_from


def reference_history(deliveries):
    """Versions by a plain loop, for comparison."""
    result = {}
    for key in {d[0] for d in deliveries}:
        versions = []
        for _, ts, n, value in sorted(d for d in deliveries if d[0] == key):
            if not versions or versions[-1][2] != value:
                versions.append((key, ts, value))
        result[key] = versions
    return result


def spark_history(spark, deliveries, bucket="day"):
    df = spark.createDataFrame(
        [(k, 1_700_000_000 + ts * 40_000, n, v) for k, ts, n, v in deliveries], "k string, s long, n int, v string"
    ).select("k", F.timestamp_seconds("s").alias("ts"), "n", "v")
    return history.scd2_history(df, ["k"], ["ts", "n"], ["v"], bucket=bucket)


def check(spark, deliveries, got):
    expected = reference_history(deliveries)
    found = {}
    for r in sorted(got.collect(), key=lambda r: (r.k or "", r.valid_from, r.n)):
        found.setdefault(r.k, []).append(r)
    assert {k: [x.v for x in v] for k, v in found.items()} == {k: [x[2] for x in v] for k, v in expected.items()}
    for versions in found.values():
        assert [v.is_current for v in versions] == [False] * (len(versions) - 1) + [True]
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from  # no gap, no overlap
        assert versions[-1].valid_to is None


def test_history_cases(spark):
    deliveries = [
        ("a", 0, 0, "x"), ("a", 1, 1, "x"), ("a", 5, 2, "y"), ("a", 9, 3, "x"),  # unchanged, A-B-A
        ("b", 3, 4, None), ("b", 4, 5, "z"), ("b", 4, 6, None),  # NULL value, equal time
        ("c", 2, 7, None),
        (None, 1, 8, "x"), (None, 7, 9, "x"), (None, 9, 10, "y"),  # a missing key is one key
    ]
    check(spark, deliveries, spark_history(spark, deliveries))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 12), st.sampled_from(["x", "y", None])), min_size=1, max_size=25))
def test_history_matches_loop(spark, items):
    deliveries = [(k, ts, n, v) for n, (k, ts, v) in enumerate(items)]
    check(spark, deliveries, spark_history(spark, deliveries))


def test_late_change_reopens_a_version(spark, values):
    def frame(*rows):
        return spark.createDataFrame(rows, "k string, t string, n int, v string").selectExpr("k", "CAST(t AS TIMESTAMP) AS ts", "n", "v")

    first = frame((None, "2024-01-01", 0, "o"), ("a", "2024-01-01", 1, "x"), ("a", "2024-01-10", 2, "x"), ("b", "2024-01-01", 3, "q"))
    late = frame((None, "2024-01-03", 6, "p"), ("a", "2024-01-05", 4, "y"), ("d", "2024-01-02", 5, "new"))
    args = (["k"], ["ts", "n"], ["v"])
    got = history.scd2_apply(history.scd2_history(first, *args), first.unionByName(late), late, *args)
    assert [(k, v, str(f)[:10], c) for k, v, f, c in sorted(values(got, "k", "v", "valid_from", "is_current"), key=lambda r: (r[0] or "", str(r[2])))] == [
        (None, "o", "2024-01-01", False), (None, "p", "2024-01-03", True),
        ("a", "x", "2024-01-01", False), ("a", "y", "2024-01-05", False), ("a", "x", "2024-01-10", True),
        ("b", "q", "2024-01-01", True), ("d", "new", "2024-01-02", True),
    ]


def test_upsert(spark, values):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (None, "n", "z")], "k int, v string, w string")
    source = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z"), (None, "N", "Q")], "k int, v string, w string")
    assert values(sinks.merge_upsert(target, source, "k")) == sorted([
        (1, "a", "x"), (2, "B", "Y"), (3, "C", "Z"), (None, "n", "z"), (None, "N", "Q")], key=repr)
    listed = sinks.merge_upsert(target, source, ["k"], update_columns=["v"], insert_columns=["k", "v"])
    assert values(listed) == sorted([
        (1, "a", "x"), (2, "B", "y"), (3, "C", None), (None, "n", "z"), (None, "N", None)], key=repr)
    keyed = source.filter("k IS NOT NULL")
    once = sinks.merge_upsert(target, keyed, "k")
    assert values(sinks.merge_upsert(once, keyed, "k")) == values(once)


def test_scd1(spark, values):
    current = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    incoming = spark.createDataFrame([("a", 2), ("a", 3), ("c", 9)], "k string, v int")
    assert values(dimensions.scd1_upsert(current, incoming, "k", [F.desc("v")])) == [("a", 3), ("b", 1), ("c", 9)]
