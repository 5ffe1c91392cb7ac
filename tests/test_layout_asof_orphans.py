from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerloom.operators import asof, joins, quarantine, validation
from ledgerloom.sources import layout, readers, versions


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustering_keeps_rows_and_helps_both_columns(spark, location, values):
    root = location("t")
    rows = spark.range(20_000).selectExpr(
        "id", "cast(id % 997 as int) AS a", "concat('k', lpad(cast((id * 7919) % 1000 as string), 4, '0')) AS b", "if(id % 100 = 0, null, date_add(DATE '2024-01-01', cast(id % 365 as int))) AS day")
    versions.overwrite(spark, root, rows.repartition(8))
    at = layout.cluster(spark, root, ["a", "b"], files=64)
    total = versions.entries(spark, at).count()
    assert total >= 32
    for column, low, high in (("a", 100, 120), ("b", "k0300", "k0320")):
        some = versions.between(column, low, high)
        assert versions.entries(spark, at).filter("true").transform(some).count() <= total // 4
        got = versions.read(spark, at, of=some).filter(F.col(column).between(low, high))
        assert values(got) == values(rows.filter(F.col(column).between(low, high)))
    assert readers.read_table(spark, root).exceptAll(rows).count() == 0 and readers.read_table(spark, root).count() == 20_000
    assert layout.clustered(rows, ["day", "a", "b"]).count() == 20_000  # NULL days stay
    assert layout.clustered(rows.limit(0), ["a", "day"]).count() == 0


def test_interleaving_takes_the_columns_in_turn(spark):
    row = spark.createDataFrame([(0b1010, 0b0110)], "x bigint, y bigint").select(layout.interleaved(["x", "y"], 4).alias("z")).first()
    assert row.z == 0b10_01_11_00


def test_small_files_are_packed(spark, location):
    assert layout.packed([("a", 6), ("b", 5), ("c", 4), ("d", 3), ("e", 20)], 10) == [["e"], ["a", "c"], ["b", "d"]]
    root = location("t")
    versions.overwrite(spark, root, spark.range(0, 3000, 1, 12).withColumn("p", F.col("id") % 2), partition_by=["p"])
    for k in range(4):
        versions.append(spark, root, spark.range(k, k + 1, 1, 1).withColumn("p", F.lit(0).cast("bigint")), partition_by=["p"])
    before = versions.entries(spark, versions.version(spark, root)).count()
    gone = layout.compact(spark, root)
    listed = versions.entries(spark, versions.version(spark, root))
    assert listed.count() == before - gone == 2 and readers.read_table(spark, root).count() == 3004
    assert layout.compact(spark, root) == 0


def brute_asof(facts, history):
    def version(key, at):
        found = [v for k, a, b, v in history if None not in (k, key, at, a) and k == key and a <= at and (b is None or at < b)]
        return found[0] if found else None

    return sorted(((i, version(k, t)) for i, k, t in facts), key=repr)


def test_asof_equals_brute_force_with_a_hot_key(spark, values):
    rng = random.Random(4)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    history = []
    for key in range(30):
        cuts = sorted(rng.sample(range(8000), rng.randint(1, 12)))
        history += [(key, day(a), day(b) if b is not None else None, f"v{key}-{a}") for a, b in zip(cuts, [*cuts[1:], None if key % 3 else cuts[-1] + 50])]
    history += [(5, day(9000), day(9000), "no length"), (6, None, day(5), "no start"), (None, day(0), None, "no key")]
    facts = [(i, 7 if i % 3 == 0 else rng.choice([*range(32), None]), rng.choice([day(rng.randrange(9000)), None]) if i % 50 else day(0)) for i in range(1500)]
    facts += [(2000 + j, h[0], h[1]) for j, h in enumerate(history) if h[1]]  # exactly at a start
    f = spark.createDataFrame([(*x, "own") for x in facts], "id int, k int, t timestamp, v0 string").repartition(5)
    h = spark.createDataFrame(history, "k int, a timestamp, b timestamp, v string")
    for width in ("day", "month", "year"):
        got = asof.join_asof(f, h, "k", "t", "a", "b", ["v"], width)
        assert got.columns == ["id", "k", "t", "v0", "v"]
        assert values(got, "id", "v") == brute_asof(facts, history)
    assert asof.join_asof(f.limit(0), h, "k", "t", "a", "b", ["v"]).count() == 0
    assert asof.join_asof(f, h.limit(0), "k", "t", "a", "b", ["v"]).filter("v IS NOT NULL").count() == 0


def test_records_are_compared_as_multisets(spark, values):
    of = lambda xs: spark.createDataFrame([(x,) for x in xs], "record bigint")
    left, right = of([1, 1, 2, 3, 3, 3, 9]), of([1, 1, 2, 3, 4, 9, 9])
    assert values(validation.record_differences(left, right)) == [(3, 3, 1), (4, 0, 1), (9, 1, 2)]
    assert validation.record_differences(left, left).count() == 0
    verdict = validation.reconcile(of([1, 2, 3, 4]), of([1, 1, 2]), of([4])).first()
    assert (verdict.actual, verdict.passed) == (0.5, False)  # one lost, one too many: not made up for
    assert validation.reconcile(of([]), of([]), of([])).first().actual == 0
    plan = plan_of(validation.record_differences(left.withColumn("original_record", F.lit("long text")), right))
    assert "original_record" not in plan


def test_orphans_of_all_keys_from_one_scan(spark, location, values):
    spark.createDataFrame([(1, "a", "x"), (2, None, "y"), (3, "zz", "y"), (4, "zz", "nn"), (5, "a", None)], "id int, c string, m string").write.parquet(location("rows"))
    rows = spark.read.parquet(location("rows"))
    known = [("c", spark.createDataFrame([("a",), ("a",), (None,)], "k string"), "k"), ("m", spark.createDataFrame([("x",), ("y",)], "k string"), "k")]
    assert values(joins.orphan_keys(rows, known)) == [("c", "zz", 2), ("m", "nn", 1)]
    assert values(joins.orphan_summary(rows, known, include_null=True)) == [("c", 3, 4, 5), ("m", 2, 4, 5)]
    assert values(joins.orphan_summary(rows, known, include_null=False)) == [("c", 2, 4, 5), ("m", 1, 4, 5)]
    assert values(joins.orphan_summary(rows.limit(0), known, include_null=True)) == [("c", 0, 0, 0), ("m", 0, 0, 0)]
    assert plan_of(joins.orphan_keys(rows, known)).count("FileScan") == 1
    broken = quarantine.orphan_quarantine(rows, known)
    assert values(broken, "id", "_rejection_reason") == [(3, "orphan_c"), (4, "orphan_c"), (4, "orphan_m")]
    assert plan_of(broken).count("ReadSchema: struct<id:int,c:string,m:string>") == 1


def test_quarantine_write_reads_back_what_it_wrote(spark, transactions, location, values):
    from ledgerloom.operators import rules

    _, rejected = rules.rule_split(transactions({"amount": None}, {"status": "X", "amount": "-1"}, {}))
    assert quarantine.write(spark, location("q"), rejected, "transactions_raw", at=F.lit("2024-02-01").cast("timestamp")) == 3
    assert quarantine.write(spark, location("q"), rejected, "transactions_raw", at=F.lit("2024-02-02").cast("timestamp")) == 3
    assert quarantine.write(spark, location("q"), rejected.limit(0), "transactions_raw") == 0
    assert values(readers.read_table(spark, location("q")).groupBy("quarantine_date").count(), "count") == [(3,), (3,)]
