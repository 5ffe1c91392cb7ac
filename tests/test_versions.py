from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import readers, sinks, versions


def numbered(spark, low, high, note="old"):
    return spark.range(low, high, 1, 1).select("id", F.lit(note).alias("note"))


def files(spark, root, table=versions.MAIN):
    return {r.file for r in versions.entries(spark, versions.version(spark, root), table).collect()}


def rows_of(spark, root, table=versions.MAIN):
    return versions.read(spark, versions.version(spark, root), table)


def test_a_reader_between_two_steps_sees_one_version(spark, location, values):
    root = location("t")
    assert versions.version(spark, root) is None and versions.resolve(spark, root) is None
    versions.overwrite(spark, root, numbered(spark, 0, 3))
    opened = readers.read_table(spark, root)
    seen = []
    real = versions._write_new
    # the moment before the commit, when all files of the next version are there
    versions._write_new = lambda *a: seen.append(values(readers.read_table(spark, root), "id")) or real(*a)
    try:
        versions.overwrite(spark, root, spark.createDataFrame([(7, 1.5)], "id bigint, other double"))
    finally:
        versions._write_new = real
    assert seen == [[(0,), (1,), (2,)]]
    assert values(opened, "id", "note") == [(0, "old"), (1, "old"), (2, "old")]
    assert [tuple(r) for r in readers.read_table(spark, root).collect()] == [(7, 1.5)]
    assert versions.read(spark, versions.version(spark, root, 0)).count() == 3


def test_of_two_writers_one_is_told(spark, location):
    root = location("t")
    versions.overwrite(spark, root, numbered(spark, 0, 3))
    base = versions.version(spark, root)
    versions.append(spark, root, numbered(spark, 3, 5))
    with pytest.raises(versions.CommitConflict):
        versions.publish(spark, root, {versions.MAIN: versions.Change(numbered(spark, 9, 10))}, base=base)
    assert rows_of(spark, root).count() == 5


def test_upsert_leaves_untouched_files(spark, location, values):
    root = location("t")
    versions.overwrite(spark, root, numbered(spark, 0, 1000).repartitionByRange(10, "id"), zones=["id"])
    before = files(spark, root)
    assert len(before) == 10
    source = spark.createDataFrame([(5, "new"), (6, "new"), (999, "new"), (5000, "added"), (None, "no key")], "id bigint, note string")
    sinks.upsert_to(spark, root, source, "id")
    assert len(before & files(spark, root)) == 8
    got = rows_of(spark, root)
    assert got.count() == 1002
    assert values(got.filter("note <> 'old'")) == [(5, "new"), (5000, "added"), (6, "new"), (999, "new"), (None, "no key")]
    with pytest.raises(ValueError, match="repeats keys"):
        sinks.upsert_to(spark, root, spark.createDataFrame([(1, "a"), (1, "b")], "id bigint, note string"), "id")


def test_delete_and_move_at_file_grain(spark, location, values):
    root = location("t")
    days = spark.range(90).select("id", F.expr("date_add(DATE '2024-01-01', cast(id % 3 as int))").alias("day"))
    versions.overwrite(spark, root, days, partition_by=["day"])
    before = files(spark, root)
    assert versions.remove(spark, root, F.col("day") == F.lit("1999-01-01").cast("date")) == 0
    assert versions.remove(spark, root, F.col("day") == F.lit("2024-01-01").cast("date"), into="archive") == 30
    moved = files(spark, root, "archive")
    assert moved < before and files(spark, root) == before - moved  # handed over, not written anew
    assert versions.remove(spark, root, (F.col("day") == F.lit("2024-01-02").cast("date")) & (F.col("id") < 10), into="archive") == 3
    assert {r.id for r in rows_of(spark, root, "archive").collect()} == {*range(0, 90, 3), 1, 4, 7}
    assert rows_of(spark, root).count() == 57
    assert versions.remove(spark, root, F.lit(None).cast("boolean")) == 0  # unknown is no match


def test_vacuum_keeps_what_named_versions_need(spark, location):
    root = location("t")
    for k in range(4):
        versions.append(spark, root, numbered(spark, k, k + 1))
    versions.overwrite(spark, root, numbered(spark, 0, 5))
    assert versions.vacuum(spark, root, keep=2) == 0  # the version before still names the four files
    versions.overwrite(spark, root, numbered(spark, 0, 6))
    assert versions.vacuum(spark, root, keep=1) >= 5
    assert versions.numbers(spark, root) == [5] and rows_of(spark, root).count() == 6


def test_columns_come_and_types_stay(spark, location, values):
    root = location("t")
    versions.append(spark, root, numbered(spark, 0, 1))
    versions.append(spark, root, numbered(spark, 1, 2).withColumn("extra", F.lit(1.5)))
    assert values(rows_of(spark, root)) == [(0, "old", None), (1, "old", 1.5)]
    with pytest.raises(ValueError, match="note changes"):
        versions.append(spark, root, spark.createDataFrame([(2, 3)], "id bigint, note int"))


def test_odd_partition_values_and_empty_tables(spark, location, values):
    root = location("t")
    odd = ["a b", "50%", "x=y/z", "", None, "007", "ü+1"]
    versions.overwrite(spark, root, spark.createDataFrame([(i, p) for i, p in enumerate(odd)], "id int, p string"), partition_by=["p"])
    # Spark's directories cannot tell an empty text from NULL
    assert values(rows_of(spark, root)) == sorted([(i, p or None) for i, p in enumerate(odd)], key=repr)
    only = versions.read(spark, versions.version(spark, root), of=lambda e: e.filter("part_p = '007'"))
    assert values(only) == [(5, "007")]
    versions.overwrite(spark, root, numbered(spark, 0, 0))
    assert rows_of(spark, root).count() == 0 and rows_of(spark, root).columns == ["id", "note"]


def test_a_path_may_mean_a_table_of_another_store(spark, location):
    root = location("t")
    versions.publish(spark, root, {versions.MAIN: versions.Change(numbered(spark, 0, 2)), "rest": versions.Change(numbered(spark, 2, 5))})
    versions.link(spark, location("rest"), root, "rest")
    versions.link(spark, location("rest"), root, "rest")
    assert readers.read_table(spark, location("rest")).count() == 3
    with pytest.raises(ValueError, match="belongs to another store"):
        versions.link(spark, location("rest"), root, "other")


def test_fingerprints_tell_contents_not_order(spark, location):
    a = spark.createDataFrame([("x", None), (None, "x"), ("y", "z")], "a string, b string")
    b = spark.createDataFrame([("y", "z"), (None, "x"), ("x", None)], "a string, b string")
    c = spark.createDataFrame([("y", "z"), (None, "x"), (None, "x")], "a string, b string")
    told = [tuple(df.agg(*versions.fingerprints(["a", "b"])).first()) for df in (a, b, c)]
    assert told[0] == told[1] != told[2]


def test_sql_reads_by_a_view(spark, location):
    versions.overwrite(spark, location("t"), numbered(spark, 0, 4))
    versions.view(spark, location("t"), "numbered_view")
    assert spark.sql("SELECT sum(id) AS s FROM numbered_view").first().s == 6


def test_steps_together_raise_the_first_error(spark):
    from ledgerloom.session import together

    assert together({"a": lambda: 1, "b": lambda: 2}) == {"a": 1, "b": 2} and together({}) == {}
    with pytest.raises(ZeroDivisionError):
        together({"a": lambda: 1, "b": lambda: 1 // 0})
