from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import ingest, rules
from ledgerloom.plans import bronze, layers, silver
from ledgerloom.session import new_location, shared_root
from ledgerloom.sources import readers, sinks, versions

TABLES = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_root_follows_the_session(spark):
    assert new_location(spark, "x").startswith(shared_root(spark))
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_and_json_loads(spark, transactions, location):
    df = transactions({}, {"transaction_id": "T2", "amount": None}).drop("_batch_id")
    df.write.csv(location("csv"), header=True)
    df.write.json(location("json"))
    assert bronze.load_csv(spark, location("csv"), "transactions", location("raw"), "B1") == 2
    assert bronze.load_json(spark, location("json"), "transactions", location("raw"), "B2") == 2
    raw = readers.read_table(spark, location("raw"))
    assert set(raw.columns) == {*schemas.raw("transactions").names, "_load"}
    assert raw.filter("amount IS NULL").count() == 2
    assert raw.filter("_source_file IS NULL").count() == 0
    assert bronze.record_count(spark, location("raw")) == 4
    assert readers.read_as_of(spark, location("raw"), up_to_batch="B1").count() == 2
    assert readers.as_of(raw, timestamp="1999-01-01").count() == 0


def test_catalog_table_and_partition_overwrite(spark, values):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.write_table(df, "demo_table", partition_by=["p"])
    sinks.overwrite_partitions(spark, spark.createDataFrame([(9, "a")], "v int, p string"), "demo_table", ["p"])
    assert values(readers.read_table(spark, "demo_table"), "v", "p") == [(2, "b"), (9, "a")]
    assert silver.table_exists(spark, "demo_table") and not silver.table_exists(spark, "no_such_table")
    spark.sql("DROP TABLE demo_table")


def test_enforce_schema_and_conformance(spark, values):
    df = spark.createDataFrame([("1", "x", "k"), ("q", None, "k")], "a string, b string, extra string")
    wanted = "a int, b string, c date"
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(wanted)
    fixed = ingest.enforce_schema(df.filter("a = '1'"), schema)
    assert fixed.schema.simpleString() == "struct<a:int,b:string,c:date>"
    assert ingest.enforce_schema(df, T.StructType.fromDDL("b string, c date"), fill_missing=False).columns == ["b"]
    report = {r.column_name: tuple(r)[1:] for r in ingest.schema_conformance(df, schema).collect()}
    assert report == {"a": ("expected", 2, 0, 1), "b": ("expected", 2, 1, 0), "c": ("missing", 2, None, None),
                      "extra": ("unexpected", 2, 0, 0)}


def test_transform_is_incremental_and_repeatable(spark, transactions, location, values):
    raw, fact, bad = location("raw"), location("fact"), location("bad")
    first = transactions({}, {"transaction_id": "T2", "amount": "-1", "status": "X"})
    bronze.load_dataframe(first.drop("_batch_id"), "transactions", raw, "2024001")
    report = silver.transform_transactions(spark, raw, fact, bad)
    assert report.count() == 10
    state = lambda: (readers.read_table(spark, fact).count(), readers.read_table(spark, bad).count())
    assert state() == (1, 2)
    silver.transform_transactions(spark, raw, fact, bad)
    assert state() == (1, 2)  # nothing new
    bronze.load_dataframe(transactions({"transaction_id": "T3"}).drop("_batch_id"), "transactions", raw, "2024002")
    silver.transform_transactions(spark, raw, fact, bad)
    assert state() == (2, 2)
    silver.transform_transactions(spark, raw, fact, bad, since_batch_id="2024001")  # again, after a lost run
    assert state() == (2, 2)
    assert values(readers.read_table(spark, fact), "transaction_id", "_batch_id") == [("T1", "2024001"), ("T3", "2024002")]


def test_gate_stops_before_writing(spark, transactions, location):
    from ledgerloom.operators.quality import QualityGateError

    bronze.load_dataframe(transactions({"amount": None}).drop("_batch_id"), "transactions", location("raw"), "B1")
    with pytest.raises(QualityGateError):
        silver.transform_transactions(spark, location("raw"), location("fact"), location("bad"), gate="prod")
    assert not silver.table_exists(spark, location("fact"))


def test_late_rows_and_repeated_epochs(spark, location, values):
    from ledgerloom.streaming import bronze_stream, silver_stream

    schema = "k int, ts string, v string"
    for n, rows in enumerate([[(1, "b", "new"), (2, "a", "x")], [(1, "a", "late"), (3, "a", "y")], [(2, "c", "z")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(location(f"in/{n}"))
        source = spark.readStream.schema(schema).parquet(location("in/*"))
        silver_stream.upsert_stream(source, ["k"], ["ts"], location("out"), location("cp")).awaitTermination()
    expected = [(1, "b", "new"), (2, "c", "z"), (3, "a", "y")]
    assert values(silver_stream.current_rows(spark, location("out")), "k", "ts", "v") == expected
    # the state before the last epoch is still there, which is what a repeat would read
    before = silver_stream.current_rows(spark, location("out"), before=2)
    assert values(before, "k", "ts", "v") == [(1, "b", "new"), (2, "a", "x"), (3, "a", "y")]
    assert bronze_stream.deduplicated(source.withColumn("t", F.current_timestamp()), ["k"], "t", "1 hour").isStreaming


def test_files_of_late_data_do_not_grow_with_epochs(spark, location):
    from ledgerloom.streaming import silver_stream

    for n in range(10):
        spark.range(20).selectExpr(f"id % 7 + {n % 3} AS k", f"{n} AS ts").coalesce(1).write.mode("append").parquet(location(f"in/{n}"))
    source = spark.readStream.schema("k bigint, ts int").option("maxFilesPerTrigger", 1).parquet(location("in/*"))
    silver_stream.upsert_stream(source, ["k"], ["ts"], location("out"), location("cp")).awaitTermination()
    assert len(versions.numbers(spark, location("out"))) == 3
    newest = versions.version(spark, location("out"))
    assert newest.number == 9
    left = [f for _, _, names in os.walk(location("out/_data")) for f in names if f.endswith(".parquet")]
    named = {f for n in versions.numbers(spark, location("out")) for t in versions.version(spark, location("out"), n).tables.values() for f in t.files}
    assert len(left) == len(named) <= 12
    got = {r.k: r.ts for r in silver_stream.current_rows(spark, location("out")).collect()}
    assert got == {k: max(n for n in range(10) if n % 3 <= k <= n % 3 + 6) for k in range(9)}


def test_run_end_to_end(spark, location):
    from ledgerloom.registry.flows import _deliveries

    layout = layers.Layout(location("lake"))
    made = _deliveries(spark, TABLES)
    n = made["transactions"].count()
    counts = {r.table_name: r.records for r in layers.run(spark, made, layout, "B1").collect()}
    assert counts["transactions_raw"] == n and counts["executive_summary"] == 1
    checks = {r.check_name: r for r in layers.validate(spark, layout).collect()}
    assert checks["reconcile"].actual == 0 and checks["reconcile"].passed
    # the same deliveries again are no work, and change nothing
    at = versions.version(spark, layout.silver("fact_transactions")).number
    again = {r.table_name: r.records for r in layers.run(spark, made, layout, "B1").collect()}
    assert again == counts and versions.version(spark, layout.silver("fact_transactions")).number == at


def test_plans(spark):
    """What the plans must and must not contain."""
    from ledgerloom.registry import QUERIES
    from ledgerloom.sources import star

    valid, invalid = rules.rule_split(star.raw_transactions(spark, TABLES))
    for side in (valid, invalid):
        plan = plan_of(side)
        assert plan.count("FileScan") == 1 and "Exchange" not in plan  # one scan, no shuffle
    pruned = plan_of(QUERIES["executive_summary"](spark, TABLES))
    assert "EqualTo(status,COMPLETED)" in pruned and "description" not in pruned
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES["win_preferred_channel"](spark, TABLES)))
    assert sorted(c.split(":")[0] for c in scan.group(1).split(",")) == ["channel", "customer_key"]
    assert "WindowGroupLimit" in plan_of(QUERIES["win_dedup_latest"](spark, TABLES))
    history = QUERIES["scd2_history"](spark, TABLES)
    history.collect()
    final = plan_of(history).split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final and "Join" not in final
    for name in ("daily_kpis", "customer_analytics", "scd2_history", "bronze_orphan_counts", "dq_transaction_suite"):
        plan = plan_of(QUERIES[name](spark, TABLES))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name


@pytest.mark.parametrize("name", [
    "stream_bronze_ingest", "stream_silver_foreach", "late_data", "stream_dedup", "sink_merge_upsert", "sink_delete_where",
    "daily_kpis", "monthly_kpis", "customer_analytics", "scd2_history", "scd2_incremental", "quarantine_replay",
    "load_retry", "transform_late_rows", "transform_null_batch", "transform_rerun_next_day", "late_data_restart",
    "append_new_column", "load_csv_mixed_headers", "transform_corrected_load", "load_two_deliveries", "stream_then_batch", "transform_reader_between", "limit_records", "merge_duplicate_source", "run_all_layers",
    "dq_transaction_suite", "bronze_orphan_counts", "lookup_surrogate_keys", "transform_transactions",
])
def test_against_sql(spark, name):
    from compare import connect, difference

    from ledgerloom.registry import ORACLES, QUERIES

    problem, rows, _ = difference(spark, connect(TABLES), name, TABLES, QUERIES, ORACLES)
    assert problem is None and rows > 0


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == contract.entry(spark).columns
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
    from ledgerloom.registry import ORACLES, QUERIES

    assert set(QUERIES) == set(ORACLES) <= set(contract.queries())


def test_json_landing_is_compressed_and_whole(spark, tmp_path, monkeypatch):
    from ledgerloom.registry import flows

    monkeypatch.setattr(flows, "new_location", lambda _, name: str(tmp_path / name))
    loaded = flows.load_transactions_json(spark, "/root/testdata/sf0.001")
    files = [p.name for p in (tmp_path / "landing").glob("part-*")]
    assert files and all(n.endswith(".json.gz") for n in files)
    assert loaded.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()


def test_write_leaves_no_shuffle_files(spark, location):
    from ledgerloom.sources import star

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    for name in ("customers", "merchants"):
        versions.overwrite(spark, location(name), getattr(star, name)(spark, "/root/testdata/sf0.001").repartition(3))
    assert blocks.getAllFiles().size() <= before
