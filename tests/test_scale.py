"""Steps that have to move little: what they do on many rows, told by their plans and files on a few."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from ledgerloom.operators import kpis
from ledgerloom.registry import flows
from ledgerloom.sources import star, versions

TABLES = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_layers_are_written_where_their_join_leaves_them(spark, location, monkeypatch):
    written, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (written.append(plan(w._df)), real(w, *a, **k))[1])
    for name, build in (("fact", star.derived_fact), ("transactions_raw", star.derived_raw_transactions)):
        written.clear()
        stored = star._layer(spark, f"{TABLES}/", name, build)
        assert stored.exceptAll(build(spark, TABLES)).isEmpty() and stored.count() == build(spark, TABLES).count()
        assert len(written) == 1 and "Repartition" not in written[0] and "RebalancePartitions" not in written[0]
        # the sort stands below the derived texts
        assert written[0].index("Project") < written[0].index("Sort")


def test_landing_files_are_not_gathered(spark, location, monkeypatch):
    written, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda w, *a, **k: (written.append(plan(w._df)), real(w, *a, **k))[1])
    rows = spark.range(0, 1000, 1, 8).withColumn("t", F.lit("x"))
    assert flows.land(rows, location("landing"), 2) == 4
    assert flows.land(rows.coalesce(1), location("landing"), 2) == 2
    assert flows.land(rows.limit(0), location("landing"), 2) == 1
    assert spark.read.parquet(location("landing")).count() == 2000
    assert not any("Repartition" in w for w in written[:1])


def test_distinct_counts_multiply_no_row(spark):
    rows = spark.createDataFrame(
        [(20240101, 1, 1, "1.00"), (20240101, 1, None, "2.00"), (20240102, None, 1, None), (20240201, 2, 2, "5.00"), (None, 3, 3, "7.00"), (None, 3, 4, "1.00")],
        "date_key int, customer_key long, merchant_key long, a string").withColumn("amount_usd", F.col("a").cast("decimal(18,2)"))
    rows = rows.withColumn("m", F.floor(F.col("date_key") / 100))
    got = kpis.activity(rows, ["m"], active_days="date_key")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (202401, 3, Decimal("3.00"), 1.5, 1, 1, 2), (202402, 1, Decimal("5.00"), 5.0, 1, 1, 1), (None, 2, Decimal("8.00"), 4.0, 1, 2, 0)], key=repr)
    assert "Expand" not in plan(got)


def test_fingerprints_are_exact_sums(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    hashes = rows.select(F.xxhash64("t", F.coalesce(F.col("n").cast("string"), F.lit("\u0000"))).alias("h1")).withColumn("h2", F.xxhash64(F.lit("again"), "h1"))
    want = [sum(r[c] for r in hashes.collect()) for c in ("h1", "h2")]
    found = rows.agg(*versions.fingerprints(["t", "n"]))
    assert list(found.first()) == want and found.schema.simpleString() == "struct<h1:decimal(38,0),h2:decimal(38,0)>"
    assert list(rows.limit(0).agg(*versions.fingerprints(["t", "n"])).first()) == [0, 0]
    # decimals are slow to add row by row
    assert "sum(cast(" not in plan(found).lower()
