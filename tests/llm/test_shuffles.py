from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm import simhash_dedup
from ledgerloom.llm.common import apart, held, stored
from ledgerloom.session import CLEANUP, shuffles_removed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_table_is_not_sent_to_all(spark):
    # Spark takes an exploded table for as small as what it came from
    few = spark.range(100).withColumnRenamed("id", "fp")
    many = few.select("fp", F.explode(F.sequence(F.lit(1), F.lit(35))).alias("t"))
    assert "BroadcastHashJoin" in _plan(few.join(many, "fp"))
    assert "BroadcastHashJoin" not in _plan(few.join(apart(many), "fp"))
    assert "BroadcastHashJoin" in _plan(many.join(held(few), "fp"))
    assert "BroadcastHashJoin" not in _plan(many.join(held(few, 99), "fp"))


def test_simhash_joins_its_keys_by_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(simhash_dedup, "stored", lambda df, label: (plans.append(_plan(df)), stored(df, label))[1])
    fps = spark.createDataFrame([(k,) for k in (1, 3, 2**40, 2**41)], "fp bigint")
    assert {(r.a, r.b) for r in simhash_dedup.links(fps).collect()} >= {(1, 3)}
    assert len(plans) == 1 and "BroadcastHashJoin" not in plans[0]


def test_setting_is_back_after_the_last_write(spark):
    before = spark.conf.get(CLEANUP)
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            assert spark.conf.get(CLEANUP) == "true"
        assert spark.conf.get(CLEANUP) == "true"
    assert spark.conf.get(CLEANUP) == before
