"""Facts joined to the version of a dimension that was valid at their time.

A version holds from its start to the start of the next one. Joined by key alone, a fact would meet every version of its key,
and a key with a third of all facts would be one group. Here time is cut into buckets. Of each key and bucket that facts fall into,
the pieces are worked out first: the versions that start inside it, and the one that was carried over from before. Facts then join
pieces by key and bucket, and the interval decides. A hot key is spread over its buckets, and each fact meets the few
pieces of one bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import same_key


def _bucket(moment: Column, width: str) -> Column:
    return F.date_trunc(width, moment)


def pieces(
    used: DataFrame, history: DataFrame, keys: list[str], valid_from: str, valid_to: str, attributes: list[str], width: str
) -> DataFrame:
    """(keys, _bucket, _from, _to, attributes) for the keys and buckets of `used`: versions cut by the buckets they are asked in."""
    state = F.struct(F.col(valid_from).alias("_from"), F.col(valid_to).alias("_to"), *attributes).alias("_state")
    starts = history.filter(F.col(valid_from).isNotNull() & ~F.coalesce(F.col(valid_to) <= F.col(valid_from), F.lit(False)))
    starts = starts.select(*keys, state)
    inside = starts.withColumn("_bucket", _bucket(F.col("_state._from"), width)).join(used, [*keys, "_bucket"], "left_semi")

    # the version before the bucket: keys have a row a version and a row a bucket here, never a row a fact
    marks = starts.select(*keys, F.col("_state._from").alias("_at"), F.lit(1).alias("_kind"), "_state").unionByName(
        used.select(*keys, F.col("_bucket").alias("_at"), F.lit(0).alias("_kind")), allowMissingColumns=True)
    before = W.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = marks.withColumn("_state", F.last("_state", ignorenulls=True).over(before)).filter("_kind = 0")
    carried = carried.filter(F.col("_state").isNotNull() & (F.col("_state._to").isNull() | (F.col("_state._to") > F.col("_at"))))
    carried = carried.select(*keys, "_state", F.col("_at").alias("_bucket"))
    return inside.select(*keys, "_bucket", "_state.*").unionByName(carried.select(*keys, "_bucket", "_state.*"))


def join_asof(
    facts: DataFrame, history: DataFrame, keys: str | list[str], at: str, valid_from: str, valid_to: str,
    attributes: list[str], width: str = "month",
) -> DataFrame:
    """All facts with the attributes of the version of their key that holds at their time, NULL where there is none.

    A version holds from `valid_from`, inclusive, to `valid_to`, exclusive; NULL means still; one without length never holds.
    Versions of a key must not overlap. Facts without key or time have no version. Choose the width so that the
    facts of the hottest key in one bucket are work for a few tasks: adaptive execution splits a large group further.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    timed = facts.withColumn("_bucket", _bucket(F.col(at), width))
    used = timed.select(*keys, "_bucket").dropna().distinct()
    cut = pieces(used, history, keys, valid_from, valid_to, attributes, width).alias("p")
    on = same_key("f", "p", [*keys, "_bucket"]) & (F.col("p._from") <= F.col(f"f.{at}"))
    on = on & (F.col("p._to").isNull() | (F.col(f"f.{at}") < F.col("p._to")))
    joined = timed.alias("f").join(cut, on, "left")
    return joined.select(*[F.col(f"f.`{c}`") for c in facts.columns], *[F.col(f"p.`{c}`") for c in attributes])
