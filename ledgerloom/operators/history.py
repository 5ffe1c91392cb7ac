"""Slowly changing dimensions with history.

A version opens whenever the tracked attributes differ from the previous delivery of the
same key, and closes when the next one opens.

The previous delivery is found with two windows instead of one over the whole key: first
inside (key, time bucket), then over the first and last rows of the buckets of each key. A
key that holds a third of all rows is spread over its buckets. Both steps read the same
exchange, so the deliveries are scanned and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.sources.sinks import latest_per_key, same_key


def with_neighbour(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    name: str,
    following: bool = False,
    bucket: str = "day",
) -> DataFrame:
    """Add `name`: the value of the previous (or following) row of the same key.

    `order` is a total order within a key and starts with a timestamp, which is cut into
    buckets of the given width. Choose the width so that one bucket of the hottest key fits
    a task. NULL values are told apart from "no neighbour" by wrapping them in a struct.
    """
    wrapped = F.struct(value.alias("v"))
    marked = df.withColumns({"_value": wrapped, "_bucket": F.date_trunc(bucket, F.col(order[0]))})
    sort = [F.desc(c) if following else F.asc(c) for c in order]

    inside = W.partitionBy(*keys, "_bucket").orderBy(*sort)
    local = marked.withColumns({
        "_near": F.lag("_value").over(inside), "_beyond": F.lead("_value").over(inside),
    })
    opens, closes = F.col("_near").isNull(), F.col("_beyond").isNull()
    settled = local.filter(~opens).select(*df.columns, F.col("_near").alias(name))

    # the rows at both ends of a bucket: the row before an opening one closes the bucket before
    across = W.partitionBy(*keys).orderBy(*sort)
    ends = local.filter(opens | closes).withColumn("_far", F.lag("_value").over(across))
    return settled.unionByName(ends.filter(opens).select(*df.columns, F.col("_far").alias(name)))


def scd2_history(
    deliveries: DataFrame, keys: list[str], order: list[str], attributes: list[str], bucket: str = "day"
) -> DataFrame:
    """Versions per key: attributes, valid_from, valid_to (NULL while current), is_current.

    Repeated deliveries with unchanged attributes do not open a version; A, B, A opens three.
    """
    state = F.struct(*attributes)
    seen = with_neighbour(deliveries, keys, order, state, "_before", bucket=bucket)
    changed = seen.filter(F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(state))
    opened = changed.drop("_before").withColumn("valid_from", F.col(order[0]))
    closed = with_neighbour(opened, keys, order, F.col("valid_from"), "_next", following=True, bucket=bucket)
    return closed.select(
        *keys,
        *attributes,
        "valid_from",
        F.col("_next.v").alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
        *[c for c in order[1:] if c not in keys + attributes],
    )


def scd2_apply(
    history: DataFrame, log: DataFrame, batch: DataFrame, keys: list[str], order: list[str],
    attributes: list[str], bucket: str = "day",
) -> DataFrame:
    """History after a batch has been appended to the delivery log.

    Only the keys in the batch are rebuilt, from all their deliveries, so late and
    out-of-order changes land in the right place. Versions alone would not be enough: they
    no longer hold the unchanged deliveries that a late change can turn into a version.
    """
    touched = batch.select(keys).distinct().alias("b")
    on = same_key("a", "b", keys, null_safe=True)
    rebuilt = scd2_history(log.alias("a").join(touched, on, "left_semi"), keys, order, attributes, bucket)
    untouched = history.alias("a").join(touched, on, "left_anti")
    return untouched.unionByName(rebuilt.select(history.columns))


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def latest_delivery(deliveries: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return latest_per_key(deliveries, keys, [F.desc(c) for c in order])
