"""Connected components over a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import apart, stored


def _links(df: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    return df.select(high.alias("a"), low.alias("b")).filter("a != b").distinct()


def _contracted(links: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones, move to its smallest neighbour.

    Minima are combined before the shuffle, and the joins are equi-joins that adaptive execution
    splits on a hot node.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.join(apart(least), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(apart(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _links(small.unionByName(least.select("a", F.col("m").alias("b"))))


def roots(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every linked node that is not itself the root: root is the component's least node.

    `pairs` may repeat links in either direction; NULL ends link nothing. An empty table gives an
    empty result. Rounds grow with the logarithm of the longest chain; each is written to the shared
    folder, so a lost executor repeats one round at most.
    """
    pairs = pairs.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a IS NOT NULL AND b IS NOT NULL")
    links, before = stored(_links(pairs), "links"), None
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")))
    while (now := tuple(links.agg(*mark).first())) != before and now[0]:
        links, before = stored(_contracted(links), "links"), now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
