"""URL filters: subdomain rules first, then a Bloom filter cascade over listed hosts.

The cascade gives exact membership for every key of a universe that is known in full, here all hosts of the corpus.
Level 1 encodes the listed keys; level 2 the unlisted keys that level 1 takes for listed; level 3 the
listed keys that level 2 takes for those; and so on until a level has no false positive. A key's
verdict is that of the first level that does not contain it, so no join is needed.

Levels are arrays of 64-bit words made by one aggregation each. Their size follows from counts, never from the keys
themselves reaching the driver, and is checked: beyond `MOST_BITS` the universe is split by hash into shards,
each with a cascade of its own.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import computed, stored, text_of
from ledgerloom.llm.decontamination import LOWER, UPPER
from ledgerloom.session import new_location

#: bits of one level that a task may hold, 8 MB
MOST_BITS = 1 << 26


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, where the path starts as given."""

    host: str
    path: str
    allow: bool

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"


#: fixed values of the contract
RULES = (
    Rule("net", "/", False),
    Rule("example.net", "/en/", True),
    Rule("example.com", "/de/", False),
    Rule("org", "/fr/", True),
)


def parts(url: str | Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty where it is NULL or has no `://`."""
    text = text_of(url)
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """(name, allow) of the longest rule that fits, else NULL; of equally long ones the first."""
    found = F.lit(None).cast("struct<name:string,allow:boolean>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.allow).alias("allow"))).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    """One Bloom filter; bit p of it is bit p % 8 of byte p // 8."""

    bits: int
    hashes: int
    number: int
    table: bytes = b""

    def places(self, key: Column) -> list[Column]:
        """Bit positions of a key, from two hashes that differ by level."""
        bits = F.lit(self.bits)
        first, second = (F.pmod(F.xxhash64(F.lit(2 * self.number + i), key), bits) for i in (0, 1))
        return [F.pmod(first + second * i, bits).cast("int") for i in range(1, self.hashes + 1)]

    def contains(self, key: Column) -> Column:
        """Short-circuits at the first bit that is not set."""
        table = F.lit(self.table)
        byte = lambda p: F.conv(F.hex(F.substring(table, F.shiftright(p, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return reduce(Column.__and__, [F.getbit(byte(p), p.bitwiseAND(F.lit(7))) == 1 for p in self.places(key)])


def _level(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """The level that encodes the `count` keys of column `key` with about the given rate of false positives."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    empty = Level(bits, max(1, round(bits / count * math.log(2))), number)
    places = keys.select(F.explode(F.array(*empty.places(F.col("key")))).alias("p"))
    # bits are joined to words before the shuffle and after it
    one = F.expr("shiftleft(1L, p & 63)")
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("v")).toArrow()
    table = np.zeros(bits // 64, dtype="<i8")
    table[words.column("w").to_numpy()] = words.column("v").to_numpy()
    return Level(bits, empty.hashes, number, table.tobytes())


def cascade(universe: DataFrame) -> list[Level]:
    """Levels for a universe of distinct keys (key, listed), none if no key is listed."""
    counts = dict(universe.groupBy("listed").count().collect())
    own, other = counts.get(True, 0), counts.get(False, 0)
    inside, outside, levels = universe.filter("listed").select("key"), universe.filter("NOT listed").select("key"), []
    # the first level is sparse enough to leave about as many false positives as there are listed keys
    rate = min(0.5, own / (math.sqrt(2) * other)) if other else 0.5
    while own:
        levels.append(_level(inside, own, rate, len(levels)))
        wrong = stored(outside.filter(levels[-1].contains(F.col("key"))), "false_positives")
        inside, outside, own, rate = wrong, inside, wrong.count(), 0.5
    return levels


def listed_in(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed: the first level without it decides."""
    verdict = F.lit(len(levels) % 2 == 1)
    for i in reversed(range(len(levels))):
        verdict = F.when(levels[i].contains(key), verdict).otherwise(F.lit(i % 2 == 1))
    return verdict


def judge(pages: DataFrame, listed: DataFrame, id: str = "page_id", url: str = "url", listed_host: str = "host", rules: tuple[Rule, ...] = RULES, most_bits: int = MOST_BITS) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of `pages`.

    The longest rule that fits decides; else the verdict is block for a host in `listed`, allow for another. Listed
    hosts outside the corpus are no part of the universe. NULL URLs and those without `://` have an empty host and
    path, and an empty or NULL listed host counts for nothing. Repeated rows are judged alike. An empty table gives no rows, an empty
    list allows. Other columns are not read.
    """
    host, path = parts(url)
    split = pages.select(F.col(id).alias("id"), host.alias("host"), path.alias("path"))
    known = listed.select(F.col(listed_host).alias("key")).filter("key != ''").distinct().withColumn("hit", F.lit(True))
    universe = split.select(F.col("host").alias("key")).distinct().join(known, "key", "left")
    universe = stored(universe.select("key", F.coalesce("hit", F.lit(False)).alias("listed")), "hosts")
    own, total = universe.agg(F.count_if("listed"), F.count(F.lit(1))).first()
    # 1.44 bits a key for each halving of the first level's rate, and three levels' worth for the rest
    bits = own * (4.5 + 1.44 * max(0.0, math.log2(max(1, total) / max(1, own))))
    shards = max(1, math.ceil(bits / most_bits))

    def of(rows: DataFrame, levels: list[Level]) -> DataFrame:
        judged = computed(rows, {"rule": matching_rule(F.col("host"), F.col("path"), rules), "hit": listed_in(levels, F.col("host"))})
        allow = F.coalesce(F.col("rule.allow"), ~F.col("hit"))
        return judged.select(F.col("id").alias(id), "host", "path", F.col("rule.name").alias("rule"), F.when(allow, "allow").otherwise("block").alias("verdict"))

    if shards == 1:
        return of(split, cascade(universe))
    shard = lambda key: F.pmod(F.xxhash64(F.col(key), F.lit("shard")), F.lit(shards)).cast("int").alias("shard")
    routed = by_shard(split.select("*", shard("host")), "routed_pages")
    keys = by_shard(universe.select("*", shard("key")), "routed_hosts")
    return reduce(DataFrame.unionByName, [
        of(routed.filter(F.col("shard") == s).drop("shard"), cascade(keys.filter(F.col("shard") == s).drop("shard"))) for s in range(shards)])


def by_shard(rows: DataFrame, label: str) -> DataFrame:
    """Rows written by the partitions of column `shard`, of which a filter then reads one."""
    spark, path = rows.sparkSession, new_location(rows.sparkSession, label)
    rows.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
