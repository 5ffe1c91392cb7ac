"""Layout jobs of tables with commits: clustering by several columns, and few files of good size.

Parquet skips by least and greatest values, and so do the entries of a table. Sorting by one column after another
helps the first only. Here each column's value becomes a rank among quantiles, and the bits of the ranks are interleaved to one
number; rows that are near by this number are near in every column, so a file spans little of each.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import versions

#: bits of a rank: so many halvings of a column's values
BITS = 8
#: bytes of a file that is worth leaving alone, and that several small ones are put together to
FILE_BYTES = 128 << 20


def as_number(df: DataFrame, column: str) -> Column:
    """A value as a double in the same order: numbers, times and days as they are, of texts the first six bytes."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(value.cast("string"), "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.BooleanType):
        return value.cast("int").cast("double")
    return value.cast("double")


def with_ranks(df: DataFrame, columns: list[str], bits: int = BITS) -> tuple[DataFrame, list[str]]:
    """The frame with the rank of every column among 2**bits quantiles; NULL has rank 0. One aggregate finds the quantiles."""
    names = [f"_rank_{i}" for i in range(len(columns))]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(*[F.percentile_approx(as_number(df, c), shares, 10_000).alias(n) for c, n in zip(columns, names)]).first()
    for column, name in zip(columns, names):
        # at most 2**bits numbers
        edges = sorted({float(x) for x in cuts[name] or []})
        number = F.coalesce(as_number(df, column), F.lit(float("-inf")))
        df = df.withColumn(name, number)
        if edges:
            splits = [float("-inf"), *edges, float("inf")]
            ranked = Bucketizer(splits=splits, inputCol=name, outputCol=f"{name}_of", handleInvalid="keep").transform(df)
            df = ranked.withColumn(name, F.col(f"{name}_of").cast("bigint")).drop(f"{name}_of")
        else:
            df = df.withColumn(name, F.lit(0).cast("bigint"))
    return df, names


def interleaved(ranks: list[str], bits: int = BITS) -> Column:
    """One number of the bits of all ranks, high bits first and the columns in turn."""
    total = F.lit(0).cast("bigint")
    for b in range(bits):
        for i, name in enumerate(reversed(ranks)):
            bit = F.shiftright(F.col(name), b).bitwiseAND(F.lit(1).cast("bigint"))
            total = total + F.shiftleft(bit, b * len(ranks) + i)
    return total


def clustered(df: DataFrame, columns: list[str], files: int | None = None, bits: int = BITS) -> DataFrame:
    """The rows in ranges of the interleaved ranks, sorted in each; `files` ranges, or as adaptive execution sizes them.

    Rows of equal rank are spread by a hash, so a value with very many rows takes several ranges.
    """
    if len(columns) * bits > 62:
        raise ValueError("too many columns for one number: give fewer bits")
    ranked, names = with_ranks(df, columns, bits)
    told = ranked.withColumn("_place", interleaved(names, bits))
    order = ["_place", F.xxhash64(*columns)]
    spread = told.repartitionByRange(files, *order) if files else told.repartitionByRange(*order)
    return spread.sortWithinPartitions("_place", *columns).drop("_place", *names)


def cluster(spark: SparkSession, root: str, columns: list[str], files: int | None = None, table: str = versions.MAIN) -> versions.Version:
    """Write a table anew, clustered by several columns, which become its zones. Readers see the old files until the commit."""
    at = versions.version(spark, root)
    rows = clustered(versions.read(spark, at, table), columns, files)
    return versions.publish(spark, root, {table: versions.Change(rows, zones=tuple(columns))}, base=at)[0]


def packed(sizes: list[tuple[str, int]], room: int) -> list[list[str]]:
    """Files by name put together so that none holds more than `room` bytes: largest first, each into the first bin that fits."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        for k, (used, held) in enumerate(bins):
            if used + size <= room:
                bins[k] = (used + size, [*held, name])
                break
        else:
            bins.append((size, [name]))
    return [held for _, held in bins]


def compact(spark: SparkSession, root: str, room: int = FILE_BYTES, table: str = versions.MAIN) -> int:
    """Put small files together to files of at most `room` bytes, partition by partition; how many files went.

    Files above half of that stay as they are, and so does one that is alone. The driver holds the small files' names and sizes.
    """
    at = versions.version(spark, root)
    known, listed = at.tables[table], versions.entries(spark, at, table)
    parts = [f"part_{c}" for c in known.partition_by]
    by_part: dict[tuple, list[tuple[str, int]]] = {}
    for r in listed.filter(F.col("bytes") <= room // 2).select("file", "bytes", *parts).toLocalIterator():
        by_part.setdefault(tuple(r[p] for p in parts), []).append((r.file, r.bytes))
    bins = [b for sizes in by_part.values() for b in packed(sizes, room) if len(b) > 1]
    if not bins:
        return 0
    place = f"{root.rstrip('/')}/{versions.ENTRIES}/bins-{uuid.uuid4().hex}"
    told = [(name, k) for k, names in enumerate(bins) for name in names]
    spark.createDataFrame(told, "file string, bin int").coalesce(1).write.parquet(place)
    chosen = spark.read.parquet(place)
    rows = versions.read(spark, at, table, lambda e: e.join(chosen, "file", "left_semi"), named="_file")
    # one row a small file; a range of one number is one task and so one file
    binned = rows.join(F.broadcast(chosen), F.col("_file") == F.col("file")).repartitionByRange(len(bins), "bin")
    change = versions.Change(
        binned.drop("_file", "file", "bin"), lambda e: e.join(chosen, "file", "left_anti"), tuple(known.partition_by), tuple(known.zones), rebalance=False)
    versions.publish(spark, root, {table: change}, base=at)
    return len(told) - len(bins)
