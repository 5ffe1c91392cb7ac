"""Tables whose versions are named by commits: new files beside the old, one small file flips readers over.

A store is a folder. Data files below `_data` are written once and never changed. An entry describes one data
file: rows, bytes, partition values, least and greatest value of the zone columns, and, on request, a fingerprint of its
rows that does not depend on their order. A commit names the entries, schema, partition and zone columns of every
table of the store, so several tables change together. Commits are numbered; the file of a number can be made only once, so
of two writers that started from the same version one is told so.

Readers open the newest commit and exactly the files that it names. A run that dies before its commit leaves
files that no commit names; `vacuum` removes them with the versions that are no longer wanted. The driver holds file names,
never rows.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from decimal import Decimal
from functools import partial, reduce
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.session import shuffles_removed, together

COMMITS, ENTRIES, DATA, LINK = "_commits", "_entries", "_data", "_store"
#: the table of a store that a plain path means
MAIN = "main"
#: partition directory of one writing; not a column of the table
WRITING = "_writing"
#: files that a commit names itself; of more the entries tell
NAMED = 256
#: ranges into which the keys of a change are cut to find the files that may hold them
RANGES = 256


class CommitConflict(RuntimeError):
    """Another writer committed from the same version first."""


@dataclass(frozen=True)
class Table:
    """`entries` is the place of the entries and `columns` their schema; `files` are their names, if they are few."""

    entries: str
    columns: str
    schema: str
    rows: int
    partition_by: list[str] = field(default_factory=list)
    zones: list[str] = field(default_factory=list)
    files: list[str] | None = None

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Version:
    root: str
    number: int
    tables: dict[str, Table]


@dataclass(frozen=True)
class Change:
    """What a commit does to one table: new rows, and which entries of the version before stay (none if not given)."""

    rows: DataFrame | None
    keep: Callable[[DataFrame], DataFrame] | None = None
    partition_by: tuple[str, ...] = ()
    zones: tuple[str, ...] = ()
    fingerprint: tuple[str, ...] = ()
    #: partition column: files of a value that the new rows have too are replaced, the others stay
    replace: str | None = None
    #: entries taken over from another table of the store, without touching their files
    adopted: DataFrame | None = None
    #: gather partition values into few files; not for rows that are laid out already
    rebalance: bool = True
    #: what the table looks like if neither rows nor a version before tell
    schema: StructType | None = None


# --- files ---------------------------------------------------------------------------------------


def _path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    found, fs = _path(spark, path)
    return fs.exists(found)


def _names(spark: SparkSession, folder: str) -> list[str]:
    found, fs = _path(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(found)] if fs.exists(found) else []


def _read_text(spark: SparkSession, path: str) -> str:
    found, fs = _path(spark, path)
    stream = fs.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that appears whole or not at all; False if it is there already."""
    final, fs = _path(spark, path)
    draft, _ = _path(spark, f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.exists(final) and fs.rename(draft, final):
        return True
    fs.delete(draft, False)
    return False


# --- versions -------------------------------------------------------------------------------------


def resolve(spark: SparkSession, path: str) -> tuple[str, str] | None:
    """(store, table) that a path means; None if it is no store and no link to one."""
    path = path.rstrip("/")
    if _exists(spark, f"{path}/{COMMITS}"):
        return path, MAIN
    if _exists(spark, f"{path}/{LINK}"):
        target = json.loads(_read_text(spark, f"{path}/{LINK}"))
        return target["store"], target["table"]
    return None


def link(spark: SparkSession, path: str, store: str, table: str) -> None:
    """Let a path mean a table of another folder's store."""
    target = json.dumps({"store": store.rstrip("/"), "table": table})
    place = f"{path.rstrip('/')}/{LINK}"
    if not _write_new(spark, place, target) and _read_text(spark, place) != target:
        raise ValueError(f"{path} belongs to another store")


def numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in _names(spark, f"{root}/{COMMITS}") if n.endswith(".json") and not n.startswith("."))


def version(spark: SparkSession, root: str, number: int | None = None) -> Version | None:
    """A version of a store, the newest unless told otherwise; None before the first commit."""
    if number is None:
        known = numbers(spark, root)
        if not known:
            return None
        number = known[-1]
    told = json.loads(_read_text(spark, f"{root}/{COMMITS}/{number:012d}.json"))
    return Version(root, number, {name: Table(**t) for name, t in told["tables"].items()})


def entries(spark: SparkSession, at: Version, table: str = MAIN) -> DataFrame:
    known = at.tables[table]
    return spark.read.schema(StructType.fromJson(json.loads(known.columns))).parquet(known.entries)


def read(
    spark: SparkSession, at: Version, table: str = MAIN, of: Callable[[DataFrame], DataFrame] | None = None, named: str | None = None,
) -> DataFrame:
    """The rows of a table, or of those of its files whose entries `of` keeps; `named` adds the entry's file name to each row."""
    known = at.tables[table]
    if of is None and known.files is not None:
        files = known.files
    else:
        listed = entries(spark, at, table)
        files = [r.file for r in (of(listed) if of is not None else listed).select("file").collect()]
    columns = [F.col(f"`{c}`") for c in known.struct.names]
    if not files:
        empty = spark.createDataFrame([], known.struct)
        return empty.withColumn(named, F.lit("")) if named else empty
    rows = spark.read.schema(known.struct).option("basePath", f"{at.root}/{DATA}").parquet(*[unquote(f) for f in files])
    return rows.select(*columns, *([F.col("_metadata.file_path").alias(named)] if named else []))


def view(spark: SparkSession, path: str, name: str) -> None:
    """Let SQL read a table with commits by a name of the session, as it is now."""
    store, table = resolve(spark, path)
    read(spark, version(spark, store), table).createOrReplaceTempView(name)


def between(zone: str, low, high) -> Callable[[DataFrame], DataFrame]:
    """Entries of files that may hold values of a zone column from low to high."""
    return lambda listed: listed.filter((F.col(f"high_{zone}") >= F.lit(low)) & (F.col(f"low_{zone}") <= F.lit(high)))


def fingerprints(columns) -> list[Column]:
    """(h1, h2) of the rows of a group: sums of two hashes of a row, whatever their order. NULL differs from any text."""
    row = F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns])
    told = {"h1": row, "h2": F.xxhash64(F.lit("again"), row)}
    return [F.coalesce(_exact_sum(h), F.lit(0)).cast("decimal(38,0)").alias(name) for name, h in told.items()]


def _exact_sum(number: Column) -> Column:
    """Sum of longs beyond the range of a long: pieces of 22 bits are added as longs, because adding decimals row by row is slow."""
    low = (1 << 22) - 1
    pieces = (number.bitwiseAND(F.lit(low)), F.shiftright(number, 22).bitwiseAND(F.lit(low)), F.shiftright(number, 44))
    return reduce(lambda a, b: a + b, [F.sum(p).cast("decimal(20,0)") * F.lit(Decimal(1 << 22 * i)) for i, p in enumerate(pieces)])


def _written(spark: SparkSession, root: str, change: Change) -> DataFrame:
    """Entries of the files of a change's rows, which are written here."""
    base = f"{root}/{DATA}"
    place = f"{base}/{WRITING}={uuid.uuid4().hex}"
    rows, parts = change.rows, list(change.partition_by)
    if parts and change.rebalance:
        rows = rows.hint("rebalance", *parts)
    rows.write.partitionBy(*parts).option("compression", "zstd").parquet(place)
    schema = StructType([rows.schema[c] for c in rows.columns])
    back = spark.read.schema(schema).option("basePath", base).parquet(place)
    stats = [F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_size").alias("bytes")]
    stats += [F.first(F.col(c).cast("string")).alias(f"part_{c}") for c in parts]
    stats += [f(c).alias(f"{name}_{c}") for c in change.zones for name, f in (("low", F.min), ("high", F.max))]
    if change.fingerprint:
        stats += fingerprints(change.fingerprint)
    return back.groupBy(F.col("_metadata.file_path").alias("file")).agg(*stats)


def _merged(before: StructType | None, now: StructType | None) -> StructType:
    """Columns of both, the older first; a column that changes its type is an error."""
    if before is None or now is None:
        return before or now
    types = {f.name: f.dataType for f in before.fields}
    for f in now.fields:
        if types.get(f.name, f.dataType) != f.dataType:
            raise ValueError(f"column {f.name} changes from {types[f.name].simpleString()} to {f.dataType.simpleString()}")
    return StructType(before.fields + [f for f in now.fields if f.name not in types])


def publish(
    spark: SparkSession, root: str, changes: dict[str, Change], base: Version | None = None, attempts: int = 5,
) -> tuple[Version, dict[str, int]]:
    """Write the new rows of some tables and commit them together; the new version, and the rows added to each table.

    Tables that are not named stay. With `base`, the version from which the rows were derived, a commit by another writer in
    between is an error. Without it the change does not depend on what the table holds, and is put on top of the other's.
    """
    root = root.rstrip("/")
    with_rows = {name: change for name, change in changes.items() if change.rows is not None}
    with shuffles_removed(spark):
        fresh = together({name: partial(_stored, spark, root, name, partial(_written, spark, root, change)) for name, change in with_rows.items()})
    added = {name: found.rows for name, found in fresh.items()}
    for _ in range(1 if base is not None else attempts):
        now = base if base is not None else version(spark, root)
        tables = dict(now.tables) if now else {}
        tables |= together({name: partial(_next, spark, root, now, name, change, fresh.get(name)) for name, change in changes.items()})
        number = now.number + 1 if now else 0
        told = json.dumps({"tables": {n: asdict(t) for n, t in tables.items()}})
        if _write_new(spark, f"{root}/{COMMITS}/{number:012d}.json", told):
            return Version(root, number, tables), added
    raise CommitConflict(f"version {number} of {root} was committed by another writer")


def _stored(spark: SparkSession, root: str, name: str, make: Callable[[], DataFrame]) -> Table:
    """Entries written to a file of their own, one row a data file; a table of them, as yet without schema."""
    place, rows = f"{root}/{ENTRIES}/{name}-{uuid.uuid4().hex}", make()
    rows.coalesce(1).write.parquet(place)
    back = spark.read.schema(rows.schema).parquet(place)
    some = back.select("file", "rows").limit(NAMED + 1).collect()
    few = len(some) <= NAMED
    total = sum(r.rows for r in some) if few else back.agg(F.sum("rows")).first()[0]
    return Table(place, rows.schema.json(), "", total, files=[r.file for r in some] if few else None)


def _next(spark: SparkSession, root: str, now: Version | None, name: str, change: Change, fresh: Table | None) -> Table:
    """A table as it is after a change."""
    old = now.tables.get(name) if now else None
    stays = old is not None and (change.keep is not None or change.replace is not None)
    new = entries(spark, Version(root, 0, {name: fresh}), name) if fresh is not None else None
    parts = []
    if stays and change.keep is not None:
        parts.append(change.keep(entries(spark, now, name)))
    elif stays:
        value = f"part_{change.replace}"
        given = new.select(F.col(value).alias("_value")).distinct()
        parts.append(entries(spark, now, name).join(given, F.col(value).eqNullSafe(F.col("_value")), "left_anti"))
    parts += [change.adopted] if change.adopted is not None else []
    if parts or fresh is None:
        union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts + ([new] if new is not None else []))
        fresh = _stored(spark, root, name, lambda: union)
    schema = change.rows.schema if change.rows is not None else change.schema
    if not stays:
        return dataclasses.replace(fresh, schema=schema.json(), partition_by=list(change.partition_by), zones=list(change.zones))
    # a zone counts only if all files have it
    zones = old.zones if change.rows is None else [z for z in change.zones if z in old.zones]
    parts_by = old.partition_by if change.rows is None else list(change.partition_by)
    return dataclasses.replace(fresh, schema=_merged(old.struct, schema).json(), partition_by=parts_by, zones=zones)


def overwrite(spark: SparkSession, root: str, rows: DataFrame, partition_by=(), zones=()) -> int:
    """Replace a whole table, whatever its schema was; readers see the old one until the commit."""
    _, added = publish(spark, root, {MAIN: Change(rows, None, tuple(partition_by), tuple(zones))})
    return added[MAIN]


def append(spark: SparkSession, root: str, rows: DataFrame, partition_by=(), zones=()) -> int:
    _, added = publish(spark, root, {MAIN: Change(rows, lambda listed: listed, tuple(partition_by), tuple(zones))})
    return added[MAIN]


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Remove all versions but the newest `keep`, and the files that none of those names; how many files went.

    Not while another writer is between writing and committing: its files are not named yet.
    """
    root = root.rstrip("/")
    known = numbers(spark, root)
    stay = [version(spark, root, n) for n in known[-keep:]]
    wanted = None
    for at in stay:
        for name in at.tables:
            some = entries(spark, at, name).select("file")
            wanted = some if wanted is None else wanted.unionByName(some)
    named = {unquote(urlsplit(r.file).path) for r in wanted.distinct().toLocalIterator()} if wanted is not None else set()
    listed = {t.entries.rsplit("/", 1)[-1] for at in stay for t in at.tables.values()}
    gone = 0
    base, fs = _path(spark, f"{root}/{DATA}")
    if fs.exists(base):
        found, doomed = fs.listFiles(base, True), []
        while found.hasNext():
            place = found.next().getPath()
            if place.getName().endswith(".parquet") and place.toUri().getPath() not in named:
                doomed.append(place)
        for place in doomed:
            gone += fs.delete(place, False)
    for number in known[:-keep]:
        fs.delete(_path(spark, f"{root}/{COMMITS}/{number:012d}.json")[0], False)
    for name in _names(spark, f"{root}/{ENTRIES}"):
        if name not in listed:
            fs.delete(_path(spark, f"{root}/{ENTRIES}/{name}")[0], True)
    return gone


# --- changes at file grain -------------------------------------------------------------------------


def key_ranges(source: DataFrame, keys: list[str]) -> DataFrame:
    """At most RANGES rows (low_k, high_k for every key) that cover the keys of a source."""
    spread = source.select(*keys).dropna().repartitionByRange(RANGES, *keys)
    stats = [f(k).alias(f"{name}_{k}") for k in keys for name, f in (("from", F.min), ("to", F.max))]
    return spread.groupBy(F.spark_partition_id().alias("range")).agg(*stats).drop("range")


def touched_files(spark: SparkSession, at: Version, source: DataFrame, keys: list[str], table: str = MAIN) -> DataFrame:
    """Entries of the files that hold a key of the source.

    The zones tell which files may; of those the key columns alone are read.
    """
    listed = entries(spark, at, table)
    zoned = [k for k in keys if k in at.tables[table].zones]
    near = listed
    if zoned:
        # at most RANGES rows against one row a file
        ranges = F.broadcast(key_ranges(source, zoned))
        meets = None
        for k in zoned:
            one = (F.col(f"low_{k}") <= F.col(f"to_{k}")) & (F.col(f"high_{k}") >= F.col(f"from_{k}"))
            meets = one if meets is None else meets & one
        near = listed.join(ranges, meets, "left_semi")
    rows = read(spark, at, table, lambda _: near, named="_file").select("_file", *keys)
    hit = rows.join(source.select(*keys).dropna().distinct(), keys, "left_semi").select(F.col("_file").alias("file")).distinct()
    return listed.join(hit, "file", "left_semi")


def merge(
    spark: SparkSession, root: str, source: DataFrame, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame],
    table: str = MAIN, also: dict[str, Change] | None = None,
) -> Version:
    """Change a table by a source: only files that hold one of its keys are read in full and written anew.

    `combine(rows of those files, source)` gives what stands in their place. New files are cut by ranges of the keys, a
    key with very many rows over several, so that zones stay narrow. Repeated calls in parallel: one of them fails.
    """
    at = version(spark, root)
    if at is None or table not in at.tables:
        raise ValueError(f"no table {table} at {root}")
    known = at.tables[table]
    touched = touched_files(spark, at, source, keys, table)
    place = f"{root.rstrip('/')}/{ENTRIES}/touched-{uuid.uuid4().hex}"
    touched.select("file").coalesce(1).write.parquet(place)
    touched = spark.read.parquet(place)
    before = read(spark, at, table, lambda listed: listed.join(touched, "file", "left_semi"))
    rows = combine(before, source)
    # a second column of the order spreads a key with many rows
    order = [*[F.col(k) for k in keys], F.xxhash64(*rows.columns)]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*keys)
    change = Change(rows, lambda listed: listed.join(touched, "file", "left_anti"), tuple(known.partition_by), tuple(known.zones))
    return publish(spark, root, {table: change} | (also or {}), base=at)[0]


def remove(
    spark: SparkSession, root: str, condition: Column, table: str = MAIN, into: str | None = None,
) -> int:
    """Delete the rows for which a condition is true, or move them to another table of the store; how many they were.

    Files without such a row stay, files with nothing else are dropped or handed over as they are, and only
    those with both kinds are written anew. One commit.
    """
    at = version(spark, root)
    if at is None or table not in at.tables:
        return 0
    known, doomed = at.tables[table], F.coalesce(condition, F.lit(False))
    hits = read(spark, at, table, named="_file").filter(doomed).groupBy(F.col("_file").alias("file")).agg(F.count(F.lit(1)).alias("hits"))
    place = f"{root.rstrip('/')}/{ENTRIES}/removed-{uuid.uuid4().hex}"
    entries(spark, at, table).join(hits, "file").coalesce(1).write.parquet(place)
    met = spark.read.parquet(place)
    total = met.agg(F.coalesce(F.sum("hits"), F.lit(0))).first()[0]
    if not total:
        return 0
    whole, mixed = met.filter("hits = rows").drop("hits"), met.filter("hits < rows")
    split = None if mixed.isEmpty() else read(spark, at, table, lambda listed: listed.join(mixed, "file", "left_semi"))
    parts, zones = tuple(known.partition_by), tuple(known.zones)
    changes = {table: Change(
        None if split is None else split.filter(~doomed), lambda listed: listed.join(met, "file", "left_anti"), parts, zones)}
    if into is not None:
        changes[into] = Change(
            None if split is None else split.filter(doomed), lambda listed: listed, parts, zones, adopted=whole, schema=known.struct)
    publish(spark, root, changes, base=at)
    return total
