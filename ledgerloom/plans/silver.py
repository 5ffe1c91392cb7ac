"""Raw transactions to fact and quarantine."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import dimensions, facts, quality, quarantine, rules
from ledgerloom.operators.validation import record_of
from ledgerloom.plans.bronze import contents
from ledgerloom.session import new_location, together
from ledgerloom.sources import versions
from ledgerloom.sources.readers import is_path, read_table
from ledgerloom.sources.sinks import write_table


def transform(
    raw: DataFrame, row_rules: list[rules.Rule] | None = None, at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(fact rows, quarantine rows), each with the number of its record. Both are narrow: one scan each, no shuffle."""
    row_rules = row_rules if row_rules is not None else rules.transaction_rules()
    columns = schemas.BUSINESS_COLUMNS["transactions"]
    valid = rules.valid_rows(raw, row_rules).withColumn("record", record_of(columns))
    rejected = quarantine.by_reason(rules.invalid_records(raw, row_rules), columns)
    return facts.build_fact(valid, created_at=at), quarantine.to_quarantine(rejected, "transactions_raw", at=at)


def with_load(raw: DataFrame) -> DataFrame:
    """Name each row's load: the partition it was loaded into, or else its batch. Never NULL."""
    if "_load" in raw.columns:
        name = F.coalesce(F.col("_load"), F.lit("load"))
    else:
        # prefixed, so that a numeric batch id is not read back as a number
        name = F.concat(F.lit("batch"), F.coalesce(F.concat(F.lit("_"), F.col("_batch_id")), F.lit("")))
    return raw.withColumn("load", name)


def load_states(raw: DataFrame) -> DataFrame:
    """(load, n, h1, h2): a load changes when its contents do, whatever their order and its clock."""
    return raw.groupBy("load").agg(F.count(F.lit(1)).alias("n"), *versions.fingerprints(contents([c for c in raw.columns if c != "load"])))


def month_key() -> Column:
    """Month of the transaction: a day per directory would give tiny files."""
    return F.floor(F.col("date_key") / 100).cast("int")


QUARANTINE, LOADS = "quarantine", "loads"


def _opened(spark: SparkSession, raw_table: str):
    """(states, rows of loads): of a raw table with commits the states come from its entries, and rows are read load by load.

    Both are pinned to the version that is newest now.
    """
    found = versions.resolve(spark, raw_table) if is_path(raw_table) else None
    if found is None:
        raw = with_load(read_table(spark, raw_table))
        return load_states(raw), lambda loads: raw if loads is None else raw.join(loads, "load", "left_semi")
    at, table = versions.version(spark, found[0]), found[1]
    sums = [F.sum(c).cast("decimal(38,0)").alias(c) for c in ("h1", "h2")]
    states = versions.entries(spark, at, table).groupBy(F.coalesce("part__load", F.lit("load")).alias("load")).agg(F.sum("rows").alias("n"), *sums)

    def rows(loads: DataFrame | None) -> DataFrame:
        name = F.coalesce(F.col("part__load"), F.lit("load"))
        of = None if loads is None else lambda listed: listed.join(loads, name == loads["load"], "left_semi")
        return with_load(versions.read(spark, at, table, of))

    return states, rows


def fact_changes(fact: DataFrame, rejected: DataFrame, done: DataFrame | None) -> dict[str, versions.Change]:
    """Fact and quarantine rows as one commit, in the place of what they held of the loads `done`; of everything if None."""

    def keep(listed: DataFrame) -> DataFrame:
        return listed.join(done, listed["part_load"] == done["load"], "left_anti")

    stays = None if done is None else keep
    return {
        versions.MAIN: versions.Change(fact.withColumn("month_key", month_key()), stays, ("load", "month_key"), ("date_key", "transaction_timestamp")),
        QUARANTINE: versions.Change(rejected, stays, ("load",), ("quarantine_date",), rebalance=False),
    }


def transform_transactions(
    spark: SparkSession,
    raw_table: str,
    fact_table: str,
    quarantine_table: str,
    incremental: bool = True,
    since_batch_id: str | None = None,
    gate: str | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Process new or changed loads and return the quality report, one row per check.

    A load is a partition of the raw table, or a batch where the raw table has none; a NULL batch
    is a load like any other. Incremental runs take the batches from `since_batch_id` on, or the
    loads whose state (row count and fingerprint of the contents) is not the one last processed, also if it was known
    once before. Fact, quarantine and processed states change in one commit: a reader sees all of a run or nothing, and a run
    that died is simply run again, on whatever day. Full runs replace everything. The quarantine lives in the
    fact's store; its own path leads there. With a `gate` environment the run stops before writing when
    a threshold is breached and the environment demands it.
    """
    if not is_path(fact_table):
        raise ValueError("fact and quarantine are tables with commits: give paths")
    states, rows_of = _opened(spark, raw_table)
    known = versions.version(spark, fact_table)
    logged = known is not None and LOADS in known.tables
    processed = versions.read(spark, known, LOADS) if logged else None
    todo = states
    if incremental and since_batch_id is not None:
        todo = states.join(facts.since_batch(rows_of(None), since_batch_id).select("load").distinct(), "load", "left_semi")
    elif incremental and logged:
        todo = states.join(processed, ["load", "n", "h1", "h2"], "left_anti")
    pending = new_location(spark, "pending_loads")
    # one row a load
    write_table(todo.hint("rebalance"), pending, mode="overwrite")
    todo = spark.read.schema(todo.schema).parquet(pending)
    raw = rows_of(todo.select("load") if incremental else None)

    report = quality.run_checks(raw.drop("load"), quality.transaction_suite())
    if incremental and todo.isEmpty():
        return report
    if gate is not None:
        quality.enforce_gate(quality.threshold_gate(report, gate))

    fact, rejected = transform(raw, at=at)
    done = todo.select("load") if incremental else None
    others = processed.join(todo.select("load"), "load", "left_anti") if incremental and logged else None
    log = todo if others is None else others.unionByName(todo)
    versions.link(spark, quarantine_table, fact_table, QUARANTINE)
    versions.publish(spark, fact_table, fact_changes(fact, rejected, done) | {LOADS: versions.Change(log.coalesce(1))})
    return report


def replay_quarantine(
    spark: SparkSession, fact_table: str, fix: Callable[[DataFrame], DataFrame] | None = None,
    batch_id: str | None = None, at: Column | None = None,
) -> dict[str, int]:
    """Send quarantined records through the rules again, after `fix` has changed their raw columns; records by what became of them.

    Accepted ones become facts of their load and leave the quarantine in one commit: before it nothing has happened, after
    it they are no longer there to be replayed, so a run that died is run again and each record counts once. Only files of the
    quarantine that hold an accepted record are written anew. The others stay as they were rejected.
    """
    base = versions.version(spark, fact_table)
    held = versions.read(spark, base, QUARANTINE)
    records = quarantine.replay(held, schemas.raw("transactions"), batch_id=batch_id)
    # the number of the rejected record stays its own, whatever is fixed in it
    again = fix(records) if fix is not None else records
    valid = rules.valid_rows(again, rules.transaction_rules())
    place = new_location(spark, "replayed")
    write_table(facts.build_fact(valid, created_at=at).withColumn("month_key", month_key()), place, mode="overwrite")
    accepted = spark.read.parquet(place)
    gone = accepted.select("load", "record").distinct()
    files = new_location(spark, "replayed_files")
    named = versions.read(spark, base, QUARANTINE, named="_file").join(gone, ["load", "record"], "left_semi")
    named.select(F.col("_file").alias("file")).distinct().write.parquet(files)
    touched = spark.read.schema("file string").parquet(files)
    stay = versions.read(spark, base, QUARANTINE, lambda e: e.join(touched, "file", "left_semi")).join(gone, ["load", "record"], "left_anti")
    total, done = records.count(), accepted.count()
    if done:
        known = base.tables
        versions.publish(spark, fact_table, {
            versions.MAIN: versions.Change(accepted, lambda e: e, tuple(known[versions.MAIN].partition_by), tuple(known[versions.MAIN].zones)),
            QUARANTINE: versions.Change(
                stay, lambda e: e.join(touched, "file", "left_anti"), tuple(known[QUARANTINE].partition_by), tuple(known[QUARANTINE].zones)),
        }, base=base)
    return {"replayed": total, "accepted": done, "rejected": total - done}


def table_exists(spark: SparkSession, reference: str) -> bool:
    if not is_path(reference):
        return spark.catalog.tableExists(reference)
    if (found := versions.resolve(spark, reference)) is not None:
        return (now := versions.version(spark, found[0])) is not None and found[1] in now.tables
    try:
        return bool(spark.read.parquet(reference).columns)
    except AnalysisException:
        return False


def build_all_dimensions(
    spark: SparkSession, raw_tables: dict[str, str], targets: dict[str, str],
    start_year: int = 2020, end_year: int = 2030,
) -> dict[str, int]:
    """Write the four dimensions, each in one commit, and return their row counts."""
    built = {
        "dim_customer": dimensions.dim_customer(read_table(spark, raw_tables["customers"])),
        "dim_account": dimensions.dim_account(read_table(spark, raw_tables["accounts"])),
        "dim_merchant": dimensions.dim_merchant(read_table(spark, raw_tables["merchants"])),
        "dim_date": dimensions.dim_date(dimensions.calendar_days(spark, start_year, end_year)),
    }
    return together({name: partial(versions.overwrite, spark, targets[name], table) for name, table in built.items()})


def build_dim_account(spark: SparkSession, raw_table: str, target: str, scd_type: int = 2) -> int:
    """Write the account dimension and return its row count; types as for customers."""
    raw = read_table(spark, raw_table)
    if scd_type == 1:
        return versions.overwrite(spark, target, dimensions.dim_account(raw))
    return versions.overwrite(spark, target, dimensions.dim_account_history(raw).sortWithinPartitions("_is_current"))


def build_dim_customer(spark: SparkSession, raw_table: str, target: str, scd_type: int = 2) -> int:
    """Write the customer dimension and return its row count: the latest record per customer
    (type 1), or all versions (type 2), sorted by currentness so that lookups of current rows
    skip the past."""
    raw = read_table(spark, raw_table)
    if scd_type == 1:
        return versions.overwrite(spark, target, dimensions.dim_customer(raw))
    return versions.overwrite(spark, target, dimensions.dim_customer_history(raw).sortWithinPartitions("_is_current"))
