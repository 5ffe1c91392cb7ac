"""Registered queries that write and read back: scans, sinks, loads, streams, whole runs.

Files go to a fresh place below the shared folder of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import reference_data as ref
from ledgerloom.operators import asof, history
from ledgerloom.plans import bronze, gold as gold_plan, layers, silver
from ledgerloom.registry.base import ORACLES, query
from ledgerloom.registry.gold import NEWEST
from ledgerloom.registry.oracle import sql
from ledgerloom.registry.quality import KEPT, SUITE, _slim
from ledgerloom.registry.silver import FACT_ROWS, _clock
from ledgerloom.session import new_location, shuffles_removed
from ledgerloom.sources import layout, readers, sinks, star, versions
from ledgerloom.streaming import bronze_stream, silver_stream

BUSINESS = schemas.BUSINESS_COLUMNS
ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority"


# --- scans -----------------------------------------------------------------------------------


@query("scan_csv", f"SELECT {ORDERS} FROM orders")
def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    orders, path = star.table(spark, d, "orders"), new_location(spark, "csv")
    orders.write.csv(path, header=True)
    return readers.read_csv(spark, path, schema=orders.schema)


@query("scan_csv_inferred", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_acctbal FROM customer")
def scan_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    path = new_location(spark, "csv")
    star.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.csv(path, header=True)
    return readers.read_csv(spark, path)


@query("scan_json", f"SELECT {ORDERS} FROM orders")
def scan_json(spark: SparkSession, d: str) -> DataFrame:
    orders, path = star.table(spark, d, "orders"), new_location(spark, "json")
    orders.write.json(path)
    return readers.read_json(spark, path, schema=orders.schema)


@query("scan_parquet", f"SELECT {ORDERS} FROM orders")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_parquet(spark, f"{d}/orders.parquet")


@query("scan_table_asof", sql("""
SELECT transaction_id, _batch_id, 'batch' AS kind FROM raw WHERE _batch_id <= 'B199612'
UNION ALL SELECT transaction_id, _batch_id, 'time' FROM raw WHERE _ingestion_timestamp <= TIMESTAMP '1995-06-01'""", "raw"))
def scan_table_asof(spark: SparkSession, d: str) -> DataFrame:
    """The raw log as it stood after a batch, and at a moment."""
    log = star.raw_transactions(spark, d).select("transaction_id", "_batch_id", "_ingestion_timestamp")
    by_batch = readers.as_of(log, up_to_batch="B199612").withColumn("kind", F.lit("batch"))
    by_time = readers.as_of(log, timestamp="1995-06-01").withColumn("kind", F.lit("time"))
    return by_batch.unionByName(by_time).drop("_ingestion_timestamp")


@query("scan_catalog_table", f"SELECT {ORDERS} FROM orders")
def scan_catalog_table(spark: SparkSession, d: str) -> DataFrame:
    name = f"orders_{uuid.uuid4().hex[:12]}"
    location = new_location(spark, "catalog")
    sinks.write_table(star.table(spark, d, "orders"), name, location=location)
    return readers.read_table(spark, name)


# --- sinks -----------------------------------------------------------------------------------


@query("sink_append", f"SELECT {ORDERS} FROM orders UNION ALL SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F'")
def sink_append(spark: SparkSession, d: str) -> DataFrame:
    orders, path = star.table(spark, d, "orders"), new_location(spark, "append")
    sinks.append(orders, path)
    sinks.append(orders.filter("o_orderstatus = 'F'"), path)
    return readers.read_table(spark, path)


@query("sink_overwrite", f"SELECT {ORDERS} FROM orders WHERE o_orderstatus = 'F'")
def sink_overwrite(spark: SparkSession, d: str) -> DataFrame:
    orders, path = star.table(spark, d, "orders"), new_location(spark, "overwrite")
    sinks.overwrite(orders, path)
    sinks.overwrite(orders.filter("o_orderstatus = 'F'"), path)
    return readers.read_table(spark, path)


@query("sink_partitioned", """
SELECT o_orderkey, o_orderpriority, year(o_orderdate) AS order_year FROM orders WHERE year(o_orderdate) = 1998""")
def sink_partitioned(spark: SparkSession, d: str) -> DataFrame:
    """Written by year; the filter then lists one directory."""
    path = new_location(spark, "partitioned")
    orders = star.table(spark, d, "orders").withColumn("order_year", F.year("o_orderdate"))
    sinks.append(orders, path, partition_by=["order_year"])
    written = readers.read_table(spark, path).filter("order_year = 1998")
    return written.select("o_orderkey", "o_orderpriority", "order_year")


@query("sink_overwrite_partitions", """
SELECT year(o_orderdate) AS order_year, count(*) FILTER (WHERE year(o_orderdate) <> 1998 OR o_orderstatus = 'F') AS n
FROM orders GROUP BY 1""")
def sink_overwrite_partitions(spark: SparkSession, d: str) -> DataFrame:
    """One year is replaced by its completed orders, twice; the other years stay."""
    path = new_location(spark, "partitions")
    orders = star.table(spark, d, "orders").withColumn("order_year", F.year("o_orderdate"))
    sinks.overwrite(orders, path, partition_by=["order_year"])
    redone = orders.filter("order_year = 1998 AND o_orderstatus = 'F'")
    for _ in range(2):
        sinks.overwrite_partitions(spark, redone, path, ["order_year"])
    return readers.read_table(spark, path).groupBy("order_year").agg(F.count(F.lit(1)).alias("n"))


@query("sink_merge_upsert", """
WITH source AS (SELECT DISTINCT l_orderkey, l_linenumber, 9.0::DOUBLE AS l_quantity FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT -o_orderkey - 1, 1, 9.0 FROM orders)
SELECT t.l_orderkey, t.l_linenumber, coalesce(s.l_quantity, t.l_quantity) AS l_quantity
FROM lineitem t LEFT JOIN source s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM source WHERE l_orderkey < 0""")
def sink_merge_upsert(spark: SparkSession, d: str) -> DataFrame:
    """Upsert on a two-column key; the target holds repeated keys, all of which change."""
    path = new_location(spark, "upsert")
    target = star.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    versions.overwrite(spark, path, target.repartitionByRange("l_orderkey"), zones=["l_orderkey", "l_linenumber"])
    nine = F.lit(9.0).alias("l_quantity")
    returned = star.table(spark, d, "lineitem").filter("l_returnflag = 'R'")
    changed = returned.select("l_orderkey", "l_linenumber", nine).distinct()
    added = star.table(spark, d, "orders").select(
        (-F.col("o_orderkey") - 1).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), nine
    )
    sinks.upsert_to(spark, path, changed.unionByName(added), ["l_orderkey", "l_linenumber"])
    return readers.read_table(spark, path)


@query("sink_delete_where", KEPT)
def sink_delete_where(spark: SparkSession, d: str) -> DataFrame:
    path = new_location(spark, "delete")
    versions.overwrite(spark, path, _slim(spark, d), partition_by=["batch_id"])
    doomed = sinks.removal_condition("transactions_raw", older_than_days=365, as_of=F.lit("2001-11-05").cast("date"))
    sinks.delete_from(spark, path, doomed)
    return readers.read_table(spark, path).drop("source_table")


@query("drop_and_rebuild", "SELECT c_custkey, c_name FROM customer")
def drop_and_rebuild(spark: SparkSession, d: str) -> DataFrame:
    """A table is replaced as a whole, whatever schema it had before."""
    path = new_location(spark, "rebuild")
    versions.overwrite(spark, path, star.table(spark, d, "supplier"))
    versions.overwrite(spark, path, star.table(spark, d, "customer").select("c_custkey", "c_name"))
    return readers.read_table(spark, path)


@query("compact_cluster", """
SELECT l_orderkey, l_suppkey, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate, l_quantity FROM lineitem""")
def compact_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Small files put together, then rewritten near by ship date and supplier at once."""
    path = new_location(spark, "clustered")
    lines = star.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity")
    versions.overwrite(spark, path, lines.repartition(16))
    layout.compact(spark, path)
    layout.cluster(spark, path, ["l_shipdate", "l_suppkey"])
    return readers.read_table(spark, path)


# --- raw loads ---------------------------------------------------------------------------------


def _loaded(table: DataFrame, source: str) -> DataFrame:
    return table.select("_batch_id", "_source_system", "_ingestion_timestamp", *BUSINESS[source])


def _loaded_sql(source: str, relation: str, system: str, batch: str) -> str:
    return (
        f"SELECT '{batch}' AS _batch_id, '{system}' AS _source_system, '2002-01-01 06:00:00' AS _ingestion_timestamp, "
        + ", ".join(BUSINESS[source]) + f" FROM {relation}"
    )


# a CSV field without text reads as NULL, so the empty currency does not survive
CSV_DELIVERED = "(SELECT * REPLACE (nullif(currency, '') AS currency) FROM delivered)"


@query("load_transactions_csv", sql(_loaded_sql("transactions", CSV_DELIVERED, "file_ingest", "B1"), "delivered"))
def load_transactions_csv(spark: SparkSession, d: str) -> DataFrame:
    landing, target = new_location(spark, "landing"), new_location(spark, "transactions_raw")
    star.delivered_transactions(spark, d).drop("q", "shipped").write.csv(landing, header=True)
    bronze.load_csv(spark, landing, "transactions", target, "B1", ingested_at=_clock())
    return _loaded(readers.read_table(spark, target), "transactions")


@query("load_transactions_json", sql(_loaded_sql("transactions", "delivered", "file_ingest", "B2"), "delivered"))
def load_transactions_json(spark: SparkSession, d: str) -> DataFrame:
    landing, target = new_location(spark, "landing"), new_location(spark, "transactions_raw")
    # every line names all fields: compressed it is a tenth. Such a file is read by one task, so none has very many rows
    with shuffles_removed(spark):
        star.delivered_transactions(spark, d).drop("q", "shipped").write.option("maxRecordsPerFile", 500_000).json(landing, compression="gzip")
    bronze.load_json(spark, landing, "transactions", target, "B2", ingested_at=_clock())
    return _loaded(readers.read_table(spark, target), "transactions")


@query("load_transactions_df", sql(_loaded_sql("transactions", "delivered", "orders", "B3"), "delivered"))
def load_transactions_df(spark: SparkSession, d: str) -> DataFrame:
    target = new_location(spark, "transactions_raw")
    bronze.load_dataframe(
        star.delivered_transactions(spark, d), "transactions", target, "B3", "lineitem", "orders", _clock()
    )
    return _loaded(readers.read_table(spark, target), "transactions")


@query("load_customers", sql(_loaded_sql("customers", "customer_deliveries", "crm", "B1"), "customer_deliveries"))
def load_customers(spark: SparkSession, d: str) -> DataFrame:
    landing, target = new_location(spark, "landing"), new_location(spark, "customers_raw")
    star.customer_deliveries(spark, d).write.csv(landing, header=True)
    bronze.load_csv(spark, landing, "customers", target, "B1", "crm", _clock())
    return _loaded(readers.read_table(spark, target), "customers")


@query("load_accounts", sql(_loaded_sql("accounts", "accounts", "core", "B1"), "accounts"))
def load_accounts(spark: SparkSession, d: str) -> DataFrame:
    landing, target = new_location(spark, "landing"), new_location(spark, "accounts_raw")
    star.accounts(spark, d).write.csv(landing, header=True)
    bronze.load_csv(spark, landing, "accounts", target, "B1", "core", _clock())
    return _loaded(readers.read_table(spark, target), "accounts")


@query("load_merchants", sql(_loaded_sql("merchants", "merchants", "erp", "B1"), "merchants"))
def load_merchants(spark: SparkSession, d: str) -> DataFrame:
    target = new_location(spark, "merchants_raw")
    bronze.load_dataframe(star.merchant_records(spark, d), "merchants", target, "B1", "supplier", "erp", _clock())
    return _loaded(readers.read_table(spark, target), "merchants")


# --- silver and gold plans -----------------------------------------------------------------------

HASHED = ("transaction_key", "customer_key", "account_key", "merchant_key", "record")


def _processed(spark: SparkSession, d: str) -> tuple[str, str, DataFrame]:
    """Raw table written in two halves, each processed by its own incremental run."""
    raw_table, fact_table, rejects = (new_location(spark, n) for n in ("raw", "fact", "quarantine"))
    raw = star.raw_transactions(spark, d)
    for half in (F.col("_batch_id") < "B199806", F.col("_batch_id") >= "B199806"):
        sinks.append(raw.filter(half), raw_table)
        report = silver.transform_transactions(spark, raw_table, fact_table, rejects, at=_clock())
    silver.transform_transactions(spark, raw_table, fact_table, rejects, at=_clock())  # nothing new: no change
    return fact_table, rejects, report


@query("transform_transactions", sql(FACT_ROWS, "typed", "rates"))
def transform_transactions(spark: SparkSession, d: str) -> DataFrame:
    fact_table, _, _ = _processed(spark, d)
    return readers.read_table(spark, fact_table).drop(*HASHED, "load", "month_key")


@query("transform_rejects", sql("""
SELECT reason AS rejection_reason, _batch_id AS batch_id, count(*) AS n FROM rejected GROUP BY ALL""", "rejected"))
def transform_rejects(spark: SparkSession, d: str) -> DataFrame:
    _, rejects, _ = _processed(spark, d)
    return readers.read_table(spark, rejects).groupBy("rejection_reason", "batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("transform_report", sql(SUITE, "raw"))
def transform_report(spark: SparkSession, d: str) -> DataFrame:
    raw_table, fact_table, rejects = (new_location(spark, n) for n in ("raw", "fact", "quarantine"))
    sinks.append(star.raw_transactions(spark, d), raw_table)
    return silver.transform_transactions(spark, raw_table, fact_table, rejects, incremental=False)


def _count_rows(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "table_name string, records bigint")


@query("build_all_dimensions", sql("""
SELECT 'dim_customer' AS table_name, count(DISTINCT customer_id) AS records FROM customer_deliveries
UNION ALL SELECT 'dim_account', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'dim_merchant', count(DISTINCT l_suppkey) FROM lineitem
UNION ALL SELECT 'dim_date', 2557""", "customer_deliveries"))
def build_all_dimensions(spark: SparkSession, d: str) -> DataFrame:
    root = new_location(spark, "dimensions")
    sources = {
        "customers": star.customer_deliveries(spark, d),
        "accounts": star.account_deliveries(spark, d),
        "merchants": star.merchant_deliveries(spark, d),
    }
    for name, rows in sources.items():
        sinks.write_table(rows, f"{root}/{name}_raw", mode="overwrite")
    return _count_rows(spark, silver.build_all_dimensions(
        spark, {n: f"{root}/{n}_raw" for n in sources},
        {t: f"{root}/{t}" for t in layers.DIMENSIONS}, 1995, 2001,
    ))


def _group_count(name: str, columns: str, relation: str = "fact") -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS records FROM (SELECT DISTINCT {columns} FROM {relation})"


COMPLETED = "fact WHERE status = 'COMPLETED'"
ANALYTICS_COUNTS = " UNION ALL ".join([
    _group_count("revenue_summary", "date_key, channel, transaction_type, status, country_code"),
    _group_count("customer_analytics", "customer_key", COMPLETED),
    _group_count("merchant_analytics", "merchant_key", COMPLETED),
    _group_count("channel_performance", "date_key // 100, channel"),
    _group_count("geographic_summary", "year(full_date), quarter(full_date), country_code"),
])
KPI_COUNTS = " UNION ALL ".join([
    _group_count("daily_kpis", "date_key", COMPLETED),
    _group_count("monthly_kpis", "date_key // 100", COMPLETED),
    "SELECT 'executive_summary', 1",
])


@query("gold_build_all", sql(ANALYTICS_COUNTS, "fact"))
def gold_build_all(spark: SparkSession, d: str) -> DataFrame:
    tables = gold_plan.analytics_tables(
        star.fact(spark, d), star.customers(spark, d), star.merchants(spark, d), star.calendar(spark)
    )
    return _count_rows(spark, gold_plan.write_all(tables, new_location(spark, "gold")))


@query("kpi_build_all", sql(KPI_COUNTS, "fact"))
def kpi_build_all(spark: SparkSession, d: str) -> DataFrame:
    tables = gold_plan.kpi_tables(star.fact(spark, d), star.calendar(spark))
    return _count_rows(spark, gold_plan.write_all(tables, new_location(spark, "kpis")))


def _deliveries(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "transactions": star.delivered_transactions(spark, d),
        "customers": star.customer_records(spark, d),
        "accounts": star.accounts(spark, d),
        "merchants": star.merchant_records(spark, d),
    }


SILVER_COUNTS = """
SELECT 'fact_transactions' AS table_name, count(*) AS records FROM typed
UNION ALL SELECT 'quarantine', count(*) FROM rejected UNION ALL SELECT 'dim_customer', count(*) FROM customer
UNION ALL SELECT 'dim_account', count(*) FROM orders UNION ALL SELECT 'dim_merchant', count(*) FROM supplier
UNION ALL SELECT 'dim_date', 2557"""
DONE = "typed WHERE status = 'COMPLETED'"
ALL_COUNTS = " UNION ALL ".join([
    SILVER_COUNTS,
    "SELECT 'transactions_raw', count(*) FROM lineitem UNION ALL SELECT 'customers_raw', count(*) FROM customer",
    "SELECT 'accounts_raw', count(*) FROM orders UNION ALL SELECT 'merchants_raw', count(*) FROM supplier",
    _group_count("revenue_summary", "transaction_date, channel, transaction_type, status, country_code", "typed"),
    _group_count("customer_analytics", "customer_id", DONE),
    _group_count("merchant_analytics", "merchant_id", DONE),
    _group_count("channel_performance", "strftime(transaction_date, '%Y%m'), channel", "typed"),
    _group_count("geographic_summary", "year(transaction_date), quarter(transaction_date), country_code", "typed"),
    _group_count("daily_kpis", "transaction_date", DONE),
    _group_count("monthly_kpis", "strftime(transaction_date, '%Y%m')", DONE),
    "SELECT 'executive_summary', 1",
])


@query("run_all_layers", sql(ALL_COUNTS, "typed", "rejected"))
def run_all_layers(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries to gold in one run; rows per table of every layer."""
    layout = layers.Layout(new_location(spark, "run"))
    return layers.run(spark, _deliveries(spark, d), layout, "B1", years=(1995, 2001), at=_clock())


@query("full_reprocess", sql(SILVER_COUNTS, "typed", "rejected"))
def full_reprocess(spark: SparkSession, d: str) -> DataFrame:
    layout, rebuilt = layers.Layout(new_location(spark, "run")), layers.Layout(new_location(spark, "again"))
    layers.ingest(_deliveries(spark, d), layout, "B1", _clock())
    return layers.full_reprocess(spark, layout, rebuilt, years=(1995, 2001), at=_clock())


# --- streams ---------------------------------------------------------------------------------


@query("stream_bronze_ingest", sql("""
SELECT 'S1' AS _batch_id, 'core' AS _source_system, '2002-01-01 06:00:00' AS _ingestion_timestamp, account_id, customer_id,
       account_type, account_number, balance, currency, status, opened_date, closed_date FROM accounts""", "accounts"))
def stream_bronze_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Account files picked up as a stream, five files in batches of two."""
    landing, target, checkpoint = (new_location(spark, n) for n in ("landing", "accounts_raw", "checkpoint"))
    star.accounts(spark, d).repartition(5).write.parquet(landing)
    delivery = bronze_stream.file_stream(spark, landing, schemas.delivered("accounts"), maxFilesPerTrigger=2)
    rows = bronze_stream.raw_stream(delivery, "accounts", "core", "S1", _clock())
    bronze_stream.ingest_stream(rows, target, checkpoint).awaitTermination()
    return _loaded(readers.read_table(spark, target), "accounts")


def land(rows: DataFrame, landing: str, batches: int) -> int:
    """Add rows to a landing folder as files that no exchange gathers, two or more for a batch; how many make one of `batches` batches."""

    def files() -> int:
        return sum(name.endswith(".parquet") for name in versions._names(rows.sparkSession, landing))

    most, before = -(-rows.count() // (2 * batches)), files()
    rows.write.mode("append").option("maxRecordsPerFile", max(1, most)).parquet(landing)
    return max(1, -(-(files() - before) // batches))


@query("stream_silver_foreach", sql(FACT_ROWS, "typed", "rates"))
def stream_silver_foreach(spark: SparkSession, d: str) -> DataFrame:
    names = ("landing", "fact", "quarantine", "checkpoint")
    landing, fact, rejects, checkpoint = (new_location(spark, n) for n in names)
    files = land(star.raw_transactions(spark, d), landing, 2)
    raw = bronze_stream.file_stream(spark, landing, schemas.raw("transactions"), maxFilesPerTrigger=files)
    silver_stream.fact_stream(raw, fact, rejects, checkpoint, at=_clock()).awaitTermination()
    return readers.read_table(spark, fact).drop(*HASHED, "load", "month_key")


@query("late_data", """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def late_data(spark: SparkSession, d: str) -> DataFrame:
    """Newest event per user, from files that arrive in no time order."""
    landing, target, checkpoint = (new_location(spark, n) for n in ("landing", "latest", "checkpoint"))
    events = star.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts")
    events.repartition(3).write.parquet(landing)
    rows = bronze_stream.file_stream(spark, landing, events.schema, maxFilesPerTrigger=1)
    upsert = silver_stream.upsert_stream(rows, ["user_id"], ["ts", "event_id"], target, checkpoint)
    upsert.awaitTermination()
    return silver_stream.current_rows(spark, target)


@query("stream_dedup", "SELECT event_id, user_id, event_type FROM events")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every file is delivered twice; repeats within the watermark are dropped."""
    landing, target, checkpoint = (new_location(spark, n) for n in ("landing", "events", "checkpoint"))
    events = star.table(spark, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp"))
    events.write.parquet(landing)
    events.write.mode("append").parquet(landing)
    rows = bronze_stream.file_stream(spark, landing, events.schema, maxFilesPerTrigger=1)
    unique = bronze_stream.deduplicated(rows, ["event_id"], "ts", "60 days")
    bronze_stream.append_stream(unique, target, checkpoint).awaitTermination()
    return readers.read_table(spark, target).drop("ts")


# --- gold tables through their upkeep --------------------------------------------------------------

GOLD = (
    "revenue_summary", "customer_analytics", "merchant_analytics", "channel_performance", "geographic_summary",
    "daily_kpis", "monthly_kpis", "executive_summary",
)
_kept_gold: dict[tuple[str, str, bool], str] = {}


def _gold_root(spark: SparkSession, d: str, grown: bool) -> str:
    """All eight tables, made once per application; with `grown` in two runs, the second for a load that reaches into the past."""
    key = (spark.sparkContext.applicationId, d, grown)
    # somebody may have cleaned the folder
    if key not in _kept_gold or versions.version(spark, f"{_kept_gold[key]}/revenue_summary") is None:
        table, root = new_location(spark, "fact"), new_location(spark, "gold")
        late = (F.col("date_key") >= 20010101) | (F.pmod(F.xxhash64("transaction_id"), F.lit(50)) == 0) & (F.col("date_key") < 19960000)
        fact = star.fact(spark, d).withColumn("load", F.when(late & F.lit(grown), "second").otherwise("first"))
        fact = fact.withColumn("month_key", silver.month_key())
        for load in ("first", "second") if grown else ("first",):
            versions.publish(spark, table, {versions.MAIN: versions.Change(
                fact.filter(F.col("load") == load), partition_by=("load", "month_key"), zones=("date_key", "transaction_timestamp"), replace="load")})
            gold_plan.refresh(
                spark, table, star.customers(spark, d), star.merchants(spark, d), star.calendar(spark), root, F.lit("2002-01-01").cast("date"), _clock())
        _kept_gold[key] = root
    return _kept_gold[key]


def _gold_table(name: str, grown: bool):
    def built(spark: SparkSession, d: str) -> DataFrame:
        return readers.read_table(spark, f"{_gold_root(spark, d, grown)}/{name}").drop("month_key", "quarter_key", "_created_timestamp")

    return built


for _name in GOLD:
    _sql = ORACLES[_name].replace(NEWEST, "DATE '2002-01-01'")
    query(f"gold_built_{_name}", _sql)(_gold_table(_name, False))
    query(f"gold_grown_{_name}", _sql)(_gold_table(_name, True))


# key columns, decimal columns with what they are in the fact, and the rows that count
EXACT = {
    "revenue_summary": ("date_key, channel, transaction_type, status, country_code",
                        {"total_revenue_usd": "sum(amount_usd)", "min_transaction_value": "min(amount_usd)", "max_transaction_value": "max(amount_usd)"}, "TRUE"),
    "customer_analytics": ("customer_key", {"lifetime_value_usd": "sum(amount_usd)"}, "status = 'COMPLETED'"),
    "merchant_analytics": ("merchant_key", {"total_revenue_usd": "sum(amount_usd)"}, "status = 'COMPLETED'"),
    "channel_performance": ("year, month, channel", {"total_revenue_usd": "sum(amount_usd)"}, "TRUE"),
    "geographic_summary": ("year, quarter, country_code", {"total_revenue_usd": "sum(amount_usd)"}, "TRUE"),
    "daily_kpis": ("date_key", {"total_revenue": "sum(amount_usd)"}, "status = 'COMPLETED'"),
    "monthly_kpis": ("year, month", {"total_revenue": "sum(amount_usd)"}, "status = 'COMPLETED'"),
}


def _exact_table(name: str):
    keys, sums, _ = EXACT[name]

    def exact(spark: SparkSession, d: str) -> DataFrame:
        """Decimals as text, so that neither a digit nor the scale is lost in the comparison."""
        rows = readers.read_table(spark, f"{_gold_root(spark, d, False)}/{name}")
        return rows.select(*keys.split(", "), *[F.col(c).cast("string").alias(c) for c in sums])

    return exact


for _name, (_keys, _sums, _rows) in EXACT.items():
    _shown = ", ".join(f"CAST(CAST({v} AS DECIMAL(28,2)) AS VARCHAR) AS {c}" for c, v in _sums.items())
    query(f"gold_exact_{_name}", sql(f"""
SELECT {_keys}, {_shown} FROM (SELECT f.*, year, quarter, month FROM fact f LEFT JOIN calendar c ON f.date_key = c.date_key)
WHERE {_rows} GROUP BY ALL""", "fact", "calendar"))(_exact_table(_name))


@query("join_asof_customer", sql("""WITH versions AS (
  SELECT customer_id, email, try_strptime(created_at, '%Y-%m-%d %H:%M:%S') AS since FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id, created_at ORDER BY phone DESC) AS rn FROM customer_deliveries) WHERE rn = 1)
SELECT f.transaction_id, f.customer_key, strftime(f.transaction_timestamp, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
       CAST(f.amount_usd AS DOUBLE) AS amount_usd, v.email
FROM fact f ASOF LEFT JOIN versions v ON CAST(f.customer_key AS VARCHAR) = v.customer_id AND f.transaction_timestamp >= v.since""",
    "fact", "customer_deliveries"))
def join_asof_customer(spark: SparkSession, d: str) -> DataFrame:
    """Every fact with the address that its customer had then."""
    log = star.customer_deliveries(spark, d).select("customer_id", "email", "phone", F.col("created_at").cast("timestamp").alias("since"))
    told = sinks.latest_per_key(log, ["customer_id", "since"], [F.desc("phone")])
    kept = history.scd2_history(told, ["customer_id"], ["since"], ["email"], bucket="year")
    facts = star.fact(spark, d).select("transaction_id", "customer_key", F.col("transaction_timestamp").cast("timestamp"), "amount_usd")
    facts = facts.withColumn("customer_id", F.col("customer_key").cast("string"))
    return asof.join_asof(facts, kept, "customer_id", "transaction_timestamp", "valid_from", "valid_to", ["email"], "quarter").drop("customer_id")


@query("compact_cluster_pruned", """
SELECT column_name, n, true AS at_most_a_quarter FROM (
  SELECT 'l_shipdate' AS column_name, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-06-01'
  UNION ALL SELECT 'l_suppkey', count(*) FROM lineitem WHERE l_suppkey BETWEEN 10 AND 14)""")
def compact_cluster_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Clustered by two columns: a filter on either of them opens at most a quarter of the files."""
    path = new_location(spark, "clustered")
    versions.overwrite(spark, path, star.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_quantity"))
    at = layout.cluster(spark, path, ["l_shipdate", "l_suppkey"], files=256)
    total = versions.entries(spark, at).count()
    shown = None
    for column, low, high in (("l_shipdate", F.lit("1997-03-01").cast("timestamp_ntz"), F.lit("1997-05-31 23:59:59.999999").cast("timestamp_ntz")), ("l_suppkey", F.lit(10), F.lit(14))):
        some = versions.between(column, low, high)
        opened = some(versions.entries(spark, at)).count()
        rows = versions.read(spark, at, of=some).filter(F.col(column).between(low, high))
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(column).alias("column_name"), "n", F.lit(4 * opened <= total).alias("at_most_a_quarter"))
        shown = one if shown is None else shown.unionByName(one)
    return shown


@query("quarantine_replay_fixed", sql("""
WITH fixed AS (
  SELECT *, null_transaction_id OR null_amount OR invalid_amount OR negative_amount OR invalid_status OR invalid_transaction_type
    OR invalid_channel OR invalid_date AS other FROM judged)
SELECT (SELECT count(*) FROM valid) + (SELECT count(*) FROM fixed WHERE invalid_currency AND NOT other) AS facts,
       (SELECT count(*) FROM fixed WHERE other) AS rejected_records,
       (SELECT count(*) FROM fixed WHERE invalid_currency AND NOT other) AS accepted""", "judged", "valid"))
def quarantine_replay_fixed(spark: SparkSession, d: str) -> DataFrame:
    """Unknown currencies are set right and replayed, and replayed again; a commit that fails in between changes nothing."""
    raw_table, fact, rejects = (new_location(spark, n) for n in ("raw", "fact", "quarantine"))
    sinks.append(star.raw_transactions(spark, d), raw_table)
    silver.transform_transactions(spark, raw_table, fact, rejects, at=_clock())

    def fix(records: DataFrame) -> DataFrame:
        wrong = F.col("currency").isNotNull() & ~F.col("currency").isin(ref.CURRENCIES)
        return records.withColumn("currency", F.when(wrong, F.lit("USD")).otherwise(F.col("currency")))

    real, died = versions._write_new, []
    versions._write_new = lambda *a: died.append(a) or False
    try:
        silver.replay_quarantine(spark, fact, fix, at=_clock())
    except versions.CommitConflict:
        pass
    finally:
        versions._write_new = real
    done = silver.replay_quarantine(spark, fact, fix, at=_clock())
    again = silver.replay_quarantine(spark, fact, fix, at=_clock())
    left = readers.read_table(spark, rejects).filter("first").select(F.count(F.lit(1))).scalar()
    facts = readers.read_table(spark, fact).agg(F.count(F.lit(1)).alias("facts"))
    return facts.select("facts", left.alias("rejected_records"), F.lit(done["accepted"] + again["accepted"]).cast("bigint").alias("accepted"))
