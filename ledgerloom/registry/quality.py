"""Registered queries: data-quality checks, quarantine, validation, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.functions import reference_data as ref
from ledgerloom.operators import gold, quality, quarantine, reports, rules, validation
from ledgerloom.registry.base import query
from ledgerloom.registry.oracle import CHANNELS, CURRENCIES, SEGMENT, STATUSES, TIER, TRANSACTION_TYPES, dbl, half_up, sql, ts
from ledgerloom.session import new_location
from ledgerloom.sources import readers, sinks, star, versions

NEWEST_DAY = "DATE '2001-11-05'"


def _as_of():
    """The day after the newest raw batch; fixed, so that reruns give the same rows."""
    return F.lit("2001-11-05").cast("date")


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d)


# --- checks ------------------------------------------------------------------------------------


def check_sql(name: str, failed: str, rows: str = "count(*)", threshold: float = 0.0, severity: str = "error", source: str = "raw") -> str:
    return (
        f"SELECT '{name}' AS check_name, '{severity}' AS severity, CAST({rows} AS BIGINT) AS checked_rows, "
        f"CAST({failed} AS BIGINT) AS failed_rows, {half_up(f'({failed}) * 100', rows, 2)} AS actual_pct, "
        f"CAST({threshold} AS DOUBLE) AS threshold_pct, ({failed}) * 100.0 / ({rows}) <= {threshold} AS passed FROM {source}"
    )


def where(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


UNIQUE_ID = "count(transaction_id) - count(DISTINCT transaction_id)"
BAD_DATE = "transaction_date IS NOT NULL AND TRY_CAST(transaction_date AS DATE) IS NULL"
SUITE = " UNION ALL ".join([
    check_sql("not_null_transaction_id", where("transaction_id IS NULL")),
    check_sql("unique_transaction_id", UNIQUE_ID, "count(transaction_id)"),
    check_sql("not_null_customer_id", where("customer_id IS NULL"), threshold=1.0, severity="warning"),
    check_sql("not_null_amount", where("amount IS NULL")),
    check_sql("positive_amount", where("TRY_CAST(amount AS DOUBLE) <= 0")),
    check_sql("in_set_currency", where(f"currency NOT IN ({CURRENCIES})"), threshold=1.0),
    check_sql("in_set_status", where(f"status NOT IN ({STATUSES})"), threshold=0.5),
    check_sql("in_set_transaction_type", where(f"transaction_type NOT IN ({TRANSACTION_TYPES})"), threshold=0.5),
    check_sql("in_set_channel", where(f"channel NOT IN ({CHANNELS})"), threshold=0.5),
    check_sql("date_format_transaction_date", where(BAD_DATE), threshold=1.0),
])


def _register_check(key: str, statement: str, *tables: str):
    """Register a check list on the raw transactions."""

    def register(checks):
        @query(key, sql(statement, *tables))
        def run(spark: SparkSession, d: str) -> DataFrame:
            return quality.run_checks(_raw(spark, d), checks(spark, d))

        return checks

    return register


@_register_check("dq_not_null", check_sql("not_null_customer_id", where("customer_id IS NULL"), threshold=2.5), "raw")
def dq_not_null(spark: SparkSession, d: str):
    return [quality.not_null("customer_id", threshold_pct=2.5)]


@_register_check("dq_unique", check_sql("unique_transaction_id", UNIQUE_ID, "count(transaction_id)"), "raw")
def dq_unique(spark: SparkSession, d: str):
    return [quality.unique("transaction_id")]


@_register_check("dq_in_set", check_sql("in_set_channel", where(f"channel NOT IN ({CHANNELS})"), threshold=5), "raw")
def dq_in_set(spark: SparkSession, d: str):
    return [quality.in_set("channel", ref.CHANNELS, threshold_pct=5)]


@_register_check("dq_positive", " UNION ALL ".join([
    check_sql("positive_amount", where("TRY_CAST(amount AS DOUBLE) < 0"), threshold=10),
    check_sql("positive_amount", where("TRY_CAST(amount AS DOUBLE) <= 0")),
]), "raw")
def dq_positive(spark: SparkSession, d: str):
    return [quality.positive("amount", threshold_pct=10), quality.positive("amount", allow_zero=False)]


@_register_check("dq_ref_integrity", " UNION ALL ".join([
    check_sql("ref_integrity_customer_id", where("r.customer_id IS NOT NULL AND c.customer_id IS NULL"), threshold=5,
              source="raw r LEFT JOIN customers c ON r.customer_id = c.customer_id"),
    check_sql("ref_integrity_merchant_id", where("r.merchant_id IS NOT NULL AND m.merchant_id IS NULL"),
              source="raw r LEFT JOIN merchants m ON r.merchant_id = m.merchant_id"),
]), "raw", "customers")
def dq_ref_integrity(spark: SparkSession, d: str):
    return [
        quality.ref_integrity("customer_id", star.customers(spark, d), "customer_id", threshold_pct=5),
        quality.ref_integrity("merchant_id", star.merchants(spark, d), "merchant_id"),
    ]


@_register_check("dq_date_format", check_sql("date_format_transaction_date", where(BAD_DATE), threshold=5), "raw")
def dq_date_format(spark: SparkSession, d: str):
    return [quality.date_format("transaction_date", threshold_pct=5)]


@_register_check("dq_range", check_sql(
    "range_amount", where("TRY_CAST(amount AS DOUBLE) NOT BETWEEN 1000 AND 90000"), threshold=15), "raw")
def dq_range(spark: SparkSession, d: str):
    return [quality.in_range("amount", 1000, 90000, threshold_pct=15)]


@_register_check("dq_duplicates_multi", check_sql(
    "duplicates_customer_id_account_id", "coalesce(sum(n - 1), 0)", "sum(n)", threshold=50,
    source="(SELECT count(*) AS n FROM raw GROUP BY customer_id, account_id)"), "raw")
def dq_duplicates_multi(spark: SparkSession, d: str):
    return [quality.no_duplicates(["customer_id", "account_id"], threshold_pct=50)]


@_register_check("dq_transaction_suite", SUITE, "raw")
def dq_transaction_suite(spark: SparkSession, d: str):
    return quality.transaction_suite()


def _suite(spark: SparkSession, d: str) -> DataFrame:
    return quality.run_checks(_raw(spark, d), quality.transaction_suite())


@query("dq_report", sql(f"""WITH suite AS ({SUITE})
SELECT count(*) AS check_count, {where('passed')} AS passed_count, {where('NOT passed')} AS failed_count,
       {where("NOT passed AND severity = 'error'")} AS failed_errors,
       {where("NOT passed AND severity = 'error'")} = 0 AS passed FROM suite""", "raw"))
def dq_report(spark: SparkSession, d: str) -> DataFrame:
    return quality.report_summary(_suite(spark, d))


GATE = "UNION ALL ".join(
    f"""SELECT '{env}' AS environment, check_name, actual_pct, CAST({limit} AS DOUBLE) AS limit_pct,
       failed_rows * 100.0 / checked_rows > {limit} AS breach,
       failed_rows * 100.0 / checked_rows > {limit} AND {str(fail).upper()} AS blocks
       FROM suite WHERE check_name LIKE '{prefix}%' """
    for env, null_limit, dup_limit, fail in (("dev", 5, 1, False), ("test", 2, 0.5, False), ("prod", 1, 0.1, True))
    for prefix, limit in (("not_null_", null_limit), ("unique_", dup_limit))
)


@query("dq_threshold_gate", sql(f"WITH suite AS ({SUITE}) {GATE}", "raw"))
def dq_threshold_gate(spark: SparkSession, d: str) -> DataFrame:
    report = _suite(spark, d)
    gates = [quality.threshold_gate(report, env) for env in ref.QUALITY_GATES]
    return gates[0].unionByName(gates[1]).unionByName(gates[2])


AMOUNT = "TRY_CAST(amount AS DECIMAL(18,2))"


@query("dq_amount_profile", sql(f"""
SELECT count({AMOUNT}) AS n, {dbl(f'min({AMOUNT})')} AS min_amount, {dbl(f'max({AMOUNT})')} AS max_amount,
       CAST(sum({AMOUNT}) AS DOUBLE) / count({AMOUNT}) AS avg_amount,
       round(stddev_samp(CAST({AMOUNT} AS DOUBLE)), 4) AS stddev_amount FROM raw""", "raw"))
def dq_amount_profile(spark: SparkSession, d: str) -> DataFrame:
    profile = quality.amount_profile(_raw(spark, d))
    return profile.withColumn("stddev_amount", F.round("stddev_amount", 4))


@query("dq_value_distribution", sql("""
SELECT 'currency' AS column_name, currency AS value, count(*) AS n FROM raw GROUP BY currency
UNION ALL SELECT 'status', status, count(*) FROM raw GROUP BY status""", "raw"))
def dq_value_distribution(spark: SparkSession, d: str) -> DataFrame:
    return quality.value_distribution(_raw(spark, d), ["currency", "status"])


# --- quarantine ----------------------------------------------------------------------------------


def _quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rejected rows, dated by their ingestion."""
    _, rejected = rules.rule_split(_raw(spark, d))
    return quarantine.to_quarantine(rejected, "transactions_raw", at=F.col("_ingestion_timestamp"))


QUARANTINE = "quarantine AS (SELECT *, CAST(_load_date AS DATE) AS quarantine_date FROM rejected)"


@query("quarantine_write", sql(f"""
SELECT {ts('_ingestion_timestamp')} AS quarantine_timestamp, 'transactions_raw' AS source_table,
       reason AS rejection_reason, _batch_id AS batch_id, CAST(_load_date AS VARCHAR) AS quarantine_date,
       transaction_id FROM rejected""", "rejected"))
def quarantine_write(spark: SparkSession, d: str) -> DataFrame:
    """Written by day and read back. Of the record text only the id is shown; the whole of it is checked by the replay."""
    target = new_location(spark, "quarantine")
    _, rejected = rules.rule_split(_raw(spark, d))
    quarantine.write(spark, target, rejected, "transactions_raw", at=F.col("_ingestion_timestamp"))
    rows = readers.read_table(spark, target)
    ident = F.get_json_object("original_record", "$.transaction_id").alias("transaction_id")
    return rows.select(*[c for c in rows.columns if c != "original_record"], ident)


@query("quarantine_write_nb", sql("""
SELECT transaction_id AS record_id, 'transactions_raw' AS source_table,
       CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) <= 0 THEN 'Negative/zero amount'
            WHEN currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD') THEN 'Invalid currency'
            WHEN customer_id IS NULL THEN 'Missing customer_id' ELSE 'Other validation failure' END AS rejection_reason,
       amount, strftime(_ingestion_timestamp, '%Y-%m-%d %H:%M:%S') AS _quarantine_timestamp
FROM strict WHERE NOT ok""", "strict"))
def quarantine_write_nb(spark: SparkSession, d: str) -> DataFrame:
    _, invalid = rules.strict_split(_raw(spark, d))
    rows = quarantine.to_quarantine_nb(invalid, at=F.col("_ingestion_timestamp"))
    amount = F.get_json_object("original_data", "$.amount").alias("amount")
    return rows.select("record_id", "source_table", "rejection_reason", amount, "_quarantine_timestamp")


def _stats_level(level: str, label: str, grouping: str) -> str:
    return (
        f"SELECT '{level}' AS level, {label} AS label, count(*) AS n, count(DISTINCT _batch_id) AS batches, "
        f"{ts('min(_ingestion_timestamp)')} AS earliest, {ts('max(_ingestion_timestamp)')} AS latest FROM rejected{grouping}"
    )


@query("quarantine_stats", sql(" UNION ALL ".join([
    _stats_level("total", "NULL", ""),
    _stats_level("reason", "reason", " GROUP BY reason"),
    _stats_level("source", "'transactions_raw'", ""),
]), "rejected"))
def quarantine_stats(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.stats(_quarantine(spark, d))


@query("order_reason_counts", sql("SELECT reason AS rejection_reason, count(*) AS n FROM rejected GROUP BY reason", "rejected"))
def order_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.reason_counts(_quarantine(spark, d))


@query("quarantine_lookup", sql("""
SELECT _batch_id AS batch_id, reason AS rejection_reason, transaction_id FROM rejected
WHERE reason = 'invalid_currency' AND _batch_id = 'B199805'""", "rejected"))
def quarantine_lookup(spark: SparkSession, d: str) -> DataFrame:
    found = quarantine.lookup(_quarantine(spark, d), "transactions_raw", "invalid_currency", "B199805", limit=None)
    ident = F.get_json_object("original_record", "$.transaction_id").alias("transaction_id")
    return found.select("batch_id", "rejection_reason", ident)


@query("limit_records", sql("SELECT least(count(*), 1000) AS returned FROM rejected", "rejected"))
def limit_records(spark: SparkSession, d: str) -> DataFrame:
    """The lookup by hand asks for a thousand records; which ones is open."""
    return quarantine.lookup(_quarantine(spark, d), limit=1000).agg(F.count(F.lit(1)).alias("returned"))


FIRST_REASON = "CASE " + " ".join(f"WHEN {r} THEN '{r}'" for r in (
    "invalid_amount", "invalid_channel", "invalid_currency", "invalid_date", "invalid_status",
    "invalid_transaction_type", "negative_amount", "null_amount", "null_transaction_id",
)) + " END"


@query("quarantine_replay", sql(f"""
SELECT {', '.join(schemas.BUSINESS_COLUMNS['transactions'])}, _batch_id, {ts('_ingestion_timestamp')} AS _ingestion_timestamp,
       CAST(_load_date AS VARCHAR) AS _load_date, _source_file, _source_system,
       {ts('_ingestion_timestamp')} AS _original_quarantine_timestamp, {FIRST_REASON} AS _original_rejection_reason
FROM judged WHERE {FIRST_REASON} IS NOT NULL""", "judged"))
def quarantine_replay(spark: SparkSession, d: str) -> DataFrame:
    records = rules.invalid_records(_raw(spark, d), rules.transaction_rules())
    rows = quarantine.by_reason(records, schemas.BUSINESS_COLUMNS["transactions"])
    kept = quarantine.to_quarantine(rows, "transactions_raw", at=F.col("_ingestion_timestamp"))
    return quarantine.replay(kept, schemas.raw("transactions")).drop("record")


REPLAYED = "SELECT *, " + FIRST_REASON + """ AS why FROM judged WHERE """ + FIRST_REASON + " IS NOT NULL"


@query("quarantine_replay_plain", sql(f"""
SELECT {', '.join(schemas.BUSINESS_COLUMNS['transactions'])}, why AS _original_rejection_reason FROM ({REPLAYED})""", "judged"))
def quarantine_replay_plain(spark: SparkSession, d: str) -> DataFrame:
    """The replay of rows that do not tell which is of a record's first reason."""
    found = quarantine.replay(_quarantine(spark, d), schemas.raw("transactions"))
    return found.select(*schemas.BUSINESS_COLUMNS["transactions"], "_original_rejection_reason")


@query("quarantine_daily_trend", sql(f"""WITH {QUARANTINE}
SELECT CAST(quarantine_date AS VARCHAR) AS quarantine_date, reason AS rejection_reason, count(*) AS rejections
FROM quarantine WHERE quarantine_date >= {NEWEST_DAY} - 7 GROUP BY ALL""", "rejected"))
def quarantine_daily_trend(spark: SparkSession, d: str) -> DataFrame:
    return quarantine.daily_trend(_quarantine(spark, d), _as_of())


@query("quarantine_rate_alert", sql("""
SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM valid) AS rejected_rows,
       CAST((count(*) - (SELECT count(*) FROM valid)) * 100 AS DOUBLE) / count(*) AS rate_pct,
       (count(*) - (SELECT count(*) FROM valid)) * 100.0 / count(*) > 5 AS alert FROM raw""", "raw", "valid"))
def quarantine_rate_alert(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    rejected = rules.invalid_records(raw, rules.transaction_rules())
    return quarantine.rate_alert(raw.select(F.count(F.lit(1))), rejected.select(F.count(F.lit(1))))


@query("quarantine_orphans", sql("""
SELECT transaction_id, customer_id AS broken, 'orphan_customer_id' AS reason FROM raw
WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM customers)
UNION ALL SELECT transaction_id, account_id, 'orphan_account_id' FROM raw
WHERE account_id NOT IN (SELECT account_id FROM accounts)
UNION ALL SELECT transaction_id, merchant_id, 'orphan_merchant_id' FROM raw
WHERE merchant_id NOT IN (SELECT merchant_id FROM merchants)""", "raw", "customers", "accounts"))
def quarantine_orphans(spark: SparkSession, d: str) -> DataFrame:
    rows = _raw(spark, d).select("transaction_id", "customer_id", "account_id", "merchant_id")
    broken = quarantine.orphan_quarantine(rows, [
        ("customer_id", star.customers(spark, d), "customer_id"),
        ("account_id", star.accounts(spark, d), "account_id"),
        ("merchant_id", star.merchants(spark, d), "merchant_id"),
    ])
    reason = F.col(rules.REASON)
    value = F.when(reason == "orphan_customer_id", F.col("customer_id")).when(
        reason == "orphan_account_id", F.col("account_id")).otherwise(F.col("merchant_id"))
    return broken.select("transaction_id", value.alias("broken"), reason.alias("reason"))


KEPT = sql(f"""WITH {QUARANTINE}
SELECT _batch_id AS batch_id, reason AS rejection_reason, transaction_id, CAST(quarantine_date AS VARCHAR) AS quarantine_date
FROM quarantine WHERE quarantine_date >= {NEWEST_DAY} - 365""", "rejected")


def _slim(spark: SparkSession, d: str) -> DataFrame:
    ident = F.get_json_object("original_record", "$.transaction_id").alias("transaction_id")
    return _quarantine(spark, d).select("source_table", "batch_id", "rejection_reason", ident, "quarantine_date")


@query("quarantine_archive", sql(f"""WITH {QUARANTINE}
SELECT quarantine_date < {NEWEST_DAY} - 30 AS archived, reason AS rejection_reason, count(*) AS n
FROM quarantine GROUP BY ALL""", "rejected"))
def quarantine_archive(spark: SparkSession, d: str) -> DataFrame:
    """Moved to the archive in one commit, and both tables read back."""
    target, archive = new_location(spark, "quarantine"), new_location(spark, "quarantine_archive")
    versions.overwrite(spark, target, _slim(spark, d).repartitionByRange("quarantine_date"), zones=["quarantine_date"])
    sinks.delete_from(spark, target, sinks.older_than("quarantine_date", 30, _as_of()), archive)
    both = readers.read_table(spark, archive).withColumn("archived", F.lit(True)).unionByName(
        readers.read_table(spark, target).withColumn("archived", F.lit(False)))
    return both.groupBy("archived", "rejection_reason").agg(F.count(F.lit(1)).alias("n"))


@query("retention_prune", KEPT)
def retention_prune(spark: SparkSession, d: str) -> DataFrame:
    """Deleted from the table, day by day, and what is left read back."""
    target = new_location(spark, "quarantine")
    versions.overwrite(spark, target, _slim(spark, d).repartitionByRange("quarantine_date"), zones=["quarantine_date"])
    sinks.prune(spark, {"quarantine": (target, "quarantine_date", ref.RETENTION_DAYS["silver"])}, _as_of())
    return readers.read_table(spark, target).drop("source_table")


@query("retention_prune_layers", sql(f"""
SELECT 'raw' AS table_name, count(*) FILTER (WHERE _load_date < {NEWEST_DAY} - 90) AS deleted, count(*) FILTER (WHERE _load_date >= {NEWEST_DAY} - 90) AS kept FROM raw
UNION ALL SELECT 'quarantine', count(*) FILTER (WHERE _load_date < {NEWEST_DAY} - 30), count(*) FILTER (WHERE _load_date >= {NEWEST_DAY} - 30) FROM rejected""",
    "raw", "rejected"))
def retention_prune_layers(spark: SparkSession, d: str) -> DataFrame:
    """Two layers pruned by their own numbers of days: rows deleted, and rows that the tables then hold."""
    raw, held = new_location(spark, "raw"), new_location(spark, "quarantine")
    versions.overwrite(spark, raw, _raw(spark, d).repartitionByRange("_load_date"), zones=["_load_date"])
    versions.overwrite(spark, held, _slim(spark, d).repartitionByRange("quarantine_date"), zones=["quarantine_date"])
    days = ref.RETENTION_DAYS
    gone = sinks.prune(spark, {"raw": (raw, "_load_date", days["bronze"]), "quarantine": (held, "quarantine_date", days["quarantine"])}, _as_of())
    left = reports.layer_record_counts({"raw": readers.read_table(spark, raw), "quarantine": readers.read_table(spark, held)})
    deleted = F.when(F.col("table_name") == "raw", gone["raw"]).otherwise(gone["quarantine"]).cast("bigint")
    return left.select("table_name", deleted.alias("deleted"), F.col("records").alias("kept"))


# --- validation and monitoring --------------------------------------------------------------------


def verdict_sql(name: str, actual: str, passed: str, source: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST({actual} AS DOUBLE) AS actual, ({actual}) {passed} AS passed FROM {source}"


@query("val_null_keys", sql(verdict_sql("null_keys", "count(*) FILTER (WHERE customer_key IS NULL) / count(*)", "= 0", "fact"), "fact"))
def val_null_keys(spark: SparkSession, d: str) -> DataFrame:
    return validation.null_keys(star.fact(spark, d), "customer_key")


@query("val_dup_keys", sql(verdict_sql(
    "dup_keys", "count(*) FILTER (WHERE n > 1) / CAST(sum(n) AS DOUBLE)", "< 0.01",
    "(SELECT count(*) AS n FROM fact GROUP BY transaction_id)"), "fact"))
def val_dup_keys(spark: SparkSession, d: str) -> DataFrame:
    return validation.duplicate_keys(star.fact(spark, d), "transaction_id")


@query("val_amount_range", sql(verdict_sql(
    "amount_range", "count(*) FILTER (WHERE amount_usd < 0 OR amount_usd > 1000000)", "= 0", "fact"), "fact"))
def val_amount_range(spark: SparkSession, d: str) -> DataFrame:
    return validation.amount_range(star.fact(spark, d))


@query("val_fk_orphan_rate", sql(" UNION ALL ".join([
    verdict_sql("orphan_rate_customer_id",
                "count(*) FILTER (WHERE r.customer_id IS NOT NULL AND c.customer_id IS NULL) / count(r.customer_id)", "< 0.05",
                "raw r LEFT JOIN customers c ON r.customer_id = c.customer_id"),
    verdict_sql("orphan_rate_merchant_id",
                "count(*) FILTER (WHERE r.merchant_id IS NOT NULL AND m.merchant_id IS NULL) / count(r.merchant_id)", "< 0.05",
                "raw r LEFT JOIN merchants m ON r.merchant_id = m.merchant_id"),
]), "raw", "customers"))
def val_fk_orphan_rate(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d)
    people = validation.orphan_rate(raw, "customer_id", star.customers(spark, d), "customer_id")
    return people.unionByName(validation.orphan_rate(raw, "merchant_id", star.merchants(spark, d), "merchant_id"))


@query("val_amount_coverage", sql(verdict_sql(
    "amount_coverage", "count(TRY_CAST(amount AS DECIMAL(18,2))) / count(*)", "> 0.95", "raw"), "raw"))
def val_amount_coverage(spark: SparkSession, d: str) -> DataFrame:
    amount = F.col("amount").try_cast("decimal(18,2)").alias("amount_usd")
    return validation.amount_coverage(_raw(spark, d).select(amount))


@query("val_reconcile", sql("""
SELECT 'reconcile' AS check_name,
       CAST(abs(count(*) - (SELECT count(*) FROM valid) - (SELECT count(*) FROM judged j WHERE """ + FIRST_REASON + """ IS NOT NULL))
            AS DOUBLE) / count(*) AS actual, TRUE AS passed FROM raw""", "raw", "valid", "judged"))
def val_reconcile(spark: SparkSession, d: str) -> DataFrame:
    raw = _raw(spark, d).withColumn("record", validation.record_of(schemas.BUSINESS_COLUMNS["transactions"]))
    checks = rules.transaction_rules()
    return validation.reconcile(raw, rules.valid_rows(raw, checks), rules.invalid_records(raw, checks))


RECORD = ", ".join(schemas.BUSINESS_COLUMNS["transactions"])


@query("reconcile_differences", sql(f"""
SELECT transaction_id, amount, n AS delivered, CASE WHEN transaction_id LIKE '%7-1' THEN 0 ELSE 2 * n END AS accounted
FROM (SELECT {RECORD}, count(*) AS n FROM raw GROUP BY ALL) WHERE transaction_id LIKE '%7-1' OR transaction_id LIKE '%8-1'""", "raw"))
def reconcile_differences(spark: SparkSession, d: str) -> DataFrame:
    """Some records are lost on the way and some come twice: which, and how often they are on either side."""
    columns = schemas.BUSINESS_COLUMNS["transactions"]
    raw = _raw(spark, d).withColumn("record", validation.record_of(columns))
    lost, twice = (F.coalesce(F.col("transaction_id").endswith(x), F.lit(False)) for x in ("7-1", "8-1"))
    accounted = raw.filter(~lost).select("record").unionAll(raw.filter(twice).select("record"))
    found = validation.record_differences(raw, accounted)
    named = raw.groupBy("record").agg(*[F.min(c).alias(c) for c in ("transaction_id", "amount")])
    return found.join(named, "record").select("transaction_id", "amount", F.col("left_n").alias("delivered"), F.col("right_n").alias("accounted"))


@query("val_dim_coverage", sql("""
SELECT 'dim_coverage' AS check_name, CAST(count(DISTINCT customer_id) AS DOUBLE) / count(*) AS actual,
       count(DISTINCT customer_id) / count(*) > 0.95 AS passed FROM customer_deliveries""", "customer_deliveries"))
def val_dim_coverage(spark: SparkSession, d: str) -> DataFrame:
    deliveries = star.customer_deliveries(spark, d)
    return validation.dimension_coverage(deliveries, deliveries.select("customer_id").distinct())


@query("val_segments", sql(verdict_sql(
    "labels_customer_segment", "count(DISTINCT s)", "> 0",
    f"(SELECT {SEGMENT} AS s FROM (SELECT sum(amount_usd) AS lifetime_value_usd FROM fact GROUP BY customer_key))"), "fact"))
def val_segments(spark: SparkSession, d: str) -> DataFrame:
    customers = gold.customer_analytics_nb(star.fact(spark, d), star.customers(spark, d))
    return validation.labels_present(customers, "customer_segment")


@query("val_tiers", sql(verdict_sql(
    "labels_merchant_tier", "count(DISTINCT s)", "> 0",
    f"(SELECT {TIER} AS s FROM (SELECT sum(amount_usd) AS total_revenue_usd FROM fact GROUP BY merchant_key))"), "fact"))
def val_tiers(spark: SparkSession, d: str) -> DataFrame:
    merchants = gold.merchant_analytics_nb(star.fact(spark, d), star.dim_merchant_nb(spark, d))
    return validation.labels_present(merchants, "merchant_tier")


COUNTS = sql("""
SELECT 'bronze_transactions' AS table_name, count(*) AS records FROM raw
UNION ALL SELECT 'silver_fact', count(*) FROM valid
UNION ALL SELECT 'silver_quarantine', count(*) FROM rejected""", "raw", "valid", "rejected")


def _layers(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    raw = _raw(spark, d)
    valid, rejected = rules.rule_split(raw)
    return {"bronze_transactions": raw, "silver_fact": valid, "silver_quarantine": rejected}


@query("layer_record_counts", COUNTS)
def layer_record_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.layer_record_counts(_layers(spark, d))


@query("union_all_counts", """
SELECT 'customer' AS table_name, count(*) AS records FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem""")
def union_all_counts(spark: SparkSession, d: str) -> DataFrame:
    names = ("customer", "supplier", "orders", "lineitem")
    return reports.layer_record_counts({n: star.table(spark, d, n) for n in names})


@query("freshness", sql("""
SELECT table_name, strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest,
       datediff('second', latest, TIMESTAMP '2001-11-05 12:00:00') / 3600 AS lag_hours,
       datediff('second', latest, TIMESTAMP '2001-11-05 12:00:00') / 3600 > 24 AS alert FROM (
  SELECT 'bronze' AS table_name, max(_ingestion_timestamp) AS latest FROM raw
  UNION ALL SELECT 'silver', max(transaction_timestamp) FROM typed)""", "raw", "typed"))
def freshness(spark: SparkSession, d: str) -> DataFrame:
    from ledgerloom.operators import facts

    raw = _raw(spark, d)
    fact = facts.typed(rules.rule_split(raw)[0])
    tables = {"bronze": (raw, "_ingestion_timestamp"), "silver": (fact, "transaction_timestamp")}
    return reports.freshness(tables, F.lit("2001-11-05 12:00:00").cast("timestamp"))


@query("run_metrics", sql("""
SELECT 'rule_split' AS step, count(*) AS input_rows, (SELECT count(*) FROM valid) AS output_rows,
       count(*) - (SELECT count(*) FROM valid) AS rejected_rows,
       CAST((SELECT count(*) FROM valid) * 100 AS DOUBLE) / count(*) AS success_rate FROM raw""", "raw", "valid"))
def run_metrics(spark: SparkSession, d: str) -> DataFrame:
    return reports.run_metrics("rule_split", _raw(spark, d), ~rules.any_fires(rules.transaction_rules()))
