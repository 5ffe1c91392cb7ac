"""Registered queries: raw-layer operators, rules, fact build, dimensions, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.functions.columns import count_if, date_key_of, day
from ledgerloom.operators import dimensions, facts, history, ingest, joins, rules
from ledgerloom.registry.base import query
from ledgerloom.registry.oracle import dbl, sql, ts
from ledgerloom.sources import star
from ledgerloom.sources.sinks import merge_upsert

BUSINESS = ", ".join(schemas.BUSINESS_COLUMNS["transactions"])
DELIVERED = [c for c in schemas.BUSINESS_COLUMNS["transactions"]]
META = (
    f"{ts('_ingestion_timestamp')} AS _ingestion_timestamp, _source_file, _source_system, _batch_id, "
    "CAST(_load_date AS VARCHAR) AS _load_date"
)


def _clock():
    """A fixed ingestion time, so that reruns give the same rows."""
    return F.lit("2002-01-01 06:00:00").cast("timestamp")


# --- raw layer -----------------------------------------------------------------------------


@query("cast_all_to_string", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders""")
def cast_all_to_string(spark: SparkSession, d: str) -> DataFrame:
    # a decimal, because engines print the same double differently
    priced = star.table(spark, d, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return ingest.cast_all_to_string(priced)


@query("add_ingestion_metadata", """
SELECT s_suppkey, s_name, '2002-01-01 06:00:00' AS _ingestion_timestamp, 'supplier.parquet' AS _source_file,
       'erp' AS _source_system, 'B1' AS _batch_id, '2002-01-01' AS _load_date FROM supplier""")
def add_ingestion_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = star.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return ingest.add_ingestion_metadata(rows, "supplier.parquet", "erp", "B1", _clock())


@query("add_ingestion_metadata_nb", """
SELECT s_suppkey, s_name, '2002-01-01 06:00:00' AS _ingested_at, 'B1' AS _batch_id,
       'supplier.parquet' AS _source_file FROM supplier""")
def add_ingestion_metadata_nb(spark: SparkSession, d: str) -> DataFrame:
    rows = star.table(spark, d, "supplier").select("s_suppkey", "s_name")
    return ingest.add_ingestion_metadata_nb(rows, "supplier.parquet", "B1", _clock())


@query("enforce_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS c_acctbal,
       CAST(NULL AS INTEGER) AS added FROM customer""")
def enforce_schema(spark: SparkSession, d: str) -> DataFrame:
    wanted = T.StructType.fromDDL("c_custkey string, c_name string, c_acctbal decimal(18,2), added int")
    return ingest.enforce_schema(star.table(spark, d, "customer"), wanted)


@query("schema_conformance", sql("""
SELECT 'amount' AS column_name, 'expected' AS state, count(*) AS total_rows, count(*) - count(amount) AS null_rows,
       count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(18,2)) IS NULL) AS uncastable_rows FROM raw
UNION ALL SELECT 'transaction_date', 'expected', count(*), count(*) - count(transaction_date),
       count(*) FILTER (WHERE transaction_date IS NOT NULL AND TRY_CAST(transaction_date AS DATE) IS NULL) FROM raw
UNION ALL SELECT 'customer_id', 'expected', count(*), count(*) - count(customer_id), 0 FROM raw
UNION ALL SELECT 'device', 'missing', count(*), NULL, NULL FROM raw
UNION ALL SELECT 'status', 'unexpected', count(*), count(*) - count(status), 0 FROM raw""", "raw"))
def schema_conformance(spark: SparkSession, d: str) -> DataFrame:
    rows = star.raw_transactions(spark, d).select("customer_id", "amount", "transaction_date", "status")
    wanted = T.StructType.fromDDL("customer_id string, amount decimal(18,2), transaction_date date, device string")
    return ingest.schema_conformance(rows, wanted)


@query("bronze_record_count", sql("SELECT count(*) AS records FROM raw", "raw"))
def bronze_record_count(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d).agg(F.count(F.lit(1)).alias("records"))


@query("batch_summary", sql(f"""
SELECT _batch_id, count(*) AS record_count, {ts('min(_ingestion_timestamp)')} AS first_ingestion,
       {ts('max(_ingestion_timestamp)')} AS last_ingestion, count(DISTINCT transaction_id) AS unique_transactions,
       count(DISTINCT customer_id) AS unique_customers FROM raw GROUP BY _batch_id""", "raw"))
def batch_summary(spark: SparkSession, d: str) -> DataFrame:
    return ingest.batch_summary(star.raw_transactions(spark, d))


NEWEST_BATCHES = sql(f"""
SELECT _batch_id, total_records, {ts('batch_start')} AS batch_start, {ts('batch_end')} AS batch_end FROM (
  SELECT _batch_id, count(*) AS total_records, min(_ingestion_timestamp) AS batch_start,
         max(_ingestion_timestamp) AS batch_end FROM raw GROUP BY _batch_id) AS b
ORDER BY b.batch_start DESC, b._batch_id DESC LIMIT 10""", "raw")


@query("batch_metrics_latest", NEWEST_BATCHES)
def batch_metrics_latest(spark: SparkSession, d: str) -> DataFrame:
    return ingest.batch_metrics_latest(star.raw_transactions(spark, d))


@query("latest_batches_top10", sql("""
SELECT _batch_id, count(*) AS total_records FROM raw GROUP BY _batch_id ORDER BY _batch_id DESC LIMIT 10""", "raw"))
def latest_batches_top10(spark: SparkSession, d: str) -> DataFrame:
    return ingest.batch_metrics_latest(star.raw_transactions(spark, d)).select("_batch_id", "total_records")


@query("bronze_dedup", sql("""
SELECT transaction_id, amount, transaction_date FROM (
  SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_date DESC, amount DESC NULLS LAST) AS rn
  FROM raw) WHERE rn = 1""", "raw"))
def bronze_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = star.raw_transactions(spark, d).select("transaction_id", "amount", "transaction_date")
    return ingest.dedup_by_key(rows, "transaction_id", [F.desc("transaction_date"), F.desc_nulls_last("amount")])


@query("bad_marker_profile", sql("""
SELECT count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_NULL\\_%' ESCAPE '\\') AS null_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_DUP\\_%' ESCAPE '\\') AS duplicate_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_BADCUR\\_%' ESCAPE '\\') AS invalid_currency_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_ORPHAN\\_%' ESCAPE '\\') AS orphan_fk_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_NEG\\_%' ESCAPE '\\') AS negative_amount_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_BADDATE\\_%' ESCAPE '\\') AS malformed_date_rows,
       count(*) FILTER (WHERE transaction_id LIKE 'TEST\\_%' ESCAPE '\\') AS marked_rows,
       count(*) FILTER (WHERE transaction_id IS NULL OR transaction_id NOT LIKE 'TEST\\_%' ESCAPE '\\') AS good_rows,
       count(*) AS total_rows FROM raw""", "raw"))
def bad_marker_profile(spark: SparkSession, d: str) -> DataFrame:
    return ingest.bad_marker_profile(star.raw_transactions(spark, d))


def _orphan_sql(name: str, child: str, column: str, parent: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) FILTER (WHERE p.k IS NULL) AS orphan_rows, "
        f"count(c.{column}) AS keyed_rows, count(*) AS total_rows "
        f"FROM {child} c LEFT JOIN (SELECT DISTINCT {column} AS k FROM {parent}) p ON c.{column} = p.k"
    )


@query("bronze_orphan_counts", sql(" UNION ALL ".join([
    _orphan_sql("accounts_customers", "accounts", "customer_id", "customers"),
    _orphan_sql("transactions_customers", "raw", "customer_id", "customers"),
    _orphan_sql("transactions_accounts", "raw", "account_id", "accounts"),
    _orphan_sql("transactions_merchants", "raw", "merchant_id", "merchants"),
]), "raw", "customers", "accounts"))
def bronze_orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    raw, customers, accounts = star.raw_transactions(spark, d), star.customers(spark, d), star.accounts(spark, d)
    own = accounts.select(F.col("customer_id").alias("accounts_customers"))
    keys = raw.select(*[F.col(f"{k}_id").alias(f"transactions_{k}s") for k in ("customer", "account", "merchant")])
    known = {"customers": (customers, "customer_id"), "accounts": (accounts, "account_id"), "merchants": (star.merchants(spark, d), "merchant_id")}
    references = [(f"transactions_{name}", *known[name]) for name in known]
    return joins.orphan_summary(own, [("accounts_customers", *known["customers"])], include_null=True).unionByName(
        joins.orphan_summary(keys, references, include_null=True))


@query("good_bad_sample", sql("""
SELECT * FROM (SELECT transaction_id, amount, transaction_date, TRUE AS bad FROM raw
  WHERE transaction_id LIKE 'TEST\\_%' ESCAPE '\\'
  ORDER BY transaction_id, amount NULLS FIRST, transaction_date NULLS FIRST LIMIT 5)
UNION ALL
SELECT * FROM (SELECT transaction_id, amount, transaction_date, FALSE AS bad FROM raw
  WHERE transaction_id IS NULL OR transaction_id NOT LIKE 'TEST\\_%' ESCAPE '\\'
  ORDER BY transaction_id NULLS FIRST, amount NULLS FIRST, transaction_date NULLS FIRST LIMIT 5)""", "raw"))
def good_bad_sample(spark: SparkSession, d: str) -> DataFrame:
    rows = star.raw_transactions(spark, d).select("transaction_id", "amount", "transaction_date")
    bad = ingest.good_bad_sample(rows, bad=True).withColumn("bad", F.lit(True))
    return bad.unionByName(ingest.good_bad_sample(rows, bad=False).withColumn("bad", F.lit(False)))


# --- incremental selection ---------------------------------------------------------------------


@query("incremental_by_batch", sql(f"SELECT _batch_id, {BUSINESS} FROM raw WHERE _batch_id >= 'B199901'", "raw"))
def incremental_by_batch(spark: SparkSession, d: str) -> DataFrame:
    return facts.since_batch(star.raw_transactions(spark, d), "B199901").select("_batch_id", *DELIVERED)


@query("incremental_by_watermark", sql("""
SELECT _batch_id, transaction_id, amount FROM raw
WHERE _ingestion_timestamp > (SELECT max(_ingestion_timestamp) FROM raw WHERE _batch_id <= 'B199906')""", "raw"))
def incremental_by_watermark(spark: SparkSession, d: str) -> DataFrame:
    raw = star.raw_transactions(spark, d)
    done = raw.filter(F.col("_batch_id") <= "B199906").select(F.col("_ingestion_timestamp").alias("_created_timestamp"))
    return facts.after_watermark(raw, done).select("_batch_id", "transaction_id", "amount")


@query("incremental_by_unprocessed_batch", sql("""
SELECT _batch_id, transaction_id, amount FROM raw WHERE _batch_id NOT IN (
  SELECT 'B' || strftime(o_orderdate, '%Y%m') FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01')""", "raw"))
def incremental_by_unprocessed_batch(spark: SparkSession, d: str) -> DataFrame:
    seen = star.table(spark, d, "orders").filter(F.col("o_orderdate") < "1999-07-01")
    done = seen.select(F.concat(F.lit("B"), F.date_format("o_orderdate", "yyyyMM")).alias("_batch_id"))
    return facts.unprocessed_batches(star.raw_transactions(spark, d), done).select("_batch_id", "transaction_id", "amount")


# --- rules -------------------------------------------------------------------------------------


@query("rule_split", sql("""
SELECT transaction_id, amount, currency, reason AS _rejection_reason FROM rejected
UNION ALL SELECT transaction_id, amount, currency, 'valid' FROM valid""", "rejected", "valid"))
def rule_split(spark: SparkSession, d: str) -> DataFrame:
    """Both sides of the split from one scan: a valid row shows the reason 'valid'."""
    judged = rules.verdicts(star.raw_transactions(spark, d), rules.transaction_rules())
    return judged.select("transaction_id", "amount", "currency", rules.REASON)


@query("rule_split_valid", sql(f"SELECT {BUSINESS} FROM valid", "valid"))
def rule_split_valid(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = rules.rule_split(star.raw_transactions(spark, d))
    return valid.select(DELIVERED)


@query("rule_split_records", sql("""
SELECT transaction_id, amount, null_transaction_id::INT + null_amount::INT + invalid_amount::INT + negative_amount::INT
       + invalid_currency::INT + invalid_status::INT + invalid_transaction_type::INT + invalid_channel::INT
       + invalid_date::INT AS fired
FROM judged WHERE null_transaction_id OR null_amount OR invalid_amount OR negative_amount OR invalid_currency
  OR invalid_status OR invalid_transaction_type OR invalid_channel OR invalid_date""", "judged"))
def rule_split_records(spark: SparkSession, d: str) -> DataFrame:
    rejected = rules.invalid_records(star.raw_transactions(spark, d), rules.transaction_rules())
    return rejected.select("transaction_id", "amount", F.size(rules.REASONS).alias("fired"))


# fixed values: names of the nine rules
RULES = [
    "null_transaction_id", "null_amount", "invalid_amount", "negative_amount", "invalid_currency",
    "invalid_status", "invalid_transaction_type", "invalid_channel", "invalid_date",
]


@query("rule_counts", sql(
    "SELECT count(*) AS total_rows, (SELECT count(*) FROM valid) AS valid_rows, "
    + ", ".join(f"count(*) FILTER (WHERE {r}) AS {r}" for r in RULES) + " FROM judged", "judged", "valid"))
def rule_counts(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_counts(star.raw_transactions(spark, d), rules.transaction_rules())


def _register_rule(rule: str) -> None:
    @query(f"rule_{rule}", sql(f"SELECT transaction_id, {rule_columns(rule)} FROM judged WHERE {rule}", "judged"))
    def one_rule(spark: SparkSession, d: str) -> DataFrame:
        condition = dict(rules.transaction_rules())[rule]
        return star.raw_transactions(spark, d).filter(condition).select("transaction_id", *rule_columns(rule).split(", "))


def rule_columns(rule: str) -> str:
    field = rule.removeprefix("null_").removeprefix("invalid_").removeprefix("negative_")
    return {"transaction_id": "customer_id", "date": "transaction_date"}.get(field, field)


for _rule in RULES:
    _register_rule(_rule)


@query("rule_negative_unless_refund", sql("""
SELECT transaction_id, amount, transaction_type FROM raw
WHERE TRY_CAST(amount AS DOUBLE) < 0 AND transaction_type <> 'REFUND'""", "raw"))
def rule_negative_unless_refund(spark: SparkSession, d: str) -> DataFrame:
    _, condition = rules.negative_unless_refund()
    return star.raw_transactions(spark, d).filter(condition).select("transaction_id", "amount", "transaction_type")


@query("rule_date_out_of_range", sql("""
SELECT transaction_id, transaction_date FROM raw
WHERE TRY_CAST(transaction_date AS DATE) NOT BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""", "raw"))
def rule_date_out_of_range(spark: SparkSession, d: str) -> DataFrame:
    _, condition = rules.date_out_of_range("1996-01-01", "2000-12-31")
    return star.raw_transactions(spark, d).filter(condition).select("transaction_id", "transaction_date")


@query("rule_duplicate_id", sql("""
SELECT transaction_id, count(*) AS n FROM raw WHERE transaction_id IS NOT NULL
GROUP BY transaction_id HAVING count(*) > 1""", "raw"))
def rule_duplicate_id(spark: SparkSession, d: str) -> DataFrame:
    return rules.duplicate_ids(star.raw_transactions(spark, d), "transaction_id")


@query("nb_valid_filter", sql("SELECT transaction_id, amount, currency, customer_id FROM strict WHERE ok", "strict"))
def nb_valid_filter(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = rules.strict_split(star.raw_transactions(spark, d))
    return valid.select("transaction_id", "amount", "currency", "customer_id")


@query("nb_invalid_filter", sql("SELECT transaction_id, amount, currency, customer_id FROM strict WHERE NOT ok", "strict"))
def nb_invalid_filter(spark: SparkSession, d: str) -> DataFrame:
    _, invalid = rules.strict_split(star.raw_transactions(spark, d))
    return invalid.select("transaction_id", "amount", "currency", "customer_id")


STRICT_REASON = (
    "CASE WHEN TRY_CAST(amount AS DECIMAL(18,2)) <= 0 THEN 'Negative/zero amount' "
    "WHEN currency NOT IN ('USD', 'EUR', 'GBP', 'JPY', 'CAD') THEN 'Invalid currency' "
    "WHEN customer_id IS NULL THEN 'Missing customer_id' ELSE 'Other validation failure' END"
)


@query("nb_first_reason", sql(
    f"SELECT transaction_id, {STRICT_REASON} AS rejection_reason FROM strict WHERE NOT ok", "strict"))
def nb_first_reason(spark: SparkSession, d: str) -> DataFrame:
    _, invalid = rules.strict_split(star.raw_transactions(spark, d))
    return invalid.select("transaction_id", rules.strict_reason().alias("rejection_reason"))


# --- fact build --------------------------------------------------------------------------------


def _valid(spark: SparkSession, d: str) -> DataFrame:
    return rules.rule_split(star.raw_transactions(spark, d))[0]


@query("type_transform", sql(f"""
SELECT transaction_id, customer_id, account_id, merchant_id, {ts('transaction_timestamp')} AS transaction_timestamp,
       CAST(transaction_date AS VARCHAR) AS transaction_date, {dbl('amount')} AS amount, currency, transaction_type, status,
       channel, country_code, description, _batch_id FROM typed""", "typed"))
def type_transform(spark: SparkSession, d: str) -> DataFrame:
    return facts.typed(_valid(spark, d))


@query("hash_surrogate_keys", sql("""
SELECT count(*) AS rows, count(transaction_id) AS transaction_keys, count(customer_id) AS customer_keys,
       count(account_id) AS account_keys, count(merchant_id) AS merchant_keys,
       count(DISTINCT transaction_id) AS distinct_transactions, count(DISTINCT customer_id) AS distinct_customers,
       count(DISTINCT account_id) AS distinct_accounts, count(DISTINCT merchant_id) AS distinct_merchants
FROM typed""", "typed"))
def hash_surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys are present where ids are, and as many different ones: no collision."""
    keyed = facts.with_hash_keys(facts.typed(_valid(spark, d)))
    return keyed.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(f"{n}_key").alias(f"{n}_keys") for n in ("transaction", "customer", "account", "merchant")],
        *[F.count_distinct(f"{n}_key").alias(f"distinct_{n}s") for n in ("transaction", "customer", "account", "merchant")],
    )


@query("date_key", sql("""
SELECT transaction_id, transaction_date,
       CAST(strftime(TRY_CAST(transaction_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key FROM raw""", "raw"))
def date_key(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d).select(
        "transaction_id", "transaction_date", date_key_of(day(F.col("transaction_date"))).alias("date_key")
    )


@query("sequence_surrogate_keys", "SELECT count(*) AS n, count(*) AS n_keys, 0 AS n_null FROM customer")
def sequence_surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    """The keys differ from run to run; what holds of them is that each row has its own."""
    keyed = facts.with_sequence_key(star.customers(spark, d).drop("customer_key"), "customer_key")
    return keyed.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("customer_key").alias("n_keys"),
        F.count(F.when(F.col("customer_key").isNull(), 1)).cast("int").alias("n_null"),
    )


@query("lookup_surrogate_keys", sql("""
SELECT transaction_id, c.customer_key, a.account_number AS account_key, m.merchant_key
FROM strict s LEFT JOIN customers c ON s.customer_id = c.customer_id LEFT JOIN accounts a ON s.account_id = a.account_id
     LEFT JOIN merchants m ON s.merchant_id = m.merchant_id WHERE ok""", "strict", "customers", "accounts"))
def lookup_surrogate_keys(spark: SparkSession, d: str) -> DataFrame:
    valid, _ = rules.strict_split(star.raw_transactions(spark, d))
    accounts = star.accounts(spark, d).withColumn("account_key", F.col("account_number"))
    keyed = joins.with_business_keys(valid, star.customers(spark, d), accounts, star.merchants(spark, d))
    return keyed.select("transaction_id", "customer_key", "account_key", "merchant_key")


@query("fact_nb", sql(f"""
SELECT transaction_id, c.customer_key, m.merchant_key,
       CAST(strftime(TRY_CAST(transaction_date AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
       {ts("try_strptime(transaction_timestamp, '%Y-%m-%d %H:%M:%S')")} AS transaction_timestamp,
       {dbl('TRY_CAST(amount AS DECIMAL(18,2))')} AS amount_usd, s.currency, transaction_type, channel,
       coalesce(TRY_CAST(amount AS DECIMAL(18,2)) > 10000, FALSE) AS is_fraud
FROM strict s LEFT JOIN customers c ON s.customer_id = c.customer_id
     LEFT JOIN merchants m ON s.merchant_id = m.merchant_id WHERE ok""", "strict", "customers"))
def fact_nb(spark: SparkSession, d: str) -> DataFrame:
    accounts = star.accounts(spark, d).withColumn("account_key", F.col("account_number"))
    built = facts.build_fact_nb(
        star.raw_transactions(spark, d), star.customers(spark, d), accounts, star.merchants(spark, d)
    )
    return built.drop("account_key", "_batch_id")


USD = (
    "CAST(round(amount * coalesce(rate, CAST(1 AS DECIMAL(10,5))), 2) AS DECIMAL(18,2))"
)


@query("currency_normalize", sql(f"""
SELECT transaction_id, t.currency, {dbl('amount')} AS amount, {dbl(USD)} AS amount_usd
FROM typed t LEFT JOIN rates ON t.currency = code""", "typed", "rates"))
def currency_normalize(spark: SparkSession, d: str) -> DataFrame:
    return facts.with_usd(facts.typed(_valid(spark, d))).select("transaction_id", "currency", "amount", "amount_usd")


@query("fraud_flag", sql("""
SELECT transaction_id, coalesce(TRY_CAST(amount AS DECIMAL(18,2)) > 10000, FALSE) AS is_fraud FROM raw""", "raw"))
def fraud_flag(spark: SparkSession, d: str) -> DataFrame:
    amount = F.col("amount").try_cast("decimal(18,2)")
    return star.raw_transactions(spark, d).select("transaction_id", facts.fraud_flag(amount).alias("is_fraud"))


FACT_ROWS = f"""
SELECT transaction_id, CAST(strftime(transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
       {ts('transaction_timestamp')} AS transaction_timestamp, {dbl('amount')} AS amount, t.currency,
       {dbl(USD)} AS amount_usd, transaction_type, status, channel, country_code, description,
       '2002-01-01 06:00:00' AS _created_timestamp, '2002-01-01 06:00:00' AS _updated_timestamp, _batch_id
FROM typed t LEFT JOIN rates ON t.currency = code"""


@query("audit_columns", sql(FACT_ROWS, "typed", "rates"))
def audit_columns(spark: SparkSession, d: str) -> DataFrame:
    """Final fact rows without the four hash keys, which SQL cannot restate."""
    return facts.build_fact(_valid(spark, d), created_at=_clock()).drop(
        "transaction_key", "customer_key", "account_key", "merchant_key"
    )


# --- dimensions ----------------------------------------------------------------------------------


@query("dim_customer", sql("""
SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email, phone,
       CAST(NULL AS VARCHAR) AS date_of_birth, country_code, created_at AS customer_since, TRUE AS _is_current FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, email DESC, phone DESC) AS rn
  FROM customer_deliveries) WHERE rn = 1""", "customer_deliveries"))
def dim_customer(spark: SparkSession, d: str) -> DataFrame:
    built = dimensions.dim_customer(star.customer_deliveries(spark, d))
    return built.drop("customer_key", "_effective_from", "_effective_to", "_created_timestamp")


CUSTOMER_VERSIONS = sql("""WITH seen AS (
  SELECT *, lag(email) OVER w AS before, row_number() OVER w AS place FROM customer_deliveries
  WINDOW w AS (PARTITION BY customer_id ORDER BY created_at, email, phone)), opened AS (
  SELECT * FROM seen WHERE place = 1 OR before IS DISTINCT FROM email)
SELECT customer_id, first_name, last_name, email, country_code, created_at AS _effective_from,
       lead(created_at) OVER w AS _effective_to, lead(created_at) OVER w IS NULL AS _is_current
FROM opened WINDOW w AS (PARTITION BY customer_id ORDER BY created_at, email, phone)""", "customer_deliveries")


@query("dim_customer_history", CUSTOMER_VERSIONS)
def dim_customer_history(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_customer_history(star.customer_deliveries(spark, d)).drop("customer_key")


@query("dim_account_history", """
WITH delivered AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id, lpad(CAST(l_partkey AS VARCHAR), 16, '0') AS account_number,
         CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'EUR' WHEN 'R' THEN 'GBP' END AS currency,
         CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CLOSED' END AS status, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS opened
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
marked AS (
  SELECT *, lag(currency || '|' || status) OVER w AS before FROM delivered
  WINDOW w AS (PARTITION BY account_id ORDER BY opened, account_number, currency, customer_id, status)),
opened AS (SELECT * FROM marked WHERE before IS NULL OR before <> currency || '|' || status)
SELECT account_id, currency, status, strftime(opened, '%Y-%m-%d %H:%M:%S') AS _effective_from,
       strftime(lead(opened) OVER w, '%Y-%m-%d %H:%M:%S') AS _effective_to, lead(opened) OVER w IS NULL AS _is_current
FROM opened WINDOW w AS (PARTITION BY account_id ORDER BY opened, account_number, currency, customer_id, status)""")
def dim_account_history(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_account_history(star.account_deliveries(spark, d), ("currency", "status")).drop("account_key")


@query("win_dedup_latest", sql("""
SELECT customer_id, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, phone DESC) AS rn
  FROM customer_deliveries) WHERE rn = 1""", "customer_deliveries"))
def win_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = star.customer_deliveries(spark, d).select("customer_id", "created_at", "phone")
    return history.latest_delivery(rows, ["customer_id"], ["created_at", "phone"]).drop("phone")


@query("dim_account", """
SELECT CAST(l_orderkey AS VARCHAR) AS account_id, CAST(o_custkey AS VARCHAR) AS customer_id, account_number, currency,
       status, CAST(opened AS VARCHAR) AS opened_date, CAST(NULL AS VARCHAR) AS closed_date FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY opened DESC, status DESC, account_number DESC,
         currency DESC) AS rn FROM (
    SELECT l_orderkey, o_custkey, lpad(CAST(l_partkey AS VARCHAR), 16, '0') AS account_number,
           CASE l_returnflag WHEN 'A' THEN 'USD' WHEN 'N' THEN 'EUR' WHEN 'R' THEN 'GBP' END AS currency,
           CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CLOSED' END AS status, CAST(l_shipdate AS DATE) AS opened
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)) WHERE rn = 1""")
def dim_account(spark: SparkSession, d: str) -> DataFrame:
    built = dimensions.dim_account(star.account_deliveries(spark, d))
    return built.select("account_id", "customer_id", "account_number", "currency", "status", "opened_date", "closed_date")


@query("dim_merchant", sql("""
SELECT merchant_id, name AS merchant_name, category, country_code, place AS city, mcc_code FROM (
  SELECT m.*, merchant_name || ' ' || l_returnflag AS name, city || '/' || l_linenumber AS place,
         row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, merchant_name || ' ' || l_returnflag DESC,
                            city || '/' || l_linenumber DESC) AS rn
  FROM lineitem LEFT JOIN merchants m ON l_suppkey = merchant_key) WHERE rn = 1""", "merchants"))
def dim_merchant(spark: SparkSession, d: str) -> DataFrame:
    built = dimensions.dim_merchant(star.merchant_deliveries(spark, d))
    return built.select("merchant_id", "merchant_name", "category", "country_code", "city", "mcc_code")


@query("dim_customer_nb", sql("""
SELECT customer_id, first_name, last_name, email, phone, CAST(NULL AS VARCHAR) AS date_of_birth, country_code,
       substr(created_at, 1, 10) AS customer_since, TRUE AS is_active, TRUE AS is_current
FROM customer_deliveries WHERE customer_id IS NOT NULL""", "customer_deliveries"))
def dim_customer_nb(spark: SparkSession, d: str) -> DataFrame:
    built = dimensions.dim_customer_nb(star.customer_deliveries(spark, d))
    return built.drop("customer_key", "effective_start_date", "effective_end_date", "_created_timestamp")


@query("dim_account_nb", sql("""
SELECT account_id, customer_key, account_type, status AS account_status, CAST(balance AS DOUBLE) AS balance, currency,
       opened_date, closed_date, TRUE AS is_current
FROM accounts a LEFT JOIN customers c ON a.customer_id = c.customer_id""", "accounts", "customers"))
def dim_account_nb(spark: SparkSession, d: str) -> DataFrame:
    built = dimensions.dim_account_nb(star.accounts(spark, d), star.customers(spark, d))
    return built.drop("account_key", "effective_start_date", "effective_end_date", "_created_timestamp")


@query("dim_merchant_nb", sql("""
SELECT merchant_id, merchant_name, category AS merchant_category, city, country_code, mcc_code, TRUE AS is_active
FROM merchants""", "merchants"))
def dim_merchant_nb(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_merchant_nb(star.merchant_records(spark, d)).drop("merchant_key", "_created_timestamp")


COVERED = """WHERE year BETWEEN (SELECT min(year(o_orderdate)) FROM orders) AND (SELECT max(year(o_orderdate)) FROM orders)"""


@query("dim_date", sql(f"""
SELECT CAST(full_date AS VARCHAR) AS full_date, * EXCLUDE (full_date, iso_year) FROM calendar {COVERED}""", "calendar"))
def dim_date(spark: SparkSession, d: str) -> DataFrame:
    """Calendar of the full years that the orders touch."""
    return dimensions.dim_date(dimensions.covering_days(star.table(spark, d, "orders"), "o_orderdate"))


@query("dim_date_nb", sql(f"""
SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, year, quarter, month, month_name, week_of_year, day_of_month,
       day_of_week, day_name, is_weekend, FALSE AS is_holiday FROM calendar {COVERED}""", "calendar"))
def dim_date_nb(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.dim_date_nb(dimensions.covering_days(star.table(spark, d, "orders"), "o_orderdate"))


@query("scd1_upsert", sql("""
SELECT coalesce(n.customer_id, c.customer_id) AS customer_id, coalesce(n.email, c.last_name || '@old.com') AS email
FROM customers c FULL JOIN (SELECT customer_id, email FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC, phone DESC) AS rn
  FROM customer_deliveries) WHERE rn = 1) n ON c.customer_id = n.customer_id""", "customer_deliveries"))
def scd1_upsert(spark: SparkSession, d: str) -> DataFrame:
    current = star.customers(spark, d).select("customer_id", F.concat("last_name", F.lit("@old.com")).alias("email"))
    incoming = star.customer_deliveries(spark, d)
    merged = dimensions.scd1_upsert(
        current.withColumns({"created_at": F.lit(""), "phone": F.lit("")}),
        incoming.select("customer_id", "email", "created_at", "phone"),
        "customer_id", [F.desc("created_at"), F.desc("phone")],
    )
    return merged.select("customer_id", "email")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")


SCD2 = """
SELECT user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS valid_from,
       strftime(lead(ts) OVER w, '%Y-%m-%d %H:%M:%S') AS valid_to, lead(ts) OVER w IS NULL AS is_current, event_id
FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query("scd2_history", SCD2)
def scd2_history(spark: SparkSession, d: str) -> DataFrame:
    return history.scd2_history(_events(spark, d), ["user_id"], ["ts", "event_id"], ["event_type"])


@query("scd2_incremental", SCD2)
def scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """History of the deliveries before a day, brought up to date with the rest: the same
    rows as a history of everything."""
    log, cut = _events(spark, d), F.lit("2024-01-20").cast("timestamp_ntz")
    old, new = log.filter(F.col("ts") < cut), log.filter(F.col("ts") >= cut)
    args = (["user_id"], ["ts", "event_id"], ["event_type"])
    return history.scd2_apply(history.scd2_history(old, *args), log, new, *args)


# --- set operations and scalar functions -----------------------------------------------------------


@query("union_by_name_missing", """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer""")
def union_by_name_missing(spark: SparkSession, d: str) -> DataFrame:
    shops = star.table(spark, d, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")
    people = star.table(spark, d, "customer").selectExpr(
        "c_mktsegment AS segment", "c_custkey AS id", "c_acctbal AS balance", "c_name AS name"
    )
    return shops.unionByName(people, allowMissingColumns=True)


@query("distinct_ids", sql("SELECT DISTINCT transaction_id FROM rejected", "rejected"))
def distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    _, rejected = rules.rule_split(star.raw_transactions(spark, d))
    return rejected.select("transaction_id").distinct()


@query("distinct_values", sql("SELECT DISTINCT currency, status FROM raw", "raw"))
def distinct_values(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d).select("currency", "status").distinct()


@query("empty_like", "SELECT o_orderkey, o_orderstatus FROM orders WHERE FALSE")
def empty_like(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "orders").select("o_orderkey", "o_orderstatus").filter(F.lit(False))


@query("functions_text", """
SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, regexp_matches(c_name, '0$') AS ends_zero,
       c_mktsegment LIKE 'B%' AS like_b, starts_with(c_mktsegment, 'M') AS starts_m FROM customer""")
def functions_text(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "customer").select(
        "c_custkey",
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.col("c_name").rlike("0$").alias("ends_zero"),
        F.col("c_mktsegment").like("B%").alias("like_b"),
        F.col("c_mktsegment").startswith("M").alias("starts_m"),
    )


@query("functions_time", """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS compact, month(o_orderdate) AS month,
       datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days,
       CAST(CAST(o_orderdate - INTERVAL 30 DAY AS DATE) AS VARCHAR) AS month_before FROM orders""")
def functions_time(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
        F.month("o_orderdate").alias("month"),
        F.datediff(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("age_days"),
        F.date_sub(F.to_date("o_orderdate"), 30).alias("month_before"),
    )


@query("functions_math", """
SELECT c_custkey, abs(c_acctbal) AS magnitude, greatest(c_acctbal, 0.0) AS at_least_zero,
       CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded, c_acctbal / 4 AS quarter FROM customer""")
def functions_math(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "customer").select(
        "c_custkey",
        F.abs("c_acctbal").alias("magnitude"),
        F.greatest(F.col("c_acctbal"), F.lit(0.0)).alias("at_least_zero"),
        F.round(F.col("c_acctbal").cast("decimal(18,2)"), 1).alias("rounded"),
        (F.col("c_acctbal") / 4).alias("quarter"),
    )


@query("functions_hash", """
SELECT upper(substr(md5('cust_' || c_custkey), 1, 12)) AS id, c_custkey FROM customer""")
def functions_hash(spark: SparkSession, d: str) -> DataFrame:
    digest = F.md5(F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).cast("binary"))
    return star.table(spark, d, "customer").select(F.upper(F.substring(digest, 1, 12)).alias("id"), "c_custkey")


@query("functions_conditional", sql("""
SELECT coalesce(currency, 'none') AS currency, count(*) AS n, count(*) FILTER (WHERE amount IS NULL) AS null_amounts,
       count(*) FILTER (WHERE status IN ('COMPLETED', 'REFUNDED')) AS settled,
       sum(CASE WHEN channel = 'POS' THEN 1 ELSE 0 END)::BIGINT AS pos FROM raw GROUP BY 1""", "raw"))
def functions_conditional(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d).groupBy(F.coalesce("currency", F.lit("none")).alias("currency")).agg(
        F.count(F.lit(1)).alias("n"),
        count_if(F.col("amount").isNull()).alias("null_amounts"),
        count_if(F.col("status").isin("COMPLETED", "REFUNDED")).alias("settled"),
        F.sum(F.when(F.col("channel") == "POS", 1).otherwise(0)).alias("pos"),
    )


@query("functions_cast", sql("""
SELECT transaction_id, amount, TRY_CAST(amount AS DOUBLE) AS as_double,
       CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS as_decimal,
       CAST(TRY_CAST(transaction_date AS DATE) AS VARCHAR) AS as_date FROM raw""", "raw"))
def functions_cast(spark: SparkSession, d: str) -> DataFrame:
    return star.raw_transactions(spark, d).select(
        "transaction_id", "amount",
        F.col("amount").try_cast("double").alias("as_double"),
        F.col("amount").try_cast("decimal(18,2)").alias("as_decimal"),
        F.col("transaction_date").try_cast("date").alias("as_date"),
    )


@query("functions_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS record FROM events""")
def functions_json(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "events").select(
        "event_id",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.to_json(F.struct("event_id", "event_type")).alias("record"),
    )


@query("functions_aggregate", """
SELECT l_returnflag, count(*) AS n, count(DISTINCT l_suppkey) AS suppliers, min(l_quantity) AS low,
       max(l_quantity) AS high, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total,
       round(stddev_samp(l_quantity), 6) AS spread FROM lineitem GROUP BY l_returnflag""")
def functions_aggregate(spark: SparkSession, d: str) -> DataFrame:
    return star.table(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.min("l_quantity").alias("low"),
        F.max("l_quantity").alias("high"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("total"),
        F.round(F.stddev_samp("l_quantity"), 6).alias("spread"),
    )


@query("merge_upsert_listed_columns", sql("""
SELECT coalesce(a.account_id, n.id) AS account_id,
       CASE WHEN n.id IS NOT NULL THEN n.status ELSE a.status END AS status,
       CASE WHEN a.account_id IS NOT NULL THEN a.opened_date END AS opened_date
FROM accounts a FULL JOIN (SELECT CAST(o_orderkey + 5 AS VARCHAR) AS id, 'MOVED' AS status FROM orders) n
  ON a.account_id = n.id""", "accounts"))
def merge_upsert_listed_columns(spark: SparkSession, d: str) -> DataFrame:
    """Update one column on match; insert only the key and that column otherwise."""
    target = star.accounts(spark, d).select("account_id", "status", "opened_date")
    source = star.table(spark, d, "orders").selectExpr(
        "CAST(o_orderkey + 5 AS STRING) AS account_id", "'MOVED' AS status", "'2001-01-01' AS opened_date"
    )
    return merge_upsert(target, source, "account_id", update_columns=["status"], insert_columns=["account_id", "status"])
