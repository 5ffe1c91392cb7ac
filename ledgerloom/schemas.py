"""Declared schemas of the raw layer, the fact table and the quarantine."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT = T.StringType()

INGESTION_COLUMNS = [
    T.StructField("_ingestion_timestamp", T.TimestampType()),
    T.StructField("_source_file", _TEXT),
    T.StructField("_source_system", _TEXT),
    T.StructField("_batch_id", _TEXT),
    T.StructField("_load_date", T.DateType()),
]

# fixed values: business columns of each source, in delivery order
BUSINESS_COLUMNS = {
    "transactions": [
        "transaction_id", "customer_id", "account_id", "merchant_id", "transaction_date",
        "transaction_timestamp", "amount", "currency", "transaction_type", "status", "channel",
        "country_code", "description",
    ],
    "customers": [
        "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth",
        "country_code", "created_at", "updated_at",
    ],
    "accounts": [
        "account_id", "customer_id", "account_type", "account_number", "balance", "currency",
        "status", "opened_date", "closed_date",
    ],
    "merchants": ["merchant_id", "merchant_name", "category", "country_code", "city", "mcc_code"],
}
BUSINESS_KEY = {
    "transactions": "transaction_id",
    "customers": "customer_id",
    "accounts": "account_id",
    "merchants": "merchant_id",
}


def delivered(source: str) -> T.StructType:
    """Schema of a source file: every business column as text."""
    return T.StructType([T.StructField(c, _TEXT) for c in BUSINESS_COLUMNS[source]])


def raw(source: str) -> T.StructType:
    """Schema of the raw table: lineage columns, then the business columns as text."""
    return T.StructType(INGESTION_COLUMNS + delivered(source).fields)


FACT = T.StructType([
    T.StructField("transaction_key", T.LongType(), False),
    T.StructField("transaction_id", _TEXT, False),
    T.StructField("customer_key", T.LongType()),
    T.StructField("account_key", T.LongType()),
    T.StructField("merchant_key", T.LongType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("transaction_timestamp", T.TimestampType()),
    T.StructField("amount", T.DecimalType(18, 2)),
    T.StructField("currency", _TEXT),
    T.StructField("amount_usd", T.DecimalType(18, 2)),
    T.StructField("transaction_type", _TEXT),
    T.StructField("status", _TEXT),
    T.StructField("channel", _TEXT),
    T.StructField("country_code", _TEXT),
    T.StructField("description", _TEXT),
    T.StructField("_created_timestamp", T.TimestampType()),
    T.StructField("_updated_timestamp", T.TimestampType()),
])

QUARANTINE = T.StructType([
    T.StructField("quarantine_timestamp", T.TimestampType()),
    T.StructField("source_table", _TEXT),
    T.StructField("rejection_reason", _TEXT),
    T.StructField("batch_id", _TEXT),
    T.StructField("quarantine_date", T.DateType()),
    T.StructField("original_record", _TEXT),
])
