"""Dimension builders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.columns import day, key_of, moment, money
from ledgerloom.operators.history import scd2_history
from ledgerloom.operators.joins import accounts_with_customer
from ledgerloom.sources.sinks import latest_per_key, merge_upsert


def _current_version(rows: DataFrame, effective_from: Column | None) -> DataFrame:
    now = F.current_timestamp()
    return rows.withColumns({
        "_effective_from": effective_from if effective_from is not None else now,
        "_effective_to": F.lit(None).cast("timestamp"),
        "_is_current": F.lit(True),
        "_created_timestamp": now,
    })


def dim_customer(raw: DataFrame, effective_from: Column | None = None) -> DataFrame:
    """Latest delivery per customer by creation time; ties go to the newest update, then
    to the larger record, so reruns agree."""
    latest = latest_per_key(
        raw.withColumn("customer_since", moment(F.col("created_at"))),
        ["customer_id"],
        [F.desc_nulls_last("customer_since"), F.desc_nulls_last("updated_at"),
         F.desc_nulls_last("email"), F.desc_nulls_last("phone"), F.desc_nulls_last("last_name")],
    )
    return _current_version(latest.select(
        key_of(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "phone",
        day(F.col("date_of_birth")).alias("date_of_birth"),
        "country_code",
        "customer_since",
    ), effective_from)


def dim_customer_history(
    raw: DataFrame,
    tracked: tuple[str, ...] = ("first_name", "last_name", "email", "country_code"),
    bucket: str = "month",
) -> DataFrame:
    """All versions of each customer: one opens whenever a tracked attribute changes between
    deliveries, in order of their update (or creation) time."""
    changed_at = moment(F.coalesce("updated_at", "created_at"))
    order = list(dict.fromkeys(["email", "phone", *tracked]))  # ties of the time, so reruns agree
    deliveries = raw.select("customer_id", *order, changed_at.alias("changed_at"))
    order = ["changed_at", *order]
    versions = scd2_history(deliveries, ["customer_id"], order, list(tracked), bucket)
    return versions.select(
        key_of(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        *tracked,
        F.col("valid_from").alias("_effective_from"),
        F.col("valid_to").alias("_effective_to"),
        F.col("is_current").alias("_is_current"),
    )


def dim_account(raw: DataFrame, effective_from: Column | None = None) -> DataFrame:
    """Latest delivery per account by opening day."""
    latest = latest_per_key(
        raw.withColumn("opened", day(F.col("opened_date"))),
        ["account_id"],
        [F.desc_nulls_last("opened"), F.desc_nulls_last("status"), F.desc_nulls_last("account_number"),
         F.desc_nulls_last("customer_id"), F.desc_nulls_last("currency")],
    )
    return _current_version(latest.select(
        key_of(F.col("account_id")).alias("account_key"),
        "account_id",
        key_of(F.col("customer_id")).alias("customer_key"),
        "customer_id",
        "account_type",
        "account_number",
        "currency",
        "status",
        F.col("opened").alias("opened_date"),
        day(F.col("closed_date")).alias("closed_date"),
    ), effective_from)


def dim_account_history(
    raw: DataFrame,
    tracked: tuple[str, ...] = ("account_type", "currency", "status"),
    bucket: str = "month",
) -> DataFrame:
    """All versions of each account: one opens whenever a tracked attribute changes between
    deliveries, in order of the opening day."""
    columns = [c for c in raw.columns if c in ("account_number", "customer_id", *tracked)]
    opened = day(F.col("opened_date")).cast("timestamp")
    deliveries = raw.select("account_id", *columns, opened.alias("changed_at"))
    order = ["changed_at", *sorted(columns)]
    tracked = tuple(c for c in tracked if c in columns)
    versions = scd2_history(deliveries, ["account_id"], order, list(tracked), bucket)
    return versions.select(
        key_of(F.col("account_id")).alias("account_key"),
        "account_id",
        *tracked,
        F.col("valid_from").alias("_effective_from"),
        F.col("valid_to").alias("_effective_to"),
        F.col("is_current").alias("_is_current"),
    )


def dim_merchant(raw: DataFrame) -> DataFrame:
    """Newest delivery per merchant (no history)."""
    latest = latest_per_key(
        raw,
        ["merchant_id"],
        [F.desc_nulls_last("_ingestion_timestamp"), F.desc_nulls_last("merchant_name"),
         F.desc_nulls_last("category"), F.desc_nulls_last("city")],
    )
    now = F.current_timestamp()
    return latest.select(
        key_of(F.col("merchant_id")).alias("merchant_key"),
        "merchant_id",
        "merchant_name",
        "category",
        "country_code",
        "city",
        "mcc_code",
        now.alias("_created_timestamp"),
        now.alias("_updated_timestamp"),
    )


# --- variants of the scheduled job: no dedup, sequence keys ---------------------------------


def _open_period() -> list[Column]:
    return [
        F.current_timestamp().alias("effective_start_date"),
        F.lit(None).cast("timestamp").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        F.current_timestamp().alias("_created_timestamp"),
    ]


def dim_customer_nb(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("customer_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("customer_key"),
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone",
        F.col("date_of_birth").try_cast("date").alias("date_of_birth"),
        "country_code",
        F.col("created_at").try_cast("date").alias("customer_since"),
        F.lit(True).alias("is_active"),
        *_open_period(),
    )


def dim_account_nb(raw: DataFrame, customers: DataFrame) -> DataFrame:
    return accounts_with_customer(raw.filter(F.col("account_id").isNotNull()), customers).select(
        F.monotonically_increasing_id().alias("account_key"),
        "account_id",
        "customer_key",
        "account_type",
        F.col("status").alias("account_status"),
        money(F.col("balance")).alias("balance"),
        "currency",
        F.col("opened_date").try_cast("date").alias("opened_date"),
        F.col("closed_date").try_cast("date").alias("closed_date"),
        *_open_period(),
    )


def dim_merchant_nb(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("merchant_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("merchant_key"),
        "merchant_id",
        "merchant_name",
        F.col("category").alias("merchant_category"),
        "city",
        "country_code",
        "mcc_code",
        F.lit(True).alias("is_active"),
        F.current_timestamp().alias("_created_timestamp"),
    )


# --- calendar ---------------------------------------------------------------------------


def calendar_days(spark: SparkSession, start_year: int = 2020, end_year: int = 2030) -> DataFrame:
    """One row per day of the inclusive years."""
    return spark.range(0, 1, 1, 1).select(F.explode(F.sequence(
        F.lit(f"{start_year}-01-01").cast("date"), F.lit(f"{end_year}-12-31").cast("date")
    )).alias("full_date"))


def covering_days(rows: DataFrame, column: str) -> DataFrame:
    """Days of all full years the column touches."""
    span = rows.agg(F.year(F.min(column)).alias("y1"), F.year(F.max(column)).alias("y2"))
    return span.select(F.explode(F.sequence(
        F.make_date("y1", F.lit(1), F.lit(1)), F.make_date("y2", F.lit(12), F.lit(31))
    )).alias("full_date"))


def dim_date(days: DataFrame) -> DataFrame:
    """Calendar attributes: ISO week, Monday = 1, fiscal year starting in July."""
    return days.selectExpr(
        "year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS date_key",
        "full_date",
        "year(full_date) AS year",
        "quarter(full_date) AS quarter",
        "month(full_date) AS month",
        "date_format(full_date, 'MMMM') AS month_name",
        "date_format(full_date, 'MMM') AS month_short",
        "weekofyear(full_date) AS week_of_year",
        "day(full_date) AS day_of_month",
        "weekday(full_date) + 1 AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "date_format(full_date, 'EEE') AS day_short",
        "weekday(full_date) >= 5 AS is_weekend",
        "day(full_date) = 1 AS is_month_start",
        "full_date = last_day(full_date) AS is_month_end",
        "year(add_months(full_date, -6)) AS fiscal_year",
        "quarter(add_months(full_date, -6)) AS fiscal_quarter",
    )


def dim_date_nb(days: DataFrame) -> DataFrame:
    """Calendar of the scheduled job: narrow integers, a holiday flag, no short or fiscal columns."""
    return dim_date(days).select(
        "date_key",
        "full_date",
        F.col("year").cast("smallint").alias("year"),
        *[F.col(c).cast("tinyint").alias(c) for c in ("quarter", "month")],
        "month_name",
        *[F.col(c).cast("tinyint").alias(c) for c in ("week_of_year", "day_of_month", "day_of_week")],
        "day_name",
        "is_weekend",
        F.lit(False).alias("is_holiday"),
    )


def scd1_upsert(current: DataFrame, incoming: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Overwrite by business key with the newest incoming version."""
    return merge_upsert(current, latest_per_key(incoming, [key], order), key)
