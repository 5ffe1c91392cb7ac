"""Raw-layer operators: text casting, lineage columns, schema enforcement, batch reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom import schemas
from ledgerloom.functions import reference_data as ref
from ledgerloom.functions.columns import count_if
from ledgerloom.sources.sinks import latest_per_key


def cast_all_to_string(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def add_ingestion_metadata(
    df: DataFrame,
    source_file: str | Column,
    source_system: str,
    batch_id: str | Column,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Five lineage columns. `source_file` may be a column such as `_metadata.file_path`;
    `ingested_at` pins the clock for reruns that must give the same rows."""
    now = ingested_at if ingested_at is not None else F.current_timestamp()

    def as_column(value):
        return value if isinstance(value, Column) else F.lit(value)

    return df.withColumns({
        "_ingestion_timestamp": now,
        "_source_file": as_column(source_file),
        "_source_system": F.lit(source_system),
        "_batch_id": as_column(batch_id),
        "_load_date": F.to_date(now),
    })


def add_ingestion_metadata_nb(
    df: DataFrame, source_file: str, batch_id: str, ingested_at: Column | None = None
) -> DataFrame:
    """Three-column lineage of the scheduled job."""
    return df.withColumns({
        "_ingested_at": ingested_at if ingested_at is not None else F.current_timestamp(),
        "_batch_id": F.lit(batch_id),
        "_source_file": F.lit(source_file),
    })


def enforce_schema(df: DataFrame, schema: StructType, fill_missing: bool = True) -> DataFrame:
    """One projection: cast known columns, typed NULL for missing ones, drop the rest."""
    present = set(df.columns)
    return df.select([
        (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields
        if fill_missing or f.name in present
    ])


def to_raw(
    df: DataFrame,
    source: str,
    source_file: str | Column,
    source_system: str,
    batch_id: str | Column,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Delivery to raw-table rows: text columns, lineage, declared column order."""
    text = cast_all_to_string(df)
    return enforce_schema(
        add_ingestion_metadata(text, source_file, source_system, batch_id, ingested_at),
        schemas.raw(source),
    )


def schema_conformance(df: DataFrame, expected: StructType) -> DataFrame:
    """How well the data fits a target schema, one row per column: rows, NULLs and
    non-NULL values that do not cast. One aggregate over one scan, then unpivoted."""
    declared = {f.name: f.dataType for f in expected.fields}
    measures, reports = [F.count(F.lit(1)).alias("_rows")], []
    for name in list(declared) + [c for c in df.columns if c not in declared]:
        if name not in df.columns:
            state, nulls, bad = "missing", F.lit(None), F.lit(None)
        else:
            column = F.col(name)
            state = "expected" if name in declared else "unexpected"
            castable = column.try_cast(declared[name]) if name in declared else column
            measures += [
                count_if(column.isNull()).alias(f"n_{name}"),
                count_if(column.isNotNull() & castable.isNull()).alias(f"b_{name}"),
            ]
            nulls, bad = F.col(f"n_{name}"), F.col(f"b_{name}")
        reports.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(state).alias("state"),
            F.col("_rows").alias("total_rows"),
            nulls.cast("long").alias("null_rows"),
            bad.cast("long").alias("uncastable_rows"),
        ))
    return df.agg(*measures).select(F.inline(F.array(*reports)))


def batch_summary(raw: DataFrame, batch_id: str | None = None) -> DataFrame:
    """Per batch: rows, ingestion span, distinct transactions and customers."""
    rows = raw if batch_id is None else raw.filter(F.col("_batch_id") == batch_id)
    return rows.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.min("_ingestion_timestamp").alias("first_ingestion"),
        F.max("_ingestion_timestamp").alias("last_ingestion"),
        F.count_distinct("transaction_id").alias("unique_transactions"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )


def batch_metrics_latest(raw: DataFrame, n: int = 10) -> DataFrame:
    """The newest n batches with their size and span."""
    per_batch = raw.groupBy("_batch_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min("_ingestion_timestamp").alias("batch_start"),
        F.max("_ingestion_timestamp").alias("batch_end"),
    )
    return per_batch.orderBy(F.desc("batch_start"), F.desc("_batch_id")).limit(n)


def dedup_by_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return latest_per_key(df, [key], order)


def bad_marker_profile(df: DataFrame) -> DataFrame:
    """One row: rows per bad-data marker, marked rows, unmarked rows, all rows."""
    ident = F.col("transaction_id")
    marked = F.coalesce(ident.startswith("TEST_"), F.lit(False))
    return df.agg(
        *[count_if(ident.startswith(prefix)).alias(f"{name}_rows") for name, prefix in ref.BAD_MARKERS.items()],
        count_if(marked).alias("marked_rows"),
        count_if(~marked).alias("good_rows"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def good_bad_sample(df: DataFrame, bad: bool, n: int = 5) -> DataFrame:
    """The first n rows with (or without) the test prefix, in id order."""
    marked = F.coalesce(F.col("transaction_id").startswith("TEST_"), F.lit(False))
    return df.filter(marked if bad else ~marked).orderBy("transaction_id", "amount", "transaction_date").limit(n)
