"""The whole run: deliveries to raw tables, to fact and dimensions, to gold tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators import validation
from ledgerloom.plans import bronze, gold, silver
from ledgerloom.session import shuffles_removed, together
from ledgerloom.sources import versions
from ledgerloom.sources.readers import read_table

SOURCES = ["transactions", "customers", "accounts", "merchants"]
DIMENSIONS = ["dim_customer", "dim_account", "dim_merchant", "dim_date"]


@dataclass(frozen=True)
class Layout:
    """Paths of all tables below one root."""

    root: str

    def raw(self, source: str) -> str:
        return f"{self.root}/bronze/{source}_raw"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def validation(self) -> str:
        return f"{self.gold}/validation_report"


def ingest(deliveries: dict[str, DataFrame], layout: Layout, batch_id: str, at: Column | None = None) -> dict[str, int]:
    return together({
        f"{source}_raw": partial(bronze.load_dataframe, df, source, layout.raw(source), batch_id, ingested_at=at)
        for source, df in deliveries.items()
    })


def calendar_years(spark: SparkSession, fact_table: str, years: tuple[int, int] | None) -> tuple[int, int]:
    """Full years that cover all days of the fact, by its entries, and the years asked for."""
    store, table = versions.resolve(spark, fact_table)
    listed = versions.entries(spark, versions.version(spark, store), table)
    low, high = listed.agg(F.min("low_date_key"), F.max("high_date_key")).first()
    spans = [years] if years else []
    spans += [(low // 10000, high // 10000)] if low is not None else []
    return (min(a for a, _ in spans), max(b for _, b in spans)) if spans else (2020, 2030)


def build_silver(
    spark: SparkSession, layout: Layout, incremental: bool, years: tuple[int, int] | None = None, at: Column | None = None,
    gate: str | None = None,
) -> None:
    fact = layout.silver("fact_transactions")
    silver.transform_transactions(
        spark, layout.raw("transactions"), fact, layout.silver("quarantine"), incremental=incremental, at=at, gate=gate,
    )
    silver.build_all_dimensions(
        spark, {s: layout.raw(s) for s in SOURCES[1:]}, {d: layout.silver(d) for d in DIMENSIONS}, *calendar_years(spark, fact, years)
    )


def build_gold(spark: SparkSession, layout: Layout, as_of: Column | None = None, at: Column | None = None) -> dict[str, int]:
    customer, merchant, date = (read_table(spark, layout.silver(t)) for t in ("dim_customer", "dim_merchant", "dim_date"))
    return gold.refresh(spark, layout.silver("fact_transactions"), customer, merchant, date, layout.gold, as_of, at)


def validate(spark: SparkSession, layout: Layout) -> DataFrame:
    raw = read_table(spark, layout.raw("transactions"))
    fact = read_table(spark, layout.silver("fact_transactions"))
    rejected = read_table(spark, layout.silver("quarantine")).filter("first")
    raw = raw.withColumn("record", validation.record_of(schemas.BUSINESS_COLUMNS["transactions"]))
    checks = [
        validation.null_keys(fact, "transaction_key"),
        validation.duplicate_keys(fact, "transaction_key"),
        validation.amount_range(fact),
        validation.amount_coverage(fact),
        validation.orphan_rate(fact, "customer_key", read_table(spark, layout.silver("dim_customer")), "customer_key"),
        validation.orphan_rate(fact, "merchant_key", read_table(spark, layout.silver("dim_merchant")), "merchant_key"),
        validation.reconcile(raw, fact, rejected),
    ]
    report = checks[0]
    for check in checks[1:]:
        report = report.unionByName(check)
    return report


def layer_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Rows per table of all layers, as the commits tell them: no table is read."""
    paths = {f"{s}_raw": layout.raw(s) for s in SOURCES}
    paths |= {t: layout.silver(t) for t in ["fact_transactions", "quarantine", *DIMENSIONS]}
    paths |= {t: f"{layout.gold}/{t}" for t in gold.TABLES}
    return committed_counts(spark, paths)


def committed_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, records) of tables with commits by name."""
    counts = []
    for name, path in paths.items():
        store, table = versions.resolve(spark, path)
        counts.append(F.struct(F.lit(name).alias("table_name"), F.lit(versions.version(spark, store).tables[table].rows).cast("bigint").alias("records")))
    return spark.range(1).select(F.inline(F.array(*counts)))


class ValidationError(RuntimeError):
    """A finished run broke a validation that its caller demands."""


def run(
    spark: SparkSession, deliveries: dict[str, DataFrame], layout: Layout, batch_id: str,
    years: tuple[int, int] | None = None, at: Column | None = None, as_of: Column | None = None,
    gate: str | None = None, strict: bool = False,
) -> DataFrame:
    """Ingest a batch, bring silver, its histories and gold up to date, validate, and return the
    rows per table. The calendar covers the years asked for and all that the facts have.

    `gate` stops the silver step as in `transform_transactions`. The validation report is
    written to the gold layer; with `strict` a failed check is an error.
    """
    with shuffles_removed(spark):
        ingest(deliveries, layout, batch_id, at)
        build_silver(spark, layout, incremental=True, years=years, at=at, gate=gate)
        together({
            "customers": lambda: silver.build_dim_customer(spark, layout.raw("customers"), layout.silver("dim_customer_history")),
            "accounts": lambda: silver.build_dim_account(spark, layout.raw("accounts"), layout.silver("dim_account_history")),
            "gold": lambda: build_gold(spark, layout, as_of, at),
            "validation": lambda: versions.overwrite(spark, layout.validation, validate(spark, layout)),
        })
    failed = read_table(spark, layout.validation).filter("NOT coalesce(passed, false)")
    if strict and not failed.isEmpty():
        raise ValidationError(", ".join(r.check_name for r in failed.select("check_name").collect()))
    return layer_counts(spark, layout)


def full_reprocess(
    spark: SparkSession, layout: Layout, rebuilt: Layout,
    years: tuple[int, int] | None = None, at: Column | None = None, as_of: Column | None = None,
) -> DataFrame:
    """Rebuild silver and gold from the raw tables. `rebuilt` may be the layout itself: each table's commit flips its readers
    from the old contents to the new."""
    fact = rebuilt.silver("fact_transactions")
    silver.transform_transactions(spark, layout.raw("transactions"), fact, rebuilt.silver("quarantine"), incremental=False, at=at)
    silver.build_all_dimensions(
        spark, {s: layout.raw(s) for s in SOURCES[1:]}, {d: rebuilt.silver(d) for d in DIMENSIONS}, *calendar_years(spark, fact, years)
    )
    build_gold(spark, rebuilt, as_of, at)
    return committed_counts(spark, {t: rebuilt.silver(t) for t in ("fact_transactions", "quarantine", *DIMENSIONS)})
