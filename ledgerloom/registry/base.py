"""Registry of runnable queries and the SQL that states the same result independently."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def presentable(df: DataFrame) -> DataFrame:
    """Types that every client shows alike: text for dates, double for decimals."""
    shown = []
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.DateType):
            name = f"CAST({name} AS STRING)"
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            name = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')"
        elif isinstance(f.dataType, T.DecimalType):
            name = f"CAST({name} AS DOUBLE)"
        elif isinstance(f.dataType, (T.ByteType, T.ShortType)):
            name = f"CAST({name} AS INT)"
        shown.append(f"{name} AS `{f.name}`")
    return df.selectExpr(*shown)


def query(name: str, sql: str | None = None):
    """Register a query; `sql` gives the same rows on the same tables."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: presentable(build(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
