"""Small helpers that the operators share: words, row identity, stored intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import new_location, shuffles_removed

#: ASCII white space, the separators of the word contract `[^\x20\x09-\x0D]+`.
SPACES = "[\\x20\\x09-\\x0D]+"


def text_of(column: str | Column) -> Column:
    """The text, empty where it is NULL."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def words_of(column: str | Column, separators: str = SPACES) -> Column:
    """Array of the words between separators; NULL and blank texts have none."""
    return F.array_remove(F.split(text_of(column), separators), "")


def row_key(id_column: str, text_column: str) -> Column:
    """Identity of a row by content: rows that agree in id and text are one document told twice."""
    return F.xxhash64(F.col(id_column), F.col(text_column))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends here, lost executors lose nothing."""
    spark = df.sparkSession
    path = new_location(spark, label)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """The frame with more columns, each computed once per row.

    A generator stands between them and their readers. Without it the optimizer copies the expressions
    into filters and lambdas that name them, and a lambda over words would split its text once per word.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def once(value: Column, use) -> Column:
    """use(value) with the value computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def unused(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


#: rows of a few numbers that may be broadcast, about 15 to 30 MB in a task, and more in the driver that sends them
HELD = 500_000


def held(df: DataFrame, most: int = HELD) -> DataFrame:
    """A stored frame of a few numbers a row, to be broadcast if its count allows, else joined by shuffle."""
    return F.broadcast(df) if df.count() <= most else apart(df)


def apart(df: DataFrame) -> DataFrame:
    """The frame, to be joined by shuffle and sort whatever its size is guessed to be.

    Spark takes the rows of an explode for as many as went in and a file's bytes for the rows' size in memory, and would send
    a table of many millions of rows through the driver.
    """
    return df.hint("merge")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
