"""Session settings, written intermediate tables and text expressions of the operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.session import configure, scratch_path

# A word is a run of characters other than space, tab, line feed, vertical tab,
# form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"

SETTINGS = {
    # Arrow batches are cut by bytes, so that long texts do not fill a Python worker.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    # Steps end in written tables, so a step's shuffle files can go with it.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Settings that the operators rely on (idempotent)."""
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can reach, fixes values that must
    not change between jobs, and lets Spark see the true size of the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def div(a: Column, b: Column) -> Column:
    """Whole quotient of whole numbers."""
    return F.call_function("div", a, b)


def packed(df: DataFrame, *without: str, **named: Column) -> DataFrame:
    """The columns of ``df`` but ``without`` as one struct ``row``, next to ``named`` ones.

    Whatever the columns of a table are called, they cannot clash with an operator's own.
    """
    inner = [F.col(f"`{c}`") for c in df.columns if c not in without]
    # A struct needs a field.
    row = F.struct(*(inner or [F.lit(0).alias("_")]))
    return df.select(row.alias("row"), *[c.alias(n) for n, c in named.items()])


def unpacked(df: DataFrame, columns: list[str], **instead: Column) -> DataFrame:
    """The columns of ``row`` under their names, with ``instead`` in place of those left out."""
    return df.select(*[instead[c].alias(c) if c in instead else F.col(f"row.`{c}`") for c in columns])
