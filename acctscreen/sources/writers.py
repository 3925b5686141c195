"""Sinks: table overwrite, range-clustered rows, a given number of files, CSV
export in the original text formats, metadata refresh and preview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, TimestampNTZType, TimestampType

from acctscreen.functions.datetime import DATE_FORMAT, DATETIME_FORMAT
from acctscreen.sources.readers import CSV_NULL


def overwrite_table(df: DataFrame, name: str, fmt: str | None = None) -> None:
    """Replace a managed table (``fmt='parquet'`` for a Hive-readable one)."""
    w = df.write.mode("overwrite")
    if fmt:
        w = w.format(fmt)
    w.saveAsTable(name)


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """``df`` dealt out by ranges of ``keys`` and sorted within them, so that
    files and row groups of what is written hold narrow ranges and a read of
    one key skips the others.  The other columns break ties: a key with a
    large share of the rows is spread over several files."""
    order = [F.col(c).asc_nulls_first() for c in (*keys, *(c for c in df.columns if c not in keys))]
    ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
    return ranged.sortWithinPartitions(*order)


def write_files(df: DataFrame, path: str, files: int | None = None) -> None:
    """Parquet, written in parallel, or into as many files as the caller asks for."""
    (df if files is None else df.repartition(files)).write.mode("overwrite").parquet(path)


def as_text_columns(df: DataFrame) -> DataFrame:
    """Dates as ``yyyy-MM-dd`` and timestamps as ``yyyy-MM-dd HH:mm:ss`` text,
    the formats of the original job's hand-off files."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), DATE_FORMAT).alias(f.name))
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            cols.append(F.date_format(F.col(f.name), DATETIME_FORMAT).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index column, written in parallel; ``read_csv``
    gives every value back.

    Null is an empty field, an empty text a quoted one; blanks stay, quotes
    are doubled, and a field with line ends is quoted.  (A lone column's null
    is written out, as readers skip an empty line.)"""
    out = as_text_columns(df)
    for f in out.schema.fields:
        if isinstance(f.dataType, StringType):
            taken = F.raise_error(F.lit(f"{f.name} holds the text that stands for null"))
            out = out.withColumn(f.name, F.when(F.col(f.name) == CSV_NULL, taken).otherwise(F.col(f.name)))
    w = out.write.mode("overwrite").option("header", True).option("escape", '"')
    w = w.option("nullValue", "" if len(out.columns) > 1 else CSV_NULL).option("emptyValue", '""')
    w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def refresh(spark: SparkSession, name: str) -> None:
    """Drop cached metadata of a table another process has rewritten."""
    spark.catalog.refreshTable(name)


def preview(df: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` rows, for an eyeball check."""
    return df.limit(n)
