"""Sources: metastore tables, Parquet paths, JDBC subqueries, CSV with an
explicit schema, parameterised SQL files and dated snapshots."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from acctscreen.sources.quarantine import Checked, set_aside


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A metastore table (``db.table``) or a Parquet file/directory path."""
    if "/" in name_or_path or name_or_path.endswith(".parquet"):
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_source(spark: SparkSession, source: str | dict) -> DataFrame:
    """A table name or path, or the arguments of ``read_jdbc`` by name."""
    return read_table(spark, source) if isinstance(source, str) else read_jdbc(spark, **source)


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Run ``query`` inside the database and read its rows.

    The subquery form keeps the filter and column list in the database.
    Give ``partition_column`` with bounds and ``num_partitions`` so the read
    is split over executors; without them JDBC reads in a single task.
    Credentials come in ``properties`` (``user``/``password``) from the
    deployment, never from a table."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC read needs bounds and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


#: What an unquoted empty field is taken for while a file is read; a quoted one
#: is an empty text.  No text may be equal to it (``export_csv`` checks).
CSV_NULL = "\ue000null\ue000"
CSV_RECORD = "_record"


def _csv(spark: SparkSession, path: str, schema: StructType | str, mode: str, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", CSV_RECORD)
    reader = reader.option("header", True).option("enforceSchema", False).option("columnPruning", False)
    # Quotes are doubled inside quotes (RFC 4180, as pandas writes them); a backslash is a character.
    reader = reader.option("escape", '"').option("multiLine", multi_line)
    return reader.option("nullValue", CSV_NULL).option("emptyValue", "").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """CSV with a header and a given schema, value by value as it was written.
    Never inferred: inference turns an account number such as
    ``00000000000123`` into the integer 123.

    An empty field is null and a quoted empty one an empty text; blanks, line
    ends and quotes inside a field stay.  A header that differs from the
    schema in names or order, a record of more or fewer fields, and text that
    does not convert stop the job (a value is converted when it is read: not
    by a mere count).  ``read_csv_checked`` sets bad records aside instead.

    A file whose records may span lines is read by one task; with
    ``multi_line=False`` files are split, for text known to have no line ends."""
    return _csv(spark, path, schema, "FAILFAST", multi_line)


def read_csv_checked(spark: SparkSession, path: str, schema: StructType | str, to: str, multi_line: bool = True) -> Checked:
    """``read_csv`` that keeps going: records that do not fit the schema are
    stored under ``to`` with their text, apart from the good ones.  The files
    are read once.  A wrong header stops the job all the same."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = StructType([*schema.fields, StructField(CSV_RECORD, StringType())])
    rows = _csv(spark, path, wide, "PERMISSIVE", multi_line)
    bad = F.when(F.col(CSV_RECORD).isNotNull(), F.array(F.lit("record does not fit the schema")))
    return set_aside(rows, bad, {c: F.col(c) for c in schema.names}, {"record": F.col(CSV_RECORD)}, to)


def sql_file(spark: SparkSession, path: str | Path, **args) -> DataFrame:
    """Run the SQL text of ``path`` with named parameters (``:snap_date``,
    ``IDENTIFIER(:tbl)``) bound by Spark, not by string replacement."""
    text = Path(path).read_text(encoding="utf-8")
    return spark.sql(text, args=args)


def snapshot(
    df: DataFrame, snap_date: str, columns: list[str] | tuple[str, ...],
    date_col: str = "snap_date", days_back: int = 1,
) -> DataFrame:
    """Rows of the snapshot ``days_back`` days before ``snap_date``.

    An equality on a literal date: with the table partitioned by
    ``date_col`` only one partition is listed and read."""
    day = F.date_sub(F.lit(snap_date).cast("date"), days_back)
    return df.filter(F.col(date_col) == day).select(*columns)
