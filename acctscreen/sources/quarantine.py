"""Good rows and rejected rows from one pass, stored apart."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class Checked:
    """``good`` rows, ``rejected`` rows with their ``reasons``, and how many
    there are of each.  Both are scans of stored tables."""

    good: DataFrame
    rejected: DataFrame
    n_good: int
    n_rejected: int

    def or_fail(self, most: float = 0.0) -> DataFrame:
        """The good rows, if no more than ``most`` of all rows were rejected."""
        total = self.n_good + self.n_rejected
        if self.n_rejected > most * total:
            raise ValueError(f"{self.n_rejected} of {total} rows were rejected")
        return self.good


@contextmanager
def _both_open(spark: SparkSession) -> Iterator[None]:
    """A task that writes two folders keeps both files open and need not sort its rows."""
    old = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "2")
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, old)


def set_aside(df: DataFrame, reasons: Column, good: dict[str, Column], raw: dict[str, Column], path: str) -> Checked:
    """Writes ``df`` once to ``path``, in two folders.  Rows with ``reasons`` (an
    array of text, null or empty for a good row) are stored as they came
    (``raw`` columns and the reasons), the others by their ``good`` columns.
    The rows of each kind are counted while they pass."""
    spark, counts = df.sparkSession, Observation()
    bad = F.coalesce(F.size(reasons) > 0, F.lit(False))
    rejected = F.struct(*[c.alias(n) for n, c in raw.items()], reasons.alias("reasons"))
    out = df.withColumn("_bad", bad).select(
        *[F.when(~F.col("_bad"), c).alias(n) for n, c in good.items()],
        F.when(F.col("_bad"), rejected).alias("_rejected"),
        "_bad",
    )
    seen = out.observe(counts, F.count(F.lit(1)).alias("n"), F.count_if("_bad").alias("bad"))
    with _both_open(spark):
        seen.write.mode("overwrite").partitionBy("_bad").parquet(path)
    stored = spark.read.schema(out.schema).parquet(path)
    n, n_bad = counts.get["n"], counts.get["bad"]
    return Checked(
        stored.filter(~F.col("_bad")).select(*good),
        stored.filter(F.col("_bad")).select("_rejected.*"),
        n - n_bad,
        n_bad,
    )
