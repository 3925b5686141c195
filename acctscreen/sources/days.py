"""Dated Parquet tables whose days are replaced as a whole.

A day is written to a folder of its own beside what readers see,

    <path>/snap_date=<day>/run=<id>/part-*.parquet

and published by one empty file whose name says which run is the day's:

    <path>/_published/snap_date=<day>/<number>-<id>

Making a file is atomic in any store, so a reader sees the whole day of
before or the whole new one.  A run that stops while it writes leaves a
folder that nothing names; ``vacuum_day`` removes such folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DAY = "snap_date"
#: Published runs of a day that stay: the present one, and the one before for readers at work.
KEEP = 2


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder), _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _remove(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def _folder(path: str, day: str, run: str, partition_col: str) -> str:
    return f"{path.rstrip('/')}/{partition_col}={day}/run={run}"


def _published(path: str, day: str, partition_col: str) -> str:
    return f"{path.rstrip('/')}/_published/{partition_col}={day}"


def _runs(spark: SparkSession, path: str, day: str, partition_col: str) -> list[tuple[str, str]]:
    """Published runs of a day as (file name, run), oldest first."""
    return [(n, n.partition("-")[2]) for n in _names(spark, _published(path, day, partition_col)) if "-" in n and not n.startswith((".", "_"))]


def publish_day(spark: SparkSession, path: str, day: str, run: str, partition_col: str = DAY) -> None:
    """Makes ``run`` the day's rows, and removes runs beyond the last ``KEEP``."""
    before = _runs(spark, path, day, partition_col)
    number = int(before[-1][0].partition("-")[0]) + 1 if before else 1
    marker = f"{_published(path, day, partition_col)}/{number:010d}-{run}"
    _fs(spark, marker).create(_path(spark, marker), False).close()
    for name, old in before[: max(len(before) + 1 - KEEP, 0)]:
        _remove(spark, f"{_published(path, day, partition_col)}/{name}")
        _remove(spark, _folder(path, day, old, partition_col))


def write_day(df: DataFrame, path: str, day: str, partition_col: str = DAY) -> DataFrame:
    """Replaces one day of a dated table and returns that day's rows, read
    back.  A rerun whose result is empty leaves an empty day and not the rows
    of the run before; a run that fails leaves the day as it was; other days
    are not touched."""
    spark, run = df.sparkSession, uuid.uuid4().hex
    folder = _folder(path, day, run, partition_col)
    df.write.parquet(folder)
    publish_day(spark, path, day, run, partition_col)
    return spark.read.schema(df.schema).parquet(folder)


def read_day(spark: SparkSession, path: str, day: str, partition_col: str = DAY) -> DataFrame:
    """One published day of a dated table; its files hold the schema, also of an empty day."""
    runs = _runs(spark, path, day, partition_col)
    if not runs:
        raise FileNotFoundError(f"{path} has no published {partition_col}={day}")
    return spark.read.parquet(_folder(path, day, runs[-1][1], partition_col))


def published_days(spark: SparkSession, path: str, partition_col: str = DAY) -> list[str]:
    names = _names(spark, f"{path.rstrip('/')}/_published")
    return [n.partition("=")[2] for n in names if n.startswith(f"{partition_col}=")]


def read_days(spark: SparkSession, path: str, days: Sequence[str] | None = None, partition_col: str = DAY) -> DataFrame:
    """All published days, or the given ones, with the day as a column."""
    days = published_days(spark, path, partition_col) if days is None else list(days)
    runs = {d: _runs(spark, path, d, partition_col) for d in days}
    missing = [d for d, r in runs.items() if not r]
    if missing or not days:
        raise FileNotFoundError(f"{path} has no published {partition_col} {', '.join(missing)}".rstrip())
    folders = [_folder(path, d, r[-1][1], partition_col) for d, r in runs.items()]
    return spark.read.option("basePath", path).parquet(*folders).drop("run")


def vacuum_day(spark: SparkSession, path: str, day: str, partition_col: str = DAY) -> list[str]:
    """Removes runs of a day that were never published, such as those of runs
    that stopped; not to be called while the day is being written."""
    known = {run for _, run in _runs(spark, path, day, partition_col)}
    folder = f"{path.rstrip('/')}/{partition_col}={day}"
    lost = [n for n in _names(spark, folder) if n.startswith("run=") and n[4:] not in known]
    for n in lost:
        _remove(spark, f"{folder}/{n}")
    return lost
