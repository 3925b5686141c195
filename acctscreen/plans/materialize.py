"""Stage hand-off tables under the cluster's shared checkpoint folder.

A DataFrame that several later steps read (the cleaned transactions, the
activity span, the exclusion lists) is written once as Parquet and read
back.  That cuts the lineage — a lost executor recomputes from the written
table, not from the raw inputs — and the later steps scan a compact,
column-pruned table instead of re-running the joins that built it.

Folders made here belong to the process: ``release`` removes them, and so
does the end of the process.
"""

from __future__ import annotations

import atexit
import logging
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)
_made: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder: ``spark.checkpoint.dir``, or
    what ``SparkContext.setCheckpointDir`` was given.  Without either, a
    session whose tasks run in the driver's own process gets a temporary
    folder; on a cluster there is none that all executors share, so this raises."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="acctscreen-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def run_root(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder for one run's stage tables under the shared folder."""
    root = f"{shared_dir(spark)}/acctscreen/{label}-{uuid.uuid4().hex[:12]}"
    _made.append((spark, root))
    return root


def table_name(spark: SparkSession, label: str) -> str:
    """The name of a fresh managed table, which ``release`` drops."""
    name = f"acctscreen_{label}_{uuid.uuid4().hex[:12]}"
    _tables.append((spark, name))
    return name


def release(spark: SparkSession) -> None:
    """Remove the folders and tables that were made for this session; frames
    that read them are of no use afterwards."""
    own = [root for s, root in _made if s is spark]
    _made[:] = [(s, root) for s, root in _made if s is not spark]
    tables = [name for s, name in _tables if s is spark]
    _tables[:] = [(s, name) for s, name in _tables if s is not spark]
    jvm = spark._jvm
    if not spark._jsc.sc().isStopped():
        for name in tables:
            spark.sql(f"drop table if exists {name}")
    conf = jvm.org.apache.hadoop.conf.Configuration() if spark._jsc.sc().isStopped() else spark._jsc.hadoopConfiguration()
    for root in own:
        path = jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _release_all() -> None:
    for spark in {id(s): s for s, _ in _made}.values():
        try:
            release(spark)
        except Exception as e:  # the JVM may be gone; its folders then stay
            log.debug("scratch folders were not removed: %s", e)


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` and return a scan of it (with the
    known schema: no footer reads to infer it)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_list(ex: DataFrame) -> DataFrame:
    """``ex`` computed once, and a scan of what was stored."""
    return write_and_read(ex, run_root(ex.sparkSession, "list"))
