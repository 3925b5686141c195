from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    wh = tmp_path_factory.mktemp("warehouse")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("acctscreen-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", str(wh))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        # Tests only: the session has no shared folder, so use a temporary one.
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


def rows(df, *cols):
    """Sorted list of tuples of ``cols`` (all columns when none given)."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((v is None, str(v)) for v in t))
