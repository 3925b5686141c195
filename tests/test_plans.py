"""Physical-plan checks: no Python evaluation, no cartesian or nested-loop
joins, filters and column lists pushed into Parquet scans."""

import datetime as dt

import pytest

from acctscreen.plans.catalog import QUERIES
from acctscreen.config import ScreenConfig
from acctscreen.operators.candidates import candidate_transactions
from acctscreen.operators.cleansing import clean
from tests.conftest import SF001

BANNED = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
          "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_nested_loops(spark, name):
    df = QUERIES[name](spark, SF001)
    text = plan_text(df)
    for b in BANNED:
        assert b not in text, f"{name}: {b}"


def test_scan_pushdown_and_pruning(spark, tmp_path):
    cols = ("acct_nbr_ori", "tx_date", "tx_time", "drcr", "cust_id", "tx_amt", "pb_bal", "cur",
            "channel_desc", "memo", "remk", "jrnl_no", "tx_mode", "emp_no", "unused_wide_col")
    data = [("00000000000001", dt.date(2024, 1, 10), 5, "1", "A000000001", "1", "1", "TWD", "c", "m",
             None, 1, "1", "EMP4001", "x" * 50)]
    path = str(tmp_path / "txn")
    spark.createDataFrame(data, ", ".join(
        f"{c} {'date' if c == 'tx_date' else 'long' if c in ('tx_time', 'jrnl_no') else 'string'}"
        for c in cols)).write.parquet(path)
    txn = spark.read.parquet(path)
    cfg = ScreenConfig(txn_columns=cols[:13], channels=("c",), memos=("m",))
    ex_a = spark.createDataFrame([("zz",)], "acct_nbr_ori string")
    ex_c = spark.createDataFrame([("B000000001",)], "cust_id string")
    df = clean(candidate_transactions(txn, ex_a, ex_c, "2024-01-31", cfg), cfg)
    assert df.count() == 1
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scans = [b for b in text.split("\n\n") if b.lstrip().startswith("(") and "Scan parquet" in b
             and "tx_mode" in b]
    assert scans, text
    for s in scans:
        read_schema = [ln for ln in s.splitlines() if ln.startswith("ReadSchema")][0]
        pushed = [ln for ln in s.splitlines() if ln.startswith("PushedFilters")][0]
        assert "unused_wide_col" not in read_schema                 # column pruning
        assert "tx_date" in pushed and "EqualTo(tx_mode,1)" in pushed


def test_log_scan_prunes_days_by_span_bounds(spark, tmp_path):
    from acctscreen.operators.access import access_counts

    rows_ = [(f"A{i % 5}", i, dt.datetime(2024, 1, 1 + i % 30, 10), "MDS01", dt.date(2024, 1, 1 + i % 30))
             for i in range(300)]
    schema = "company_uid string, login_log_key long, access_time timestamp_ntz, menu_id string, access_date date"
    spark.createDataFrame(rows_, schema).write.partitionBy("access_date").parquet(str(tmp_path / "mb"))
    mb = spark.read.parquet(str(tmp_path / "mb"))
    web = spark.createDataFrame([], schema)
    span = spark.createDataFrame([("x", "A1", dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 10))],
                                 "acct_nbr_ori string, cust_id string, max_date timestamp_ntz, min_date timestamp_ntz")
    df = access_counts(mb, web, span, ScreenConfig(log_day_column="access_date"), ("2024-01-05", "2024-01-20"))
    assert df.count() == 1  # A1 logs on Jan 2, 7, 12, ...: only the 12th is inside [10th, 12th]
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    scan = [b for b in text.split("\n\n") if "Scan parquet" in b and "company_uid" in b][0]
    part = [ln for ln in scan.splitlines() if ln.startswith("PartitionFilters")][0]
    pushed = [ln for ln in scan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "access_date" in part and "Subquery" in part   # days pruned at run time
    assert "In(menu_id" in pushed


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_funnels_into_one_partition(spark, name):
    """A single-partition exchange may only feed a global aggregate (one
    row per task arrives) or a top-k/limit; no window runs without a
    partition key."""
    df = QUERIES[name](spark, SF001)
    lines = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple").splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            parent = lines[i - 1]
            assert ("HashAggregate(keys=[]" in parent or "TakeOrderedAndProject" in parent
                    or "Limit" in parent), f"{name}: {parent.strip()}"
        if " Window [" in line or line.lstrip(" :+-").startswith("Window ["):
            assert "windowspecdefinition(specifiedwindowframe" not in line, f"{name}: {line.strip()}"


def test_window_reaches_the_log_scan(spark, tmp_path):
    """The literal window is pushed as a range on the time column, where row
    groups outside it are skipped, and changes no result."""
    from acctscreen.operators.access import access_counts

    rows_ = [(f"A{i % 5}", i, dt.datetime(2023, 1, 1) + dt.timedelta(hours=6 * i), "MDS01") for i in range(2000)]
    schema = "company_uid string, login_log_key long, access_time timestamp_ntz, menu_id string"
    spark.createDataFrame(rows_, schema).write.parquet(str(tmp_path / "mb"))
    mb, web = spark.read.parquet(str(tmp_path / "mb")), spark.createDataFrame([], schema)
    span = spark.createDataFrame([("x", "A1", dt.datetime(2024, 1, 20), dt.datetime(2024, 1, 10))],
                                 "acct_nbr_ori string, cust_id string, max_date timestamp_ntz, min_date timestamp_ntz")
    cfg = ScreenConfig()
    narrow = access_counts(mb, web, span, cfg, ("2024-01-01", "2024-01-31"))
    wide = access_counts(mb, web, span, cfg)
    assert sorted(map(tuple, narrow.collect())) == sorted(map(tuple, wide.collect())) != []
    text = spark._jvm.PythonSQLUtils.explainString(narrow._jdf.queryExecution(), "formatted")
    scan = [b for b in text.split("\n\n") if "Scan parquet" in b and "company_uid" in b][0]
    pushed = [ln for ln in scan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "GreaterThanOrEqual(access_time" in pushed and "LessThan(access_time" in pushed
