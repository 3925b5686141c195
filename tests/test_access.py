import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from acctscreen.config import ScreenConfig
from acctscreen.operators.access import (
    access_counts,
    access_counts_long,
    access_events,
    attach_access_counts,
)
from acctscreen.operators.activity import customer_activity_span, customer_ids, txn_date_bounds
from tests.conftest import rows

CFG = ScreenConfig()
LOG = "company_uid string, login_log_key long, access_time timestamp_ntz, menu_id string"
T = dt.datetime


def span_df(spark):
    return spark.createDataFrame(
        [("acct1", "A1", T(2024, 1, 20), T(2024, 1, 10)), ("acct2", "A2", T(2024, 1, 15), T(2024, 1, 12))],
        "acct_nbr_ori string, cust_id string, max_date timestamp_ntz, min_date timestamp_ntz",
    )


def test_span_bounds_per_customer(spark):
    txn = spark.createDataFrame(
        [("x1", "C1", dt.date(2024, 1, 3)), ("x2", "C1", dt.date(2024, 1, 9)),
         ("x2", "C1", dt.date(2024, 1, 5)), ("y", "C2", dt.date(2024, 1, 7))],
        "acct_nbr_ori string, cust_id string, tx_date date",
    )
    got = rows(customer_activity_span(txn))
    assert got == [("x1", "C1", T(2024, 1, 9), T(2024, 1, 3)), ("x2", "C1", T(2024, 1, 9), T(2024, 1, 3)),
                   ("y", "C2", T(2024, 1, 7), T(2024, 1, 7))]
    assert rows(customer_ids(txn)) == [("C1",), ("C2",)]
    assert rows(txn_date_bounds(txn)) == [(dt.date(2024, 1, 3), dt.date(2024, 1, 9))]


def test_counts_filters_and_missing_categories(spark):
    mb = spark.createDataFrame(
        [
            ("A1", 1, T(2024, 1, 10, 8), "MDS01"),     # mb_check
            ("A1", 1, T(2024, 1, 10, 9), "MDS0401"),   # same login again: counted once
            ("A1", 2, T(2024, 1, 10, 9), "MPS1302"),   # mb_limit
            ("A1", 3, T(2024, 1, 9, 23), "MDS01"),     # before the range: dropped
            ("A9", 4, T(2024, 1, 11, 9), "MDS01"),     # unknown customer: dropped
            ("A2", 5, T(2024, 1, 12, 0), "OTHER"),     # other menu: dropped
            ("A2", None, T(2024, 1, 13, 0), "MDS01"),  # null login: a group with 0 logins
        ],
        LOG,
    )
    web = spark.createDataFrame(
        [("A2", 7, T(2024, 1, 20, 23, 59), "CDS04"), ("A1", 8, T(2024, 1, 21), "CDS04")], LOG)
    got = rows(access_counts(mb, web, span_df(spark), CFG))
    assert got == [
        ("A1", dt.date(2024, 1, 10), 1, 1, None),
        ("A2", dt.date(2024, 1, 13), None, 0, None),
        ("A2", dt.date(2024, 1, 20), None, None, 1),
    ]
    long = rows(access_counts_long(access_events(mb, web, CFG, span_df(spark))))
    assert ("A1", dt.date(2024, 1, 10), "mb_check", 1) in long
    assert ("A2", dt.date(2024, 1, 13), "mb_check", 0) in long


def test_range_uses_log_day_column_when_present(spark):
    # The range test reads the log's own access_date, not the day of access_time.
    mb = spark.createDataFrame(
        [("A1", 1, T(2024, 1, 1, 8), "MDS01", dt.date(2024, 1, 11))],
        LOG + ", access_date date",
    )
    web = spark.createDataFrame([], LOG + ", access_date date")
    got = rows(access_counts(mb, web, span_df(spark), CFG.with_(log_day_column="access_date")))
    assert got == [("A1", dt.date(2024, 1, 1), None, 1, None)]
    # Not named, it is not used; named but missing, the job stops.
    assert rows(access_counts(mb, web, span_df(spark), CFG)) == []
    with pytest.raises(AnalysisException):
        access_counts(mb.drop("access_date"), web, span_df(spark), CFG.with_(log_day_column="access_date"))


def test_attach_fills_zero_and_keeps_rows(spark):
    feats = spark.createDataFrame(
        [("A1", dt.date(2024, 1, 10), 1), ("A1", dt.date(2024, 1, 11), 2), ("A3", dt.date(2024, 1, 10), 3)],
        "cust_id string, tx_date date, n int",
    )
    counts = spark.createDataFrame(
        [("A1", dt.date(2024, 1, 10), 2, None, 1)],
        "company_uid string, access_date date, mb_limit long, mb_check long, eb_check long",
    )
    out = attach_access_counts(feats, counts)
    assert out.columns == ["cust_id", "tx_date", "n", "mb_limit", "mb_check", "eb_check"]
    assert rows(out, "n", "mb_limit", "mb_check", "eb_check") == [(1, 2, 0, 1), (2, 0, 0, 0), (3, 0, 0, 0)]
