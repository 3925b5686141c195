import itertools

import pytest
from pyspark.errors import AnalysisException

from acctscreen.config import ScreenConfig
from acctscreen.operators.exclusions import (
    brokerage_accounts,
    exclude,
    excluded_accounts,
    excluded_customers,
    flagged_accounts,
    payroll_accounts,
)
from tests.conftest import rows

OUTER = [("a",), ("b",), (None,)]
LISTS = {
    "plain": [("a",)],
    "with_null": [("a",), (None,)],
    "only_null": [(None,)],
    "empty": [],
}


@pytest.mark.parametrize("outer_has_null,list_name", list(itertools.product([True, False], LISTS)))
def test_null_aware_exclude_equals_sql_not_in(spark, outer_has_null, list_name):
    outer = spark.createDataFrame(OUTER if outer_has_null else OUTER[:2], "k string")
    ex = spark.createDataFrame(LISTS[list_name], "v string")
    outer.createOrReplaceTempView("o")
    ex.createOrReplaceTempView("x")
    want = rows(spark.sql("select k from o where k not in (select v from x)"))
    assert rows(exclude(outer, ex, "k", "v", null_aware=True)) == want


def test_plain_exclude_is_not_exists(spark):
    outer = spark.createDataFrame(OUTER, "k string")
    ex = spark.createDataFrame([("a",), (None,)], "v string")
    assert rows(exclude(outer, ex, "k", "v", null_aware=False)) == [("b",), (None,)]


def test_null_aware_exclude_plan_has_no_nested_loop(spark):
    outer = spark.createDataFrame(OUTER, "k string")
    ex = spark.createDataFrame(LISTS["with_null"], "v string")
    plan = exclude(outer, ex, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_lists(spark):
    cfg = ScreenConfig(broker_prefix="XX")
    txn = spark.createDataFrame(
        [("00000000000001", "A000000001"), ("00000000000002", "A000000001"),
         ("00000000000003", "A000000002"), ("00000000000003", "A000000002")],
        "acct_nbr_ori string, cust_id string",
    )
    cust = spark.createDataFrame(
        [("A000000001", "Y", "20", 40), ("A000000002", "N", "1", 5), ("12345678", "N", "20", 40),
         ("A000000003", "N", "7", 50)],
        "cust_id string, flg_pr string, occupation string, age int",
    )
    pay = payroll_accounts(txn, cust)
    assert rows(pay) == [("00000000000001", "Y"), ("00000000000002", "Y")]
    # Individuals only: the 8-character id is not excluded.
    assert rows(excluded_customers(cust, cfg)) == [("A000000001",), ("A000000002",)]

    sec = spark.createDataFrame(
        [("1", "XX01"), ("2", None), ("3", "XX"), ("4", "YY"), ("5", "YY05"), ("5", "XX09")],
        "dep_acct_no string, stck_cstdy_cd string",
    )
    assert rows(brokerage_accounts(sec, cfg)) == [("1",), ("2",), ("3",), ("4",), ("5",)]

    names = "acct_no_sav string, derivative_date date, derivative_flg string, swindle_moratorium_date date, " \
            "swindle_moratorium_flg string, swindle_flg string, alert_date date, alert_flg string"
    data = [("f1", "Y", None), ("f2", None, "Y"), ("f3", None, None), ("00000000000001", "Y", None)]
    flags = spark.createDataFrame([(a, None, None, None, None, s, None, y) for a, y, s in data], names)
    upper = flags.toDF(*[c.upper() for c in flags.columns])
    assert rows(flagged_accounts(upper)) == rows(flagged_accounts(flags))
    with pytest.raises(AnalysisException):
        flagged_accounts(flags.drop("derivative_flg"))
    assert rows(flagged_accounts(flags), "acct_no_sav") == [("00000000000001",), ("f1",), ("f2",)]
    ex = excluded_accounts(flags, pay, brokerage_accounts(sec, cfg))
    # Alert 'Y' only (not swindle), union with payroll and brokerage, distinct.
    assert rows(ex) == sorted(
        [("00000000000001",), ("00000000000002",), ("1",), ("2",), ("3",), ("4",), ("5",), ("f1",)]
    )


def test_not_in_is_forced_to_broadcast_but_exclude_is_not(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        outer = spark.createDataFrame(OUTER, "k string")
        ex = spark.createDataFrame(LISTS["plain"], "v string")
        outer.createOrReplaceTempView("o2")
        ex.createOrReplaceTempView("x2")
        sql_plan = spark.sql("select k from o2 where k not in (select v from x2)")._jdf.queryExecution() \
            .executedPlan().toString()
        ours = exclude(outer, ex, "k", "v")
        our_plan = ours._jdf.queryExecution().executedPlan().toString()
        # SQL NOT IN: a null-aware broadcast anti join even with broadcasts disabled.
        assert "BroadcastHashJoin" in sql_plan and "LeftAnti, BuildRight, true" in sql_plan
        # exclude(): an ordinary sort-merge anti join, same rows.
        assert "SortMergeJoin" in our_plan and "LeftAnti" in our_plan
        assert "BroadcastHashJoin" not in our_plan
        assert rows(ours) == rows(spark.table("o2").where("k not in (select v from x2)"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
