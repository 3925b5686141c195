import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from acctscreen.config import ScreenConfig
from acctscreen.operators.cleansing import (
    clean,
    exchange_groups,
    exclude_payroll,
    filter_channel_memo,
    filter_currency,
    normalize_transactions,
    remove_exchanges,
)
from tests.conftest import rows

CFG = ScreenConfig(channels=("web", "atm"), memos=("xfer",), removed_remarks=("loan",))
SCHEMA = ("acct_nbr_ori string, cust_id string, tx_date date, tx_time long, drcr string, "
          "tx_amt string, pb_bal string, cur string, channel_desc string, memo string, "
          "remk string, jrnl_no long, tx_mode string")
D = dt.date(2024, 1, 10)


def txn(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def base(**kw):
    r = dict(acct_nbr_ori="123", cust_id="A000000001", tx_date=D, tx_time=3661, drcr="1",
             tx_amt="10.5", pb_bal="100", cur="TWD", channel_desc="web", memo="xfer", remk=None,
             jrnl_no=1, tx_mode="1")
    r.update(kw)
    return tuple(r.values())


def test_normalize_types_padding_and_utc_clock(spark):
    prev = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    try:
        out = normalize_transactions(txn(spark, [base(), base(tx_mode="2")]), CFG).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert len(out) == 1
    r = out[0]
    assert r.acct_nbr_ori == "00000000000123"
    assert r.drcr == 1 and r.tx_amt == 10.5 and r.pb_bal == 100.0
    # 3661 s is 01:01:01 in UTC whatever the session zone.
    assert r.tx_time == dt.datetime(2024, 1, 10, 1, 1, 1)


def test_normalize_full_epoch_and_long_account(spark):
    # A full epoch value: only its UTC clock time is kept, on tx_date.
    epoch = int(dt.datetime(2023, 5, 6, 23, 59, 58, tzinfo=dt.timezone.utc).timestamp())
    r = normalize_transactions(
        txn(spark, [base(tx_time=epoch, acct_nbr_ori=" 123456789012345 ")]), CFG).collect()[0]
    assert r.tx_time == dt.datetime(2024, 1, 10, 23, 59, 58)
    assert r.acct_nbr_ori == "123456789012345"  # longer than 14: kept whole, trimmed


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_normalize_bad_number_fails(spark, ansi):
    prev = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for bad in (base(drcr="x"), base(tx_amt="1,5")):
            with pytest.raises(Exception, match="cannot cast"):
                normalize_transactions(txn(spark, [bad]), CFG).collect()
        ok = normalize_transactions(txn(spark, [base(drcr=None, tx_amt=" 2.5 ")]), CFG).collect()[0]
        assert ok.drcr is None and ok.tx_amt == 2.5
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_channel_memo_remark(spark):
    data = [
        base(jrnl_no=1),                            # kept, null remark
        base(jrnl_no=2, remk="loan"),               # removed remark
        base(jrnl_no=3, remk="rent"),               # kept
        base(jrnl_no=4, channel_desc="branch"),     # channel not allowed
        base(jrnl_no=5, channel_desc=None),         # null channel dropped
        base(jrnl_no=6, memo=None),                 # null memo dropped
    ]
    got = [r[0] for r in rows(filter_channel_memo(txn(spark, data), CFG), "jrnl_no")]
    assert got == [1, 3]


def test_exchange_rules(spark):
    data = [
        # group 1: TWD debit + USD credit -> exchange, both legs removed
        base(jrnl_no=1, cur="TWD", drcr="1"), base(jrnl_no=1, cur="USD", drcr="2"),
        # group 2: two currencies, one drcr -> kept
        base(jrnl_no=2, cur="TWD", drcr="1"), base(jrnl_no=2, cur="USD", drcr="1"),
        # group 3: one currency plus a null, two drcr -> exchange (null is a value)
        base(jrnl_no=3, cur="TWD", drcr="1"), base(jrnl_no=3, cur=None, drcr="2"),
        # group 4: null journal never forms a group -> kept
        base(jrnl_no=None, cur="TWD", drcr="1"), base(jrnl_no=None, cur="USD", drcr="2"),
        # group 5: same journal, other second -> separate groups, kept
        base(jrnl_no=5, cur="TWD", drcr="1", tx_time=10), base(jrnl_no=5, cur="USD", drcr="2", tx_time=11),
    ]
    norm = normalize_transactions(txn(spark, data), CFG)
    groups = rows(exchange_groups(norm), "jrnl_no", "n_rows")
    assert groups == [(1, 2), (3, 2)]
    kept = rows(remove_exchanges(norm), "jrnl_no", "cur")
    assert kept == sorted([(2, "TWD"), (2, "USD"), (None, "TWD"), (None, "USD"), (5, "TWD"), (5, "USD")],
                          key=lambda t: tuple((v is None, str(v)) for v in t))


def test_currency_filter_must_come_last(spark):
    # The USD leg identifies the exchange; filtering TWD first would keep the TWD leg.
    data = [base(jrnl_no=1, cur="TWD", drcr="1"), base(jrnl_no=1, cur="USD", drcr="2")]
    assert clean(txn(spark, data), CFG).count() == 0
    norm = normalize_transactions(txn(spark, data), CFG)
    assert remove_exchanges(filter_currency(norm)).count() == 1


def test_payroll_anti_join_ignores_null_code(spark):
    t = txn(spark, [base(acct_nbr_ori="a"), base(acct_nbr_ori="b"), base(acct_nbr_ori="c")])
    pay = spark.createDataFrame([("a", "Y"), ("b", None)], "acct_no_14 string, payroll_code string")
    assert rows(exclude_payroll(t, pay), "acct_nbr_ori") == [("b",), ("c",)]


# -- property: exchange removal against a brute-force pandas rule ----------

def _brute_force(pdf: pd.DataFrame) -> list:
    keys = ["acct_nbr_ori", "tx_time", "jrnl_no"]
    out = []
    for _, r in pdf.iterrows():
        if any(pd.isna(r[k]) for k in keys):
            out.append(r["rid"])
            continue
        same = pdf[(pdf.acct_nbr_ori == r.acct_nbr_ori) & (pdf.tx_time == r.tx_time)
                   & (pdf.jrnl_no == r.jrnl_no)]
        n_cur = len(set(None if pd.isna(v) else v for v in same.cur))
        n_drcr = len(set(same.drcr))
        if not (n_cur > 1 and n_drcr > 1):
            out.append(r["rid"])
    return sorted(out)


row_st = st.tuples(
    st.sampled_from(["a", "b"]),
    st.sampled_from([1, 2]),
    st.sampled_from([1, 2, None]),
    st.sampled_from(["1", "2"]),
    st.sampled_from(["TWD", "USD", None]),
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_st, min_size=1, max_size=12))
def test_exchange_removal_matches_brute_force(spark, data):
    recs = [(i, a, t, j, d, c) for i, (a, t, j, d, c) in enumerate(data)]
    df = spark.createDataFrame(
        recs, "rid int, acct_nbr_ori string, tx_time long, jrnl_no long, drcr string, cur string")
    got = sorted(r.rid for r in remove_exchanges(df).select("rid").collect())
    pdf = pd.DataFrame(recs, columns=["rid", "acct_nbr_ori", "tx_time", "jrnl_no", "drcr", "cur"])
    assert got == _brute_force(pdf)
    # Idempotent: removing twice changes nothing.
    assert remove_exchanges(remove_exchanges(df)).count() == len(got)
