import datetime as dt

from acctscreen.config import ScreenConfig
from acctscreen.operators.candidates import candidate_transactions, ordered
from tests.conftest import rows

COLS = ("acct_nbr_ori", "tx_date", "cust_id", "emp_no", "tx_mode", "jrnl_no")
SCHEMA = "acct_nbr_ori string, tx_date date, cust_id string, emp_no string, tx_mode string, jrnl_no long"
CFG = ScreenConfig(txn_columns=("jrnl_no",))


def r(j, acct="acc1", d=dt.date(2024, 1, 15), cust="A000000001", emp="EMP4001", mode="1"):
    return (acct, d, cust, emp, mode, j)


def test_each_filter(spark):
    data = [
        r(1),                                   # kept
        r(2, d=dt.date(2023, 12, 31)),          # first day of the window: kept
        r(3, d=dt.date(2024, 1, 31)),           # snapshot day: kept
        r(4, d=dt.date(2023, 12, 30)),          # before the window
        r(5, d=dt.date(2024, 2, 1)),            # after the window
        r(6, mode="2"),                         # other tx_mode
        r(7, emp="EMP4999"),                    # not a teller code
        r(8, emp="EMP3000"),                    # 4th character '3': kept
        r(9, cust="12345678"),                  # not an individual id
        r(10, cust="1234567890"),               # 10 characters but starts with a digit
        r(11, acct="excluded"),                 # excluded account
        r(12, cust="A000000009"),               # excluded customer
        r(13, acct=None),                       # null account, lists hold no null: dropped (NOT IN)
    ]
    txn = spark.createDataFrame(data, SCHEMA)
    ex_a = spark.createDataFrame([("excluded",)], "acct_nbr_ori string")
    ex_c = spark.createDataFrame([("A000000009",)], "cust_id string")
    got = [x[0] for x in rows(candidate_transactions(txn, ex_a, ex_c, "2024-01-31", CFG))]
    assert got == [1, 2, 3, 8]


def test_null_in_account_list_empties_the_selection(spark):
    txn = spark.createDataFrame([r(1), r(2, acct="other")], SCHEMA)
    ex_a = spark.createDataFrame([("excluded",), (None,)], "acct_nbr_ori string")
    ex_c = spark.createDataFrame([], "cust_id string")
    assert candidate_transactions(txn, ex_a, ex_c, "2024-01-31", CFG).count() == 0
    plain = CFG.with_(null_aware_exclusions=False)
    assert candidate_transactions(txn, ex_a, ex_c, "2024-01-31", plain).count() == 2


def test_ordered_is_total(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 2, "x"), ("a", 1, "y"), ("a", 2, None)],
                               "acct_nbr_ori string, tx_date int, tx_time string")
    got = [tuple(x) for x in ordered(df, ("acct_nbr_ori", "tx_date")).collect()]
    assert got == [("a", 1, "y"), ("a", 2, None), ("a", 2, "x"), ("b", 2, None)]
