"""Bank-shaped views over the driver's TPC-H-style test tables.

The screening job reads savings transactions, customers, account flags,
brokerage accounts, online-banking logs and an account snapshot.  The test
data has none of these, so each one is derived here from ``lineitem``,
``orders``, ``customer`` and ``events`` by a fixed rule (see FIXTURES.md).
The same rules exist as portable SQL in ``VIEW_SQL`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acctscreen.config import ScreenConfig
from acctscreen.sources.inputs import ScreenInputs

# Snapshot day every test runs with; the window is 2023-12-31 .. 2024-01-31.
SNAP_DATE = "2024-01-31"

# Fixed values of the mapped test data (FIXTURES.md, "Test config lists").
TEST_CHANNELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
TEST_MEMOS = ("AF", "AO", "NF", "RO", "RF")
TEST_REMOVED_REMARKS = ("R1", "R2")

TEST_CONFIG = ScreenConfig(
    channels=TEST_CHANNELS,
    memos=TEST_MEMOS,
    removed_remarks=TEST_REMOVED_REMARKS,
)
# The same run with the registered-transfer lookup, and with the logs' own day column.
REGISTERED_CONFIG = TEST_CONFIG.with_(
    registered_keys=(("acct_nbr_ori", "acct_no_14"),),
    registered_columns=("since", "kind"),
)
LOG_DAY_CONFIG = TEST_CONFIG.with_(log_day_column="access_date")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _cust_id(key: Column) -> Column:
    # Every 11th customer gets an 8-character id, i.e. not an individual.
    return F.when(key % 11 == 0, _pad(key, 8)).otherwise(F.concat(F.lit("A"), _pad(key, 9)))


def load(spark: SparkSession, sf_dir: str) -> ScreenInputs:
    """The bank-shaped inputs of one test scale, as lazy DataFrames."""

    def t(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

    lineitem, orders, customer, events = t("lineitem"), t("orders"), t("customer"), t("events")
    li, o = F.col, F.col

    savings_txn = lineitem.join(orders, li("l_orderkey") == o("o_orderkey")).select(
        _pad(o("o_custkey") * 2 + li("l_suppkey") % 2, 14).alias("acct_nbr_ori"),
        _cust_id(o("o_custkey")).alias("cust_id"),
        o("o_custkey").cast("string").alias("acct_nbr"),
        F.date_add(F.lit("2023-12-16").cast("date"), (li("l_orderkey") % 60 + li("l_linenumber") % 3).cast("int")).alias("act_date"),
        F.date_add(F.lit("2023-12-16").cast("date"), (li("l_orderkey") % 60).cast("int")).alias("tx_date"),
        ((li("l_orderkey") * 37) % 86400).alias("tx_time"),
        F.when(li("l_returnflag") == "R", "1").otherwise("2").alias("drcr"),
        F.when(li("l_partkey") % 4 != 0, _pad(li("l_partkey"), 14)).alias("own_trans_acct"),
        li("l_extendedprice").alias("tx_amt"),
        o("o_totalprice").alias("pb_bal"),
        _pad(li("l_suppkey") % 100, 4).alias("tx_brh"),
        F.when(li("l_partkey") % 31 == 0, F.lit(None).cast("string"))
        .when(li("l_partkey") % 5 == 0, "USD").otherwise("TWD").alias("cur"),
        o("o_orderpriority").alias("channel_desc"),
        F.substring(o("o_orderpriority"), 1, 1).alias("chal_1"),
        F.concat(li("l_returnflag"), li("l_linestatus")).alias("memo"),
        F.when(li("l_partkey") % 13 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("R"), (li("l_partkey") % 10).cast("string"))).alias("remk"),
        F.when(li("l_suppkey") % 3 == 0, F.concat(F.lit("EMP3"), _pad(li("l_suppkey") % 1000, 3)))
        .otherwise(F.concat(F.lit("EMP4"), _pad(li("l_partkey") % 25, 3))).alias("emp_no"),
        li("l_orderkey").alias("jrnl_no"),
        F.when(li("l_linenumber") == 7, "2").otherwise("1").alias("tx_mode"),
    )

    c = F.col

    def day(first: str, n: int) -> Column:
        return F.date_add(F.lit(first).cast("date"), (c("c_custkey") % n).cast("int"))

    customers = customer.select(
        _cust_id(c("c_custkey")).alias("cust_id"),
        (c("c_nationkey") + 5).cast("string").alias("occupation"),
        (c("c_custkey") % 80).cast("int").alias("age"),
        F.when((c("c_mktsegment") == "BUILDING") & (c("c_custkey") % 3 == 0), "Y")
        .otherwise("N").alias("flg_pr"),
    )
    account_flags = customer.select(
        _pad(c("c_custkey") * 2, 14).alias("acct_no_sav"),
        F.when(c("c_custkey") % 17 == 0, day("2023-01-01", 300)).alias("derivative_date"),
        F.when(c("c_custkey") % 17 == 0, "Y").alias("derivative_flg"),
        F.when(c("c_custkey") % 19 == 0, day("2023-02-01", 200)).alias("swindle_moratorium_date"),
        F.when(c("c_custkey") % 19 == 0, "Y").alias("swindle_moratorium_flg"),
        F.when(c("c_acctbal") > 9000, "Y").alias("swindle_flg"),
        F.when(c("c_acctbal") < 0, day("2023-03-01", 100)).alias("alert_date"),
        F.when(c("c_acctbal") < 0, "Y").when(c("c_acctbal") < 2000, "N").alias("alert_flg"),
    )
    nk = c("c_nationkey")
    brokerage_links = customer.select(
        _pad(c("c_custkey") * 2 + 1, 14).alias("dep_acct_no"),
        F.when(nk == 0, F.lit(None).cast("string"))
        .when(nk < 3, F.concat(F.lit("XX"), _pad(nk, 2)))
        .when(nk < 5, "YY")
        .otherwise(F.concat(F.lit("YY"), _pad(nk, 2))).alias("stck_cstdy_cd"),
    )
    uid = F.concat(F.lit("A"), _pad(c("user_id"), 9)).alias("company_uid")
    login = (c("event_id") - c("event_id") % 3).alias("login_log_key")
    et = c("event_type")
    # The logs' own day: of every seventh event the day after the access.
    log_day = F.date_add(F.to_date(c("ts")), F.when(c("event_id") % 7 == 0, 1).otherwise(0)).alias("access_date")
    mobile_log = events.filter(et != "purchase").select(
        uid, login, c("ts").alias("access_time"),
        F.when(et == "click", "MDS01").when(et == "view", "MPS1302")
        .when(et == "error", "MDS0401").otherwise("OTHER").alias("menu_id"), log_day,
    )
    web_log = events.filter(et.isin("purchase", "signup")).select(
        uid, login, c("ts").alias("access_time"),
        F.when(et == "purchase", "CDS0401").otherwise("OTHER").alias("menu_id"), log_day,
    )
    account_snapshot = customer.select(
        _pad(c("c_custkey") * 2, 14).alias("acct_no_14"),
        F.date_add(F.lit("2020-01-01").cast("date"), (c("c_custkey") % 1400).cast("int")).alias("acct_open_dt"),
        F.lit("2024-01-30").cast("date").alias("snap_date"),
        F.when(c("c_custkey") % 7 == 0, "  ").when(c("c_custkey") % 5 != 0, F.concat(F.lit("P"), (c("c_custkey") % 4).cast("string"))).alias("payroll_code"),
    )
    # Several rows per account, as registered transfers have.
    registered = orders.select(
        _pad(o("o_custkey") * 2, 14).alias("acct_no_14"),
        o("o_orderdate").cast("date").alias("since"),
        o("o_orderpriority").alias("kind"),
    )
    return ScreenInputs(savings_txn, customers, account_flags, brokerage_links, mobile_log, web_log, account_snapshot, registered)


# Production values that stand for the test data's, so that the default lists can be run.
PRODUCTION_VALUES = {
    "channel_desc": {"1-URGENT": "新端末", "2-HIGH": "網路銀行 網銀", "3-MEDIUM": "一卡通", "5-LOW": "銀行資訊交換平台FEP匯款"},
    "memo": {"AF": "提領", "AO": "轉支", "NF": "ＣＤ轉帳", "RO": "匯入款", "RF": "國外匯出"},
    "remk": {"R1": "信用卡", "R2": "房貸", "R3": "房"},
}


def with_production_values(txn: DataFrame) -> DataFrame:
    """``txn`` with the production's channels, memos and remarks."""
    return txn.withColumns({
        c: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), F.col(c)), F.col(c)) for c, m in PRODUCTION_VALUES.items()
    })


# Remarks that a text file can lose: by jrnl_no modulo 9 (others stay as they are).
AWKWARD_REMARKS = ("  both ends ", "", "two\nlines", 'a "quoted" word', "back\\slash\\", "comma, and\r\nmore", None, "\\N")


def with_awkward_text(txn: DataFrame) -> DataFrame:
    """``txn`` with blanks, empty and null text, line ends, quotes and backslashes in ``remk``."""
    out, k = F.col("remk"), F.col("jrnl_no") % 9
    for i, v in enumerate(AWKWARD_REMARKS):
        out = F.when(k == i, F.lit(v).cast("string")).otherwise(out)
    return txn.withColumn("remk", out)


# Text that does not convert: (column, jrnl_no modulo, text).
BAD_TEXT = (("drcr", 41, "D"), ("pb_bal", 43, "n/a"), ("tx_amt", 47, "12,5x"), ("tx_date", 53, "2024-02-30"), ("tx_time", 59, ""))


def with_bad_text(txn: DataFrame) -> DataFrame:
    """``txn`` with the converted columns as text, some of which does not convert."""
    return txn.withColumns({c: F.when(F.col("jrnl_no") % m == 0, F.lit(v)).otherwise(F.col(c).cast("string")) for c, m, v in BAD_TEXT})


# Portable SQL of the same views (runs in DuckDB and in Spark).
VIEW_SQL = {
    "savings_txn": """
select lpad(cast(o_custkey*2 + l_suppkey%2 as string),14,'0') acct_nbr_ori,
 case when o_custkey%11=0 then lpad(cast(o_custkey as string),8,'0')
      else concat('A',lpad(cast(o_custkey as string),9,'0')) end cust_id,
 cast(o_custkey as string) acct_nbr, cast(date '2023-12-16' + cast(l_orderkey%60 + l_linenumber%3 as int) as date) act_date,
 cast(date '2023-12-16' + cast(l_orderkey%60 as int) as date) tx_date, (l_orderkey*37)%86400 tx_time,
 case when l_returnflag='R' then '1' else '2' end drcr, 
 case when l_partkey%4<>0 then lpad(cast(l_partkey as string),14,'0') end own_trans_acct,
 l_extendedprice tx_amt, o_totalprice pb_bal, lpad(cast(l_suppkey%100 as string),4,'0') tx_brh,
 case when l_partkey%31=0 then null when l_partkey%5=0 then 'USD' else 'TWD' end cur,
 o_orderpriority channel_desc, substr(o_orderpriority,1,1) chal_1, concat(l_returnflag,l_linestatus) memo,
 case when l_partkey%13=0 then null else concat('R',cast(l_partkey%10 as string)) end remk,
 case when l_suppkey%3=0 then concat('EMP3',lpad(cast(l_suppkey%1000 as string),3,'0'))
      else concat('EMP4',lpad(cast(l_partkey%25 as string),3,'0')) end emp_no,
 l_orderkey jrnl_no, case when l_linenumber=7 then '2' else '1' end tx_mode
from lineitem join orders on l_orderkey=o_orderkey""",
    "customers": """
select case when c_custkey%11=0 then lpad(cast(c_custkey as string),8,'0')
            else concat('A',lpad(cast(c_custkey as string),9,'0')) end cust_id,
 cast(c_nationkey+5 as string) occupation, cast(c_custkey%80 as int) age,
 case when c_mktsegment='BUILDING' and c_custkey%3=0 then 'Y' else 'N' end flg_pr
from customer""",
    "account_flags": """
select lpad(cast(c_custkey*2 as string),14,'0') acct_no_sav,
 case when c_custkey%17=0 then cast(date '2023-01-01' + cast(c_custkey%300 as int) as date) end derivative_date,
 case when c_custkey%17=0 then 'Y' end derivative_flg,
 case when c_custkey%19=0 then cast(date '2023-02-01' + cast(c_custkey%200 as int) as date) end swindle_moratorium_date,
 case when c_custkey%19=0 then 'Y' end swindle_moratorium_flg,
 case when c_acctbal>9000 then 'Y' end swindle_flg,
 case when c_acctbal<0 then cast(date '2023-03-01' + cast(c_custkey%100 as int) as date) end alert_date,
 case when c_acctbal<0 then 'Y' when c_acctbal<2000 then 'N' end alert_flg
from customer""",
    "brokerage_links": """
select lpad(cast(c_custkey*2+1 as string),14,'0') dep_acct_no,
 case when c_nationkey=0 then null
      when c_nationkey<3 then concat('XX',lpad(cast(c_nationkey as string),2,'0'))
      when c_nationkey<5 then 'YY'
      else concat('YY',lpad(cast(c_nationkey as string),2,'0')) end stck_cstdy_cd
from customer""",
    "mobile_log": """
select concat('A',lpad(cast(user_id as string),9,'0')) company_uid, event_id-event_id%3 login_log_key,
 ts access_time,
 case event_type when 'click' then 'MDS01' when 'view' then 'MPS1302' when 'error' then 'MDS0401' else 'OTHER' end menu_id, cast(cast(ts as date) + case when event_id%7=0 then 1 else 0 end as date) access_date
from events where event_type<>'purchase'""",
    "web_log": """
select concat('A',lpad(cast(user_id as string),9,'0')) company_uid, event_id-event_id%3 login_log_key,
 ts access_time, case when event_type='purchase' then 'CDS0401' else 'OTHER' end menu_id, cast(cast(ts as date) + case when event_id%7=0 then 1 else 0 end as date) access_date
from events where event_type in ('purchase','signup')""",
    "account_snapshot": """
select lpad(cast(c_custkey*2 as string),14,'0') acct_no_14,
 cast(date '2020-01-01' + cast(c_custkey%1400 as int) as date) acct_open_dt, date '2024-01-30' snap_date,
 case when c_custkey%7=0 then '  ' when c_custkey%5<>0 then concat('P',cast(c_custkey%4 as string)) end payroll_code
from customer""",
    "registered": """
select lpad(cast(o_custkey*2 as string),14,'0') acct_no_14, cast(o_orderdate as date) since, o_orderpriority kind
from orders""",
}
