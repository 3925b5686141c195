"""SQL twins of the registered queries, for DuckDB over the driver's tables.

Written from the rules' descriptions, independently of the DataFrame code
(the exchange rule, for one, uses ``count(distinct)`` plus a null flag here
and max/min/count in Spark).  Each string carries the bank-shaped views as
CTEs.  Column names equal the DataFrame outputs.
"""

from __future__ import annotations

import re

from acctscreen.config import (
    DEFAULT_CHANNELS,
    DEFAULT_EB_CHECK_MENUS,
    DEFAULT_MB_CHECK_MENUS,
    DEFAULT_MB_LIMIT_MENUS,
    DEFAULT_OCCUPATIONS,
    DEFAULT_MEMOS,
    DEFAULT_REMOVED_REMARKS,
    DEFAULT_TELLER_CODES,
    DEFAULT_TXN_COLUMNS,
)
from acctscreen.sources.fixtures import (
    AWKWARD_REMARKS,
    BAD_TEXT,
    PRODUCTION_VALUES,
    SNAP_DATE,
    TEST_CHANNELS,
    TEST_MEMOS,
    TEST_REMOVED_REMARKS,
    VIEW_SQL,
)


def _lst(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


ALL_VIEWS = tuple(VIEW_SQL)
ALL_TXN_COLUMNS = (*DEFAULT_TXN_COLUMNS, "emp_no")

# Named steps; each may use the views and the steps before it.
STEPS: dict[str, str] = {}

STEPS["payroll"] = """
select distinct acct_nbr_ori acct_no_14, 'Y' payroll_code from savings_txn t
where exists (select 1 from customers c where c.cust_id = t.cust_id and c.flg_pr = 'Y')"""

STEPS["flagged"] = """
select acct_no_sav, derivative_date, derivative_flg, swindle_moratorium_date, swindle_moratorium_flg,
  swindle_flg, alert_date, alert_flg
from account_flags
where not (derivative_flg is null and swindle_moratorium_flg is null and swindle_flg is null and alert_flg is null)"""

STEPS["brokerage"] = """
select distinct dep_acct_no from brokerage_links
where substr(stck_cstdy_cd, 1, 2) = 'XX' or stck_cstdy_cd is null
   or stck_cstdy_cd = 'XX' or length(stck_cstdy_cd) < 4"""

STEPS["ex_accounts"] = """
select distinct acct_nbr_ori from (
  select acct_no_sav acct_nbr_ori from account_flags where alert_flg = 'Y'
  union all select acct_no_14 from payroll
  union all select dep_acct_no from brokerage) u"""

STEPS["ex_customers"] = f"""
select distinct cust_id from customers
where (occupation in ({_lst(DEFAULT_OCCUPATIONS)}) or age <= 10)
  and length(cust_id) = 10 and regexp_matches(left(cust_id, 1), '[a-zA-Z]')"""

STEPS["candidates"] = f"""
select {", ".join(DEFAULT_TXN_COLUMNS)} from savings_txn
where acct_nbr_ori not in (select acct_nbr_ori from ex_accounts)
  and cust_id not in (select cust_id from ex_customers)
  and length(cust_id) = 10 and regexp_matches(left(cust_id, 1), '[a-zA-Z]')
  and tx_mode = '1'
  and (substr(emp_no, 4, 4) in ({_lst(DEFAULT_TELLER_CODES)}) or substr(emp_no, 4, 1) = '3')
  and tx_date between cast(date '{SNAP_DATE}' - interval 1 month as date) and date '{SNAP_DATE}'"""


def _normalized(src: str, cols: tuple[str, ...]) -> str:
    exprs = {
        "acct_nbr_ori": "case when length(trim(acct_nbr_ori)) < 14 then lpad(trim(acct_nbr_ori), 14, '0') "
                        "else trim(acct_nbr_ori) end acct_nbr_ori",
        "drcr": "cast(drcr as int) drcr",
        "pb_bal": "cast(pb_bal as double) pb_bal",
        "tx_amt": "cast(tx_amt as double) tx_amt",
        "tx_date": "cast(tx_date as date) tx_date",
        "tx_time": "cast(cast(tx_date as date) as timestamp) "
                   "+ to_seconds(cast(((tx_time % 86400) + 86400) % 86400 as bigint)) tx_time",
    }
    return f"select {', '.join(exprs.get(c, c) for c in cols)} from {src} where tx_mode = '1'"


def _memo_rule(src: str) -> str:
    return f"""
select * from {src}
where channel_desc in ({_lst(TEST_CHANNELS)}) and memo in ({_lst(TEST_MEMOS)})
  and not coalesce(remk in ({_lst(TEST_REMOVED_REMARKS)}), false)"""


def _exchange_groups(src: str, keys: tuple[str, ...]) -> str:
    k = ", ".join(keys)
    nn = " and ".join(f"{c} is not null" for c in keys)
    return f"""
select {k}, count(*) n_rows from {src} where {nn} group by {k}
having count(distinct cur) + max(case when cur is null then 1 else 0 end) > 1
   and count(distinct drcr) + max(case when drcr is null then 1 else 0 end) > 1"""


def _not_in_groups(src: str, groups: str, keys: tuple[str, ...]) -> str:
    on = " and ".join(f"g.{c} = t.{c}" for c in keys)
    return f"select * from {src} t where not exists (select 1 from {groups} g where {on})"


RAW_KEYS = ("acct_nbr_ori", "tx_date", "tx_time", "jrnl_no")
NORM_KEYS = ("acct_nbr_ori", "tx_time", "jrnl_no")

STEPS["memo_all"] = _memo_rule("savings_txn")
STEPS["xg_all"] = _exchange_groups("memo_all", RAW_KEYS)
STEPS["xr_all"] = _not_in_groups("memo_all", "xg_all", RAW_KEYS)

STEPS["norm_c"] = _normalized("candidates", DEFAULT_TXN_COLUMNS)
STEPS["memo_c"] = _memo_rule("norm_c")
STEPS["xg_c"] = _exchange_groups("memo_c", NORM_KEYS)
STEPS["xr_c"] = _not_in_groups("memo_c", "xg_c", NORM_KEYS)
STEPS["clean"] = "select * from xr_c where cur = 'TWD'"

STEPS["span"] = """
select p.acct_nbr_ori, p.cust_id, cast(b.mx as timestamp) max_date, cast(b.mn as timestamp) min_date
from (select distinct acct_nbr_ori, cust_id from clean) p
left join (select cust_id, max(tx_date) mx, min(tx_date) mn from clean group by cust_id) b
  on p.cust_id = b.cust_id"""


def _events(day: str | None) -> str:
    """All lookups, or those of the span's customers and range of ``day``."""
    mb = DEFAULT_MB_CHECK_MENUS + DEFAULT_MB_LIMIT_MENUS
    cond = ""
    if day:
        cond = f"""
  and company_uid in (select cust_id from span)
  and {day} between (select cast(min(min_date) as date) from span)
                and (select cast(max(max_date) as date) from span)"""
    return f"""
select company_uid, login_log_key, cast(access_time as date) access_date,
  case when menu_id in ({_lst(DEFAULT_MB_CHECK_MENUS)}) then 'mb_check'
       when menu_id in ({_lst(DEFAULT_MB_LIMIT_MENUS)}) then 'mb_limit' end category
from mobile_log where menu_id in ({_lst(mb)}){cond}
union all
select company_uid, login_log_key, cast(access_time as date) access_date,
  case when menu_id in ({_lst(DEFAULT_EB_CHECK_MENUS)}) then 'eb_check' end category
from web_log where menu_id in ({_lst(DEFAULT_EB_CHECK_MENUS)}){cond}"""


def _counts(events: str) -> str:
    def times(name: str) -> str:
        mine = f"filter (where category = '{name}')"
        return f"case when count(*) {mine} > 0 then count(distinct login_log_key) {mine} end {name}"

    return f"""
select company_uid, access_date, {times('mb_limit')}, {times('mb_check')}, {times('eb_check')}
from {events} group by company_uid, access_date"""


STEPS["log_events_all"] = _events(None)
STEPS["log_events"] = _events("cast(access_time as date)")
STEPS["log_events_own_day"] = _events("access_date")
STEPS["counts_long"] = """
select company_uid, access_date, category, count(distinct login_log_key) times
from log_events group by company_uid, access_date, category"""
STEPS["counts"] = _counts("log_events")
STEPS["counts_own_day"] = _counts("log_events_own_day")

STEPS["enriched"] = """
select c.*, i.acct_open_dt, 0 label from clean c
left join (select acct_no_14, acct_open_dt from account_snapshot where snap_date = date '2024-01-30') i
  on c.acct_nbr_ori = i.acct_no_14"""

STEPS["one_registered"] = """
select acct_no_14, since, kind from (
  select *, row_number() over (partition by acct_no_14 order by since nulls first, kind nulls first) n from registered) r
where n = 1"""

STEPS["final"] = """
select e.*, coalesce(k.mb_limit, 0) mb_limit, coalesce(k.mb_check, 0) mb_check,
  coalesce(k.eb_check, 0) eb_check
from enriched e left join counts k
  on e.cust_id = k.company_uid and cast(e.tx_date as date) = k.access_date"""


def _sql(body: str, *steps: str) -> str:
    """Views + the named steps (with the steps they use, in order) + body."""
    needed: list[str] = []

    def need(name: str) -> None:
        if name in needed:
            return
        text = STEPS[name]
        for other in STEPS:
            if other != name and _uses(text, other):
                need(other)
        needed.append(name)

    for s in steps:
        need(s)
    ctes = [f"{v} as ({VIEW_SQL[v].strip()})" for v in ALL_VIEWS]
    ctes += [f"{s} as ({STEPS[s].strip()})" for s in needed]
    return "with " + ",\n".join(ctes) + "\n" + body.strip()


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b(from|join)\s+{name}\b", text) is not None


NULL_AWARE = """
select acct_nbr_ori, jrnl_no, remk, 'list' tag from savings_txn
where remk not in (select concat('R', cast(age % 10 as string)) from customers where age < 3)
union all
select acct_nbr_ori, jrnl_no, remk, 'list_with_null' tag from savings_txn
where remk not in (select case when age = 0 then null else concat('R', cast(age % 10 as string)) end
                   from customers where age < 3)
union all
select acct_nbr_ori, jrnl_no, remk, 'empty_list' tag from savings_txn
where remk not in (select concat('R', cast(age % 10 as string)) from customers where age < 0)"""

def _production(column: str) -> str:
    cases = " ".join(f"when '{k}' then '{v}'" for k, v in PRODUCTION_VALUES[column].items())
    return f"case {column} {cases} else {column} end as {column}"


PRODUCTION = f"""
select * from (select * replace ({", ".join(map(_production, PRODUCTION_VALUES))}) from savings_txn) t
where channel_desc in ({_lst(DEFAULT_CHANNELS)}) and memo in ({_lst(DEFAULT_MEMOS)})
  and (remk is null or remk not in ({_lst(DEFAULT_REMOVED_REMARKS)}))"""

def _text(v: str | None) -> str:
    """A text as SQL: line ends by chr(), quotes doubled."""
    if v is None:
        return "null"
    parts = re.split("([\r\n])", v.replace("'", "''"))
    return " || ".join(f"chr({ord(x)})" if x in ("\r", "\n") else f"'{x}'" for x in parts if x) or "''"


AWKWARD = f"""
select * replace (case jrnl_no % 9 {" ".join(f"when {i} then {_text(v)}" for i, v in enumerate(AWKWARD_REMARKS))} else remk end as remk)
from savings_txn"""

STEPS["bad_text"] = f"""
select *, {", ".join(f"case when jrnl_no % {m} = 0 then '{v}' end as bad_{c}" for c, m, v in BAD_TEXT)} from savings_txn"""

# Rows that are good are those of the untouched view, so nothing is converted here.
CSV_GOOD = f"""
select * exclude ({", ".join(f"bad_{c}" for c, _, _ in BAD_TEXT)})
  replace (cast(drcr as int) as drcr, cast(pb_bal as double) as pb_bal, cast(tx_amt as double) as tx_amt, cast(tx_time as bigint) as tx_time)
from bad_text where {" and ".join(f"bad_{c} is null" for c, _, _ in BAD_TEXT)}"""

_BAD = f"coalesce({', '.join(f'bad_{c}' for c, _, _ in BAD_TEXT)}) is not null"
QUARANTINE = f"""
select case when {_BAD} then acct_nbr_ori else lpad(trim(acct_nbr_ori), cast(greatest(14, length(trim(acct_nbr_ori))) as int), '0') end acct_nbr_ori, cust_id, jrnl_no,
  case when not {_BAD} then cast(drcr as int) end drcr, case when not {_BAD} then cast(pb_bal as double) end pb_bal,
  case when not {_BAD} then cast(tx_amt as double) end tx_amt, case when not {_BAD} then cast(tx_date as date) end tx_date,
  case when not {_BAD} then cast(tx_date as timestamp) + to_seconds(cast(tx_time % 86400 as bigint)) end tx_time,
  case when {_BAD} then concat_ws(';', {", ".join(f"'{c}=' || bad_{c}" for c, _, _ in BAD_TEXT)}) end reasons
from bad_text where tx_mode = '1'"""

ORDER_COLS = ("acct_nbr_ori", "tx_date", "tx_time") + tuple(
    c for c in DEFAULT_TXN_COLUMNS if c not in ("acct_nbr_ori", "tx_date", "tx_time")
)
ORDER_BY = ", ".join(
    [f"{c} asc nulls first" for c in ORDER_COLS]
)

FINAL_COLS = ORDER_COLS + ("acct_open_dt", "label", "mb_limit", "mb_check", "eb_check")
FINAL_ORDER_BY = ", ".join(f"{c} asc nulls first" for c in FINAL_COLS)

ORACLE: dict[str, str] = {
    "flagged_accounts": _sql("select * from flagged", "flagged"),
    "brokerage_accounts": _sql("select * from brokerage", "brokerage"),
    "payroll_accounts": _sql("select * from payroll", "payroll"),
    "excluded_accounts": _sql("select * from ex_accounts", "ex_accounts"),
    "excluded_customers": _sql("select * from ex_customers", "ex_customers"),
    "exclude_null_aware": _sql(NULL_AWARE),
    "candidate_transactions": _sql("select * from candidates", "candidates"),
    "candidates_prefiltered": _sql("select * from candidates", "candidates"),
    "payroll_kept_pairs": _sql("select * from payroll", "payroll"),
    "ordered_candidates": _sql(f"select * from candidates order by {ORDER_BY}", "candidates"),
    "candidate_preview": _sql(f"select * from candidates order by {ORDER_BY} limit 2", "candidates"),
    "normalized_transactions": _sql(
        _normalized("savings_txn", ALL_TXN_COLUMNS)),
    "channel_memo_filtered": _sql("select * from memo_all", "memo_all"),
    "duplicate_time_keys": _sql("""
select acct_nbr_ori, tx_date, tx_time, count(*) n_rows from memo_all
where acct_nbr_ori is not null and tx_date is not null and tx_time is not null
group by acct_nbr_ori, tx_date, tx_time having count(*) > 1""", "memo_all"),
    "exchange_groups": _sql("select * from xg_all", "xg_all"),
    "exchange_removed": _sql("select * from xr_all", "xr_all"),
    "twd_only": _sql("select * from xr_all where cur = 'TWD'", "xr_all"),
    "clean_transactions": _sql("select * from clean", "clean"),
    "payroll_excluded": _sql("""
select * from savings_txn t where not exists (
  select 1 from payroll p where p.payroll_code is not null and p.acct_no_14 = t.acct_nbr_ori)""", "payroll"),
    "activity_span": _sql("select * from span", "span"),
    "customer_ids": _sql("select distinct cust_id from clean", "clean"),
    "txn_date_bounds": _sql(
        "select min(tx_date) min_tx_date, max(tx_date) max_tx_date from clean", "clean"),
    "access_events": _sql("select * from log_events_all", "log_events_all"),
    "access_counts_long": _sql("select * from counts_long", "counts_long"),
    "access_counts_wide": _sql("select * from counts", "counts"),
    "account_enriched": _sql("select * from enriched", "enriched"),
    "flagship_features": _sql("select * from final", "final"),
    "screen_lazy": _sql("select * from final", "final"),
    "flagship_bucketed": _sql("select * from final", "final"),
    "payroll_from_snapshot": _sql(
        "select distinct acct_no_14, payroll_code from account_snapshot where trim(payroll_code) <> ''"),
    "access_counts_log_day": _sql("select * from counts_own_day", "counts_own_day"),
    "account_registered": _sql("""
select e.*, r.since reg_since, r.kind reg_kind from enriched e left join one_registered r on r.acct_no_14 = e.acct_nbr_ori""",
                               "enriched", "one_registered"),
    "clean_production_lists": _sql(PRODUCTION),
    "csv_roundtrip": _sql(_normalized("savings_txn", ALL_TXN_COLUMNS)),
    "csv_awkward_text": _sql(AWKWARD),
    "csv_bad_records": _sql(CSV_GOOD, "bad_text"),
    "normalized_quarantine": _sql(QUARANTINE, "bad_text"),
    "range_written_candidates": _sql("select * from candidates", "candidates"),
    "chosen_files": _sql("select *, 3 n_files from customers"),
    "sql_file_table": _sql(f"""
select *, date '2023-12-31' first_day, date '{SNAP_DATE}' last_day from savings_txn
where tx_date >= date '2023-12-31' and tx_date <= date '{SNAP_DATE}'"""),
    "partitioned_roundtrip": _sql(f"""
select *, date '2024-01-30' snap_date from savings_txn where tx_mode = '1'
union all select *, date '{SNAP_DATE}' snap_date from savings_txn where tx_mode = '2'"""),
    "table_refresh": _sql("select * from customers where age >= 40"),
    "nonzero_preview": _sql(f"select * from final where mb_limit <> 0 order by {FINAL_ORDER_BY} limit 2",
                            "final"),
}
