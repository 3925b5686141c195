"""Candidate transactions: one month of savings transactions of ordinary
individual customers, minus excluded accounts and customers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.config import ScreenConfig
from acctscreen.functions.predicates import in_date_window, is_individual_id, teller_code_ok
from acctscreen.operators.exclusions import exclude, exclude_listed

CANDIDATE_ORDER = ("acct_nbr_ori", "tx_date", "tx_time")


def candidate_transactions(
    txn: DataFrame,
    ex_accounts: DataFrame,
    ex_customers: DataFrame,
    snap_date: str,
    cfg: ScreenConfig,
) -> DataFrame:
    """Transactions in ``[add_months(snap_date,-1), snap_date]`` with
    ``tx_mode``, an individual customer id and a teller code, whose account
    is not in ``ex_accounts.acct_nbr_ori`` and whose customer is not in
    ``ex_customers.cust_id``; the configured transaction columns.

    The cheap row filters come first and reach the Parquet scan; the two
    anti joins then see only one month of rows (with ``cfg.prefilter_lists``
    only those of them that may be on a list)."""
    cond = (
        in_date_window("tx_date", snap_date)
        & is_individual_id("cust_id")
        & teller_code_ok("emp_no", cfg.teller_codes, cfg.teller_prefix)
    )
    if cfg.tx_mode is not None:
        cond = cond & (F.col("tx_mode") == cfg.tx_mode)
    rows = txn.filter(cond)
    if cfg.prefilter_lists:
        lists = [(ex_accounts, "acct_nbr_ori", "acct_nbr_ori"), (ex_customers, "cust_id", "cust_id")]
        return exclude_listed(rows, lists, null_aware=cfg.null_aware_exclusions).select(*cfg.txn_columns)
    rows = exclude(rows, ex_accounts, "acct_nbr_ori", null_aware=cfg.null_aware_exclusions)
    rows = exclude(rows, ex_customers, "cust_id", null_aware=cfg.null_aware_exclusions)
    return rows.select(*cfg.txn_columns)


def ordered(df: DataFrame, keys: tuple[str, ...] = CANDIDATE_ORDER) -> DataFrame:
    """Global ascending order on ``keys``, remaining columns as tie-breaks so
    the order is total.  Spark range-partitions then sorts each partition,
    so no single task sorts everything."""
    rest = [c for c in df.columns if c not in keys]
    return df.orderBy(*[F.col(k).asc() for k in keys], *[F.col(c).asc_nulls_first() for c in rest])
