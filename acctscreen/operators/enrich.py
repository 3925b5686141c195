"""Account enrichment of the cleaned transactions (the feature stage)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.operators.joins import Lookup, lookup
from acctscreen.sources.readers import snapshot


def enrich_accounts(
    txn: DataFrame,
    account_snapshot: DataFrame,
    snap_date: str,
    registered: DataFrame | None = None,
    registered_keys: tuple[tuple[str, str], ...] = (),
    registered_columns: tuple[str, ...] = (),
    label: int = 0,
) -> DataFrame:
    """Add the account-open date from the previous day's account snapshot,
    ``registered_columns`` of the registered-transfer table (as ``reg_<name>``,
    when given, joined on ``registered_keys`` pairs of (txn column, table
    column)) and a constant ``label``.

    Lookups of one row per key (of an account listed twice the earliest open
    date), so there are as many rows as ``txn`` has; an account with a large
    share of them can be split over tasks."""
    opened = snapshot(account_snapshot, snap_date, ["acct_no_14", "acct_open_dt"])
    tables = [Lookup(opened, (("acct_nbr_ori", "acct_no_14"),), ("acct_open_dt",))]
    if registered is not None:
        if not registered_keys or not registered_columns:
            raise ValueError("registered transfers need registered_keys and registered_columns")
        tables.append(Lookup(registered, registered_keys, registered_columns, prefix="reg_"))
    return lookup(txn, *tables).withColumn("label", F.lit(label))
