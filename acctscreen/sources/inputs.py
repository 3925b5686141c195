"""The input tables of one screening run."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from acctscreen.config import TableNames
from acctscreen.sources.readers import read_source


@dataclass(frozen=True)
class ScreenInputs:
    savings_txn: DataFrame      # savings transactions
    customers: DataFrame     # customers
    account_flags: DataFrame     # account flags
    brokerage_links: DataFrame         # brokerage accounts
    mobile_log: DataFrame       # mobile-bank access log
    web_log: DataFrame      # web-bank access log
    account_snapshot: DataFrame         # daily account snapshot
    registered: DataFrame | None = None  # registered-transfer table


def load_inputs(spark: SparkSession, names: TableNames) -> ScreenInputs:
    """Lazily bind every input by metastore name or Parquet path."""
    return ScreenInputs(
        savings_txn=read_source(spark, names.savings_txn),
        customers=read_source(spark, names.customers),
        account_flags=read_source(spark, names.account_flags),
        brokerage_links=read_source(spark, names.brokerage_links),
        mobile_log=read_source(spark, names.mobile_log),
        web_log=read_source(spark, names.web_log),
        account_snapshot=read_source(spark, names.account_snapshot),
        registered=read_source(spark, names.registered) if names.registered else None,
    )
