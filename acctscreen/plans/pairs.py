"""(account, customer) pairs kept up to date, so that the payroll list need not
read all transactions every day.

Each ingested partition of the transactions (a load, whatever days its
transactions are dated) has its own distinct pairs, stored as a whole
(``sources.days``); a partition that is loaded anew replaces its own.  The
pairs of all partitions, merged, are those of a full scan: late postings
come with the partition that brings them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from acctscreen.operators.exclusions import account_pairs, payroll_of_pairs
from acctscreen.sources.days import published_days, read_days, write_day

PARTITION = "ingested"


def ingested(spark: SparkSession, path: str) -> list[str]:
    """The partitions whose pairs are stored."""
    return published_days(spark, path, PARTITION)


def ingest(txn: DataFrame, path: str, partition: str) -> DataFrame:
    """Stores the pairs of one ingested partition, in place of any it had."""
    return write_day(account_pairs(txn), path, partition, PARTITION)


def update_pairs(spark: SparkSession, path: str, partitions: Mapping[str, Callable[[], DataFrame]]) -> list[str]:
    """Ingests the partitions that are not stored yet and returns their names;
    the others are not read, nor even opened."""
    have = set(ingested(spark, path))
    new = [p for p in partitions if p not in have]
    for p in new:
        ingest(partitions[p](), path, p)
    return new


def pairs(spark: SparkSession, path: str) -> DataFrame:
    """The distinct pairs of all ingested partitions."""
    return read_days(spark, path, partition_col=PARTITION).select("acct_nbr_ori", "cust_id").distinct()


def payroll_of_stored_pairs(spark: SparkSession, path: str, cust: DataFrame) -> DataFrame:
    """``payroll_accounts`` of all ingested transactions."""
    return payroll_of_pairs(pairs(spark, path), cust)
