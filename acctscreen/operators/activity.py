"""Customer activity span: each (account, customer) pair with the first and
last transaction day of the customer, plus the id list and date bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_activity_span(txn: DataFrame, colocated: bool = False) -> DataFrame:
    """``(acct_nbr_ori, cust_id, max_date, min_date)``: distinct pairs, the
    customer's last and first ``tx_date`` as midnight TIMESTAMP_NTZ.

    Each task sends one row per pair; the customers' bounds are aggregated
    from the pairs, again partially, and joined back.  The bounds are grouped
    on a struct so that they reach the join by a shuffle of their own: AQE
    can then split a customer with a large share of the accounts.  Rows with
    a null customer form no span.

    ``colocated``: ``txn`` is bucketed by customer and no customer has a large
    share, so the bounds stay where the pairs are and nothing is shuffled."""
    pairs = (
        txn.filter(F.col("cust_id").isNotNull())
        .groupBy("cust_id", "acct_nbr_ori")
        .agg(F.max("tx_date").alias("pair_max"), F.min("tx_date").alias("pair_min"))
    )
    outer = [F.max("pair_max").alias("__max"), F.min("pair_min").alias("__min")]
    if colocated:
        bounds = pairs.groupBy("cust_id").agg(*outer)
    else:
        bounds = pairs.groupBy(F.struct("cust_id").alias("__k")).agg(*outer).select(F.col("__k.cust_id").alias("cust_id"), "__max", "__min")
    return pairs.join(bounds, "cust_id").select(
        "acct_nbr_ori",
        "cust_id",
        F.col("__max").cast("date").cast("timestamp_ntz").alias("max_date"),
        F.col("__min").cast("date").cast("timestamp_ntz").alias("min_date"),
    )


def customer_ids(txn: DataFrame) -> DataFrame:
    """Distinct customer ids, kept as a DataFrame for semi joins."""
    return txn.select("cust_id").filter(F.col("cust_id").isNotNull()).distinct()


def txn_date_bounds(txn: DataFrame) -> DataFrame:
    """One row: first and last ``tx_date`` (partial min/max in every task)."""
    return txn.agg(F.min("tx_date").alias("min_tx_date"), F.max("tx_date").alias("max_tx_date"))
