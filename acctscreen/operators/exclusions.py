"""Exclusion lists (payroll, flagged and brokerage accounts; excluded
customers) and the anti join that applies them."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.config import ScreenConfig
from acctscreen.functions.predicates import is_individual_id
from acctscreen.operators.joins import distinct_join_keys


def payroll_accounts(txn: DataFrame, cust: DataFrame) -> DataFrame:
    """Accounts of customers marked as payroll customers (``flg_pr='Y'``).

    Output ``(acct_no_14, payroll_code)``, distinct over both columns.  The
    transactions are first reduced to their distinct (account, customer)
    pairs — partial-aggregated in every task, so a customer or account with
    a huge share of the rows ships one row per task — and only the pairs
    meet the customer table in the join."""
    return payroll_of_pairs(account_pairs(txn), cust)


def account_pairs(txn: DataFrame) -> DataFrame:
    """Distinct (account, customer) pairs of transactions."""
    return txn.select("acct_nbr_ori", "cust_id").distinct()


def payroll_of_pairs(pairs: DataFrame, cust: DataFrame) -> DataFrame:
    """The payroll list of distinct (account, customer) pairs, such as those of
    a kept table (``plans.pairs``)."""
    payroll_cust = cust.filter(F.col("flg_pr") == "Y").select("cust_id", "flg_pr")
    return (
        pairs.join(payroll_cust, "cust_id")
        .select(F.col("acct_nbr_ori").alias("acct_no_14"), F.col("flg_pr").alias("payroll_code"))
        .distinct()
    )


def payroll_from_snapshot(account_snapshot: DataFrame) -> DataFrame:
    """The older payroll source: distinct ``(acct_no_14, payroll_code)`` of an
    account snapshot whose payroll code is not blank."""
    code = F.nullif(F.trim(F.col("payroll_code")), F.lit(""))
    return account_snapshot.filter(code.isNotNull()).select("acct_no_14", "payroll_code").distinct()


FLAG_COLUMNS = (
    "acct_no_sav", "derivative_date", "derivative_flg", "swindle_moratorium_date",
    "swindle_moratorium_flg", "swindle_flg", "alert_date", "alert_flg",
)
FLAG_TESTS = ("derivative_flg", "swindle_moratorium_flg", "swindle_flg", "alert_flg")


def flagged_accounts(account_flags: DataFrame) -> DataFrame:
    """Accounts carrying any of the four flags: the eight flag columns, all of
    which the input must have (in either case)."""
    return account_flags.filter(F.coalesce(*FLAG_TESTS).isNotNull()).select(*[F.col(c).alias(c) for c in FLAG_COLUMNS])


def brokerage_accounts(sec: DataFrame, cfg: ScreenConfig) -> DataFrame:
    """Distinct deposit accounts linked to a brokerage: custody code starting
    with the broker prefix, null, equal to it, or shorter than 4 characters."""
    code = F.col("stck_cstdy_cd")
    hit = (
        (F.substring(code, 1, len(cfg.broker_prefix)) == cfg.broker_prefix)
        | code.isNull()
        | (code == cfg.broker_prefix)
        | (F.length(code) < 4)
    )
    return sec.filter(hit).select("dep_acct_no").distinct()


def excluded_accounts(account_flags: DataFrame, payroll: DataFrame, brokerage: DataFrame) -> DataFrame:
    """Union of alert-flagged, payroll and brokerage accounts, distinct,
    as one column ``acct_nbr_ori``."""
    alert = account_flags.filter(F.col("alert_flg") == "Y").select(F.col("acct_no_sav").alias("acct_nbr_ori"))
    pay = payroll.select(F.col("acct_no_14").alias("acct_nbr_ori"))
    sec = brokerage.select(F.col("dep_acct_no").alias("acct_nbr_ori"))
    return alert.unionByName(pay).unionByName(sec).distinct()


def excluded_customers(cust: DataFrame, cfg: ScreenConfig) -> DataFrame:
    """Individuals in an excluded profession or aged at most the limit."""
    hit = F.col("occupation").isin(list(cfg.occupations)) | (F.col("age") <= cfg.max_excluded_age)
    return cust.filter(hit & is_individual_id("cust_id")).select("cust_id").distinct()


def exclude(
    df: DataFrame, ex: DataFrame, key: str, ex_key: str | None = None, null_aware: bool = True
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in column ``ex_key`` of ``ex``.

    ``null_aware=True`` gives SQL ``key NOT IN (SELECT ex_key FROM ex)``:
    a null in the list empties the result, and a null ``key`` is dropped
    unless the list is empty.  Spark plans ``NOT IN`` as a broadcast
    null-aware anti join whatever the list size; this form is an ordinary
    equi anti join (sort-merge, or broadcast when AQE measures the list as
    small) plus two list statistics read through one scalar subquery.  The
    two plans of the list differ, so ``ex`` is computed twice: pass a stored
    list if that is more than a scan.

    ``null_aware=False`` is a plain ``left_anti`` join (NOT EXISTS)."""
    ex_key = ex_key or key
    right = distinct_join_keys(ex.select(F.col(ex_key).alias("__ex_key")), ["__ex_key"])
    kept = df.join(right, F.col(key) == F.col("__ex_key"), "left_anti")
    return _null_rule(kept, ex, key, ex_key) if null_aware else kept


def _null_rule(kept: DataFrame, ex: DataFrame, key: str, ex_key: str) -> DataFrame:
    """What ``NOT IN`` makes of nulls, for rows whose key is not in the list."""
    s = ex.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(ex_key).isNull()).alias("n_null"),
        )
    ).scalar()
    return kept.filter((s["n"] == 0) | (F.col(key).isNotNull() & (s["n_null"] == 0)))


#: Largest table of key bits: 2**26 bits are a million rows of two numbers to broadcast.
MOST_BITS = 26


def key_bits(keys: DataFrame, bits: int) -> DataFrame:
    """``(__word, __bits)``: a table of 2**bits bits, 64 in a row, with the bit of
    each key's hash set.  It has 2**(bits - 6) rows at most, however many keys there are."""
    h = F.xxhash64(*keys.columns)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    return keys.groupBy(F.shiftrightunsigned(h, 64 - bits + 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))


def _may_hold(key: str, table: DataFrame, bits: int, df: DataFrame, flag: str) -> DataFrame:
    h = F.xxhash64(key)
    hit = F.call_function("bit_get", F.coalesce(F.col("__bits"), F.lit(0).cast("long")), F.pmod(h, F.lit(64)).cast("int")) == 1
    probe = df.withColumn("__at", F.shiftrightunsigned(h, 64 - bits + 6)).join(F.broadcast(table), F.col("__at") == F.col("__word"), "left")
    return probe.withColumn(flag, hit).drop("__at", "__word", "__bits")


def exclude_listed(df: DataFrame, lists: Sequence[tuple[DataFrame, str, str]], null_aware: bool = True, most_bits: int = MOST_BITS) -> DataFrame:
    """``exclude`` by several lists, each given as (list, key of df, key of the
    list), for lists that name few of the rows: the same rows, less shuffled.

    A first look at a table of hash bits (at least 16 for each key, up to
    2**``most_bits``) tells the rows that are surely on no list; they bypass
    the joins.  Only the others are shuffled to the exact anti joins,
    so a bit that two keys share costs a row's way and never the row.  ``df`` is
    read twice.  The lists' sizes are counted first (pass stored lists); one
    too long for the largest table of bits goes through ``exclude`` alone."""
    sized = []
    for ex, key, ex_key in lists:
        keys = ex.select(F.col(ex_key).cast(df.schema[key].dataType).alias("__key")).filter(F.col("__key").isNotNull())
        bits = max(16, math.ceil(math.log2(16 * keys.count() + 1)))
        if bits > most_bits + 3:  # more than half of the largest table's bits would be set
            df = exclude(df, ex, key, ex_key, null_aware)
        else:
            sized.append((ex, key, ex_key, keys, min(bits, most_bits)))
    probe, flags = df, []
    for i, (_, key, _, keys, bits) in enumerate(sized):
        probe = _may_hold(key, key_bits(keys, bits), bits, probe, f"__may{i}")
        flags.append(f"__may{i}")
    if not flags:
        return df
    listed = F.greatest(*[F.col(f).cast("int") for f in flags]) == 1 if len(flags) > 1 else F.col(flags[0])
    sure = probe.filter(~listed).select(*df.columns)
    maybe = probe.filter(listed).select(*df.columns)
    for ex, key, ex_key, _, _ in sized:
        maybe = exclude(maybe, ex, key, ex_key, null_aware)
        if null_aware:
            sure = _null_rule(sure, ex, key, ex_key)
    return sure.unionByName(maybe)
