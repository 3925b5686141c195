"""Registered queries: one per operator of the screening job, each over the
whole bank-shaped views of a test scale (``acctscreen.sources.fixtures``).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame.  Queries
that store intermediate tables run those jobs while the frame is built.
``acctscreen.plans.oracle`` holds an SQL twin for each key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctscreen.operators import access, activity, candidates, cleansing, enrich, exclusions
from acctscreen.plans import bucketed, pairs, pipeline
from acctscreen.config import ScreenConfig
from acctscreen.plans.materialize import run_root, store_list, table_name, write_and_read
from acctscreen.sources import fixtures
from acctscreen.sources.fixtures import SNAP_DATE, TEST_CONFIG as CFG
from acctscreen.sources.inputs import ScreenInputs
from acctscreen.sources.days import read_days, write_day
from acctscreen.sources.readers import read_csv, read_csv_checked, read_table, sql_file
from acctscreen.sources.writers import clustered, export_csv, overwrite_table, preview, refresh, write_files

WINDOW = pipeline.window_bounds(SNAP_DATE)
BUCKETS = 16  # of the customer; a cluster takes as many as keep one well below a task's memory
MONTH_SQL = Path(__file__).parent.parent / "sql" / "month_of_transactions.sql"

Query = Callable[[SparkSession, str], DataFrame]


def _with_inputs(fn: Callable[[ScreenInputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixtures.load(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# -- exclusion lists ---------------------------------------------------------

def q_flagged_accounts(t: ScreenInputs) -> DataFrame:
    return exclusions.flagged_accounts(t.account_flags)


def q_brokerage_accounts(t: ScreenInputs) -> DataFrame:
    return exclusions.brokerage_accounts(t.brokerage_links, CFG)


def q_payroll_accounts(t: ScreenInputs) -> DataFrame:
    return exclusions.payroll_accounts(t.savings_txn, t.customers)


def q_payroll_from_snapshot(t: ScreenInputs) -> DataFrame:
    return exclusions.payroll_from_snapshot(t.account_snapshot)


def q_payroll_kept_pairs(t: ScreenInputs) -> DataFrame:
    """The payroll list from pairs stored by the month of posting, in two runs:
    the second one reads the last month only."""
    spark, path = t.savings_txn.sparkSession, run_root(t.savings_txn.sparkSession, "pairs")
    month = F.date_format("act_date", "yyyy-MM")

    def load(name: str) -> Callable[[], DataFrame]:
        return lambda: t.savings_txn.filter(month.eqNullSafe(F.lit(name)))

    months = {m: load(m) for m in ("2023-12", "2024-01", "2024-02")}
    pairs.update_pairs(spark, path, {m: months[m] for m in list(months)[:-1]})
    pairs.update_pairs(spark, path, months)
    return pairs.payroll_of_stored_pairs(spark, path, t.customers)


def q_excluded_accounts(t: ScreenInputs) -> DataFrame:
    return pipeline.exclusion_lists(t, CFG).accounts


def q_excluded_customers(t: ScreenInputs) -> DataFrame:
    return exclusions.excluded_customers(t.customers, CFG)


def q_exclude_null_aware(t: ScreenInputs) -> DataFrame:
    """NOT IN semantics on remarks (which hold nulls) against three lists
    drawn from the customer table: plain, holding a null, and empty."""
    age = F.col("age")
    code = F.concat(F.lit("R"), (age % 10).cast("string"))
    lists = {
        "list": t.customers.filter(age < 3).select(code.alias("v")),
        "list_with_null": t.customers.filter(age < 3).select(
            F.when(age == 0, F.lit(None).cast("string")).otherwise(code).alias("v")),
        "empty_list": t.customers.filter(age < 0).select(code.alias("v")),
    }
    txn = t.savings_txn.select("acct_nbr_ori", "jrnl_no", "remk")
    parts = [
        exclusions.exclude(txn, store_list(ex), "remk", "v", null_aware=True).withColumn("tag", F.lit(tag))
        for tag, ex in lists.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- candidates and cleaning -------------------------------------------------

def _writer(t: ScreenInputs, label: str) -> pipeline.TableWriter:
    # Stage tables of one query go to a fresh folder in the shared
    # checkpoint folder, as in ``run_pipeline``.
    return pipeline.table_writer(run_root(t.savings_txn.sparkSession, label))


def _candidates(t: ScreenInputs) -> DataFrame:
    return pipeline.candidates_stage(t, CFG, SNAP_DATE, _writer(t, "candidates"))


def _cleaned(t: ScreenInputs) -> DataFrame:
    return pipeline.cleaning_stage(t, CFG, SNAP_DATE, _writer(t, "cleaned"))


def q_candidate_transactions(t: ScreenInputs) -> DataFrame:
    return _candidates(t)


def q_candidates_prefiltered(t: ScreenInputs) -> DataFrame:
    """The candidates, by lists that are looked up in tables of bits first."""
    return pipeline.candidates_stage(t, CFG.with_(prefilter_lists=True), SNAP_DATE, _writer(t, "prefiltered"))


def q_ordered_candidates(t: ScreenInputs) -> DataFrame:
    return candidates.ordered(_candidates(t))


def q_candidate_preview(t: ScreenInputs) -> DataFrame:
    """The first two candidates in account/date/time order (the eyeball
    check of the original job), on a total order."""
    return preview(candidates.ordered(_candidates(t)), 2)


def q_normalized_transactions(t: ScreenInputs) -> DataFrame:
    return cleansing.normalize_transactions(t.savings_txn, CFG)


def _memo_filtered(t: ScreenInputs) -> DataFrame:
    return cleansing.filter_channel_memo(t.savings_txn, CFG)


def q_channel_memo_filtered(t: ScreenInputs) -> DataFrame:
    return _memo_filtered(t)


def q_duplicate_time_keys(t: ScreenInputs) -> DataFrame:
    return cleansing.duplicate_time_keys(_memo_filtered(t), ("acct_nbr_ori", "tx_date", "tx_time"))


def q_exchange_groups(t: ScreenInputs) -> DataFrame:
    return cleansing.exchange_groups(_memo_filtered(t), cleansing.RAW_EXCHANGE_KEYS, store_list)


def q_exchange_removed(t: ScreenInputs) -> DataFrame:
    # Read twice, for the groups and for the rows: stored once.
    rows = write_and_read(_memo_filtered(t), run_root(t.savings_txn.sparkSession, "memo"))
    return cleansing.remove_exchanges(rows, cleansing.RAW_EXCHANGE_KEYS, store_list)


def q_twd_only(t: ScreenInputs) -> DataFrame:
    return cleansing.filter_currency(q_exchange_removed(t), CFG.currency)


def q_clean_transactions(t: ScreenInputs) -> DataFrame:
    return _cleaned(t)


def q_payroll_excluded(t: ScreenInputs) -> DataFrame:
    return cleansing.exclude_payroll(t.savings_txn, exclusions.payroll_accounts(t.savings_txn, t.customers))


# -- spans and access counts -------------------------------------------------

def _span(t: ScreenInputs) -> DataFrame:
    return activity.customer_activity_span(_cleaned(t))


def _span_table(t: ScreenInputs) -> DataFrame:
    # The span feeds both the customer semi join and the date bounds:
    # written once, read twice, instead of re-running the cleaning twice.
    spark = t.savings_txn.sparkSession
    return write_and_read(_span(t), run_root(spark, "span"))


def q_activity_span(t: ScreenInputs) -> DataFrame:
    return _span(t)


def q_customer_ids(t: ScreenInputs) -> DataFrame:
    return activity.customer_ids(_cleaned(t))


def q_txn_date_bounds(t: ScreenInputs) -> DataFrame:
    return activity.txn_date_bounds(_cleaned(t))


def q_access_events(t: ScreenInputs) -> DataFrame:
    return access.access_events(t.mobile_log, t.web_log, CFG)


def q_access_counts_long(t: ScreenInputs) -> DataFrame:
    return access.access_counts_long(access.access_events(t.mobile_log, t.web_log, CFG, _span_table(t), WINDOW))


def q_access_counts_wide(t: ScreenInputs) -> DataFrame:
    return access.access_counts(t.mobile_log, t.web_log, _span_table(t), CFG, WINDOW)


def q_access_counts_log_day(t: ScreenInputs) -> DataFrame:
    """The counts, with the range test on the logs' own day column."""
    return access.access_counts(t.mobile_log, t.web_log, _span_table(t), fixtures.LOG_DAY_CONFIG, WINDOW)


# -- features ----------------------------------------------------------------

def q_account_enriched(t: ScreenInputs) -> DataFrame:
    return enrich.enrich_accounts(_cleaned(t), t.account_snapshot, SNAP_DATE)


def q_account_registered(t: ScreenInputs) -> DataFrame:
    """The feature stage with registered transfers, of which an account has several."""
    return pipeline.feature_stage(_cleaned(t), t, fixtures.REGISTERED_CONFIG, SNAP_DATE)


def q_flagship_features(t: ScreenInputs) -> DataFrame:
    """The whole daily run: stage tables written under the shared
    checkpoint folder, the final table returned."""
    return pipeline.run_pipeline(t.savings_txn.sparkSession, t, CFG, SNAP_DATE).output


def q_nonzero_preview(t: ScreenInputs) -> DataFrame:
    """The original job's eyeball check of the final table: two rows with a
    non-zero ``mb_limit``, first in account/date/time order."""
    out = pipeline.run_pipeline(t.savings_txn.sparkSession, t, CFG, SNAP_DATE).output
    return preview(candidates.ordered(out.filter(F.col("mb_limit") != 0)), 2)


def q_screen_lazy(t: ScreenInputs) -> DataFrame:
    """The same result as ``flagship_features``, storing the lists, the
    candidates and the features only."""
    return pipeline.screen(t, CFG, SNAP_DATE, _writer(t, "screen"))


def q_flagship_bucketed(t: ScreenInputs) -> DataFrame:
    """The same result, with features and logs stored in buckets of the customer."""
    write = _writer(t, "bucketed")
    features = write("features", pipeline.feature_stage(pipeline.cleaning_stage(t, CFG, SNAP_DATE, write), t, CFG, SNAP_DATE))
    return bucketed.tracking_bucketed(features, t, CFG, WINDOW, BUCKETS)


def q_clean_production_lists(t: ScreenInputs) -> DataFrame:
    """Channel, memo and remark rules with the production's default lists."""
    return cleansing.filter_channel_memo(fixtures.with_production_values(t.savings_txn), ScreenConfig())


# -- sources and sinks ---------------------------------------------------------

def q_csv_roundtrip(t: ScreenInputs) -> DataFrame:
    """The normalised transactions as CSV text, read with an explicit schema."""
    spark, path = t.savings_txn.sparkSession, run_root(t.savings_txn.sparkSession, "csv")
    typed = cleansing.normalize_transactions(t.savings_txn, CFG)
    export_csv(typed, path)
    return read_csv(spark, path, typed.schema)


def q_csv_awkward_text(t: ScreenInputs) -> DataFrame:
    """Blanks, empty and null text, line ends, quotes and backslashes through CSV."""
    spark, path = t.savings_txn.sparkSession, run_root(t.savings_txn.sparkSession, "csv")
    rows = fixtures.with_awkward_text(t.savings_txn)
    export_csv(rows, path)
    return read_csv(spark, path, rows.schema)


def q_csv_bad_records(t: ScreenInputs) -> DataFrame:
    """Records of a CSV file that fit the schema; the others are set aside."""
    spark, root = t.savings_txn.sparkSession, run_root(t.savings_txn.sparkSession, "csv")
    export_csv(fixtures.with_bad_text(t.savings_txn), f"{root}/in")
    typed = t.savings_txn.withColumns({c: F.col(c).cast(d) for c, d in cleansing.CONVERTED.items()})
    return read_csv_checked(spark, f"{root}/in", typed.schema, f"{root}/checked").good


def q_normalized_quarantine(t: ScreenInputs) -> DataFrame:
    """Typed rows, and rows set aside with the columns that do not convert."""
    rows = fixtures.with_bad_text(t.savings_txn)
    checked = cleansing.normalize_checked(rows, CFG, run_root(rows.sparkSession, "checked"))
    none = F.lit(None).cast("string")
    good = checked.good.select("acct_nbr_ori", "cust_id", "jrnl_no", *cleansing.CONVERTED, none.alias("reasons"))
    nulls = [F.lit(None).cast(good.schema[c].dataType).alias(c) for c in cleansing.CONVERTED]
    bad = checked.rejected.select("acct_nbr_ori", "cust_id", "jrnl_no", *nulls, F.array_join("reasons", ";").alias("reasons"))
    return good.unionByName(bad)


def q_range_written_candidates(t: ScreenInputs) -> DataFrame:
    """The candidates, written by ranges of account and time and read back."""
    return write_and_read(clustered(_candidates(t), candidates.CANDIDATE_ORDER), run_root(t.savings_txn.sparkSession, "clustered"))


def q_chosen_files(t: ScreenInputs) -> DataFrame:
    """The customers in three files, with the number of files that hold them."""
    spark, path = t.customers.sparkSession, run_root(t.customers.sparkSession, "files")
    write_files(t.customers, path, files=3)
    read = spark.read.parquet(path)
    n = read.agg(F.count_distinct(F.col("_metadata.file_path")).alias("n_files")).scalar()
    return read.withColumn("n_files", n)


def q_sql_file_table(t: ScreenInputs) -> DataFrame:
    """A table made from an SQL file with parameters, read by its name."""
    spark = t.savings_txn.sparkSession
    t.savings_txn.createOrReplaceTempView("acctscreen_transactions")
    name = table_name(spark, "month")
    overwrite_table(sql_file(spark, MONTH_SQL, tbl="acctscreen_transactions", snap=dt.date.fromisoformat(SNAP_DATE)), name)
    return read_table(spark, name)


def q_partitioned_roundtrip(t: ScreenInputs) -> DataFrame:
    """Two days of a dated table, one of them written twice."""
    spark, path = t.savings_txn.sparkSession, run_root(t.savings_txn.sparkSession, "dated")
    mode = F.col("tx_mode")
    write_day(t.savings_txn.filter(mode == "1"), path, "2024-01-30")
    write_day(t.savings_txn, path, SNAP_DATE)
    write_day(t.savings_txn.filter(mode == "2"), path, SNAP_DATE)
    return read_days(spark, path)


def q_table_refresh(t: ScreenInputs) -> DataFrame:
    """A Parquet table that is replaced, refreshed and read again."""
    spark = t.customers.sparkSession
    name = table_name(spark, "customers")
    overwrite_table(t.customers, name, fmt="parquet")
    overwrite_table(t.customers.filter(F.col("age") >= 40), name, fmt="parquet")
    refresh(spark, name)
    return read_table(spark, name)


QUERIES: dict[str, Query] = {
    name[2:]: _with_inputs(fn)
    for name, fn in list(globals().items())
    if name.startswith("q_") and callable(fn)
}

FLAGSHIP = "flagship_features"
