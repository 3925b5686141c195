"""The three-stage daily screening run.

Stage 1 (cleaning): exclusion lists -> candidate transactions -> cleaning.
Stage 2 (features): account enrichment.
Stage 3 (tracking): activity spans -> daily access counts -> attached counts.

Each ``*_stage`` function returns DataFrames; given a ``write``r it stores
what several steps read.  ``run_pipeline`` writes every stage to Parquet under a shared output root and reads it back
before the next stage: the written table is the hand-off, it cuts the
lineage (a lost executor recomputes from the last stage output, not from
the raw tables) and each stage can be rerun on its own (``stages=``).
``screen`` is the same work, storing only the lists, candidates and features.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from acctscreen.config import ScreenConfig
from acctscreen.operators.access import access_counts, attach_access_counts
from acctscreen.operators.activity import customer_activity_span
from acctscreen.operators.candidates import CANDIDATE_ORDER, candidate_transactions
from acctscreen.operators.cleansing import clean
from acctscreen.operators.enrich import enrich_accounts
from acctscreen.operators.exclusions import (
    brokerage_accounts,
    excluded_accounts,
    excluded_customers,
    flagged_accounts,
    payroll_accounts,
)
from acctscreen.plans.materialize import run_root, write_and_read
from acctscreen.sources.days import read_day, write_day
from acctscreen.sources.inputs import ScreenInputs
from acctscreen.sources.writers import clustered
from acctscreen.sources.writers import export_csv as export_csv_text


@dataclass(frozen=True)
class ExclusionLists:
    payroll: DataFrame
    flagged: DataFrame
    brokerage: DataFrame
    accounts: DataFrame
    customers: DataFrame


# Stores a named intermediate table and returns a scan of what it stored.
TableWriter = Callable[[str, DataFrame], DataFrame]


def _keep(name: str, df: DataFrame) -> DataFrame:
    return df


def table_writer(root: str) -> TableWriter:
    """A writer that stores each table as Parquet under ``root``."""
    return lambda name, df: write_and_read(df, f"{root.rstrip('/')}/{name}")


def write_together(spark: SparkSession, tables: dict[str, DataFrame], write: TableWriter) -> dict[str, DataFrame]:
    """Writes independent tables at the same time.  The threads' jobs carry the
    caller's job group and pool, and one tag of their own: if a write fails,
    the others are cancelled and the failure is raised."""
    sc, tag = spark.sparkContext, f"write-{uuid.uuid4().hex[:12]}"

    def tagged(name: str) -> DataFrame:
        sc.addJobTag(tag)
        return write(name, tables[name])

    with ThreadPoolExecutor(max_workers=len(tables)) as pool:
        futures = {}
        for name in tables:
            # Properties are inherited where the target is made, once per table.
            futures[name] = pool.submit(inheritable_thread_target(spark)(tagged), name)
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        if any(f.exception() for f in done):
            sc.cancelJobsWithTag(tag)
    return {name: f.result() for name, f in futures.items()}


def exclusion_lists(inp: ScreenInputs, cfg: ScreenConfig, write: TableWriter = _keep) -> ExclusionLists:
    """The four lists of stage 1.  With a ``write``r each list is stored and
    read back: the null-aware anti join reads a list twice (keys and list
    statistics), and re-reading a stored list is cheap where recomputing
    the payroll list would rescan all transactions.  The four are
    independent, so their jobs are submitted together and share the
    cluster instead of queueing."""
    lists = {
        "payroll_accounts": payroll_accounts(inp.savings_txn, inp.customers),
        "flagged_accounts": flagged_accounts(inp.account_flags),
        "brokerage_accounts": brokerage_accounts(inp.brokerage_links, cfg),
        "excluded_customers": excluded_customers(inp.customers, cfg),
    }
    if write is not _keep:
        lists = write_together(inp.savings_txn.sparkSession, lists, write)
    payroll, flagged = lists["payroll_accounts"], lists["flagged_accounts"]
    brokerage, customers = lists["brokerage_accounts"], lists["excluded_customers"]
    return ExclusionLists(
        payroll=payroll,
        flagged=flagged,
        brokerage=brokerage,
        accounts=write("excluded_accounts", excluded_accounts(flagged, payroll, brokerage)),
        customers=customers,
    )


def candidates_stage(inp: ScreenInputs, cfg: ScreenConfig, snap_date: str,
                     write: TableWriter = _keep) -> DataFrame:
    ex = exclusion_lists(inp, cfg, write)
    return candidate_transactions(inp.savings_txn, ex.accounts, ex.customers, snap_date, cfg)


def cleaning_stage(inp: ScreenInputs, cfg: ScreenConfig, snap_date: str,
                   write: TableWriter = _keep) -> DataFrame:
    """Stage 1: the month's candidate transactions, cleaned.  The exchange
    rule reads the candidates twice (group statistics, then the anti join),
    so with a ``write``r they are stored once and scanned twice."""
    store = None if write is _keep else lambda groups: write("exchange_groups", groups)
    return clean(write("candidates", candidates_stage(inp, cfg, snap_date, write)), cfg, store)


def feature_stage(cleaned: DataFrame, inp: ScreenInputs, cfg: ScreenConfig, snap_date: str) -> DataFrame:
    """Stage 2: account-open date, registered transfers, label 0."""
    return enrich_accounts(
        cleaned, inp.account_snapshot, snap_date,
        registered=inp.registered if cfg.registered_keys else None,
        registered_keys=cfg.registered_keys, registered_columns=cfg.registered_columns, label=0,
    )


@dataclass(frozen=True)
class TrackingResult:
    span: DataFrame
    counts: DataFrame
    features: DataFrame


def tracking_stage(features: DataFrame, inp: ScreenInputs, cfg: ScreenConfig, snap_date: str,
                   span: DataFrame | None = None) -> TrackingResult:
    """Stage 3: spans, daily access counts, counts attached to features.
    Pass ``span`` to reuse a materialised span table."""
    span = span if span is not None else customer_activity_span(features)
    counts = access_counts(inp.mobile_log, inp.web_log, span, cfg, window_bounds(snap_date))
    return TrackingResult(span, counts, attach_access_counts(features, counts))


def screen(inp: ScreenInputs, cfg: ScreenConfig, snap_date: str, write: TableWriter) -> DataFrame:
    """All three stages, storing only what several steps read: the lists, the
    candidates and the features."""
    features = write("features", feature_stage(cleaning_stage(inp, cfg, snap_date, write), inp, cfg, snap_date))
    return tracking_stage(features, inp, cfg, snap_date).features


@dataclass(frozen=True)
class PipelineOutputs:
    """Stage tables of one run, each read back from its written files
    (``None`` for a table that neither this run nor a later stage needs)."""

    root: str
    payroll: DataFrame | None
    flagged: DataFrame | None
    brokerage: DataFrame | None
    excluded_customers: DataFrame | None
    candidates: DataFrame | None
    cleaned: DataFrame | None
    features: DataFrame | None
    span: DataFrame | None
    access_counts: DataFrame | None
    output: DataFrame | None


ALL_STAGES = (1, 2, 3)


def window_bounds(snap_date: str, months: int = 1) -> tuple[str, str]:
    """First and last day of the run's window, as ``yyyy-MM-dd`` text, with
    Spark's ``add_months`` rule: the day is kept, clamped to the target
    month's length (03-31 minus one month is 02-29; 02-29 gives 01-29)."""
    import calendar
    import datetime as dt

    end = dt.date.fromisoformat(snap_date)
    m0 = end.month - 1 - months
    y, m = end.year + m0 // 12, m0 % 12 + 1
    start = dt.date(y, m, min(end.day, calendar.monthrange(y, m)[1]))
    return start.isoformat(), end.isoformat()


def run_pipeline(
    spark: SparkSession, inp: ScreenInputs, cfg: ScreenConfig, snap_date: str,
    root: str | None = None, export_csv: bool = False, stages: tuple[int, ...] = ALL_STAGES,
) -> PipelineOutputs:
    """Run the stages of ``snap_date``, writing every hand-off table under
    ``root`` (default: a fresh folder in the shared checkpoint folder)
    partitioned by ``snap_date`` (``sources.days``: a day is published when it
    is whole, so a run that stops leaves the tables of the run before).

    * Stage 1: exclusion lists and candidate transactions.
    * Stage 2: cleaning and enrichment, one written ``features`` table (the
      enrichment only adds columns, so cleaned rows are not written twice).
    * Stage 3: activity span, access counts, final ``output``.

    ``stages`` reruns a subset, like the original three daily scripts; a
    skipped stage's tables are read from ``root`` for the same day.  With
    ``export_csv`` the final table is also written as CSV text
    (``yyyy-MM-dd`` dates, ``yyyy-MM-dd HH:mm:ss`` times) to
    ``export/features_<first day>_<last day>`` under the root.

    Every table is read back before its consumers run, so each stage's
    inputs are compact written tables, never a re-run of earlier joins."""
    stages = tuple(sorted(set(stages)))
    if not stages or not set(stages) <= set(ALL_STAGES):
        raise ValueError(f"stages must be a subset of {ALL_STAGES}")
    if stages != ALL_STAGES and root is None:
        raise ValueError("running part of the stages needs the root of the others")
    base = (root or run_root(spark, "pipeline")).rstrip("/")

    def w(name: str, df: DataFrame) -> DataFrame:
        return write_day(df, f"{base}/{name}", snap_date)

    def r(name: str) -> DataFrame:
        return read_day(spark, f"{base}/{name}", snap_date)

    ex = cands = features = span = counts = output = None
    if 1 in stages:
        ex = exclusion_lists(inp, cfg, w)
        # In the order of the original table, by ranges: an account's rows are in few files.
        cands = candidate_transactions(inp.savings_txn, ex.accounts, ex.customers, snap_date, cfg)
        cands = w("candidates", clustered(cands, CANDIDATE_ORDER))
    elif 2 in stages:
        cands = r("candidates")
    if 2 in stages:
        # Rows of an account sit together, in time order, inside each file.
        features = w("features", feature_stage(clean(cands, cfg, lambda g: w("exchange_groups", g)), inp, cfg, snap_date)
                     .sortWithinPartitions(*CANDIDATE_ORDER))
    elif 3 in stages:
        features = r("features")
    if 3 in stages:
        span = w("activity_span", customer_activity_span(features))
        counts = w("access_counts", access_counts(inp.mobile_log, inp.web_log, span, cfg, window_bounds(snap_date)))
        output = w("output", attach_access_counts(features, counts))
        if export_csv:
            first, last = window_bounds(snap_date)
            export_csv_text(output, f"{base}/export/features_{first}_{last}")
    cleaned = features.select(*cfg.txn_columns) if features is not None else None
    return PipelineOutputs(
        base,
        ex.payroll if ex else None, ex.flagged if ex else None,
        ex.brokerage if ex else None, ex.customers if ex else None,
        cands, cleaned, features, span, counts, output,
    )
