"""Daily online-banking lookup counts per customer, and their attachment to
the transaction features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctscreen.config import ACCESS_CATEGORIES, EB_CHECK, MB_CHECK, MB_LIMIT, ScreenConfig

EVENT_COLUMNS = ("company_uid", "login_log_key", "access_date", "category")


def _category(menu: Column, cases: list[tuple[tuple[str, ...], str]]) -> Column:
    out = None
    for menus, name in cases:
        out = (F.when if out is None else out.when)(menu.isin(list(menus)), F.lit(name))
    return out


def access_events(mobile_log: DataFrame, web_log: DataFrame, cfg: ScreenConfig,
                  span: DataFrame | None = None, window: tuple[str, str] | None = None,
                  days: DataFrame | None = None) -> DataFrame:
    """Lookups of interest from both logs, one row per log line:
    ``(company_uid, login_log_key, access_date, category)``.

    The mobile log counts toward ``mb_check``/``mb_limit``, the web log
    toward ``eb_check``; other menus are dropped.  ``access_date`` is the
    day of ``access_time``.  With ``span`` given, only customers of the span
    and days inside its overall ``[min_date, max_date]`` range are kept.  The
    range test reads ``cfg.log_day_column`` if one is named (often the logs'
    partition column; both must have it), else the day of ``access_time``.
    If ``span`` holds a part of the customers, ``days`` has the ``min_date``
    and ``max_date`` of all.

    ``window`` is the run's first and last day as literals.  The span lies
    inside it, so it changes no result, but as a range on the logs' own
    column it reaches the scan, where days and row groups are skipped."""
    parts = [_lookups(log, cases, cfg, window) for log, cases in _logs(mobile_log, web_log, cfg)]
    events = parts[0].unionByName(parts[1])
    if span is not None:
        events = _of_span(events, span, days)
    return events.drop("__day")


def _logs(mobile_log: DataFrame, web_log: DataFrame, cfg: ScreenConfig):
    """Each log with the menus that count and their categories."""
    return (
        (mobile_log, [(cfg.mb_check_menus, MB_CHECK), (cfg.mb_limit_menus, MB_LIMIT)]),
        (web_log, [(cfg.eb_check_menus, EB_CHECK)]),
    )


def _lookups(log: DataFrame, cases: list[tuple[tuple[str, ...], str]], cfg: ScreenConfig,
             window: tuple[str, str] | None) -> DataFrame:
    base = F.col(cfg.log_day_column or "access_time")
    wanted = F.col("menu_id").isin([m for ms, _ in cases for m in ms])
    if window is not None:
        first, last = (F.lit(d).cast("date") for d in window)
        wanted = wanted & (base >= first) & (base < F.date_add(last, 1))
    # Ahead of the select, where the name could also mean the alias made there.
    return log.withColumn("__day", F.to_date(base)).filter(wanted).select(
        "company_uid",
        "login_log_key",
        F.to_date(F.col("access_time")).alias("access_date"),
        _category(F.col("menu_id"), cases).alias("category"),
        "__day",
    )


def _of_span(events: DataFrame, span: DataFrame, days: DataFrame | None) -> DataFrame:
    # One aggregate gives both bounds and runs once.  Compared as days:
    # a first transaction at 10:00 still opens its whole day.
    b = (span if days is None else days).agg(
        F.struct(
            F.min("min_date").cast("date").alias("lo"),
            F.max("max_date").cast("date").alias("hi"),
        )
    ).scalar()
    ids = span.select(F.col("cust_id").alias("__uid"))
    return events.filter(F.col("__day").between(b["lo"], b["hi"])).join(
        ids, F.col("company_uid") == F.col("__uid"), "left_semi"
    )


def _distinct_logins(events: DataFrame) -> DataFrame:
    # DISTINCT on the full key including the login key: the shuffle is
    # hashed on all four columns, so one busy customer-day is spread over
    # many tasks, and each task pre-deduplicates before sending.
    return events.select(*EVENT_COLUMNS).distinct()


def _login_counts(categories: Sequence[str]) -> list[Column]:
    counted = F.col("login_log_key").isNotNull().cast("long")
    return [F.sum(F.when(F.col("category") == name, counted)).alias(name) for name in categories]


def access_counts_long(events: DataFrame) -> DataFrame:
    """Distinct logins per (customer, day, category) as ``times``."""
    return (
        _distinct_logins(events)
        .groupBy("company_uid", "access_date", "category")
        .agg(F.count("login_log_key").alias("times"))
    )


def access_counts(mobile_log: DataFrame, web_log: DataFrame, span: DataFrame, cfg: ScreenConfig,
                  window: tuple[str, str] | None = None, days: DataFrame | None = None) -> DataFrame:
    """Per known customer and day inside the span's range:
    ``(company_uid, access_date, mb_limit, mb_check, eb_check)``, each the
    number of distinct logins of that category, null when the customer had
    no lookup of that category that day.

    Distinct logins first, then one pivoting group-by that counts the
    three categories at once (no intermediate count table, no Expand).  It
    groups on a struct: counts that are joined without being stored reach the
    join by a shuffle of their own, and a busy customer-day can be split."""
    logins = _distinct_logins(access_events(mobile_log, web_log, cfg, span, window, days))
    per_day = logins.groupBy(F.struct("company_uid", "access_date").alias("__k")).agg(*_login_counts(ACCESS_CATEGORIES))
    return per_day.select("__k.*", *ACCESS_CATEGORIES)


def attach_access_counts(features: DataFrame, counts: DataFrame) -> DataFrame:
    """Left join the day's counts to each transaction (customer and
    ``tx_date`` against ``company_uid`` and ``access_date``); a missing
    count is 0.  Keeps the row count of ``features`` (counts are unique per
    customer-day)."""
    c = counts.select(
        F.col("company_uid").alias("__uid"),
        F.col("access_date").alias("__day"),
        *ACCESS_CATEGORIES,
    )
    joined = features.join(
        c,
        (F.col("cust_id") == F.col("__uid")) & (F.to_date(F.col("tx_date")) == F.col("__day")),
        "left",
    )
    return joined.fillna(0, subset=list(ACCESS_CATEGORIES)).drop("__uid", "__day")


def attach_colocated(features: DataFrame, mobile_log: DataFrame, web_log: DataFrame, span: DataFrame,
                     cfg: ScreenConfig, window: tuple[str, str] | None = None, days: DataFrame | None = None) -> DataFrame:
    """``attach_access_counts`` of ``access_counts`` for features, logs and
    ``span`` bucketed by customer alike, none with a large share of the rows:
    nothing is shuffled.

    The logs' categories are different ones, so each log is counted and joined
    by itself (a union would lose the buckets).  A customer's days, no more
    than the span has, go to a map, so that the join is by the customer alone."""
    out = features
    for log, cases in _logs(mobile_log, web_log, cfg):
        names = [name for _, name in cases]
        events = _of_span(_lookups(log, cases, cfg, window), span, days)
        logins = _distinct_logins(events.filter(F.col("access_date").isNotNull()))  # no transaction has a null day's counts
        per_day = logins.groupBy("company_uid", "access_date").agg(*_login_counts(names))
        entry = F.struct("access_date", F.struct(*names))
        by_customer = per_day.groupBy("company_uid").agg(F.map_from_entries(F.collect_list(entry)).alias("__days"))
        by_customer = by_customer.withColumnRenamed("company_uid", "__uid")
        out = out.join(by_customer, F.col("cust_id") == F.col("__uid"), "left")
        found = F.try_element_at("__days", F.to_date(F.col("tx_date")))
        out = out.withColumns({c: F.coalesce(found.getField(c), F.lit(0).cast("long")) for c in names}).drop("__uid", "__days")
    return out.select(*features.columns, *ACCESS_CATEGORIES)
