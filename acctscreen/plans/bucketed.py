"""The tracking stage over tables bucketed by customer.

Features and logs are stored in the same number of buckets of the customer,
so spans, the logs' semi join, the counts and their attachment need no
shuffle.  A bucket is read by one task and AQE cannot split it, so customers
with more rows than an even bucket are set apart: their rows are stored
unbucketed and take the usual way, whose joins can be split.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctscreen.config import ScreenConfig
from acctscreen.operators.access import access_counts, attach_access_counts, attach_colocated
from acctscreen.operators.activity import customer_activity_span
from acctscreen.plans.materialize import run_root, table_name, write_and_read
from acctscreen.sources.inputs import ScreenInputs


@dataclass(frozen=True)
class Keyed:
    """A table and its customer column."""

    table: DataFrame
    key: str


def busy_customers(tables: Mapping[str, Keyed], buckets: int) -> list[str]:
    """Customers with more rows in one of the tables than an even bucket of it
    has: fewer than ``buckets`` for each table, whatever its size."""
    busy: set[str] = set()
    for t in tables.values():
        per_customer = t.table.groupBy(F.col(t.key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        total = t.table.agg(F.count(F.lit(1)).alias("n")).scalar()
        over = per_customer.filter(F.col("k").isNotNull() & (F.col("n") * buckets > total))
        busy.update(r["k"] for r in over.select("k").collect())
    return sorted(busy)


def _apart(key: str, busy: list[str]) -> Column:
    """Rows of busy customers, and rows without one: they join nothing."""
    return F.col(key).isNull() | (F.col(key).isin(busy) if busy else F.lit(False))


@dataclass(frozen=True)
class Stored:
    """A table's rows in buckets of its key, and those set apart."""

    bucketed: DataFrame
    apart: DataFrame


def store_bucketed(tables: Mapping[str, Keyed], buckets: int) -> dict[str, Stored]:
    """Each table in ``buckets`` files of its key, sorted by it, and its busy
    rows as plain Parquet; the same customers are set apart in all tables."""
    busy = busy_customers(tables, buckets)
    out = {}
    for name, t in tables.items():
        spark, apart = t.table.sparkSession, _apart(t.key, busy)
        table = table_name(spark, name)
        # The bucket's own hash, so that each task writes one file for each of its buckets.
        t.table.filter(~apart).repartition(buckets, t.key).write.format("parquet").bucketBy(buckets, t.key).sortBy(t.key).saveAsTable(table)
        out[name] = Stored(spark.table(table), write_and_read(t.table.filter(apart), run_root(spark, f"{name}-apart")))
    return out


def tracking_bucketed(features: DataFrame, inp: ScreenInputs, cfg: ScreenConfig, window: tuple[str, str], buckets: int) -> DataFrame:
    """The tracking stage's final table, as ``pipeline.tracking_stage`` gives
    it.  ``features`` is read several times: pass a stored table."""
    first, last = (F.lit(d).cast("date") for d in window)
    at = F.col(cfg.log_day_column or "access_time")
    logs = {"mobile_log": inp.mobile_log, "web_log": inp.web_log}
    logs = {name: Keyed(log.filter((at >= first) & (at < F.date_add(last, 1))), "company_uid") for name, log in logs.items()}
    stored = store_bucketed({"features": Keyed(features, "cust_id"), **logs}, buckets)
    return track(stored["features"], stored["mobile_log"], stored["web_log"], cfg, window)


def track(features: Stored, mobile_log: Stored, web_log: Stored, cfg: ScreenConfig, window: tuple[str, str]) -> DataFrame:
    """The tracking stage over stored tables."""
    # The days of all customers' spans bound the logs' days.
    days = features.bucketed.select("cust_id", "tx_date").unionByName(features.apart.select("cust_id", "tx_date"))
    days = days.filter(F.col("cust_id").isNotNull()).select(F.col("tx_date").alias("min_date"), F.col("tx_date").alias("max_date"))
    span = customer_activity_span(features.bucketed, colocated=True)
    usual = attach_colocated(features.bucketed, mobile_log.bucketed, web_log.bucketed, span, cfg, window, days)
    busy = access_counts(mobile_log.apart, web_log.apart, customer_activity_span(features.apart), cfg, window, days)
    return usual.unionByName(attach_access_counts(features.apart, busy))
