"""Properties on the sf0.001 views: each cleaning step returns a subset of
its input, exchange removal is idempotent, counts are unique per
customer-day, and attaching counts keeps every feature row."""

from pyspark.sql import functions as F

from acctscreen.operators.access import access_counts, attach_access_counts
from acctscreen.operators.activity import customer_activity_span
from acctscreen.operators.cleansing import (
    filter_channel_memo,
    filter_currency,
    normalize_transactions,
    remove_exchanges,
)
from acctscreen.plans import pipeline
from acctscreen.sources import fixtures
from tests.conftest import SF001

CFG = fixtures.TEST_CONFIG


def _subset(small, big):
    return small.exceptAll(big.select(*small.columns)).count() == 0


def test_cleaning_properties(spark):
    t = fixtures.load(spark, SF001)
    norm = normalize_transactions(t.savings_txn, CFG)
    c8 = filter_channel_memo(norm, CFG)
    c9 = remove_exchanges(c8)
    c10 = filter_currency(c9, CFG.currency)
    assert _subset(c8, norm) and _subset(c9, c8) and _subset(c10, c9)
    assert c8.count() > c9.count() > c10.count() > 0
    assert remove_exchanges(c9).exceptAll(c9).count() == 0
    assert c9.exceptAll(remove_exchanges(c9)).count() == 0


def test_count_properties(spark):
    t = fixtures.load(spark, SF001)
    features = pipeline.feature_stage(pipeline.cleaning_stage(t, CFG, fixtures.SNAP_DATE), t, CFG,
                                      fixtures.SNAP_DATE)
    span = customer_activity_span(features)
    counts = access_counts(t.mobile_log, t.web_log, span, CFG)
    assert counts.count() == counts.select("company_uid", "access_date").distinct().count() == 51
    out = attach_access_counts(features, counts)
    assert out.count() == features.count() == 380
    assert out.filter(F.col("mb_limit").isNull() | F.col("mb_check").isNull()
                      | F.col("eb_check").isNull()).count() == 0
    # Each customer-day with counts lies inside the span's overall range.
    b = span.agg(F.min("min_date").cast("date").alias("lo"), F.max("max_date").cast("date").alias("hi")).first()
    assert counts.filter((F.col("access_date") < b.lo) | (F.col("access_date") > b.hi)).count() == 0
