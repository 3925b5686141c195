"""One account holding a third of all rows: AQE splits the skewed join
partition, results stay exact."""

import datetime as dt
import hashlib

import pytest

from acctscreen.operators.access import attach_access_counts
from acctscreen.operators.cleansing import remove_exchanges
from acctscreen.operators.exclusions import exclude
from tests.conftest import rows

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def skewed_txn(spark, n=3000):
    # A third of the rows are one booking group of one account (same second,
    # same journal): a hot key for every join and group-by on it.
    data = []
    for i in range(n):
        hot = i % 3 == 0
        acct = "HOT" if hot else f"A{i % 200:03d}"
        t = 0 if hot else i // 2
        cur = "USD" if i % 50 == 0 else "TWD"
        drcr = "2" if i % 50 == 0 else "1"
        day = dt.date(2024, 1, 1) if hot else dt.date(2024, 1, 1 + i % 28)
        # note: varied text, as real rows carry, so the hot partition stays
        # large after shuffle compression (AQE measures compressed bytes).
        note = hashlib.sha256(str(i).encode()).hexdigest()
        data.append((acct, "HOTCUST" if hot else f"C{i % 97}", t, t, drcr, cur, day, note))
    return spark.createDataFrame(
        data, "acct_nbr_ori string, cust_id string, tx_time long, jrnl_no long, drcr string, "
              "cur string, tx_date date, note string")


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_skewed_anti_joins_are_split_and_exact(spark, skew_conf):
    txn = skewed_txn(spark)
    kept = remove_exchanges(txn)
    plan = _final_plan(kept)
    assert "skew=true" in plan
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    assert rows(kept) == rows(remove_exchanges(txn))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # The hot group mixes TWD/USD and debit/credit: it is an exchange.
    assert kept.filter("acct_nbr_ori = 'HOT'").count() == 0

    ex = spark.createDataFrame([(f"A{i:03d}",) for i in range(0, 200, 7)], "v string")
    out = exclude(txn, ex, "acct_nbr_ori", "v")
    assert "skew=true" in _final_plan(out)
    assert out.filter("acct_nbr_ori = 'HOT'").count() == 1000
    assert out.count() == txn.count() - txn.join(ex, txn.acct_nbr_ori == ex.v, "left_semi").count()


def test_skewed_attach_keeps_every_row(spark, skew_conf):
    txn = skewed_txn(spark)
    counts = spark.createDataFrame(
        [(c, dt.date(2024, 1, d), d, None, 1) for d in range(1, 29) for c in ["HOTCUST", "C1", "C2"]],
        "company_uid string, access_date date, mb_limit long, mb_check long, eb_check long")
    out = attach_access_counts(txn, counts)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 3000
    assert out.filter("cust_id = 'HOTCUST' and mb_limit = 1 and eb_check = 1").count() == 1000


def test_range_write_order_spreads_a_hot_account(spark, skew_conf):
    from pyspark.sql import functions as F

    from acctscreen.operators.candidates import ordered

    # The hot account's rows, each at its own second.
    hot = (skewed_txn(spark).filter("acct_nbr_ori = 'HOT'")
           .withColumn("tx_time", F.conv(F.substring("note", 1, 8), 16, 10).cast("long")))
    out = ordered(hot)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1 and max(sizes) < 1000


def test_span_splits_a_customer_with_a_third_of_the_accounts(spark, skew_conf):
    from pyspark.sql import functions as F

    from acctscreen.operators.activity import customer_activity_span

    # Every row an account of its own: a third of the pairs are one customer's.
    txn = skewed_txn(spark).withColumn("acct_nbr_ori", F.substring("note", 1, 20)).withColumn(
        "tx_date", F.when(F.col("note").startswith("0"), F.lit("2024-01-09").cast("date")).otherwise(F.col("tx_date")))
    out = customer_activity_span(txn)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 3000
    hot = out.filter("cust_id = 'HOTCUST'").select("max_date", "min_date").distinct().collect()
    assert out.filter("cust_id = 'HOTCUST'").count() == 1000
    assert [tuple(r) for r in hot] == [(dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 1))]


def _largest_task(df) -> int:
    from pyspark.sql import functions as F

    n = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"))
    return max(r["n"] for r in n.collect())


def test_enrichment_splits_a_hot_account(spark, skew_conf):
    from acctscreen.operators.enrich import enrich_accounts

    txn = skewed_txn(spark).drop("drcr")
    accounts = ["HOT"] + [f"A{i:03d}" for i in range(200)]
    snap = spark.createDataFrame([(a, dt.date(2020, 1, 1 + i % 9), dt.date(2024, 1, 30)) for i, a in enumerate(accounts) for _ in range(2)],
                                 "acct_no_14 string, acct_open_dt date, snap_date date")
    out = enrich_accounts(txn, snap, "2024-01-31")
    assert "skew=true" in _final_plan(out)
    assert out.count() == 3000 and out.filter("acct_nbr_ori = 'HOT' and acct_open_dt = date '2020-01-01'").count() == 1000

    reg = spark.createDataFrame([(a, f"T{k}", k) for a in accounts for k in range(3)], "acct string, kind string, n int")
    both = enrich_accounts(txn, snap, "2024-01-31", registered=reg, registered_keys=(("acct_nbr_ori", "acct"),), registered_columns=("kind", "n"))
    assert "skew=true" in _final_plan(both)
    assert both.count() == 3000 and both.filter("reg_kind = 'T0' and reg_n = 0 and acct_open_dt is not null").count() == 3000
    assert _largest_task(both) < 1000


def test_attach_of_counts_that_are_not_stored_splits_a_hot_day(spark, skew_conf):
    from acctscreen.config import ScreenConfig
    from acctscreen.operators.access import access_counts
    from acctscreen.operators.activity import customer_activity_span

    txn = skewed_txn(spark)
    log = spark.createDataFrame([(c, k, dt.datetime(2024, 1, 1 + k % 28, 9), "MDS01") for c in ["HOTCUST", "C1", "C2"] for k in range(60)],
                                "company_uid string, login_log_key long, access_time timestamp_ntz, menu_id string")
    counts = access_counts(log, log.filter("false"), customer_activity_span(txn), ScreenConfig())
    out = attach_access_counts(txn, counts)
    assert "skew=true" in _final_plan(out)
    assert out.count() == 3000 and out.filter("cust_id = 'HOTCUST' and mb_check = 3").count() == 1000
