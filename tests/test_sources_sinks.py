import datetime as dt

import pytest
from pyspark.sql import functions as F

from acctscreen.operators.enrich import enrich_accounts
from acctscreen.sources.days import read_day, read_days, write_day
from acctscreen.sources.readers import read_csv, read_table, snapshot, sql_file
from acctscreen.sources.writers import (
    as_text_columns,
    export_csv,
    overwrite_table,
    preview,
    refresh,
    write_files,
)
from tests.conftest import rows


def test_csv_with_schema_keeps_leading_zeros(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("acct,amt\n00000000000123,1.5\n", encoding="utf-8")
    df = read_csv(spark, str(p), "acct string, amt double")
    assert df.collect()[0].acct == "00000000000123"


def test_sql_file_with_named_parameters(spark, tmp_path):
    spark.createDataFrame([(1, dt.date(2024, 1, 30)), (2, dt.date(2024, 1, 31))],
                          "k int, d date").createOrReplaceTempView("snap_t")
    q = tmp_path / "q.sql"
    q.write_text("select k from IDENTIFIER(:tbl) where d = date_sub(:snap, 1)", encoding="utf-8")
    df = sql_file(spark, q, tbl="snap_t", snap=dt.date(2024, 1, 31))
    assert rows(df) == [(1,)]


def test_snapshot_and_enrich(spark):
    account_snapshot = spark.createDataFrame(
        [("a", dt.date(2020, 1, 1), dt.date(2024, 1, 30)), ("a", dt.date(1999, 1, 1), dt.date(2024, 1, 29))],
        "acct_no_14 string, acct_open_dt date, snap_date date",
    )
    assert rows(snapshot(account_snapshot, "2024-01-31", ["acct_no_14", "acct_open_dt"])) == [("a", dt.date(2020, 1, 1))]
    txn = spark.createDataFrame([("a", 1), ("b", 2)], "acct_nbr_ori string, n int")
    # Several rows per key, and a column named like the transaction's own.
    reg = spark.createDataFrame([("b", "T2", 9), ("b", "T1", 7), ("b", "T1", 8)], "acct string, kind string, n int")
    out = enrich_accounts(txn, account_snapshot, "2024-01-31", registered=reg,
                          registered_keys=(("acct_nbr_ori", "acct"),), registered_columns=("kind", "n"))
    assert out.columns == ["acct_nbr_ori", "n", "acct_open_dt", "reg_kind", "reg_n", "label"]
    assert rows(out) == [("a", 1, dt.date(2020, 1, 1), None, None, 0), ("b", 2, None, "T1", 7, 0)]
    # One right column in two key pairs.
    two = spark.createDataFrame([("a", "a", 1), ("a", "b", 2)], "acct_nbr_ori string, other string, n int")
    reg = spark.createDataFrame([("a", "x")], "acct string, kind string")
    out = enrich_accounts(two, account_snapshot, "2024-01-31", registered=reg,
                          registered_keys=(("acct_nbr_ori", "acct"), ("other", "acct")), registered_columns=("kind",))
    assert rows(out, "n", "reg_kind") == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        enrich_accounts(txn, account_snapshot, "2024-01-31", registered=reg)


def test_day_write_replaces_only_its_day(spark, tmp_path):
    path = str(tmp_path / "out")
    one = spark.createDataFrame([(1,)], "v int")
    write_day(one, path, "2024-01-01")
    write_day(one.withColumn("v", F.lit(2)), path, "2024-01-02")
    write_day(one.withColumn("v", F.lit(3)), path, "2024-01-02")
    assert rows(read_days(spark, path), "v") == [(1,), (3,)]
    assert rows(write_day(one.filter("v < 0"), path, "2024-01-02")) == []
    assert rows(read_day(spark, path, "2024-01-02")) == [] and rows(read_day(spark, path, "2024-01-01")) == [(1,)]


def test_table_overwrite_refresh_preview(spark):
    df = spark.range(5).withColumnRenamed("id", "v")
    overwrite_table(df, "acctscreen_t1", fmt="parquet")
    overwrite_table(df.filter("v < 3"), "acctscreen_t1", fmt="parquet")
    refresh(spark, "acctscreen_t1")
    assert read_table(spark, "acctscreen_t1").count() == 3
    assert preview(read_table(spark, "acctscreen_t1"), 2).count() == 2


def test_files_are_as_many_as_the_caller_asks_for(spark, tmp_path):
    write_files(spark.range(100), str(tmp_path / "one"), files=1)
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    write_files(spark.range(100, numPartitions=3), str(tmp_path / "all"))
    assert len(list((tmp_path / "all").glob("*.parquet"))) == 3


def test_csv_export_text_formats(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5), "00012")],
        "tx_date date, tx_time timestamp_ntz, acct string",
    )
    assert as_text_columns(df).collect()[0] == ("2024-01-02", "2024-01-02 03:04:05", "00012")
    export_csv(df, str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert "tx_date,tx_time,acct" in text and "2024-01-02,2024-01-02 03:04:05,00012" in text


def test_payroll_from_snapshot(spark):
    from acctscreen.operators.exclusions import payroll_from_snapshot

    account_snapshot = spark.createDataFrame([("a", "P1"), ("a", "P1"), ("b", "  "), ("c", None), ("d", " P2")],
                                 "acct_no_14 string, payroll_code string")
    assert rows(payroll_from_snapshot(account_snapshot)) == [("a", "P1"), ("d", " P2")]


def test_jdbc_partitioned_read_needs_bounds(spark):
    from acctscreen.sources.readers import read_jdbc

    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none://x", "select 1", partition_column="id", num_partitions=4)


def test_recommended_conf_sizes_partitions(spark):
    from acctscreen.plans.tuning import recommended_conf

    c = recommended_conf(10 * (1 << 40), total_cores=4000)   # a 10 TB shuffle
    assert int(c["spark.sql.shuffle.partitions"]) == 40960
    assert recommended_conf(1 << 20, total_cores=8)["spark.sql.shuffle.partitions"] == "24"


def test_apply_unset_keeps_launch_settings(spark):
    from acctscreen.plans.tuning import apply_unset

    # spark.sql.shuffle.partitions was given at launch (conftest): kept.
    launch = spark.conf.get("spark.sql.shuffle.partitions")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    prev = spark.conf.get(key)
    try:
        applied = apply_unset(spark, {"spark.sql.shuffle.partitions": "999", key: "128m"})
        assert "spark.sql.shuffle.partitions" not in applied
        assert spark.conf.get("spark.sql.shuffle.partitions") == launch
        assert applied == {key: "128m"} and spark.conf.get(key) == "128m"
    finally:
        spark.conf.set(key, prev)
