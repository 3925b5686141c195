"""CSV that keeps its values, days that are published whole, rows set aside,
and range-clustered files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from acctscreen.operators.cleansing import CONVERTED, normalize_checked, normalize_transactions
from acctscreen.operators.joins import Lookup, lookup
from acctscreen.sources import days, fixtures
from acctscreen.sources.days import published_days, read_day, read_days, vacuum_day, write_day
from acctscreen.sources.quarantine import set_aside
from acctscreen.sources.readers import CSV_NULL, read_csv, read_csv_checked
from acctscreen.sources.writers import clustered, export_csv
from tests.conftest import SF001, rows

AWKWARD = [
    (1, " lead and trail ", "a"), (2, "", "b"), (3, "two\nlines", None), (4, 'quo"te,\\ back\\', "c\r\nd"), (5, None, "\re\r"),
    (6, "\\N", "#x"), (7, '"', "\t"), (8, 'a\\"b', "\ufeffbom"), (None, "  ", "x\n"), (9, "\n", "\u2028z"), (10, "\\", "null"),
    (11, '""', "'"), (12, ",", "NULL"), (None, None, None), (13, "\x00", "é"),
]


def test_csv_gives_every_value_back(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "id long, remk string, memo string").repartition(3)
    export_csv(df, str(tmp_path / "t"))
    assert rows(read_csv(spark, str(tmp_path / "t"), df.schema)) == rows(df)
    one = df.select("remk")
    export_csv(one, str(tmp_path / "one"))
    assert rows(read_csv(spark, str(tmp_path / "one"), one.schema)) == rows(one)
    flat = df.filter("id in (1, 2, 7, 11, 12)")
    export_csv(flat, str(tmp_path / "flat"))
    assert rows(read_csv(spark, str(tmp_path / "flat"), df.schema, multi_line=False)) == rows(flat)


def test_csv_text_that_stands_for_null_cannot_be_written(spark, tmp_path):
    with pytest.raises(Exception, match="stands for null"):
        export_csv(spark.createDataFrame([(CSV_NULL, 1)], "a string, b int"), str(tmp_path / "t"))


@pytest.mark.parametrize("schema", ["remk string, id long, memo string", "id long, remk string", "id long, remk string, memo string, more string", "id long, memo string, remk string"])
def test_csv_header_must_be_that_of_the_schema(spark, tmp_path, schema):
    export_csv(spark.createDataFrame(AWKWARD, "id long, remk string, memo string"), str(tmp_path / "t"))
    df = read_csv(spark, str(tmp_path / "t"), schema)
    with pytest.raises(Exception, match="CSV header"):
        df.collect()
    with pytest.raises(Exception, match="CSV header"):
        df.count()


@pytest.mark.parametrize("line", ["x,1.5", "2,abc", "2", "2,1.5,7"])
def test_csv_record_that_does_not_fit_stops_the_job(spark, tmp_path, line):
    p = tmp_path / "t.csv"
    p.write_text(f"id,amt\n1,2.5\n{line}\n", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, str(p), "id long, amt double").collect()


def test_csv_records_that_do_not_fit_are_set_aside(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('id,amt,remk\n1,2.5,"a\nb"\nx,1,c\n2,abc,d\n3,,""\n4\n', encoding="utf-8")
    got = read_csv_checked(spark, str(p), "id long, amt double, remk string", str(tmp_path / "out"))
    assert rows(got.good) == [(1, 2.5, "a\nb"), (3, None, "")]
    assert (got.n_good, got.n_rejected) == (2, 3)
    assert sorted(r["record"].strip() for r in got.rejected.collect()) == ["2,abc,d", "4", "x,1,c"]
    with pytest.raises(ValueError, match="3 of 5"):
        got.or_fail(0.5)
    assert got.or_fail(0.6).count() == 2


def test_rows_that_do_not_convert_are_set_aside_with_their_reasons(spark, tmp_path):
    txn = fixtures.with_bad_text(fixtures.load(spark, SF001).savings_txn)
    cfg = fixtures.TEST_CONFIG
    got = normalize_checked(txn, cfg, str(tmp_path / "a"))
    mode = txn.filter(F.col("tx_mode") == cfg.tx_mode)
    assert got.n_good + got.n_rejected == mode.count() == got.good.count() + got.rejected.count()
    assert got.n_rejected == got.rejected.count() > 0
    # The good rows are what the strict form gives for them; the rejected ones are as they came.
    whole = mode.filter(F.coalesce(*[F.when(F.col("jrnl_no") % m == 0, 1) for _, m, _ in fixtures.BAD_TEXT]).isNull())
    assert rows(got.good) == rows(normalize_transactions(whole, cfg))
    assert rows(got.rejected.select(*txn.columns)) == rows(mode.exceptAll(whole))
    reasons = {x.split("=")[0] for r in got.rejected.select("reasons").collect() for x in r["reasons"]}
    assert reasons <= set(CONVERTED) and len(reasons) > 2
    # All good, all bad, and none at all.
    assert normalize_checked(whole, cfg, str(tmp_path / "b")).rejected.count() == 0
    bad = normalize_checked(mode.withColumn("drcr", F.lit("?")), cfg, str(tmp_path / "c"))
    assert bad.good.count() == 0 and bad.n_rejected == mode.count()
    none = normalize_checked(txn.filter("false"), cfg, str(tmp_path / "d"))
    assert (none.n_good, none.n_rejected, none.good.count(), none.rejected.count()) == (0, 0, 0, 0)


def test_set_aside_reads_its_input_once_and_restores_the_session(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    df = spark.range(100).mapInArrow(touch, "id long")
    got = set_aside(df, F.when(F.col("id") % 10 == 0, F.array(F.lit("ten"))), {"id": F.col("id")}, {"id": F.col("id")}, str(tmp_path / "x"))
    assert (got.n_good, got.n_rejected, seen.value) == (90, 10, 100) and spark.conf.get(key) == before
    assert rows(got.rejected, "id") == [(k,) for k in sorted(range(0, 100, 10), key=str)]


def test_a_run_that_stops_half_way_leaves_the_day_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_day(spark.range(10), path, "2024-01-31")
    broken = spark.range(0, 100, numPartitions=4).withColumn("id", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        write_day(broken, path, "2024-01-31")
    assert read_day(spark, path, "2024-01-31").count() == 10
    # Written, but stopped before it is published.
    with monkeypatch.context() as m:
        m.setattr(days, "publish_day", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            write_day(spark.range(20), path, "2024-01-31")
    assert read_day(spark, path, "2024-01-31").count() == 10 == read_days(spark, path).count()
    assert len(vacuum_day(spark, path, "2024-01-31")) == 2
    assert write_day(spark.range(30), path, "2024-01-31").count() == 30
    assert read_days(spark, path).columns == ["id", "snap_date"] and read_days(spark, path).count() == 30
    assert vacuum_day(spark, path, "2024-01-31") == []


def test_a_first_run_that_stops_leaves_no_day(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="lost"):
        write_day(spark.range(5).withColumn("id", F.raise_error(F.lit("lost"))), path, "2024-01-31")
    with pytest.raises(FileNotFoundError):
        read_day(spark, path, "2024-01-31")
    with pytest.raises(FileNotFoundError):
        read_days(spark, path)


def test_the_run_before_stays_for_readers_at_work(spark, tmp_path):
    path = str(tmp_path / "t")
    old = write_day(spark.range(3), path, "2024-01-30")
    write_day(spark.range(4), path, "2024-01-30")
    assert old.count() == 3
    for n in (5, 6, 7):
        write_day(spark.range(n), path, "2024-01-30")
    assert len([x for x in os.listdir(tmp_path / "t" / "snap_date=2024-01-30") if x.startswith("run=")]) == days.KEEP
    write_day(spark.range(1), path, "2024-01-31")
    assert published_days(spark, path) == ["2024-01-30", "2024-01-31"]
    got = read_days(spark, path).groupBy("snap_date").count()
    assert rows(got) == [(dt.date(2024, 1, 30), 7), (dt.date(2024, 1, 31), 1)]
    assert read_days(spark, path, ["2024-01-31"]).count() == 1


def test_clustered_files_are_skipped_by_a_read_of_one_account(spark, tmp_path):
    import pyarrow.parquet as pq

    n = 6000
    txn = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("A"), F.lpad((F.col("id") % 400).cast("string"), 4, "0"))).alias("acct_nbr_ori"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 28).cast("int")).alias("tx_date"),
        (F.xxhash64("id") % 86400).alias("tx_time"), F.col("id").alias("jrnl_no"))
    path = tmp_path / "t"
    clustered(txn, ("acct_nbr_ori", "tx_date", "tx_time"), files=8).write.parquet(str(path))
    ranges = []
    for f in sorted(path.glob("*.parquet")):
        stats = pq.ParquetFile(f).metadata.row_group(0).column(0).statistics
        ranges.append((stats.min, stats.max))
    assert len(ranges) >= 6

    def files(account):
        return sum(lo <= account <= hi for lo, hi in ranges)

    assert files("A0007") <= 2 and files("A0222") <= 2
    assert files("HOT") >= 2  # a third of the rows is not one file
    back = spark.read.parquet(str(path))
    assert rows(back) == rows(txn)
    plan = back.filter("acct_nbr_ori = 'A0007'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(acct_nbr_ori,A0007)" in plan


def test_lookup_keeps_rows_once_and_nulls_apart(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("a", 4)], "k string, v int")
    table = spark.createDataFrame([("a", 9, "x"), ("a", 7, "y"), (None, 1, "z"), ("c", 2, "w")], "key string, n int, v string")
    got = lookup(left, Lookup(table, (("k", "key"),), ("n", "v"), prefix="t_"))
    assert got.columns == ["k", "v", "t_n", "t_v"]
    want = [("a", 1, 7, "y"), ("a", 4, 7, "y"), ("b", 2, None, None), (None, 3, None, None)]
    assert rows(got) == want
    # By the same column, by another, and by two columns; keys of other names and types of row.
    more = Lookup(spark.createDataFrame([("b", 1.5), ("a", None)], "id string, x double"), (("k", "id"),), ("x",))
    other = Lookup(spark.createDataFrame([(4, "four")], "no int, word string"), (("v", "no"),), ("word",))
    both = Lookup(spark.createDataFrame([("b", 2, True)], "k string, v int, hit boolean"), (("k", "k"), ("v", "v")), ("hit",), prefix="b_")
    got = lookup(left, Lookup(table, (("k", "key"),), ("n", "v"), prefix="t_"), more, other, both)
    assert got.columns == ["k", "v", "t_n", "t_v", "x", "word", "b_hit"]
    assert rows(got) == [("a", 1, 7, "y", None, None, None), ("a", 4, 7, "y", None, "four", None), ("b", 2, None, None, 1.5, None, True), (None, 3, None, None, None, None, None)]
