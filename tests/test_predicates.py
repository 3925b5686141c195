import datetime as dt

from pyspark.sql import functions as F

from acctscreen.functions import (
    differs_with_null,
    in_date_window,
    is_individual_id,
    isin_keep_null,
    teller_code_ok,
)
from tests.conftest import rows


def test_is_individual_id(spark):
    df = spark.createDataFrame(
        [("A123456789",), ("a123456789",), ("1234567890",), ("A12345678",), ("AB12345678",), (None,)],
        "id string",
    )
    got = [r[0] for r in df.filter(is_individual_id("id")).collect()]
    assert sorted(got) == ["A123456789", "AB12345678", "a123456789"]


def test_isin_keep_null_keeps_null_and_drops_listed(spark):
    df = spark.createDataFrame([("R1",), ("R3",), (None,)], "remk string")
    got = rows(df.filter(isin_keep_null("remk", ["R1", "R2"])))
    assert got == [("R3",), (None,)]
    # Plain negation drops the null row: the trap the helper avoids.
    assert rows(df.filter(~F.col("remk").isin("R1", "R2"))) == [("R3",)]


def test_teller_code(spark):
    df = spark.createDataFrame(
        [("EMP4001",), ("EMP4215",), ("EMP3999",), ("EMP4999",), ("EM",), (None,)], "e string"
    )
    got = sorted(r[0] for r in df.filter(teller_code_ok("e", ["4001", "4215"], "3")).collect())
    assert got == ["EMP3999", "EMP4001", "EMP4215"]


def test_date_window_month_ends(spark):
    # add_months keeps the end of month: 03-31 -> 02-29, 02-29 -> 01-29.
    days = [dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 31), dt.date(2024, 1, 28),
            dt.date(2024, 1, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = sorted(r[0] for r in df.filter(in_date_window("d", "2024-03-31")).collect())
    assert got == [dt.date(2024, 2, 29), dt.date(2024, 3, 31)]
    got = sorted(r[0] for r in df.filter(in_date_window("d", "2024-02-29")).collect())
    assert got == [dt.date(2024, 1, 29), dt.date(2024, 2, 28), dt.date(2024, 2, 29)]


def test_differs_with_null_counts_null_as_value(spark):
    df = spark.createDataFrame(
        [("a", "TWD"), ("a", "TWD"), ("b", "TWD"), ("b", None), ("c", "TWD"), ("c", "USD"),
         ("d", None), ("d", None)],
        "g string, cur string",
    )
    got = rows(df.groupBy("g").agg(differs_with_null("cur").alias("m")))
    assert got == [("a", False), ("b", True), ("c", True), ("d", False)]
