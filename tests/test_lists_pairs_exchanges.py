"""Lists looked up in bits first, payroll pairs kept up to date, and the
exchange rule without a sort."""

import random

import pytest
from pyspark.sql import functions as F

from acctscreen.operators.cleansing import RAW_EXCHANGE_KEYS, exchange_groups, filter_channel_memo, remove_exchanges, text_code
from acctscreen.operators.exclusions import exclude, exclude_listed, key_bits, payroll_accounts
from acctscreen.plans import pairs
from acctscreen.plans.materialize import store_list
from acctscreen.sources import fixtures
from tests.conftest import SF001, rows


def _nodes(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.executedPlan())
        return
    yield name, plan
    if name.endswith("QueryStageExec"):
        yield from _nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        yield from _nodes(children.apply(i))


def shuffled(df, least=0):
    """Rows that the shuffles of the executed plan wrote."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return sum(p.metrics().get("shuffleRecordsWritten").get().value() for n, p in _nodes(plan) if n == "ShuffleExchangeExec")


# -- lists ---------------------------------------------------------------------

@pytest.mark.parametrize("most_bits", [26, 3])
@pytest.mark.parametrize("null_aware", [True, False])
def test_listed_rows_are_those_of_the_plain_joins(spark, null_aware, most_bits):
    df = spark.createDataFrame([(f"a{i % 300}" if i % 11 else None, f"c{i % 70}", i) for i in range(2000)], "a string, c string, i int")
    lists = {
        "some": spark.createDataFrame([(f"a{i}",) for i in range(0, 300, 7)] * 2, "v string"),
        "null": spark.createDataFrame([("a1",), (None,)], "v string"),
        "empty": spark.createDataFrame([], "v string"),
        "only null": spark.createDataFrame([(None,)], "v string"),
    }
    other = spark.createDataFrame([(f"c{i}",) for i in range(0, 70, 5)], "w string")
    for name, ex in lists.items():
        want = exclude(df, ex, "a", "v", null_aware)
        assert rows(exclude_listed(df, [(ex, "a", "v")], null_aware, most_bits)) == rows(want)
        if name == "some":
            want = exclude(want, other, "c", "w", null_aware)
            assert rows(exclude_listed(df, [(ex, "a", "v"), (other, "c", "w")], null_aware, most_bits)) == rows(want)
    assert rows(exclude_listed(df, [], null_aware)) == rows(df)


def test_keys_of_another_type_are_hashed_alike(spark):
    df = spark.range(100).select(F.col("id").alias("k"))
    ex = spark.createDataFrame([(5,), (7,)], "v int")
    assert rows(exclude_listed(df, [(ex, "k", "v")])) == rows(exclude(df, ex, "k", "v"))


def test_rows_on_no_list_are_not_shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(20_000).select(F.concat(F.lit("a"), F.col("id") % 5000).alias("a"), "id")
        ex = store_list(spark.range(0, 5000, 100).select(F.concat(F.lit("a"), F.col("id")).alias("v")))
        plain, listed = exclude(df, ex, "a", "v"), exclude_listed(df, [(ex, "a", "v")])
        assert rows(plain) == rows(listed)
        assert shuffled(plain) > 20_000 and shuffled(listed) < 2_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_table_of_bits_is_bounded(spark):
    keys = spark.range(100_000).select("id")
    table = key_bits(keys, 16)
    assert table.count() == 2 ** 10 and table.filter("__word < 0 or __word >= 1024").count() == 0


# -- pairs ---------------------------------------------------------------------

TXN = "acct_nbr_ori string, cust_id string, tx_date string"


def test_a_second_day_reads_one_partition_and_equals_the_full_scan(spark, tmp_path):
    path, read = str(tmp_path / "pairs"), []
    cust = spark.createDataFrame([("c1", "Y"), ("c2", "N"), ("c3", "Y")], "cust_id string, flg_pr string")
    days = {
        "2024-01-01": [("a1", "c1", "2024-01-01"), ("a1", "c1", "2024-01-01"), ("a2", "c2", "2024-01-01")],
        # Late postings: dated before, and an account without a number.
        "2024-01-02": [("a9", "c3", "2023-12-24"), ("a1", "c1", "2024-01-02"), (None, "c3", "2024-01-02"), ("a4", None, "2024-01-02")],
    }
    frames = {d: spark.createDataFrame(x, TXN) for d, x in days.items()}

    def load(d):
        return lambda: read.append(d) or frames[d]

    parts = {d: load(d) for d in days}
    assert pairs.update_pairs(spark, path, {"2024-01-01": parts["2024-01-01"]}) == ["2024-01-01"]
    assert pairs.update_pairs(spark, path, parts) == ["2024-01-02"] and read == ["2024-01-01", "2024-01-02"]
    assert pairs.update_pairs(spark, path, parts) == [] and len(read) == 2
    whole = frames["2024-01-01"].unionByName(frames["2024-01-02"])
    want = rows(payroll_accounts(whole, cust))
    assert rows(pairs.payroll_of_stored_pairs(spark, path, cust)) == want
    assert ("a9", "Y") in want and (None, "Y") in want
    # A partition that is loaded anew replaces its own pairs and no others.
    pairs.ingest(frames["2024-01-02"].filter("acct_nbr_ori = 'a9'"), path, "2024-01-02")
    assert rows(pairs.pairs(spark, path)) == [("a1", "c1"), ("a2", "c2"), ("a9", "c3")]
    assert pairs.ingested(spark, path) == ["2024-01-01", "2024-01-02"]


# -- exchanges -----------------------------------------------------------------

def _bookings(spark, seed, n=600):
    r = random.Random(seed)
    texts = ["TWD", "USD", None, "", "a currency", "a currency of eight bytes", "\u6e2f\u5e63\u6e2f\u5e63", "seven77", "eight888"]
    data = [(f"a{r.randrange(9)}", "2024-01-01", r.randrange(3), r.randrange(4) or None, r.choice(texts), r.choice(["1", "2", None, "debit and more", "credit and more"])) for _ in range(n)]
    return spark.createDataFrame(data, "acct_nbr_ori string, tx_date string, tx_time int, jrnl_no int, cur string, drcr string")


def _brute(df):
    groups = {}
    for r in df.collect():
        key = tuple(r[k] for k in RAW_EXCHANGE_KEYS)
        if None not in key:
            groups.setdefault(key, []).append((r["cur"], r["drcr"]))
    return sorted(((*k, len(v)) for k, v in groups.items() if len({x for x, _ in v}) > 1 and len({x for _, x in v}) > 1), key=str)


@pytest.mark.parametrize("store", [None, store_list])
def test_groups_equal_brute_force_whatever_collides(spark, store):
    df = _bookings(spark, 1)
    want = _brute(df)

    def got(code):
        return sorted(map(tuple, exchange_groups(df, RAW_EXCHANGE_KEYS, store, code).collect()), key=str)

    assert want and got(text_code) == want
    # All texts collide; all of a length do; the least of them seem sure.
    assert got(lambda c: (F.lit(0).cast("long"), F.lit(False))) == want
    assert got(lambda c: (F.length(c).cast("long"), F.lit(False))) == want


def test_two_long_texts_that_collide_are_told_apart(spark):
    df = spark.createDataFrame([("a", "d", 1, 1, "currency one", "1"), ("a", "d", 1, 1, "currency two", "2"),
                                ("b", "d", 1, 1, "currency one", "1"), ("b", "d", 1, 1, "currency one", "2")],
                               "acct_nbr_ori string, tx_date string, tx_time int, jrnl_no int, cur string, drcr string")
    same = lambda c: (F.when(F.length(c) > 7, -1).otherwise(text_code(c)[0]), F.length(c) <= 7)
    assert [r["acct_nbr_ori"] for r in exchange_groups(df, RAW_EXCHANGE_KEYS, store_list, same).collect()] == ["a"]
    assert rows(remove_exchanges(df, RAW_EXCHANGE_KEYS, store_list), "acct_nbr_ori") == [("b",), ("b",)]


def test_codes_of_short_texts_are_their_own(spark):
    r = random.Random(3)
    texts = {"".join(r.choice("ab\x00\x01\xe9 ") for _ in range(r.randrange(0, 9))) for _ in range(3000)} | {"TWD", "\x00", "\x00\x00", ""}
    code, own = text_code(F.col("t"))
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", code.alias("c"), own.alias("own")).collect()
    short = [x for x in got if x["own"]]
    assert {x["own"] for x in got if len(x["t"].encode()) > 7} == {False} and all(x["c"] < 0 for x in got if not x["own"])
    assert len({x["c"] for x in short}) == len(short) and all(x["c"] >= 0 for x in short)


def test_no_sort_over_all_rows(spark):
    t = fixtures.load(spark, SF001)
    stored = []

    def store(df):
        df.collect()
        stored.append(df._jdf.queryExecution().executedPlan().toString())
        return store_list(df)

    memo = filter_channel_memo(t.savings_txn, fixtures.TEST_CONFIG)
    groups = exchange_groups(memo, RAW_EXCHANGE_KEYS, store)
    assert "SortAggregate" not in stored[0] and "HashAggregate" in stored[0]
    # Codes of three letters leave nothing open: there is no second look.
    assert "SortAggregate" not in groups._jdf.queryExecution().executedPlan().toString()
