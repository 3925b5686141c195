"""Shared helpers: text as bytes, hashes, samples, numbering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from acctscreen.llm import common


def test_words_and_hashes_do_not_depend_on_their_place():
    texts = ["Ab  cd\n", None, "", "x\x85y é\x0bab", "cd ab", " "]
    data, offs = common.text_bytes(pa.array(texts).slice(0))
    low = common.fold_case(data)
    starts, ends, at = common.word_bounds(low, offs, common.SPACE)
    got = [[low[starts[k] : ends[k]].tobytes().decode() for k in range(at[i], at[i + 1])] for i in range(len(texts))]
    assert got == [["ab", "cd"], [], [], ["x\x85y", "é", "ab"], ["cd", "ab"], []]
    h = common.hash_spans(low, starts, ends)
    flat = [w for part in got for w in part]
    assert all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(h)) for j in range(len(h)))
    # A slice of a column has offsets that do not begin at 0.
    part, o = common.text_bytes(pa.array(["abc", "de", "f"]).slice(1))
    assert part.tobytes() == b"def" and o.tolist() == [0, 2, 3]
    assert common.fold_case(np.frombuffer("ÉÀ×ßß".encode(), np.uint8), latin=True).tobytes().decode() == "éà×ßß"


def test_chunks_cover_all_rows_and_long_rows_stand_alone():
    offs = np.array([0, 10, 20, 2_000_000, 2_000_010, 2_000_020])
    ranges = list(common.chunks(offs, 1000))
    assert ranges == [(0, 2), (2, 3), (3, 5)]
    assert list(common.chunks(np.zeros(1, np.int64))) == [] and list(common.chunks(np.zeros(4, np.int64))) == [(0, 3)]


def test_least_by_hash_is_a_repeatable_sample(spark):
    df = spark.range(5000).select(F.col("id").alias("a"))
    one = sorted(r[0] for r in common.least_by_hash(df, ["a"], 100).collect())
    two = sorted(r[0] for r in common.least_by_hash(df.repartition(7), ["a"], 100).collect())
    best = sorted(r[0] for r in df.orderBy(F.xxhash64("a"), "a").limit(100).collect())
    assert one == two == best
    assert common.least_by_hash(df.limit(0), ["a"], 100).count() == 0 and common.least_by_hash(df.limit(30), ["a"], 100).count() == 30


def test_numbering_follows_the_order(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("v"))
    out = common.numbered(df, F.col("v").desc(), "place", common.Scratch(spark, "t")).collect()
    values = [r["v"] for r in sorted(out, key=lambda r: r["place"])]
    assert values == sorted(values, reverse=True) and sorted(r["place"] for r in out) == list(range(3000))
