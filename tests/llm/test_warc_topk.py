"""WARC round trips and exact search."""

from __future__ import annotations

import base64
import hashlib
import io
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctscreen.llm import op7_warc as warc
from acctscreen.llm import op10_topk as topk
from acctscreen.llm.common import Scratch
from tests.llm.conftest import SF

PAGES = "page_id long, url string, html string, _digest string, bytes long"


def expected(pages):
    last = {}
    n = Counter(h or "" for _, _, h in pages)
    for i, _, h in pages:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    out = []
    for i, _, h in pages:
        data = (h or "").encode()
        top = last.get(h or "")
        revisit = n[h or ""] > 1 and top is not None and i != top
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=repr)


def test_round_trip_of_edge_pages(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("<p>aé\n") for _ in range(900_000))
    rows = [(1, "http://a/\r\nX: y", "same", "d", 1), (2, None, "same", None, None), (2, "http://b", "same", "d", 1), (3, "u", None, None, None),
            (4, "", "", "d", 1), (5, "u", long, "d", 1), (None, "u", "same", "d", 1), (6, "u", "WARC/1.1\r\n\r\n\x1f\u008b\x08", "d", 1)]
    df = spark.createDataFrame(rows, PAGES)
    got = sorted((tuple(r) for r in warc.archive_pages(df).collect()), key=repr)
    assert got == expected([r[:3] for r in rows])
    assert warc.archive_pages(df.limit(0)).count() == 0


def test_any_range_size_gives_each_record_once(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    scratch = Scratch(spark, "warc-test")
    listed = warc.write_warc(pages.repartition(3), scratch.root)
    want = sorted((r["page_id"], r["html"]) for r in pages.collect())
    assert listed.count() == 3
    for size in (1000, 65_536, 1 << 30):
        rows = warc.read_warc(spark, listed, scratch.root, size).collect()
        assert sorted((r["page_id"], r["payload"]) for r in rows if r["record_type"] == "response") == want


def test_false_magic_inside_members_is_no_record():
    nested = warc.record(99, "u", b"inner")
    payload = b"\x1f\x8b\x08" * 500 + zlib.compress(b"x")
    data = b"".join(warc.record(i, "u", payload + bytes([i])) for i in range(6)) + warc.record(7, "u", nested[:10])
    cuts = list(range(0, len(data) + 97, 97))
    ids = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        ids += [f["warc-record-id"] for f, _ in warc.records_in(warc._Bytes(io.BytesIO(data), len(data)), a, min(b, len(data)))]
    assert ids == [f"<{warc.PAGE}{i}>" for i in (0, 1, 2, 3, 4, 5, 7)]


# -- search ----------------------------------------------------------------------

def brute(rows, every=20, k=20):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, [math.floor(64 * x) for x in v]) for i, v in rows]
    out = []
    for i, q in whole:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


SCHEMA = "vec_id long, embedding array<float>, score long, q int"


def test_search_equals_brute_force_with_ties_and_bad_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    base = [[float(np.float32(x)) for x in rng.normal(0, 0.2, 12)] for _ in range(40)]
    rows = [(i, base[i % 40] if i % 3 else base[0]) for i in range(400)]
    rows += [(400, None), (420, [None] * 12), (440, [float("nan")] * 12), (460, [float("inf")] + [0.0] * 11), (None, base[0]), (20, base[20]), (480, base[1][:5])]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], SCHEMA)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 8)
    monkeypatch.setattr(topk, "ROW_BLOCK", 120)
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == brute(rows)
    few = df.filter("vec_id in (0, 1, 2, 20)")
    assert sorted(tuple(r) for r in topk.top_k(few).collect()) == brute([r for r in rows if r[0] in (0, 1, 2, 20)])
    assert topk.top_k(df.limit(0)).count() == 0


def test_bounds_hold_and_get_tighter():
    rng = np.random.default_rng(4)
    q, x = np.floor(64 * rng.normal(0, 0.3, (30, 64))), np.floor(64 * rng.normal(0.1, 0.3, (50, 64)))
    before = None
    for n in topk.LEVELS:
        bound = topk.statistics(q, n) @ topk.statistics(x, n).T
        assert (bound >= q @ x.T - 1e-6).all()
        assert before is None or (bound <= before + 1e-6).all()
        before = bound


class _Counted:
    """An archive in memory that counts the bytes that are read from it."""

    def __init__(self, data: bytes):
        self.data, self.at, self.n = data, 0, 0

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        self.at += len(out)
        self.n += len(out)
        return out


@pytest.mark.parametrize("block", [1 << 10, 1 << 16, 1 << 18])
def test_an_archive_is_read_about_once(monkeypatch, block):
    monkeypatch.setattr(warc, "BLOCK", block)
    monkeypatch.setattr(warc._Bytes.get, "__defaults__", (block, 1))
    rng = random.Random(1)
    pages = [rng.randbytes(rng.randrange(0, 3000)) for _ in range(1500)]
    archive = b"".join(warc.record(k, f"http://x/{k}", p) for k, p in enumerate(pages))
    file = _Counted(archive)
    got = list(warc.records_in(warc._Bytes(file, len(archive)), 0, len(archive)))
    assert [b.partition(b"\r\n\r\n")[2] for _, b in got] == pages
    assert file.n <= (1.2 if block > 1 << 12 else 4) * len(archive)


def test_pages_of_one_payload_are_split_over_tasks(spark):
    from tests.test_skew import SKEW_CONF

    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        pages = spark.range(3000).select(F.col("id").alias("page_id"), F.sha2(F.col("id").cast("string"), 256).alias("url"),
                                         F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(F.col("id").cast("string"), 512)).alias("html"))
        out = warc.record_types(pages)
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
        assert out.filter("revisit and refers_to = 2997").count() == 999
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
