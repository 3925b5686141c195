"""Every registered query against its DuckDB twin (row count, column names,
order-insensitive value hash)."""

import datetime as dt
import hashlib
import json

import duckdb
import pytest

from acctscreen.plans.catalog import QUERIES
from acctscreen.plans.oracle import ORACLE
from tests.conftest import SF001

EMPTY = ()
TABLES = "customer orders lineitem events".split()


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows) > 0 or name in EMPTY
    assert digest(df.columns, srows) == digest(dcols, drows)


@pytest.mark.parametrize("name", ["ordered_candidates", "candidate_preview", "nonzero_preview"])
def test_order_of_rows(spark, duck, name):
    df = QUERIES[name](spark, SF001)
    res = duck.execute(ORACLE[name])
    order = [[d[0] for d in res.description].index(c) for c in df.columns]
    want = [[_norm(r[k]) for k in order] for r in res.fetchall()]
    assert [[_norm(v) for v in r] for r in df.collect()] == want
