"""Shared join helpers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_join_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct ``keys`` rows of ``df``, shaped as the small side of an
    equi join against a large, possibly skewed table.

    De-duplicated on one struct column, so the result is not already hash
    partitioned on ``keys`` and reaches the join through a shuffle of its
    own.  AQE splits a skewed partition of the large side only when both
    join inputs come straight from a shuffle; a distinct on the plain keys
    would feed the join from the aggregate and a hot key would stay in one
    task.  (When the result is small, AQE broadcasts it instead.)"""
    k = F.struct(*[F.col(c) for c in keys]).alias("__k")
    return df.select(k).distinct().select("__k.*")


@dataclass(frozen=True)
class Lookup:
    """``columns`` of ``table``, found by ``keys``: pairs of (column of the
    rows, column of the table).  They are added as ``<prefix><name>``."""

    table: DataFrame
    keys: Sequence[tuple[str, str]]
    columns: Sequence[str]
    prefix: str = ""


def _one_row_per_key(tables: Sequence[Lookup]) -> DataFrame:
    """``__key0``, .. and, for each of ``tables``, ``__row0``, ..: the least row
    of its columns, compared in their order (a null before any value)."""
    parts = []
    for n, t in enumerate(tables):
        rows = t.table
        for _, k in t.keys:
            rows = rows.filter(F.col(k).isNotNull())  # a null key matches nothing
        key = F.struct(*[F.col(k).alias(f"__key{i}") for i, (_, k) in enumerate(t.keys)]).alias("__k")
        parts.append(rows.select(key, F.struct(*[F.col(c).alias(c) for c in t.columns]).alias(f"__row{n}")))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows.groupBy("__k").agg(*[F.min(f"__row{n}").alias(f"__row{n}") for n in range(len(tables))]).select("__k.*", *[f"__row{n}" for n in range(len(tables))])


def lookup(df: DataFrame, *lookups: Lookup) -> DataFrame:
    """``df`` with the columns of each of ``lookups``: left joins that keep
    every row of ``df`` once, whatever repeats in a table (the least row of a
    key counts).

    The tables are grouped on a struct of the key, so that they reach the
    join through a shuffle of their own and AQE can split a key that holds a
    large share of ``df``.  Lookups by the same columns of ``df`` are one join:
    a second one would take over the first one's partitioning, and a join
    whose rows go on to another by the same key is not split."""
    by_key: dict[tuple[str, ...], list[Lookup]] = {}
    for t in lookups:
        by_key.setdefault(tuple(c for c, _ in t.keys), []).append(t)
    out = df
    for left, tables in by_key.items():
        cond = F.lit(True)
        for i, c in enumerate(left):
            cond = cond & (F.col(c) == F.col(f"__key{i}"))
        out = out.join(_one_row_per_key(tables), cond, "left")
        out = out.withColumns({f"{t.prefix}{c}": F.col(f"__row{n}").getField(c) for n, t in enumerate(tables) for c in t.columns})
        out = out.drop(*[f"__row{n}" for n in range(len(tables))], *[f"__key{i}" for i in range(len(left))])
    return out
