"""Boolean column helpers shared by several operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_individual_id(c: str | Column) -> Column:
    """A personal id: exactly 10 characters, the first one a Latin letter."""
    c = _c(c)
    return (F.length(c) == 10) & F.substring(c, 1, 1).rlike("[a-zA-Z]")


def isin_keep_null(c: str | Column, values: Iterable[str]) -> Column:
    """``NOT c IN values`` that keeps rows where ``c`` is null.

    Plain ``~c.isin(..)`` is null for a null ``c`` and the row is dropped;
    the deny-list rule removes only rows that carry a listed value.
    """
    return ~F.coalesce(_c(c).isin(list(values)), F.lit(False))


def teller_code_ok(emp_no: str | Column, codes: Iterable[str], prefix: str) -> Column:
    """Characters 4-7 of the employee number are a teller code, or
    character 4 equals ``prefix`` (1-based positions)."""
    e = _c(emp_no)
    return F.substring(e, 4, 4).isin(list(codes)) | (F.substring(e, 4, 1) == F.lit(prefix))


def in_date_window(c: str | Column, snap_date: str, months: int = 1) -> Column:
    """``c BETWEEN add_months(snap_date, -months) AND snap_date`` (both ends kept).

    ``snap_date`` is a literal so the bounds fold to constants and the
    predicate reaches the Parquet scan (and partition pruning)."""
    snap = F.lit(snap_date).cast("date")
    return _c(c).between(F.add_months(snap, -months), snap)


def differs_with_null(c: str | Column) -> Column:
    """Aggregate: the group holds more than one distinct value, a null
    counting as a value of its own.

    Built from max/min/count so it is partial-aggregated before the shuffle
    (a DISTINCT aggregate would not be, and is not allowed in windows)."""
    c = _c(c)
    n = F.count(c)
    # max/min are null for an all-null group: that group has one value.
    return F.coalesce(F.max(c) != F.min(c), F.lit(False)) | ((n > 0) & (n < F.count(F.lit(1))))


def strict_cast(c: str | Column, data_type: str, name: str | None = None) -> Column:
    """Cast that fails the job on a value that does not convert, whatever the
    session's ANSI setting (with ANSI off a plain cast turns it into null).
    A null stays null."""
    c = _c(c)
    v = c.try_cast(data_type)
    label = name or "value"
    return F.when(
        c.isNotNull() & v.isNull(),
        F.raise_error(F.concat(F.lit(f"cannot cast {label} to {data_type}: "), c.cast("string"))),
    ).otherwise(v)


def cast_problem(c: str | Column, data_type: str, name: str) -> Column:
    """``name=value`` for a value that does not convert, else null."""
    c = _c(c)
    return F.when(c.isNotNull() & c.try_cast(data_type).isNull(), F.concat(F.lit(f"{name}="), c.cast("string")))
