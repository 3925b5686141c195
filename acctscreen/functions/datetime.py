"""Date and time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
SECONDS_PER_DAY = 86400


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_datetime(day: str | Column, epoch_seconds: str | Column) -> Column:
    """``day`` at the UTC clock time of ``epoch_seconds`` (TIMESTAMP_NTZ).

    Only the time of day is taken from the epoch value, as the original
    job did (it printed the clock of a UTC timestamp next to ``tx_date``).
    Zone-free: ``timestamp_seconds``/``from_unixtime`` would follow the
    session time zone."""
    secs = F.pmod(_c(epoch_seconds).cast("long"), F.lit(SECONDS_PER_DAY)).cast("int")
    return _c(day).cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs
    )
