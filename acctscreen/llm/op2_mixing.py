"""Mixing sources to target weights, in DataFrame operations only.

Words are added up per source, targets follow from the sources' weights,
and a document of a source with repetition rate r is emitted floor(r) times
plus once more with probability r - floor(r).  That draw compares a number
that a hash of (seed, doc_id, text) gives with the fraction, so reruns agree
and rows without an id of their own are drawn one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch, numbered

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on seed, doc_id and text alone (null: as '')."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target from (source, size): the targets share
    ``share`` of all sizes by weight, stop at ``most`` times their source's
    size, and what is over is shared again until no target is above."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = F.array(*[F.lit(x) for x in weights])
    scratch = Scratch(sizes.sparkSession, "mix")
    # Strings order by their UTF-8 bytes, which is the order of code points.
    per = numbered(per, F.col("source").asc_nulls_last(), "nth", scratch)
    per = scratch.store(per.select("source", "source_size", F.get(w, (F.col("nth") % len(weights)).cast("int")).cast("long").alias("weight")), "sources")
    cap = F.col("source_size") * F.lit(most)
    rate, full = None, -1
    while True:
        at_cap = F.lit(False) if rate is None else cap <= F.col("weight") * F.lit(rate)
        row = per.agg(
            F.sum("source_size").alias("all"),
            F.coalesce(F.sum(F.when(at_cap, cap)), F.lit(0.0)).alias("used"),
            F.sum(F.when(~at_cap, F.col("weight"))).alias("open"),
            F.coalesce(F.sum(at_cap.cast("int")), F.lit(0)).alias("full"),
        ).first()
        if row["open"] is None or row["full"] == full:
            break
        full, rate = row["full"], (float(row["all"]) * share - row["used"]) / row["open"]
    target = F.lit(0.0) if rate is None else F.least(cap, F.col("weight") * F.lit(rate))
    return scratch.store(per.select("source", "source_size", target.cast("double").alias("target")), "targets")


def copies(target: Column, source_size: Column, drawn: Column) -> Column:
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")).cast("long")


def mix_plan(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs``.
    A null text has size 0; rows equal in doc_id and text draw the same number."""
    scratch = Scratch(docs.sparkSession, "mix")
    drawn = draw(F.col("doc_id"), F.col("text"), seed).alias("drawn")
    sizes = scratch.store(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), drawn), "sizes")
    return _planned(sizes, source_targets(sizes)).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def _planned(rows: DataFrame, targets: DataFrame) -> DataFrame:
    t = targets.withColumnRenamed("source", "_source")
    out = rows.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return out.withColumn("copies", copies(F.col("target"), F.col("source_size"), F.col("drawn")))


def mix(docs: DataFrame, seed: str = "mix-1") -> DataFrame:
    """The mix: rows of ``docs``, each as often as the plan takes it.  All
    columns stay; an empty table gives an empty one."""
    columns = docs.columns
    kept = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    sizes = docs.select("source", n_words(F.col("text")).alias("size"))
    drawn = draw(F.col("row.doc_id"), F.col("row.text"), seed).alias("drawn")
    rows = docs.select(kept).select("row", F.col("row.source").alias("source"), drawn)
    planned = _planned(rows, source_targets(sizes)).filter("copies > 0")
    many = planned.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return many.select(*[F.col("row").getField(c).alias(c) for c in columns])
