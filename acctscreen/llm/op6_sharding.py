"""Sharding by fixed virtual slots.

Every record hashes into one of thousands of slots, bytes are added up per
slot, and a versioned map says which shard a slot belongs to.  Balancing
edits the map, not the hash: only the slots that change hands move.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch

SHARDS = 24
SLOTS = 8192


@dataclass(frozen=True)
class SlotMap:
    """Shard of each slot.  ``version`` goes up by one with each edit."""

    version: int
    shards: int
    shard_of: tuple[int, ...]

    def write(self, spark: SparkSession, path: str) -> None:
        """Adds this version to the table at ``path``; a map has one row per slot."""
        rows = [(k, s) for k, s in enumerate(self.shard_of)]
        spark.createDataFrame(rows, "slot int, shard int").withColumn("shards", F.lit(self.shards)).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={self.version}")

    @staticmethod
    def read(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """The given version, or the last one."""
        maps = spark.read.parquet(path)
        version = maps.agg(F.max("version")).first()[0] if version is None else version
        rows = maps.filter(F.col("version") == version).orderBy("slot").collect()
        return SlotMap(int(version), rows[0]["shards"], tuple(r["shard"] for r in rows))


def first_map(slot_bytes: list[int], shards: int) -> SlotMap:
    """Slots by size, largest first, each to the shard with fewest bytes."""
    load = [(0, s) for s in range(shards)]
    shard_of = [0] * len(slot_bytes)
    for k in sorted(range(len(slot_bytes)), key=lambda k: (-slot_bytes[k], k)):
        have, s = load[0]
        shard_of[k] = s
        heapq.heapreplace(load, (have + slot_bytes[k], s))
    return SlotMap(1, shards, tuple(shard_of))


def rebalance(old: SlotMap, slot_bytes: list[int], shards: int) -> SlotMap:
    """``old`` edited for new slot sizes or another number of shards.  Slots
    of shards that no longer exist and slots beyond a shard's fair part move
    (small ones first), each to the shard with fewest bytes; others stay."""
    fair = sum(slot_bytes) / shards
    load, shard_of, moving = [0] * shards, list(old.shard_of), []
    for k in sorted(range(len(slot_bytes)), key=lambda k: (-slot_bytes[k], k)):
        s = shard_of[k]
        if s < shards and load[s] + slot_bytes[k] <= fair:
            load[s] += slot_bytes[k]
        else:
            moving.append(k)
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for k in moving:
        have, s = heap[0]
        shard_of[k] = s
        heapq.heapreplace(heap, (have + slot_bytes[k], s))
    return replace(old, version=old.version + 1, shards=shards, shard_of=tuple(shard_of))


def measured(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, copy, v_slot of every row.  A null text has
    no bytes.  Equal rows are told apart by a running number, so thousands of
    copies of a row spread over the slots and a re-run deals them alike."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    alike = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    each = alike.select("doc_id", "size", "text_crc32", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    return each.withColumn("v_slot", F.pmod(F.xxhash64("doc_id", "text_crc32", "copy"), F.lit(slots)).cast("int"))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot; the result has ``slots`` rows at most."""
    size, n = [0] * slots, [0] * slots
    for r in rows.groupBy("v_slot").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect():
        size[r["v_slot"]], n[r["v_slot"]] = r["size"], r["n"]
    return size, n


def next_map(spark: SparkSession, size: list[int], shards: int, maps: str) -> SlotMap:
    """The last map stored at ``maps``, edited for the slots' new sizes, or the
    first one; stored there as a version of its own."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(maps)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        slot_map = rebalance(SlotMap.read(spark, maps), size, shards)
    else:
        slot_map = first_map(size, shards)
    slot_map.write(spark, maps)
    return slot_map


def shard_rows(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    ``maps`` is the folder of the corpus's slot maps: a run over new documents
    or another number of shards edits the last one and moves few slots (the
    number of slots stays).  Without it the run begins with a map of its own.

    The law is ``bytes``: shards differ by less than the largest slot.  A row
    has a ``slot`` in its shard, from 0 without gaps: virtual slots of a shard
    follow each other by number, rows in them by doc_id (null first)."""
    scratch = Scratch(docs.sparkSession, "shard")
    rows = scratch.store(measured(docs, slots), "rows")
    return _placed(rows, rows, ["doc_id", "text_crc32", "size", "copy"], shards, slots, maps or f"{scratch.root}/map").select("doc_id", *PLACE)


#: What sharding adds to a row.
PLACE = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "v_slot"]


def _placed(rows: DataFrame, sizes: DataFrame, order: list[str], shards: int, slots: int, maps: str) -> DataFrame:
    """``rows`` with shard and slot; ``sizes`` has size and v_slot of the same rows."""
    spark = rows.sparkSession
    size, n = slot_sizes(sizes, slots)
    slot_map = next_map(spark, size, shards, maps)
    start, filled = [], [0] * shards
    for k, s in enumerate(slot_map.shard_of):
        start.append(filled[s])
        filled[s] += n[k]
    # One row for each virtual slot: its size is set by ``slots``, not by the data.
    placed = spark.createDataFrame([(k, s, start[k]) for k, s in enumerate(slot_map.shard_of)], "v_slot int, shard int, start long")
    within = F.row_number().over(Window.partitionBy("v_slot").orderBy(*order)) - 1
    return rows.withColumn("within", within).join(F.broadcast(placed), "v_slot").withColumns(
        {"law": F.lit("bytes"), "slot": F.col("start") + F.col("within"), "grown_shard": F.lit(None).cast("int")}
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, maps: str | None = None) -> DataFrame:
    """The rows of ``docs`` themselves, with the columns of ``shard_rows``: what
    a writer of shards needs, rows of a virtual slot beside each other.

    Columns of ``docs`` named like one of PLACE give way to it.  Equal rows meet
    once in a shuffle, so copies cost a number there and not a text each, and
    are told apart by a running number.  Slots' sizes are counted before
    without the texts, which stand there by their length and two hashes."""
    scratch = Scratch(docs.sparkSession, "shard")
    col = lambda c: F.col(f"`{c}`")
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    mark = F.xxhash64(*[col(c) for c in docs.columns]).alias("mark")
    facts = [(F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), mark]

    def numbered_copies(alike: DataFrame, doc_id: str) -> DataFrame:
        each = alike.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
        return each.withColumn("v_slot", F.pmod(F.xxhash64(doc_id, "text_crc32", "mark", "copy"), F.lit(slots)).cast("int"))

    rest = F.struct(*[col(c) for c in docs.columns if c != "text"]).alias("rest")
    few = docs.select(rest, *facts).groupBy("rest", "size", "text_crc32", "mark").agg(F.count(F.lit(1)).alias("n"))
    sizes = scratch.store(numbered_copies(few, "rest.doc_id").select("size", "v_slot"), "sizes")
    row = F.struct(*[col(c) for c in docs.columns]).alias("row")
    whole = docs.select(row, *facts).groupBy("row", "size", "text_crc32", "mark").agg(F.count(F.lit(1)).alias("n"))
    out = _placed(numbered_copies(whole, "row.doc_id"), sizes, ["row.doc_id", "text_crc32", "size", "mark", "row", "copy"], shards, slots, maps or f"{scratch.root}/map")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c not in PLACE], *PLACE)
