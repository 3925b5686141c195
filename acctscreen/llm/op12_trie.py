"""Prefix trie of conversations: who shares which opening, and what it saves.

A node is a distinct sequence of first turns.  Nodes are counted by a hash of
their sequence; the nodes between two branchings have the same members, so
they are one run of the trie.  The paths of runs are put in order, each batch
of them is a shard, and a shard's trie is a string of balanced parentheses:
``findclose`` over a range min-max tree of blocks of excess delimits a run's
subtree, the rank of leaf pairs ``()`` counts its leaves, and cumulative sums
in order of the opening ones give its savings.  A run on the spine that
shards share has a part in each of them, and the parts are added up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch

#: Turns whose hashes one task adds up; a longer conversation goes on in the next block.
STRETCH = 4096
#: Places of parentheses in a block of the range min-max tree.
BLOCK = 64
WORDS = r"[^\x20\x09-\x0D]+"
_NOTHING = hashlib.sha256(b"").hexdigest()

SCHEMA = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_LANES = ["s1", "s2", "s3", "s4"]


# -- conversations -------------------------------------------------------------

def ordered_turns(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Stored turns (conv_id, part, idx, h1, h2, words) and, for each
    conversation and part of the table that holds some of it, the rows of it
    there (n), the least idx, and the rows in parts before.

    Ordered by turn (null first), then role and text.  The table is sorted as
    a whole and cut into ranges, so a long conversation is in several parts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    rows = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    at = F.monotonically_increasing_id()  # the place in the sorted range; stored before it is used
    hashed = [F.xxhash64(F.lit(s), "role", "text").alias(f"h{s}") for s in (1, 2)]
    turns = rows.select("conv_id", at.alias("at"), *hashed, F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    turns = scratch.store(turns, "turns").select("conv_id", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("idx"), "h1", "h2", "words")
    parts = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.min("idx").alias("least"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part")) - F.col("n")
    return turns, scratch.store(parts.withColumn("before", before), "parts")


def rebuilt(conversations: DataFrame, scratch: Scratch, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns (c, depth from 1, h1, h2, words, total) of the rebuilt
    conversations, and the conversations (c, total), also turnless ones.

    Conversation c begins with the first h turns of c - c % ``group``, h being
    crc32(c) % ``most``; its own turns after the first h follow."""
    turns, parts = ordered_turns(conversations, scratch)
    convs = parts.groupBy("conv_id").agg(F.sum("n").alias("length"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = convs.select("conv_id", "length", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = convs.filter(F.col("conv_id") == F.col("base")).select("base", F.col("length").alias("_base"))
    took = F.least("h", F.coalesce("_base", F.lit(0)))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "h", took.alias("took"), (F.greatest(F.col("length") - F.col("h"), F.lit(0)) + took).alias("total"))
    convs = scratch.store(convs, "convs")
    placed = turns.join(parts.join(convs.drop("base"), "conv_id"), ["conv_id", "part"])
    pos = F.col("idx") - F.col("least") + F.col("before") + 1
    own = placed.withColumn("pos", pos).filter(F.col("pos") > F.col("h"))
    own = own.select(F.col("conv_id").alias("c"), (F.col("pos") - F.col("h") + F.col("took")).alias("depth"), "h1", "h2", "words", "total")
    heads = turns.filter(F.col("conv_id") % group == 0).join(parts.filter(F.col("before") < most), ["conv_id", "part"]).withColumn("pos", pos)
    heads = heads.filter(F.col("pos") < most).select(F.col("conv_id").alias("base"), "pos", "h1", "h2", "words")
    head = convs.filter("took > 0").join(heads, "base").filter(F.col("pos") <= F.col("took"))
    head = head.select(F.col("conv_id").alias("c"), F.col("pos").alias("depth"), "h1", "h2", "words", "total")
    return own.unionByName(head), convs.select(F.col("conv_id").alias("c"), "total")


# -- nodes and runs ------------------------------------------------------------

def _key(depth: Column, lanes: list[Column]) -> list[Column]:
    """The 128 bits that stand for a sequence of turns."""
    return [F.xxhash64(F.lit(s), depth, *lanes) for s in (5, 6)]


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Each turn with the key of the sequence that ends with it (p1, p2) and
    the words of that sequence.  A sequence's hash is the sum of its turns'
    (with their places), in four lanes of 32 bits that cannot overflow; sums
    are made in stretches, so no task adds up a whole long conversation."""
    t = [F.xxhash64(F.lit(s), "depth", "h1", "h2") for s in (3, 4)]
    half = F.lit((1 << 32) - 1)
    lanes = [x for h in t for x in (h.bitwiseAND(half), F.shiftrightunsigned(h, 32))]
    rows = turns.select("c", "depth", "words", "total", F.expr(f"(depth - 1) div {STRETCH}").alias("stretch"), *[x.alias(n) for x, n in zip(lanes, _LANES)])
    here = Window.partitionBy("c", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    sums = [*_LANES, "words"]
    rows = scratch.store(rows.select("c", "depth", "words", "total", "stretch", *[F.sum(x).over(here).alias(f"{x}_") for x in sums]), "stretches")
    ends = rows.groupBy("c", "stretch").agg(*[F.max(f"{x}_").alias(x) for x in sums])
    upto = Window.partitionBy("c").orderBy("stretch")
    before = ends.select("c", "stretch", *[(F.sum(x).over(upto) - F.col(x)).alias(f"{x}_b") for x in sums]).filter("stretch > 0")
    whole = rows.join(before, ["c", "stretch"], "left")
    value = {x: F.col(f"{x}_") + F.coalesce(f"{x}_b", F.lit(0)) for x in sums}
    p1, p2 = _key(F.col("depth"), [value[x] for x in _LANES])
    return scratch.store(whole.select("c", "depth", p1.alias("p1"), p2.alias("p2"), "words", value["words"].alias("path_words"), "total"), "prefixes")


def _root() -> list[Column]:
    zero = F.lit(0).cast("long")
    return [zero.alias("depth"), *(x.alias(n) for x, n in zip(_key(zero, [zero] * 4), ("p1", "p2")))]


def trie_nodes(rows: DataFrame, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """Nodes (depth, p1, p2, n members, m the smallest, words of the last turn
    and of the path), the root with them."""
    inner = rows.groupBy("depth", "p1", "p2").agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("m"), F.max("words").alias("words"), F.max("path_words").alias("path_words"))
    root = convs.agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("m")).filter("n > 0")
    zero = F.lit(0).cast("long")
    return scratch.store(inner.unionByName(root.select(*_root(), "n", "m", zero.alias("words"), zero.alias("path_words"))), "nodes")


def run_paths(rows: DataFrame, nodes: DataFrame, root, convs: DataFrame, scratch: Scratch) -> DataFrame:
    """The runs on the path of each conversation that is the smallest of its
    last node: (c, path of (a, m, n, words)).

    Along a path the number of members never grows, so nodes with equal
    smallest member and number are a run.  A path of k runs needs k others
    that leave it, each later than the one before: of N turns in all, no path
    has more than the square root of 2 N runs, however long it is."""
    found = rows.join(nodes.select("depth", "p1", "p2", "n", "m"), ["depth", "p1", "p2"])
    runs = found.groupBy("c", "m", "n").agg(F.min("depth").alias("a"), F.sum("words").alias("words"))
    zero = F.lit(0).cast("long")
    top = convs.select("c", F.lit(root["m"]).alias("m"), F.lit(root["n"]).alias("n"), zero.alias("a"), zero.alias("words"))
    runs = runs.unionByName(top).groupBy("c", "m", "n").agg(F.min("a").alias("a"), F.sum("words").alias("words"))
    paths = runs.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("a", "m", "n", "words"))).alias("path"))
    paths = paths.filter(F.element_at("path", -1)["m"] == F.col("c"))
    return scratch.store(paths, "paths")


# -- balanced parentheses ------------------------------------------------------

class Parentheses:
    """A string of balanced parentheses (True opens) with a range min-max
    tree over the excess of its blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        n = max(-(-len(opens) // BLOCK), 1)
        padded = np.full(n * BLOCK, np.iinfo(np.int64).max)
        padded[: len(opens)] = self.excess
        self.blocks = padded.reshape(n, BLOCK)
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            low = self.levels[-1]
            low = np.append(low, np.iinfo(np.int64).max) if len(low) % 2 else low
            self.levels.append(low.reshape(-1, 2).min(axis=1))

    def findclose(self, p: np.ndarray) -> np.ndarray:
        """Places of the parentheses that close those at ``p``."""
        target = self.excess[p] - 1
        block, out = p // BLOCK, np.full(len(p), -1)
        inside = (self.blocks[block] <= target[:, None]) & (np.arange(BLOCK) > (p % BLOCK)[:, None])
        here = inside.any(axis=1)
        out[here] = block[here] * BLOCK + inside[here].argmax(axis=1)
        rest = np.flatnonzero(~here)
        if len(rest):
            block = self._next_block(block[rest], target[rest])
            out[rest] = block * BLOCK + (self.blocks[block] <= target[rest][:, None]).argmax(axis=1)
        return out

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The first block after ``block`` with an excess of ``target`` or
        less: up the tree until a sibling to the right has one, then down."""
        node, level, found = block.copy(), np.zeros(len(block), int), np.zeros(len(block), bool)
        for k, low in enumerate(self.levels):
            open_ = ~found
            right = node + 1
            ok = open_ & (node % 2 == 0) & (right < len(low))
            ok[ok] = low[right[ok]] <= target[ok]
            node[ok], level[ok], found = right[ok], k, found | ok
            node = np.where(found, node, node >> 1)
        for k in range(len(self.levels) - 1, 0, -1):
            down = level == k
            left = node[down] * 2
            node[down] = np.where(self.levels[k - 1][left] <= target[down], left, left + 1)
            level[down] = k - 1
        return node


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of paths (c, path, goes_on) in order is a shard: a row for
    each run in it with its part of the leaves and savings."""
    for batch in batches:
        if not batch.num_rows:
            continue
        c, goes_on = batch.column(0).to_numpy(), batch.column(2)
        path = batch.column(1)
        run = path.flatten()
        m, n, words = (run.field(k).to_numpy() for k in (1, 2, 3))
        size = path.value_lengths().to_numpy().astype(np.int64)
        start = np.cumsum(size) - size
        i = np.repeat(np.arange(len(size)), size)
        j = np.arange(len(m)) - start[i]
        # How far each path goes along with the one before it.
        before = np.maximum(i - 1, 0)
        same = (i > 0) & (j < size[before])
        k = start[before] + np.minimum(j, size[before] - 1)
        same &= (m == m[k]) & (n == n[k])
        common = np.minimum.reduceat(np.where(same, np.iinfo(np.int64).max, j), start)
        common = np.minimum(common, size)
        turns = np.empty(2 * len(size) + 1, np.int64)  # closed, opened, closed, .., closed
        turns[0], turns[1::2] = 0, size - common
        turns[2:-1:2], turns[-1] = (size[:-1] - common[1:]), size[-1]
        bits = Parentheses(np.repeat(np.arange(len(turns)) % 2 == 1, turns))
        opened = np.flatnonzero(j >= common[i])  # the element that each opening one stands for
        p = np.flatnonzero(bits.opens)
        q = bits.findclose(p)
        pair = bits.opens.copy()
        pair[:-1] &= ~bits.opens[1:]
        if goes_on[len(size) - 1].as_py():
            pair[p[-1]] = False  # what follows it is in the next shard
        leaves = np.cumsum(pair)
        own = m[opened] == c[i[opened]]
        saved = np.concatenate([[0], np.cumsum(np.where(own, (n[opened] - 1) * words[opened], 0))])
        ranks = np.cumsum(bits.opens)  # opening ones up to a place
        up = np.where(j[opened] > 0, m[np.maximum(opened - 1, 0)], 0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(m[opened]), pa.array(n[opened]), pa.array(up, mask=j[opened] == 0),
                pa.array(leaves[q] - leaves[p] + pair[p]), pa.array(saved[ranks[q]] - saved[ranks[p] - 1]),
            ],
            ["m", "n", "up", "leaves", "saved"],
        )


def run_totals(paths: DataFrame, scratch: Scratch) -> DataFrame:
    """Runs (m, n) with parent's m, children, leaves and savings of their subtrees."""
    pairs = paths.select("c", F.explode(F.expr("transform(slice(path, 2, size(path)), (x, i) -> struct(path[i].m as um, path[i].n as un, x.m as m))")).alias("x"))
    kids = pairs.filter(F.col("x.m") == F.col("c")).groupBy(F.col("x.um").alias("m"), F.col("x.un").alias("n")).agg(F.count(F.lit(1)).alias("kids"))
    kids = scratch.store(kids, "kids")
    last = paths.select("c", "path", F.element_at("path", -1)["n"].alias("n"))
    ordered = last.join(kids.withColumnRenamed("m", "c"), ["c", "n"], "left").select("c", "path", F.coalesce("kids", F.lit(0)).alias("kids"))
    ordered = ordered.orderBy("path").select("c", "path", (F.col("kids") > 0).alias("goes_on"))
    parts = ordered.mapInArrow(_shard, "m long, n long, up long, leaves long, saved long")
    runs = parts.groupBy("m", "n").agg(F.max("up").alias("up"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return scratch.store(runs.join(kids, ["m", "n"], "left").withColumn("kids", F.coalesce("kids", F.lit(0))), "runs")


# -- members that end at a node ------------------------------------------------

_ENDS = pa.schema([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("least", pa.int64()), ("ids", pa.string())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (depth, p1, p2, c) in order: the ids of each node in the batch as one text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy() for k in range(4)]
        new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in cols[:3]], axis=0)])
        at = np.flatnonzero(new)
        ids = [",".join(map(str, x.tolist())) for x in np.split(cols[3], at[1:])]
        yield pa.RecordBatch.from_arrays([*(pa.array(x[at]) for x in cols), pa.array(ids)], schema=_ENDS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts of a node, in order, go through one hash that is kept between
    batches: no more than a batch is held."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for depth, p1, p2, _, ids in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if node == (depth, p1, p2):
                digest.update(b"," + ids.encode())
            else:
                if node is not None:
                    done.append((*node, digest.hexdigest()))
                node, digest = (depth, p1, p2), hashlib.sha256(ids.encode())
        yield _digest_rows(done)
    if node is not None:
        yield _digest_rows([(*node, digest.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["depth", "p1", "p2", "ends_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)


def ends_digests(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node.  Sorted by ranges, the ids of
    a node become a text for each batch; only these texts meet in one task."""
    ends = rows.filter(F.col("depth") == F.col("total")).select("depth", "p1", "p2", "c")
    ends = ends.unionByName(convs.filter("total = 0").select(*_root(), "c"))
    texts = ends.orderBy("depth", "p1", "p2", "c").mapInArrow(_joined, "depth long, p1 long, p2 long, least long, ids string")
    texts = texts.repartition("depth", "p1", "p2").sortWithinPartitions("depth", "p1", "p2", "least")
    return texts.mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")


# -- the operator --------------------------------------------------------------

def prefix_trie(conversations: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """A row for each node of the rebuilt conversations' trie (``SCHEMA``).

    Rows without conv_id take no part; equal turns of a conversation are in
    order of role and text, and rows that repeat are turns of their own; a
    null role or text is empty; other columns are not looked at; an empty
    table has no node, not even a root."""
    spark = conversations.sparkSession
    scratch = Scratch(spark, "trie")
    turns, convs = rebuilt(conversations, scratch, group, most)
    rows = prefixes(turns, scratch)
    nodes = trie_nodes(rows, convs, scratch)
    root = nodes.filter("depth = 0").first()
    if root is None:
        return spark.createDataFrame([], SCHEMA)
    runs = run_totals(run_paths(rows, nodes, root, convs, scratch), scratch)
    extent = nodes.groupBy("m", "n").agg(F.min("depth").alias("a"), F.max("depth").alias("b"), F.min(F.col("path_words") - F.col("words")).alias("before"))
    # Stored, so that it reaches the nodes by a shuffle of its own and a long run can be split.
    runs = scratch.store(runs.join(extent, ["m", "n"]), "extents")
    out = nodes.join(runs, ["m", "n"]).join(ends_digests(rows, convs), ["depth", "p1", "p2"], "left")
    above = F.col("path_words") - F.col("words") - F.col("before")
    return out.select(
        F.col("m").alias("conv_id"),
        "depth",
        F.when(F.col("depth") > F.col("a"), F.col("m")).otherwise(F.col("up")).alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.when(F.col("depth") < F.col("b"), F.lit(1)).otherwise(F.col("kids")).cast("long").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") - (F.col("n") - 1) * above).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"),
    )
