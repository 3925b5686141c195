"""Similarity join on word shingles: MinHash LSH forest, then exact checks.

Each distinct text has one MinHash signature, cut into trees.  A tree is a
trie of its part of the signatures; texts that share a prefix are neighbours.
Prefixes start long and are shortened until pairs at the threshold itself are
found with the target probability.  Neighbours form candidate groups.
Inside a group all pairs are checked exactly on their shingles, block against
block, with matrix products; only sums and one link per text leave a task,
never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import SPACE, Scratch, chunks, fold_case, hash_spans, mix, text_bytes, word_bounds

WORDS = 5
SIMILARITY = 0.8
TREES, DEPTH, LEAST_DEPTH = 24, 7, 4
RECALL = 0.9995
#: Texts, and shingles of them, that a block of an exact check holds on average
#: at most (a text is never cut); a task holds two blocks.
BLOCK, BLOCK_SHINGLES = 256, 1 << 20
_SEED = np.random.default_rng(20240131)
_A = _SEED.integers(1, 1 << 63, TREES * DEPTH, np.uint64) | np.uint64(1)
_B = _SEED.integers(0, 1 << 63, TREES * DEPTH, np.uint64)


def shingles(column: pa.Array, words: int = WORDS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk of rows: first row, shingle hashes, places at which each
    row's begin.  Words are what stands between ASCII white space, A-Z in
    lower case.  A text of 1 to ``words`` - 1 words is one shingle."""
    data, offs = text_bytes(column)
    weight = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]])
        starts, ends, at = word_bounds(low, offs[a : b + 1] - offs[a], SPACE)
        h = hash_spans(low, starts, ends)
        n = np.diff(at)
        total = np.zeros(len(h), np.uint64)
        for k in range(words):
            part = h[k:] * weight[k]
            total[: len(part)] += part
        many = np.maximum(n - words + 1, 0)
        own = np.repeat(at[:-1] - np.append(0, np.cumsum(many))[:-1], many) + np.arange(many.sum())
        short = np.flatnonzero((n > 0) & (n < words))
        if len(short):  # all words of a short text, mixed with their number
            values, row = [total[own]], [np.repeat(np.arange(len(n)), many)]
            for r in short:
                w = h[at[r] : at[r + 1]]
                values.append(np.array([(w * weight[: len(w)]).sum(dtype=np.uint64) ^ np.uint64(len(w))]))
                row.append(np.array([r]))
            row, values = np.concatenate(row), np.concatenate(values)
            order = np.argsort(row, kind="stable")
            values, many = values[order], np.maximum(many, (n > 0).astype(many.dtype))
        else:
            values = total[own]
        yield a, mix(values), np.append(0, np.cumsum(many))


def signatures(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of TREES * DEPTH minima (16 bits of each); every row must have a shingle."""
    out = np.empty((len(_A), len(at) - 1), np.uint16)
    if len(h) == 0:
        return out.T
    work = np.empty(len(h), np.uint64)
    for k in range(len(_A)):
        np.multiply(h, _A[k], out=work)
        work += _B[k]
        out[k] = mix(np.minimum.reduceat(work, at[:-1])) >> np.uint64(48)
    return out.T


_SIGNED = "key long, doc_id long, text_hash long, set_a long, set_b long, shingles long, signature binary"


def _signer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key, doc_id, text_hash = (batch.column(k) for k in range(3))
        for a, h, at in shingles(batch.column(3)):
            rows = np.flatnonzero(np.diff(at))
            if not len(rows):
                continue
            part, n = at[np.append(rows, len(at) - 1)], np.diff(at)[rows]
            sig = signatures(h, part)
            # Texts with equal sets of shingles are one: the set's identity is
            # the sum of hashes of its distinct shingles, 128 bits of it.
            row = np.repeat(np.arange(len(rows)), n)
            order = np.lexsort((h, row))
            hs, rs = h[order], row[order]
            new = np.append(True, (hs[1:] != hs[:-1]) | (rs[1:] != rs[:-1]))
            first = np.searchsorted(np.flatnonzero(new), part[:-1])
            ident = [np.add.reduceat(mix(hs[new] ^ np.uint64(s)), first).view(np.int64) for s in (1, 2)]
            take, sig = pa.array(a + rows), np.ascontiguousarray(sig)
            yield pa.RecordBatch.from_arrays(
                [key.take(take).cast(pa.int64()), doc_id.take(take).cast(pa.int64()), text_hash.take(take).cast(pa.int64()), *map(pa.array, ident), pa.array(n, pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())],
                names=["key", "doc_id", "text_hash", "set_a", "set_b", "shingles", "signature"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, TREES * DEPTH)


def _prefixes(depth: int, trees: int):
    """doc and, for each tree, a hash of the first ``depth`` values of its part."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _matrix(batch.column(1)).astype(np.uint64)
            out = np.empty((len(sig), trees), np.uint64)
            for t in range(trees):
                run = np.full(len(sig), t + 1, np.uint64)
                for d in range(depth):
                    run = mix(run * np.uint64(0x9E3779B97F4A7C15) + sig[:, t * DEPTH + d])
                out[:, t] = run
            doc = np.repeat(batch.column(0).to_numpy(), trees)
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(out.ravel().view(np.int64))], names=["doc", "p"])

    return make


def found_by(depth: int, s: float, trees: int = TREES) -> float:
    """Probability that a pair of similarity s shares a prefix of ``depth`` in some tree."""
    return 1 - (1 - s**depth) ** trees


def depth_for(threshold: float, target: float = RECALL) -> int:
    """The prefixes are shortened until a pair at the threshold itself, the
    hardest one, is found with the target probability: other pairs of the
    corpus, however many and however alike, change nothing for it."""
    for depth in range(DEPTH, LEAST_DEPTH, -1):
        if found_by(depth, threshold) >= target:
            return depth
    return LEAST_DEPTH


def _by(column: str) -> Column:
    """Grouped on this, an aggregate reaches a join by ``column`` through a
    shuffle of its own, and a value with a large share of the other side's
    rows can be split over tasks."""
    return F.struct(column).alias("_by")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """node, root of the connected components of (a, b) edges: large-star and
    small-star steps, each stored, until a step changes nothing.  Labels stay
    in tables; the driver sees two numbers a step."""
    edges = scratch.store(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct(), f"{name}-0")
    step, before = 0, None
    while True:
        both = edges.unionByName(edges.select(F.col("hi").alias("lo"), F.col("lo").alias("hi")))
        least = both.groupBy(_by("lo")).agg(F.min("hi").alias("hi")).select("_by.lo", F.least("hi", "_by.lo").alias("m"))
        large = both.filter("hi > lo").join(least, "lo").select(F.col("m").alias("lo"), "hi").filter("lo < hi").distinct()
        # Small star: neighbours below a node hang on the least of them.
        least = large.groupBy(_by("hi")).agg(F.min("lo").alias("m")).select("_by.hi", "m")
        joined = large.join(least, "hi")
        small = joined.select(F.col("m").alias("lo"), F.col("lo").alias("hi")).filter("lo < hi").unionByName(joined.select(F.col("m").alias("lo"), "hi"))
        step += 1
        edges = scratch.store(small.distinct(), f"{name}-{step}")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("lo", "hi").cast("long"))).first()
        if before == now:
            return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        before = now


# -- exact checks ----------------------------------------------------------------

def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each two sets share.  Sets are arrays of
    distinct hashes; the matrix product goes over columns in pieces."""
    h = np.concatenate([*left, *right])
    _, column = np.unique(h, return_inverse=True)
    sizes = [len(x) for x in (*left, *right)]
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = max(256, (1 << 21) // max(1, len(sizes)))
    top = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, top, width):
        a, b = np.searchsorted(column, [at, at + width])
        part = np.zeros((len(sizes), min(width, top - at)), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def links(left: list[np.ndarray], right: list[np.ndarray], threshold: float = SIMILARITY) -> np.ndarray:
    """Which pairs have a Jaccard similarity of ``threshold`` or more."""
    common = overlaps(left, right).astype(np.float64)
    union = np.array([len(x) for x in left])[:, None] + np.array([len(x) for x in right])[None, :] - common
    return common >= threshold * union - 1e-9


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal values of the first ``columns`` columns, in sorted input.
    A run is held whole: two blocks at most."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        keys = np.stack([table.column(k).to_numpy() for k in range(columns)], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(keys[a])
            if last is not None and key != last:
                yield last, pa.concat_tables(held)
                held = []
            last = key
            held.append(table.slice(a, b - a))
    if held:
        yield last, pa.concat_tables(held)


def _checker(threshold: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), table in _groups(batches, 3):
            side, doc, copies = (table.column(k).to_numpy() for k in (3, 4, 5))
            sets: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(doc)
            for a, h, at in shingles(table.column(6).combine_chunks()):
                for r in range(len(at) - 1):
                    sets[a + r] = np.unique(h[at[r] : at[r + 1]])
            left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
            near = links([sets[k] for k in left], [sets[k] for k in right], threshold)
            if i == j:
                np.fill_diagonal(near, False)
            label = connected(near, left, right, len(doc))
            count = np.zeros(len(doc), np.int64)
            count[left] = near @ copies[right]
            if i != j:
                count[right] = copies[left] @ near
            some = np.flatnonzero(count)
            least = np.full(len(doc), np.iinfo(np.int64).max)
            np.minimum.at(least, label, doc)
            yield pa.RecordBatch.from_arrays([pa.array(doc[some]), pa.array(count[some]), pa.array(least[label[some]])], names=["doc", "n_links", "root"])

    return check


def connected(near: np.ndarray, left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Label of each of ``n`` rows: equal where links of this block connect them."""
    label = np.arange(n)
    r, c = np.nonzero(near)
    a, b = left[r], right[c]
    while len(a):
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    return label


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def grouped(docs: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """doc_id, text_hash, root, class_id, set_id, n_links of every row that has a word."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    signed = scratch.store(rows.mapInArrow(_signer, _SIGNED), "signed")
    by_set = signed.groupBy("set_a", "set_b").agg(F.min("key").alias("doc"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("set_id"))
    sets = scratch.store(by_set, "sets")
    reps = signed.withColumnRenamed("key", "doc").join(sets.select("doc", "copies"), "doc")
    reps = scratch.store(reps.select("doc", "doc_id", "text_hash", "copies", "shingles", "signature"), "reps")
    depth = depth_for(threshold)

    # Texts that share a prefix hang on the least of them: one edge a text and tree.
    leaves = reps.select("doc", "signature").mapInArrow(_prefixes(depth, TREES), "doc long, p long")
    star = leaves.groupBy(_by("p")).agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("_by.p", "least")
    edges = leaves.join(star, "p").filter("doc <> least").select(F.col("least").alias("a"), F.col("doc").alias("b"))
    groups = components(edges, scratch, "candidates")
    members = groups.unionByName(groups.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "doc")
    members = scratch.store(members.join(reps.drop("signature"), "doc"), "members")
    sizes = members.groupBy(_by("root")).agg(F.count(F.lit(1)).alias("n"), F.sum("shingles").alias("all")).select("_by.root", "n", "all")
    blocks = F.least("n", F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("all") / BLOCK_SHINGLES)))
    placed = members.join(sizes, "root")
    placed = placed.select("doc", "root", "copies", blocks.alias("blocks"), F.pmod(F.xxhash64("doc"), blocks).alias("block"), F.xxhash64("doc_id", "text_hash").alias("_k"))
    placed = scratch.store(placed, "placed")

    # The texts of candidates, one row of those that repeat id and text.
    texts = docs.select(F.xxhash64(F.col("doc_id").cast("long"), text_hash()).alias("_k"), "text")
    texts = texts.join(placed.select("_k"), "_k", "left_semi").groupBy("_k").agg(F.first("text").alias("text"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = placed.join(texts, "_k").select("root", "doc", "copies", "block", "text", other.alias("other"))
    cells = pairs.select("root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.col("block").alias("side"), "doc", "copies", "text")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = cells.repartition(n, "root", "i", "j").sortWithinPartitions("root", "i", "j", "doc")
    linked = scratch.store(cells.mapInArrow(_checker(threshold), "doc long, n_links long, root long"), "linked")

    groups = components(linked.select(F.col("doc").alias("a"), F.col("root").alias("b")), scratch, "classes")
    counts = linked.groupBy("doc").agg(F.sum("n_links").alias("n"))
    of_set = sets.join(groups.withColumnRenamed("node", "doc"), "doc", "left").join(counts, "doc", "left")
    of_set = of_set.select("set_a", "set_b", "set_id", F.coalesce("root", "doc").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    of_set = scratch.store(of_set, "of-set")
    least = of_set.groupBy(_by("root")).agg(F.min("set_id").alias("class_id")).select("_by.root", "class_id")
    found = signed.select("doc_id", "text_hash", "set_a", "set_b").join(of_set.join(least, "root"), ["set_a", "set_b"])
    return found.select("doc_id", "text_hash", "root", "class_id", "set_id", "n_links")


def near_duplicates(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, class_id, set_id, n_links.

    ``set_id`` is the least doc_id among texts with the same set of shingles,
    ``class_id`` the least in the group that links connect (the row's own if
    it is alone), ``n_links`` the number of other rows whose similarity is
    ``threshold`` or more, copies included.  Null and empty texts have no
    shingle and no link.  Rows without a doc_id take part; a group of such
    rows only has a null id."""
    found = grouped(docs, threshold, Scratch(docs.sparkSession, "forest"))
    bare = docs.filter(F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")).select(F.col("doc_id").cast("long").alias("doc_id"))
    bare = bare.select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("set_id"), F.lit(0).cast("long").alias("n_links"))
    return found.select("doc_id", "class_id", "set_id", "n_links").unionByName(bare)


def deduplicate(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the one
    of the least doc_id (null first), of equal ids the least text hash.  Rows
    that repeat id and text are one document, the least by its other columns.
    Null and empty texts stay.  All columns stay as they are, whatever their
    names; they must have an order (no maps)."""
    columns = docs.columns
    scratch = Scratch(docs.sparkSession, "dedup")
    found = scratch.store(grouped(docs.select("doc_id", "text"), threshold, scratch), "found")
    best = found.groupBy(_by("root")).agg(F.min(F.struct("doc_id", "text_hash")).alias("best")).select("_by.root", "best")
    rows = found.groupBy("root", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).join(best, "root")
    rows = rows.select(F.xxhash64("doc_id", "text_hash").alias("_k"), F.struct("doc_id", "text_hash").eqNullSafe(F.col("best")).alias("stays"), "n")
    rows = scratch.store(rows.filter("not stays or n > 1"), "changed")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    keyed = keyed.select("row", F.xxhash64(F.col("row.doc_id").cast("long"), F.xxhash64(F.coalesce("row.text", F.lit("")))).alias("_k"))
    same = keyed.join(rows.select("_k"), "_k", "left_anti").select("row")
    one = keyed.join(rows.filter("stays"), "_k").groupBy("_k").agg(F.min("row").alias("row")).select("row")
    return same.unionByName(one).select(*[F.col("row").getField(c).alias(c) for c in columns])
