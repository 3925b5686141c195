"""Phrase collocations by vertically partitioned suffix subtrees.

Phrases are counted in the suffix tree of the corpus's words, cut at four
words' depth and never built as a whole: the suffixes are dealt out by their
first two words into groups that a memory budget bounds, each group's subtree
is built by itself from its sorted suffixes, and a phrase's count is the
number of leaves below its node.  A pair with more suffixes than the budget
is dealt out by the words after it too, and its parts are added up.

Only suffixes whose pairs of neighbours are frequent reach a group: pairs are
counted first, and tasks hold fixed-size bit tables of the frequent words and
pairs.  A bit that two share lets more suffixes through and changes no count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch, chunks, fold_case, hash_spans, mix, text_bytes, word_bounds

LEAST = 30  # occurrences of a candidate
LONGEST = 4  # words of a phrase
TOP = 2000  # phrases of a language
COVERED = 80  # percent of a phrase's occurrences that are inside a longer candidate

#: Suffixes of a group: some 40 bytes each, and a few times that while sorting.
BUDGET = 1_000_000
#: Bits of the tables of frequent words and pairs (4 and 16 MB at any size of the corpus).
WORD_BITS, PAIR_BITS = 25, 27
#: Buckets of pairs that are dealt to groups as a whole.
BUCKETS = 1 << 16
#: Rows that a task holds before it adds up equal ones and passes them on.
HELD = 1 << 21

_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_SEPARATORS = _ENDS.copy()
_SEPARATORS[[0x20, 0x09]] = True

W = ["w1", "w2", "w3", "w4"]


# -- words of a language as numbers --------------------------------------------

def _language_hash(langs: list[str]) -> np.ndarray:
    """Hashed once more than words are, so that a language's name is not as good as that word."""
    data, offs = text_bytes(pa.array(langs, pa.string()))
    return mix(hash_spans(data, offs[:-1], offs[1:]) + np.uint64(1))


def _words(batch: pa.RecordBatch) -> Iterator[tuple]:
    """For each chunk of the rows (lang, text): lower-cased bytes, starts and
    ends of the words, their numbers (hashes of word and language, never 0),
    the place of each one's language in a list, and whether the next word is
    in the same piece."""
    lang = batch.column(0).fill_null("und").dictionary_encode()
    langs, code = lang.dictionary.to_pylist(), lang.indices.to_numpy(zero_copy_only=False)
    salt = _language_hash(langs)
    data, offs = text_bytes(batch.column(1))
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]])
        starts, ends, at = word_bounds(low, offs[a : b + 1] - offs[a], _SEPARATORS)
        row = np.repeat(np.arange(a, b), np.diff(at))
        w = mix(hash_spans(low, starts, ends) + salt[code[row]])
        w[w == 0] = 1
        piece = np.cumsum(_ENDS[low])[starts] if len(starts) else starts
        linked = np.zeros(len(w), bool)
        linked[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
        yield low, starts, ends, w, langs, code[row], linked


def _summed(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of ``columns`` (the last one: numbers to add up) made one.
    Rows are put in order by a hash; two that share it stay apart."""
    *keys, n = columns
    h = keys[0] if len(keys) == 1 else mix(sum((mix(k + np.uint64(i)) for i, k in enumerate(keys)), np.zeros(len(n), np.uint64)))
    order = np.argsort(h, kind="stable")
    keys = [k[order] for k in keys]
    new = np.ones(len(n), bool)
    if len(n) > 1:
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(n[order], first) if len(first) else n


class _Held:
    """Rows of unsigned numbers and a count, added up when there are many."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.n = names, [], 0

    def add(self, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(columns)
        self.n += len(columns[0])
        if self.n >= HELD:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            keys, n = _summed([np.concatenate(c) for c in zip(*self.parts)])
            yield pa.RecordBatch.from_arrays([*(pa.array(k.view(np.int64)) for k in keys), pa.array(n)], self.names)
        self.parts, self.n = [], 0


# -- passes over the texts -----------------------------------------------------

def _word_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, w, n); languages are held by number."""
    number: dict[str, int] = {}
    names: list[str] = []
    held = _Held(["code", "w", "n"])

    def named(out: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in out:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(b.column(0)), b.column(1), b.column(2)], ["lang", "w", "n"])

    for batch in batches:
        for _, _, _, w, langs, code, _ in _words(batch):
            for x in langs:
                if x not in number:
                    number[x] = len(names)
                    names.append(x)
            own = np.array([number[x] for x in langs], np.uint64)
            (c, u), n = _summed([own[code], w, np.ones(len(w), np.int64)])
            yield from named(held.add(c, u, n))
    yield from named(held.flush())


def _bit(w: np.ndarray, bits: int) -> np.ndarray:
    return (w >> np.uint64(64 - bits)).astype(np.int64)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) + b)


def _isset(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _pair_counter(words: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(["w1", "w2", "n"])
        for batch in batches:
            for _, _, _, w, _, _, linked in _words(batch):
                known = _isset(words, _bit(w, WORD_BITS))
                i = np.flatnonzero(linked[:-1] & known[:-1] & known[1:])
                (a, b), n = _summed([w[i], w[i + 1], np.ones(len(i), np.int64)])
                yield from held.add(a, b, n)
        yield from held.flush()

    return count


def _suffixes(pairs: np.ndarray, first: np.ndarray, parts: np.ndarray):
    """(g, w1, .., w4, n): suffixes of three words or more, cut at four and at
    the first pair that is not frequent; 0 for a word that is cut off."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(["g", *W, "n"])
        for batch in batches:
            for _, _, _, w, _, _, linked in _words(batch):
                pair = np.zeros(len(w) + 2, bool)
                j = np.flatnonzero(linked)
                pair[j] = _isset(pairs, _bit(_pair(w[j], w[j + 1]), PAIR_BITS))
                i = np.flatnonzero(pair[:-2] & pair[1:-1])
                more = pair[i + 2]
                rest = np.where(more, w[np.minimum(i + 3, len(w) - 1)], np.uint64(0)) if len(i) else w[i]
                bucket = _bit(_pair(w[i], w[i + 1]), 16)
                # A bucket of several groups is dealt out by the words after the pair.
                g = first[bucket] + (_pair(w[i + 2], rest) % parts[bucket].astype(np.uint64)).astype(np.int64)
                (g, a, b, c, d), n = _summed([g.view(np.uint64), w[i], w[i + 1], w[i + 2], rest, np.ones(len(i), np.int64)])
                yield from held.add(g, a, b, c, d, n)
        yield from held.flush()

    return deal


def _subtree(whole: np.ndarray, least: int):
    """Nodes of three and four words of one group's subtree, with the leaves
    below them.  Of a bucket that is dealt to several groups the nodes of
    three words are partial, so all of them go on."""

    def build(table: pa.Table) -> pa.Table:
        g = table.column("g")[0].as_py()
        w = [table.column(c).to_numpy() for c in W]
        order = np.lexsort(w[::-1])
        w = [x[order] for x in w]
        n = table.column("n").to_numpy()[order]
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        new = np.ones(len(n), bool)
        new[1:] = (w[0][1:] != w[0][:-1]) | (w[1][1:] != w[1][:-1]) | (w[2][1:] != w[2][:-1])
        for depth in (3, 4):
            if depth == 4:
                new[1:] |= w[3][1:] != w[3][:-1]
            node = np.flatnonzero(new)
            leaves = np.add.reduceat(n, node)
            keep = (leaves >= least) | (not whole[g] and depth == 3)
            if depth == 4:
                keep &= w[3][node] != 0
            node = node[keep]
            for k in range(4):
                out[k].append(w[k][node] if k < depth else np.zeros(len(node), np.int64))
            out[4].append(leaves[keep])
        return pa.table([np.concatenate(c) for c in out], names=[*W, "a"])

    return build


def _texts_of(wanted: np.ndarray):
    """(w, word): the text of words in the bit table, each once for a batch."""

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found: dict[int, str] = {}
            for low, starts, ends, w, _, _, _ in _words(batch):
                i = np.flatnonzero(_isset(wanted, _bit(w, WORD_BITS)))
                u, at = np.unique(w[i], return_index=True)
                for x, k in zip(u.view(np.int64).tolist(), i[at].tolist()):
                    if x not in seen and x not in found:
                        found[x] = low[starts[k] : ends[k]].tobytes().decode()
            if len(seen) < HELD:
                seen.update(found)
            if found:
                yield pa.RecordBatch.from_pydict({"w": pa.array(list(found), pa.int64()), "word": pa.array(list(found.values()), pa.string())})

    return look_up


# -- tables that all tasks hold ------------------------------------------------

def _bit_table(rows: DataFrame, bits: int) -> np.ndarray:
    """A table of 2**bits bits, set for the numbers in ``rows`` (w, or the pair
    w1, w2).  It reaches the driver in 8-byte pieces: as many as the table
    has at most, however many rows there are."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = [batch.column(k).to_numpy().view(np.uint64) for k in range(batch.num_columns)]
            p = _bit(c[0] if len(c) == 1 else _pair(*c), bits)
            yield pa.RecordBatch.from_arrays([pa.array(p >> 6), pa.array(np.uint64(1) << (p & 63).astype(np.uint64)).view(pa.int64())], ["piece", "bits"])

    pieces = rows.mapInArrow(place, "piece long, bits long").groupBy("piece").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), np.int64)
    table[pieces.column("piece").to_numpy()] = pieces.column("bits").to_numpy()
    return table.view(np.uint8)


def _bucket_sizes(pairs: DataFrame) -> np.ndarray:
    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            a, b, k = (batch.column(c).to_numpy() for c in range(3))
            np.add.at(n, _bit(_pair(a.view(np.uint64), b.view(np.uint64)), 16), k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    rows = pairs.select("w1", "w2", "a").mapInArrow(size, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BUCKETS, np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def group_plan(sizes: np.ndarray, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First group and number of groups of each bucket, and of each group
    whether its buckets are in no other.  Small buckets share a group while
    they fit; one beyond the budget has groups of its own."""
    parts = np.maximum(-(-sizes // budget), 1)
    first = np.zeros(len(sizes), np.int64)
    whole: list[bool] = []
    room, current = 0, -1
    for k, n in enumerate(sizes.tolist()):
        if parts[k] > 1:
            first[k] = len(whole)
            whole += [False] * int(parts[k])
        else:
            if n > room or current < 0:
                current, room = len(whole), budget
                whole.append(True)
            first[k], room = current, room - n
    return first, parts, np.array(whole)


# -- phrases -------------------------------------------------------------------

def _key(words: list[Column | str]) -> Column:
    """The four columns of a phrase of fewer words, filled up with 0."""
    cols = [F.col(w) if isinstance(w, str) else w for w in words]
    return F.struct(*[c.alias(n) for c, n in zip([*cols, *[F.lit(0).cast("long")] * (LONGEST - len(cols))], W)])


def _length() -> Column:
    return F.when(F.col("w4") != 0, 4).when(F.col("w3") != 0, 3).when(F.col("w2") != 0, 2).otherwise(1)


def phrase_counts(docs: DataFrame, scratch: Scratch, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Stored tables: words (lang, w, n) and phrases (w1 .. w4, a) of one to
    four words that occur ``least`` times or more."""
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    words = scratch.store(texts.mapInArrow(_word_counter, "lang string, w long, n long").groupBy("lang", "w").agg(F.sum("n").alias("n")), "words")
    known = _bit_table(words.filter(F.col("n") >= least).select("w"), WORD_BITS)
    pairs = texts.mapInArrow(_pair_counter(known), "w1 long, w2 long, n long").groupBy("w1", "w2").agg(F.sum("n").alias("a"))
    pairs = scratch.store(pairs.filter(F.col("a") >= least), "pairs")
    frequent = _bit_table(pairs.select("w1", "w2"), PAIR_BITS)
    first, parts, whole = group_plan(_bucket_sizes(pairs), budget)
    dealt = texts.mapInArrow(_suffixes(frequent, first, parts), "g long, w1 long, w2 long, w3 long, w4 long, n long")
    nodes = dealt.groupBy("g").applyInArrow(_subtree(whole, least), "w1 long, w2 long, w3 long, w4 long, a long")
    deep = nodes.groupBy(*W).agg(F.sum("a").alias("a")).filter(F.col("a") >= least)
    zero = F.lit(0).cast("long")
    single = words.filter(F.col("n") >= least).select(F.col("w").alias("w1"), zero.alias("w2"), zero.alias("w3"), zero.alias("w4"), F.col("n").alias("a"))
    double = pairs.select("w1", "w2", zero.alias("w3"), zero.alias("w4"), "a")
    return words, scratch.store(single.unionByName(double).unionByName(deep), "phrases")


def _scored(phrases: DataFrame) -> DataFrame:
    """Candidates with the lowest-scoring cut (score, l, r)."""
    found = phrases.filter(F.col("w2") != 0).withColumn("d", _length())
    cuts = [
        F.when((F.col("d") == d), F.array(*[F.struct(F.lit(f"{side}{k}").alias("part"), _key(W[:k] if side == "l" else W[k:d]).alias("key")) for k in range(1, d) for side in "lr"]))
        for d in range(2, LONGEST + 1)
    ]
    parts = found.select("*", F.explode(F.coalesce(*cuts)).alias("x")).select(*W, "a", "x.part", F.col("x.key").alias("key"))
    # Grouped on the key as a whole, so that a very common word can be split over tasks.
    counts = phrases.groupBy(_key(W).alias("key")).agg(F.max("a").alias("f"))
    names = [f"{side}{k}" for k in range(1, LONGEST) for side in "lr"]
    joined = parts.join(counts, "key").groupBy(*W, "a").agg(*[F.max(F.when(F.col("part") == x, F.col("f"))).alias(x) for x in names])

    def cut(k: int) -> Column:
        score = F.expr(f"(cast(2000000 as decimal(7, 0)) * cast(a as decimal(19, 0))) div (cast(l{k} as decimal(19, 0)) + cast(r{k} as decimal(19, 0)))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    return joined.select(*W, "a", F.least(*[cut(k) for k in range(1, LONGEST)]).alias("best")).select(*W, "a", "best.score", "best.l", "best.r")


def _uncovered(found: DataFrame, covered: int) -> DataFrame:
    """``found`` without phrases that a longer one mostly explains."""
    inner = [
        F.when(F.col("d") == d, F.array(*[_key(W[i : i + k]) for k in range(2, d) for i in range(d - k + 1)]))
        for d in range(3, LONGEST + 1)
    ]
    longer = found.withColumn("d", _length()).filter(F.col("d") > 2).select("a", F.explode(F.coalesce(*inner)).alias("key"))
    most = longer.groupBy("key").agg(F.max("a").alias("most")).select("key.*", "most")
    share = F.col("most").cast("decimal(19, 0)") * 100 >= F.col("a").cast("decimal(19, 0)") * covered
    return found.join(most, W, "left").filter(~F.coalesce(share, F.lit(False))).drop("most")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """The ``top`` phrases of each language (lang, rank, phrase, a, l, r, n, score).

    A null text is empty, a null lang ``und``; equal rows count each; rows
    of no language or table without a frequent phrase give no row; other
    columns are not looked at.  Ties of score and count go by the phrase."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    words, phrases = phrase_counts(docs, scratch, least, budget)
    scored = scratch.store(_scored(phrases), "scored")
    kept = _uncovered(scored, covered).join(words.filter(F.col("n") >= least).select("lang", F.col("w").alias("w1")), "w1")
    # All ties of the last place stay until their texts are known.
    order = [F.col("score").desc(), F.col("a").desc()]
    kept = scratch.store(kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("place") <= top).drop("place"), "kept")
    at = kept.select("lang", *W, F.posexplode(F.array(*W)).alias("i", "w")).filter(F.col("w") != 0)
    wanted = at.select("w").distinct()
    texts = docs.select(F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), "text")
    spelled = texts.mapInArrow(_texts_of(_bit_table(wanted, WORD_BITS)), "w long, word string").distinct()
    phrase = at.join(spelled, "w").groupBy("lang", *W).agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("x"))
    phrase = phrase.select("lang", *W, F.array_join(F.transform("x", lambda s: s["word"]), " ").alias("phrase"))
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    out = kept.join(phrase, ["lang", *W]).join(total, "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.col("phrase")))
    return out.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
