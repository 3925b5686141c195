"""Benchmark decontamination by latent semantic retrieval.

Benchmark items and documents are cut into passages of words, weighted by
TF-IDF over the benchmark's terms (frequencies are those of all passages of
the corpus).  Products of the weights of two terms are summed over all
passages; a randomised SVD, whose products run as Spark jobs over these sums,
gives a latent space.  Document passages whose cosine with an item's passage
reaches a limit are candidates.  A candidate is a leak if the
longest common subsequence of the item and the text around the passage
covers most of the item, and, unless it covers nearly all, if the item's
answer is there too.

A benchmark of any size is taken in blocks of items, each a stated query
set against all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctscreen.llm.common import PUNCTUATION, Scratch, chunks, fold_case, hash_spans, hash_words, text_bytes, word_bounds

#: Words of a passage; the next one begins half a passage later.
PASSAGE = 32
ITEMS, RANK, OVERSAMPLING, ROUNDS = 1024, 256, 16, 2
#: Sums of term pairs that a task holds at once (more are counted in as many
#: passes over the documents), and that a row of the stored sums holds.
HELD, STORED = 1 << 24, 1 << 15
#: A product of 1 in these sums: whole numbers add up alike in any order.
UNIT = 1 << 24
COSINE = 0.45
LCS, NEARLY_ALL, ANSWER = 0.6, 0.8, 0.5
_HALF = PASSAGE // 2


def word_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per chunk of rows: first row, word hashes, places at which each row's
    begin.  Words are letters, digits and _ in lower case."""
    data, offs = text_bytes(column)
    for a, b in chunks(offs):
        low = fold_case(data[offs[a] : offs[b]], latin=True)
        starts, ends, at = word_bounds(low, offs[a : b + 1] - offs[a], PUNCTUATION)
        yield a, hash_spans(low, starts, ends).view(np.int64), at


class Vocabulary:
    """Places of hashes in a sorted array, with a bitmap in front of the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        self.bits = max(16, int(len(hashes)).bit_length() + 6)
        self.map = np.zeros(1 << self.bits, bool)
        self.map[self._slot(hashes)] = True

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return h & ((1 << self.bits) - 1)

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of known words, and their places."""
        some = np.flatnonzero(self.map[self._slot(h)])
        k = np.minimum(np.searchsorted(self.hashes, h[some]), len(self.hashes) - 1)
        real = self.hashes[k] == h[some]
        return some[real], k[real]


@dataclass(frozen=True)
class Items:
    """A block of the benchmark: ids, words, and where each one's answer (its last sentence) begins."""

    ids: list
    words: list[np.ndarray]
    answer: list[int]


def _items(rows: list[tuple]) -> Items:
    texts = [t for _, t in rows]
    words = hash_words(texts, PUNCTUATION, latin=True)
    ends = [max((t.rstrip(" .!?\n").rfind(mark) for mark in (". ", "? ", "! ", ".\n", "\n")), default=-1) + 1 for t in texts]
    before = hash_words([t[:k] for t, k in zip(texts, ends, strict=True)], PUNCTUATION, latin=True)
    return Items([i for i, _ in rows], [w.view(np.int64) for w in words], [len(b) for b in before])


def _blocks(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-passage number of each word; the row and the first word of each half passage."""
    n = np.diff(at)
    per = -(-n // _HALF)
    first = np.append(0, np.cumsum(per))
    row = np.repeat(np.arange(len(n)), per)
    inner = np.arange(first[-1]) - first[row]
    of_word = np.repeat(first[:-1], n) + (np.arange(len(words)) - np.repeat(at[:-1], n)) // _HALF
    return of_word, row, at[row] + inner * _HALF


def _frequencies(vocabulary: Vocabulary):
    """Passages that hold each known term, and (term -1) all passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, total = np.zeros(len(vocabulary.hashes), np.int64), 0
        for batch in batches:
            for _, h, at in word_hashes(batch.column(0)):
                half, row, _ = _blocks(h, at)
                pos, term = vocabulary.find(h)
                both = np.unique(half[pos] * len(df) + term)
                df += np.bincount(both % len(df), minlength=len(df))
                total += len(row)
        k = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(k, -1)), pa.array(np.append(df[k], total))], names=["term", "n"])

    return count


def _passages(words: np.ndarray, vocabulary: Vocabulary) -> list[np.ndarray]:
    """Terms of each passage of one text (every half passage begins one)."""
    out = []
    for a in range(0, max(1, len(words) - _HALF), _HALF):
        out.append(vocabulary.find(words[a : a + PASSAGE])[1])
    return out


def _vector(terms: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    t, n = np.unique(terms, return_counts=True)
    return t, n * idf[t]


def _weights(h: np.ndarray, at: np.ndarray, vocabulary: Vocabulary, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Passage, term and weight of the TF-IDF matrix of a few texts, by passage
    and term, and each passage's text; the passages have unit length."""
    half, row, _ = _blocks(h, at)
    if not len(row):
        return *(np.zeros(0, np.int64),) * 2, np.zeros(0), row
    pos, term = vocabulary.find(h)
    block = half[pos]
    same = np.append(row[1:] == row[:-1], False)  # the next half is of the same text
    first = np.append(True, ~same[:-1])
    # The last half of a text begins no passage, unless it is the only one.
    begins, ends = (same | first)[block], ~first[block]
    key, n = np.unique(np.append(block[begins] * len(idf) + term[begins], (block[ends] - 1) * len(idf) + term[ends]), return_counts=True)
    passage, term = np.divmod(key, len(idf))
    w = n * idf[term]
    return passage, term, w / np.sqrt(np.maximum(np.bincount(passage, w * w, len(row)), 1e-24))[passage], row


def _row_starts(terms: int) -> np.ndarray:
    """Places at which the rows of an upper triangle begin, and its size."""
    return np.append(0, np.cumsum(np.arange(terms, 0, -1)))


def _row_ranges(start: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of rows of up to ``most`` entries together (a longer row alone)."""
    out, a = [], 0
    while a < len(start) - 1:
        b = max(a + 1, int(np.searchsorted(start, start[a] + most, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def _pairs(vocabulary: Vocabulary, idf: np.ndarray, rows: tuple[int, int]):
    """Sums over passages of the products of two terms' weights, for first
    terms of ``rows``: the upper triangle, its diagonal halved."""
    start = _row_starts(len(idf))
    lo, hi = rows

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(start[hi] - start[lo], np.int64)
        for batch in batches:
            factor = batch.column(1).to_numpy() * UNIT
            for a, h, at in word_hashes(batch.column(0)):
                passage, term, w, row = _weights(h, at, vocabulary, idf)
                place = start[term] - start[lo] - term
                left = np.flatnonzero((term >= lo) & (term < hi))
                w_left = w * factor[a + row[passage]]
                np.add.at(total, place[left] + term[left], np.rint(w_left[left] * w[left] / 2).astype(np.int64))
                for k in range(1, PASSAGE):
                    left = left[: np.searchsorted(left, len(term) - k)]
                    left = left[passage[left] == passage[left + k]]
                    if not len(left):
                        break
                    np.add.at(total, place[left] + term[left + k], np.rint(w_left[left] * w[left + k]).astype(np.int64))
        for a, b in _row_ranges(start, STORED):
            a, b = max(a, lo), min(b, hi)
            part = total[start[a] - start[lo] : start[b] - start[lo]] if a < b else total[:0]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([a]), pa.array([b]), pa.array([part.tobytes()], pa.binary())], names=["first", "last", "part"])

    return add


_SUMS = "first long, last long, part binary"


def _added(table: pa.Table) -> pa.Table:
    total = 0
    for part in table.column("part"):
        total = total + np.frombuffer(part.as_buffer(), np.int64)
    return pa.table({"first": table.column("first").slice(0, 1), "last": table.column("last").slice(0, 1), "part": pa.array([total.tobytes()], pa.binary())})


def term_products(passages: DataFrame, vocabulary: Vocabulary, idf: np.ndarray) -> DataFrame:
    """The TF-IDF matrix's products of two columns over the passages of all
    rows (text, weight): first and last term of a range of rows, and their
    part of the upper triangle, in units of 1/UNIT.

    A task's sums do not grow with its rows, so there is a task for each
    core rather than for each split."""
    cores = passages.sparkSession.sparkContext.defaultParallelism
    start = _row_starts(len(idf))
    parts = None
    for rows in _row_ranges(start, HELD):
        part = passages.coalesce(cores).mapInArrow(_pairs(vocabulary, idf, rows), _SUMS)
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("first", "last").applyInArrow(_added, _SUMS)


def _product(q: np.ndarray):
    """Stored sums times q; rows go out in blocks of terms."""
    start = _row_starts(len(q))

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(q)
        for batch in batches:
            for a, b, part in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                flat = np.frombuffer(part, np.int64)
                upper = np.zeros((b - a, len(q) - a))
                for r in range(a, b):
                    upper[r - a, r - a :] = flat[start[r] - start[a] : start[r + 1] - start[a]]
                total[a:b] += upper @ q[a:] / UNIT
                total[a:] += upper.T @ q[a:b] / UNIT
        k = [a for a in range(0, len(total), 256) if total[a : a + 256].any()]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(k, np.int64)), pa.array([total[a : a + 256].tobytes() for a in k], pa.binary())], names=["block", "part"])

    return product


def _summed(table: pa.Table) -> pa.Table:
    parts = [np.frombuffer(x, np.float64) for x in table.column("part").to_pylist()]
    return pa.table({"block": table.column("block").slice(0, 1), "part": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})


def latent_space(passages: DataFrame, vocabulary: Vocabulary, idf: np.ndarray, rank: int = RANK, seed: int = 7, scratch: Scratch | None = None) -> np.ndarray:
    """Terms by dimensions: an orthonormal basis of the leading right singular
    vectors of the passages' TF-IDF matrix, by the randomised range finder
    with ``ROUNDS`` power iterations.  All rows of ``passages`` (column text,
    and weight if not 1) are read once for the terms' products, which are
    stored; each product with them is one Spark job.  They and the basis are
    as large as the block's vocabulary asks, whatever the corpus."""
    terms = len(vocabulary.hashes)
    k = min(terms, rank + OVERSAMPLING)
    q = np.random.default_rng(seed).standard_normal((terms, k))
    passages = passages.select("text", F.col("weight") if "weight" in passages.columns else F.lit(1.0).alias("weight"))
    scratch = scratch or Scratch(passages.sparkSession, "space")
    sums = scratch.store(term_products(passages, vocabulary, idf), "products")
    for _ in range(ROUNDS):
        q, _ = np.linalg.qr(q)
        parts = sums.mapInArrow(_product(q), "block long, part binary").groupBy("block").applyInArrow(_summed, "block long, part binary").collect()
        z = np.zeros((terms, k))
        for row in parts:
            part = np.frombuffer(row["part"], np.float64).reshape(-1, k)
            z[row["block"] : row["block"] + len(part)] = part
        u, s, _ = np.linalg.svd(z, full_matrices=False)
        q = u
    return u[:, : min(rank, k)][:, s[: min(rank, k)] > 1e-6 * s[0]]


@dataclass(frozen=True)
class Index:
    """What tasks need to check documents against one block of items.  Its
    size follows ITEMS, RANK and the items' words, not the corpus."""

    items: Items
    vocabulary: Vocabulary
    idf: np.ndarray
    space: np.ndarray  # a term's latent vector times its IDF
    passages: np.ndarray  # latent vectors of unit length of the items' passages
    item_of: np.ndarray
    rare: np.ndarray  # per term: 1 among the rarer ones of an item by IDF, 2 if the item is a word
    longest: int


def rarer(n: int) -> int:
    """How many of an item's ``n`` words count as rare: half, or as many that
    a text which keeps a share of LCS of the words keeps two rare ones."""
    return min(n, max(n // 2, n - math.ceil(LCS * n) + 2))


def build_index(items: Items, own: DataFrame, docs: DataFrame, seed: int = 7, scratch: Scratch | None = None) -> Index:
    """``own`` holds the items' texts.  The latent space is fitted to them and
    to every document; both weigh the same, so that the benchmark's terms keep
    their share of it in a corpus of any size."""
    vocabulary = Vocabulary(np.unique(np.concatenate(items.words)))
    counted = docs.select("text").mapInArrow(_frequencies(vocabulary), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(len(vocabulary.hashes)), 0
    for r in counted:
        if r["term"] < 0:
            total = r["n"]
        else:
            df[r["term"]] = r["n"]
    idf = np.log((total + 1) / (df + 1)) + 0.01
    passages = sum(len(_passages(w, vocabulary)) for w in items.words)
    both = docs.select("text", F.lit(1.0).alias("weight")).unionByName(own.select("text", F.lit(max(total, 1) / passages).alias("weight")).coalesce(1))
    space = latent_space(both, vocabulary, idf, seed=seed, scratch=scratch)
    vectors, item_of, rare = [], [], np.zeros(len(idf), np.int64)
    for k, w in enumerate(items.words):
        for terms in _passages(w, vocabulary):
            t, x = _vector(terms, idf)
            v = x @ space[t]
            vectors.append(v / max(np.linalg.norm(v), 1e-12))
            item_of.append(k)
        terms = vocabulary.find(w)[1]
        upper = terms[np.argsort(-idf[terms], kind="stable")][: rarer(len(terms))]
        rare[upper] = np.maximum(rare[upper], 2 if len(terms) == 1 else 1)
    return Index(items, vocabulary, idf, (space * idf[:, None]).astype(np.float32), np.array(vectors, np.float32), np.array(item_of), rare, max(map(len, items.words)))


def common_subsequence(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    places: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = places.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def is_leak(item: np.ndarray, answer: int, region: np.ndarray) -> tuple[bool, float]:
    """Whether ``region`` of a text holds ``item`` or a paraphrase of it, and how much of it."""
    share = common_subsequence(item, region) / len(item)
    if share >= NEARLY_ALL:
        return True, share
    part = item[answer:] if answer < len(item) else item
    return share >= LCS and common_subsequence(part, region) >= ANSWER * len(part), share


def candidates(index: Index, h: np.ndarray, at: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, int]]:
    """(row, first word, item) of passages whose cosine with an item's reaches
    the limit; ``known`` are the places and terms of the benchmark's words.

    A passage with fewer than two rare words of the benchmark is left out
    before: a text that keeps a share of LCS of an item's words keeps two of
    its rare ones, whichever words it leaves out (see ``rarer``)."""
    half, row, first = _blocks(h, at)
    if not len(row):
        return
    pos, term = known
    block = half[pos]
    score = np.bincount(block, index.rare[term], len(row))
    follows = np.append(row[1:] == row[:-1], False)
    pair = score + np.where(follows, np.append(score[1:], 0), 0)
    wanted = np.flatnonzero(pair >= 2)
    cut = np.searchsorted(block, np.arange(len(row) + 1))
    for a in range(0, len(wanted), 4096):
        part = wanted[a : a + 4096]
        # Latent vectors add up, so a passage is the sum of its two halves.
        needed = np.unique(np.append(part, part[follows[part]] + 1))
        size = cut[needed + 1] - cut[needed]
        needed, size = needed[size > 0], size[size > 0]
        order = np.argsort(-size, kind="stable")
        needed, size = needed[order], size[order]
        halves = np.zeros((len(needed) + 1, index.space.shape[1]), np.float32)  # the last: no half
        for k in range(int(size[0]) if len(size) else 0):
            longer = int(np.searchsorted(-size, -k, "left"))  # halves of more than k words
            halves[:longer] += index.space[term[cut[needed[:longer]] + k]]
        slot = np.full(len(row) + 1, len(needed))
        slot[needed] = np.arange(len(needed))
        vectors = halves[slot[part]] + halves[np.where(follows[part], slot[part + 1], len(needed))]
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        near = vectors @ index.passages.T
        for r, p in zip(*np.nonzero(near >= COSINE), strict=True):
            yield int(row[part[r]]), int(first[part[r]]), int(index.item_of[p])


def leaks_of(index: Index, column: pa.Array) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, share, first word of the passage) of each leak in a column of texts."""
    terms_of: dict[int, np.ndarray] = {}
    for a, h, at in word_hashes(column):
        best: dict[tuple[int, int], tuple[float, int]] = {}
        tried = set()
        pos, term = index.vocabulary.find(h)
        before = np.searchsorted(pos, np.arange(len(h) + 1))  # known words before each word
        for row, first, item in candidates(index, h, at, (pos, term)):
            words = index.items.words[item]
            if (row, first, item) in tried or best.get((row, item), (0.0,))[0] == 1.0:
                continue
            tried.add((row, first, item))
            lo, hi = max(at[row], first - len(words)), min(at[row + 1], first + PASSAGE + len(words))
            if item not in terms_of:
                terms_of[item] = np.zeros(len(index.idf), bool)
                terms_of[item][index.vocabulary.find(words)[1]] = True
            # No common subsequence is longer than the words there that the item has.
            if np.count_nonzero(terms_of[item][term[before[lo] : before[hi]]]) / len(words) < LCS:
                continue
            leak, share = is_leak(words, index.items.answer[item], h[lo:hi])
            if leak and share > best.get((row, item), (0.0,))[0]:
                best[row, item] = share, first - int(at[row])
        for (row, item), (share, place) in sorted(best.items()):
            yield a + row, item, share, place


def item_blocks(benchmark: DataFrame, per_block: int = ITEMS) -> Iterator[list[tuple]]:
    """(item_id, text) of items with words, ``per_block`` or fewer at a time on average."""
    items = benchmark.select("item_id", "text").filter(F.col("text").rlike(r"[0-9A-Za-z_\x{80}-\x{10FFFF}]")).distinct()
    n = items.count()
    blocks = -(-n // per_block)
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = [(r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect()]
        if rows:
            yield rows


def _indexes(docs: DataFrame, benchmark: DataFrame, label: str) -> Iterator[Index]:
    """An index for each block of items, fitted to all documents."""
    spark = docs.sparkSession
    for k, rows in enumerate(item_blocks(benchmark)):
        own = spark.createDataFrame(rows, "item_id long, text string").select("text")
        yield build_index(_items(rows), own, docs, scratch=Scratch(spark, f"{label}-{k}"))


_LEAKS = "doc_id long, item_id long, share double, first_word long"


def _finder(index: Index):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(leaks_of(index, batch.column(1)))
            take = pa.array([r for r, *_ in rows], pa.int64())
            ids = pa.array([index.items.ids[i] for _, i, _, _ in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take).cast(pa.int64()), ids, pa.array([s for _, _, s, _ in rows], pa.float64()), pa.array([w for *_, w in rows], pa.int64())], names=["doc_id", "item_id", "share", "first_word"])

    return find


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, share, first_word of every document that holds a
    benchmark item or a paraphrase of it: the share of the item's words that
    is there in order, and the word at which the best passage begins.

    Null and empty texts and items hold nothing; rows that repeat an id are
    each searched.  Without items the result is empty."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], _LEAKS)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for index in _indexes(docs, benchmark, "leaks"):
        out = out.unionByName(docs.mapInArrow(_finder(index), _LEAKS))
    return out


def _cleaner(index: Index, text: int):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for row, *_ in leaks_of(index, batch.column(text)):
                keep[row] = False
            yield batch.filter(pa.array(keep))

    return clean


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a leak.  All columns stay."""
    names = docs.columns
    out = docs
    for index in _indexes(docs.select("doc_id", "text"), benchmark, "clean"):
        out = out.mapInArrow(_cleaner(index, names.index("text")), docs.schema)
    return out
