"""What the operators share: stored tables and text as arrays of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acctscreen.plans.materialize import run_root, write_and_read


#: Rows that go to Python at once, where the session has Spark's default of
#: 10,000: whole texts are long, and both sides hold a batch outside the heap.
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = "1000"


class Scratch:
    """Tables that one run of an operator writes under the cluster's shared
    checkpoint folder: a written table cuts the lineage, so that a lost
    executor costs a re-read and not a recomputation."""

    def __init__(self, spark: SparkSession, label: str):
        self.root = run_root(spark, f"llm-{label}")
        if spark.conf.get(BATCH) == "10000":
            spark.conf.set(BATCH, BATCH_ROWS)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        return write_and_read(df, f"{self.root}/{name}")


def held_out(doc_id, folds: int):
    """Whether crc32(doc_id as text) mod ``folds`` is 0 (null id: as '')."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, order: Column, name: str, scratch: Scratch) -> DataFrame:
    """``df`` with the place of each row in ``order`` (unique), from 0.  Rows
    are dealt by ranges; each range is numbered by itself and starts where
    the ranges before it end, so no task gets all rows."""
    ranged = scratch.store(df.orderBy(order).withColumn("_range", F.spark_partition_id()), f"{name}-ranges")
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("n"))  # one row for each shuffle partition
    before = sizes.select("_range", (F.sum("n").over(Window.orderBy("_range")) - F.col("n")).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return ranged.withColumn(name, own).join(before, "_range").withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_range", "_before")


def least_by_hash(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """The ``k`` rows of ``df`` that are least by a hash of ``columns`` (ties by
    the columns), a sample that is the same in every run.  Rows far beyond
    the k-th are left out before, by how many rows there are, so that tasks
    together pass on little more than ``k`` rows."""
    digest = F.xxhash64(*columns)
    n = df.count()
    if n > 4 * k:
        df = df.filter(digest < int((2 * k / n - 0.5) * 2**64))
    return df.orderBy(digest, *columns).limit(k)


# -- text as bytes -------------------------------------------------------------

_ASCII_SPACE = np.zeros(256, bool)
_ASCII_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Separators of words: ASCII white space, or all ASCII but letters, digits and _.
SPACE, PUNCTUATION = _ASCII_SPACE, _NOT_WORD

_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_R, -1, 1 << 64)


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64.  Not kept: what a module keeps is
    made anew, and left behind, by every task that gets its functions."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:  # the next as many are those times base**have
        more = min(have, n - have)
        np.multiply(out[:more], np.uint64(pow(base, have, 1 << 64)), out=out[have : have + more])
        have += more
    return out[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(column):
        return raw[:0], np.zeros(1, np.int64)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to ``most`` bytes together (a longer row alone)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + most, "right")) - 1)
        yield a, b
        a = b


def fold_case(data: np.ndarray, latin: bool = False) -> np.ndarray:
    """Bytes with A-Z in lower case, and with ``latin`` U+00C0..U+00DE too."""
    low = _LOWER[data]
    if latin and len(low) > 1:
        up = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        low[1:][up] += 0x20
    return low


def word_bounds(data: np.ndarray, offs: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of rows ``offs`` of ``data``, and the n + 1
    places in them at which each row's words begin.  No word spans two rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    word = ~separators[data]
    before = np.empty_like(word)
    before[0], before[1:] = False, word[:-1]
    cut = offs[1:-1]
    cut = cut[cut < len(data)]
    before[cut] = False
    starts = np.flatnonzero(word & ~before)
    after = np.empty_like(word)
    after[-1], after[:-1] = False, word[1:]
    after[cut[cut > 0] - 1] = False
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offs, "left")


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends]; equal bytes have equal hashes anywhere."""
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_R, len(data)), out=total[1:])
    h = (total[ends] - total[starts]) * _power(_INVERSE, len(data) + 1)[starts]
    return mix(h ^ (ends - starts).astype(np.uint64))


def hash_words(texts: list[str], separators: np.ndarray, latin: bool = False) -> list[np.ndarray]:
    """The word hashes of a few texts, as the operators' tasks compute them."""
    data, offs = text_bytes(pa.array(texts, pa.string()))
    low = fold_case(data, latin)
    starts, ends, at = word_bounds(low, offs, separators)
    h = hash_spans(low, starts, ends)
    return [h[at[i] : at[i + 1]] for i in range(len(texts))]


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of values[at[i]:at[i+1]]; 0 for an empty range."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]
