"""Exact top-k by inner product, with segment statistics at several resolutions.

A vector is cut into segments; with mean m and deviation s of a segment of n
components, sum(q*x) over the segment is at most n*(m_q*m_x + s_q*s_x).  The
sum over segments bounds the score from above (for squared distances, from
below).  Bounds go from coarse to fine and only what may still reach a
query's k-th best score is computed exactly.  Queries meet all candidates in
blocks; a task holds one block of either.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctscreen.llm.common import Scratch

TOP = 20
SCALE = 64
#: Segments of each resolution, coarse to fine.
LEVELS = (1, 4, 16)
QUERY_BLOCK = 512
ROW_BLOCK = 8192


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(n) * (mean, deviation) of each segment: the product of two rows is the bound."""
    cuts = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)
    parts = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        seg = x[:, a:b]
        mean = seg.mean(axis=1)
        parts += [mean * np.sqrt(b - a), np.sqrt(np.maximum(((seg - mean[:, None]) ** 2).sum(axis=1), 0))]
    return np.stack(parts, axis=1) if parts else np.zeros((len(x), 1))


def best(q_ids, q, ids, x, k: int = TOP, levels: tuple[int, ...] = LEVELS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, score) of each query's k best rows of another id.
    Scores are sums of products of whole numbers, exact below 2**53."""
    if not len(q) or not len(x):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64)
    stats = [(statistics(q, n), statistics(x, n)) for n in levels]
    slack = 1e-9 * (1 + np.linalg.norm(q, axis=1) * np.linalg.norm(x, axis=1).max())
    order = np.lexsort((ids,))  # ties go to the smaller id
    ids, x, stats = ids[order], x[order], [(a, b[order]) for a, b in stats]
    out_q, out_x, out_s = [], [], []
    coarse = stats[0][0] @ stats[0][1].T
    for i in range(len(q)):
        own = ids != q_ids[i]
        n = int(own.sum())
        if n > 4 * k:
            bound = np.where(own, coarse[i], -np.inf)
            first = np.argpartition(-bound, 2 * k)[: 2 * k]
            least = np.partition(x[first] @ q[i], -k)[-k]  # the k-th best score is this or more
            left = np.flatnonzero(bound >= least - slack[i])
            for a, b in stats[1:]:
                left = left[b[left] @ a[i] >= least - slack[i]]
        else:
            left = np.flatnonzero(own)
        score = np.rint(x[left] @ q[i])
        top = np.argsort(-score, kind="stable")[:k]
        out_q.append(np.full(len(top), i))
        out_x.append(order[left[top]])
        out_s.append(score[top].astype(np.int64))
    return np.concatenate(out_q), np.concatenate(out_x), np.concatenate(out_s)


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of floor(64 * x); a shorter vector is filled up with zeros."""
    rows = [np.floor(SCALE * np.asarray(v, np.float64)) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _searched(k: int):
    def search(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        both = _matrix(pd.concat([queries["embedding"], rows["embedding"]]))
        n = len(queries)
        q_ids, ids = queries["vec_id"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
        i, j, score = best(q_ids, both[:n], ids, both[n:], k)
        return pd.DataFrame({"query_id": q_ids[i], "vec_id": ids[j], "score": score})

    return search


def top_k(embeddings: DataFrame, every: int = 20, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` highest integer inner
    products of each row whose vec_id is divisible by ``every`` with all rows
    of other ids; ties to the smaller vec_id, all if there are fewer than k.

    Vectors that are null or hold null or non-finite components and rows
    without an id take no part.  Rows repeated in id and vector count once;
    rows of one id and unlike vectors are each a row."""
    scratch = Scratch(embeddings.sparkSession, "topk")
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = embeddings.filter(F.col("vec_id").isNotNull() & x.isNotNull() & finite).select("vec_id", F.transform(x, lambda v: v.cast("double")).alias("embedding"))
    rows = rows.distinct()
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("q")).first()
    n_x, n_q = max(1, -(-sizes["n"] // ROW_BLOCK)), max(1, -(-sizes["q"] // QUERY_BLOCK))
    rows = scratch.store(rows.withColumns({"x": F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_x)), "q": F.pmod(F.xxhash64("embedding", "vec_id"), F.lit(n_q))}), "rows")
    block = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    queries = rows.filter(F.col("vec_id") % every == 0).select("vec_id", "embedding", "q", block(n_x).alias("x"))
    others = rows.select("vec_id", "embedding", block(n_q).alias("q"), "x")
    found = queries.groupBy("q", "x").cogroup(others.groupBy("q", "x")).applyInPandas(_searched(k), "query_id long, vec_id long, score long")
    # At most k rows of each query and block of rows come here.
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
