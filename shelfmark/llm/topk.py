"""Exact top-k by inner product over an impact-ordered index, processed score at a time.

A block of vectors is indexed by postings (dimension, level): the rows whose component there falls in one of a few
levels. For a query a posting has an impact, the least its rows gain over the lowest level of that dimension. Postings are
processed by descending impact. After each share of them every row has a proven range: what it has gained, plus
at most what the postings not yet processed can add, plus what the levels hide. Processing stops once only few
rows can still reach the k-th best proven score; those rows are scored exactly. Queries are a stated share of the rows; query
blocks meet vector blocks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from .common import buckets_for

VECTOR_BLOCK, QUERY_BLOCK = 8192, 4096
LEVELS, STEPS, FEW = 64, 8, 256
EXACT_LIMIT = 2 ** 26  # components up to here: 64-bit sums of up to 2,048 products are exact


class ImpactIndex:
    """The postings of a block: integer vectors of one dimension, rows in order of id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, levels: int = LEVELS):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.postings, low, high, dim = [], [], [], []
        self.width = np.zeros((n, dims))  # of the level that holds a row's component
        for d in range(dims):
            for rows in np.array_split(np.argsort(vectors[:, d], kind="stable"), min(levels, n)):
                self.postings.append(rows.astype(np.int32))
                low.append(vectors[rows[0], d])
                high.append(vectors[rows[-1], d])
                dim.append(d)
                self.width[rows, d] = float(high[-1]) - float(low[-1])
        self.low, self.high, self.dim = np.array(low, float), np.array(high, float), np.array(dim, np.int64)
        self.sizes = np.array([len(p) for p in self.postings], np.int64)

    def possible(self, query: np.ndarray, k: int, steps: int = STEPS, few: int = FEW) -> np.ndarray:
        """Rows that can be among the k best; all others are proven not to be."""
        n, dims = self.vectors.shape
        q = query.astype(float)
        ends = np.sort(np.stack([q[self.dim] * self.low, q[self.dim] * self.high]), axis=0)
        base = np.full(dims, np.inf)
        np.minimum.at(base, self.dim, ends[0])
        gain = ends[0] - base[self.dim]  # what a posting's rows have at least, over the lowest of the dimension
        rounding = 1e-9 * (1 + np.abs(ends).max(initial=0) * dims)
        order = np.argsort(-gain, kind="stable")
        hidden = self.width @ np.abs(q)  # at most so much more than the sum of its gains has a row
        least, rows, done = np.zeros(n), np.arange(n), 0
        for part in np.array_split(order, steps):
            if len(part):
                met = np.concatenate([self.postings[p] for p in part.tolist()])
                least += np.bincount(met, np.repeat(gain[part], self.sizes[part]), n)
            done += len(part)
            left = np.zeros(dims)  # the most that a posting not yet processed gains, per dimension
            np.maximum.at(left, self.dim[order[done:]], gain[order[done:]])
            kth = np.partition(least, n - k)[n - k] if n > k else -np.inf
            rows = np.flatnonzero(least + hidden + (left.sum() + rounding) >= kth)
            if len(rows) <= few:
                break
        return rows

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows other than the query's own, ties to the smaller id."""
        rows = self.possible(query, k + int((self.ids == query_id).sum()))
        rows = rows[self.ids[rows] != query_id]
        scores = exact_scores(self.vectors[rows], query)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][best], scores[best]


def exact_scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    if not len(vectors) or max(np.abs(vectors).max(initial=0), np.abs(query).max(initial=0)) <= EXACT_LIMIT:
        return vectors @ query
    sums = vectors.astype(object) @ query.astype(object)  # Python integers; a score past 64 bits is held at the edge
    return np.array([min(max(s, -2 ** 63 + 1), 2 ** 63 - 1) for s in sums], np.int64)


def integer_vectors(embeddings: DataFrame, scale: int = 1024) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component. Without rows that take no part."""
    x = F.transform("embedding", lambda c: F.floor(F.greatest(
        F.least(c.cast("double") * scale, F.lit(2.0 ** 62)), F.lit(-2.0 ** 62))))
    unfit = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~unfit).select(
        F.col("vec_id").cast("long").alias("vec_id"), x.alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of `vectors` for each row of `queries` (both vec_id, v).

    A query's own id is no candidate; ties go to the smaller vec_id, so the order is total but for repeated rows.
    Vectors meet queries of their own length only. A repeated row is a candidate each time, a repeated query counts
    once. Queries without candidates have no rows.
    """
    queries = queries.dropDuplicates(["vec_id", "v"])
    n_vectors, n_queries = vectors.count(), queries.count()
    v_blocks, q_blocks = buckets_for(n_vectors, VECTOR_BLOCK), buckets_for(n_queries, QUERY_BLOCK)

    def blocks(frame: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        return frame.select(
            F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other), "vec_id", "v")

    cell = ["dims", "v_block", "q_block"]
    stored = blocks(vectors, "v_block", v_blocks, "q_block", q_blocks).groupBy(*cell)
    asked = blocks(queries, "q_block", q_blocks, "v_block", v_blocks).groupBy(*cell)

    def search(rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": [], "query": [], "vec_id": [], "score": []}).astype("int64")]
        if len(rows) and len(wanted):
            ids = rows["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            index = ImpactIndex(ids[order], np.stack(rows["v"].to_numpy())[order])
            for query_id, query in zip(wanted["vec_id"], wanted["v"]):
                near, scores = index.best(query_id, query, k)
                mark = int.from_bytes(xxhash.xxh64_digest(query.tobytes()), "little", signed=True)
                found.append(pd.DataFrame({"query_id": query_id, "query": mark, "vec_id": near, "score": scores}))
        return pd.concat(found)

    found = stored.cogroup(asked).applyInPandas(search, "query_id long, query long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
