"""Approximate search over proximity graphs: bounded neighbour lists per vector, walked by beam search.

Vectors lie in shards: the cell of their nearest centroid, crowded cells dealt out by hash, so a shard has a bounded number of rows.
Each shard has a graph of its own, built in one task: a vector's neighbours are the most similar of its shard, and rows that
have it for a neighbour. The table holds codes, not embeddings: a walk is led by products with codewords, and
only what it ends with is scored by the real vectors. Copies of one vector stand in the graph once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import staged
from .codes import Codebooks, estimates, rescored
from .topk import CentroidCells, rank_matches

GRAPH_SCHEMA = "shard bigint, id bigint, place int, code binary, neighbours array<int>"


@dataclass(frozen=True)
class GraphSize:
    """How a graph is built and walked. Chosen for the size of the store; README has the recall."""

    shard_rows: int = 20_000
    neighbours: int = 24  # of each vector; with those that point back at most twice as many
    beam: int = 64
    entries: int = 32  # rows a walk may start from
    kept: int = 32  # of a query's walks, scored by their vectors


@dataclass(frozen=True)
class GraphIndex:
    """`graph` (shard, id, place in the shard, code, neighbours by place) and `copies` (id, copy) as written tables."""

    graph: DataFrame
    copies: DataFrame
    books: Codebooks
    size: GraphSize


def _sharded(vectors: DataFrame, rows: int, size: GraphSize) -> DataFrame:
    cells = max(1, -(-rows // size.shard_rows))
    if cells == 1:
        return vectors.withColumn("shard", F.lit(0).cast("bigint"))
    near = staged(CentroidCells.train(vectors, cells, 1).vector_cells(vectors).withColumn("cell", F.col("cells")[0]))
    counts = near.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / size.shard_rows).alias("pieces"))  # a row for each cell
    piece = F.pmod(F.xxhash64("id"), F.col("pieces"))
    return near.join(counts, "cell").select("id", "embedding", (F.shiftleft("cell", 32) + piece).alias("shard"))


def _linked(vectors: np.ndarray, m: int) -> list[np.ndarray]:
    """Neighbours of each row by place, most similar first: its m nearest, then up to m that have it among theirs."""
    n, m = len(vectors), min(m, len(vectors) - 1)
    if m < 1:
        return [np.zeros(0, np.int32)] * n
    nearest, scores = np.zeros((n, m), np.int32), np.zeros((n, m))
    for start in range(0, n, 1024):
        products = vectors[start:start + 1024] @ vectors.T
        rows = np.arange(len(products))
        products[rows, start + rows] = -np.inf
        found = np.argpartition(-products, m - 1, axis=1)[:, :m]
        order = np.argsort(-np.take_along_axis(products, found, 1), axis=1, kind="stable")
        nearest[start:start + 1024] = np.take_along_axis(found, order, 1)
        scores[start:start + 1024] = np.take_along_axis(products, nearest[start:start + 1024], 1)
    source, target = np.repeat(np.arange(n, dtype=np.int32), m), nearest.ravel()
    order = np.lexsort((source, -scores.ravel(), target))
    back = np.split(source[order], np.searchsorted(target[order], np.arange(1, n)))
    return [np.concatenate([own, np.setdiff1d(b[:2 * m], own, assume_unique=True)[:m]]).astype(np.int32) for own, b in zip(nearest, back)]


def build_graph(vectors: DataFrame, books: Codebooks, size: GraphSize = GraphSize()) -> GraphIndex:
    """The index of `vectors` (`id, embedding`, ids distinct). Null embeddings are left out."""
    kept = vectors.filter(F.col("embedding").isNotNull()).select("id", "embedding")
    distinct = kept.groupBy("embedding").agg(F.min("id").alias("rep"))
    reps = staged(distinct.select(F.col("rep").alias("id"), "embedding"))
    # Further ids of a vector that several rows share, found by its narrow hash and its first row.
    mark = F.xxhash64("embedding")
    crowded = kept.groupBy(mark.alias("mark")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    alike = kept.withColumn("mark", mark).join(crowded, "mark")
    copies = staged(alike.join(distinct, "embedding").filter("id <> rep").select(F.col("rep").alias("id"), F.col("id").alias("copy")))
    sharded = _sharded(reps, reps.count(), size)

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        points = np.stack(rows["embedding"].to_numpy()).astype(float)
        codes, _ = books.encode(points)
        return pd.DataFrame({"shard": rows["shard"], "id": rows["id"], "place": np.arange(len(rows)),
                             "code": [c.tobytes() for c in codes], "neighbours": _linked(points, size.neighbours)})

    graph = staged(sharded.groupBy("shard").applyInPandas(link, GRAPH_SCHEMA))
    return GraphIndex(graph, copies, books, size)


class Shard:
    """A shard's part of the graph in arrays."""

    def __init__(self, rows: pd.DataFrame, parts: int, size: GraphSize):
        rows = rows.sort_values("place")
        self.ids, self.size = rows["id"].to_numpy(), size
        self.codes = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(-1, parts)
        self.neighbours = rows["neighbours"].to_list()
        self.entries = np.linspace(0, len(rows) - 1, min(size.entries, len(rows))).astype(int)

    def walk(self, lookups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places the walk ends with and their estimates, best first. lookups: (parts, WORDS) of one query."""
        tables = lookups[:, None]
        seen, done = np.zeros(len(self.ids), bool), np.zeros(len(self.ids), bool)
        beam = self.entries
        seen[beam] = True
        scores = estimates(tables, self.codes[beam])[0]
        while True:
            order = np.lexsort((beam, -scores))[:self.size.beam]
            beam, scores = beam[order], scores[order]
            ahead = beam[~done[beam]][:4]
            if not len(ahead):
                return beam, scores
            done[ahead] = True
            met = np.unique(np.concatenate([self.neighbours[a] for a in ahead]))
            met = met[~seen[met]]
            seen[met] = True
            beam, scores = np.r_[beam, met], np.r_[scores, estimates(tables, self.codes[met])[0]]


def beam_matches(queries: DataFrame, index: GraphIndex, query_block: int = 4096) -> DataFrame:
    """`query_id, id`: for each query the `kept` best estimates of its walks through all shards. Copies are left out.

    A shard is loaded by one task and walked for each of `query_block` queries, which travel to it; further queries take
    further passes.
    """
    blocks = max(1, -(-queries.count() // query_block))
    part = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    size, found = index.size, None
    for block in range(blocks):
        asked = queries.filter(part == block).select("query_id", "embedding").toPandas()
        shared = queries.sparkSession.sparkContext.broadcast((asked["query_id"].to_numpy(), [
            np.asarray(e, float) for e in asked["embedding"]], index.books))

        def walk(rows: pd.DataFrame) -> pd.DataFrame:
            query_ids, asked, books = shared.value
            shard, out = Shard(rows, len(books.words), size), []
            for query_id, query in zip(query_ids, asked):
                places, scores = shard.walk(books.lookups(query[None])[:, 0])
                out += [(query_id, i, s) for i, s in zip(shard.ids[places[:size.kept]], scores[:size.kept])]
            return pd.DataFrame(out, columns=["query_id", "id", "score"])

        rows = index.graph.groupBy("shard").applyInPandas(walk, "query_id bigint, id bigint, score double")
        found = rows if found is None else found.unionAll(rows)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", best).filter(F.col("place") <= size.kept).select("query_id", "id")


def topk_graph(queries: DataFrame, index: GraphIndex, vectors: DataFrame, k: int, query_block: int = 4096) -> DataFrame:
    """`query_id, id, score, rank` of the k best vectors the walks end with; scores are exact, some of the best may be missed.

    `vectors` holds `id, embedding` of what was indexed. No more than `kept` vectors a query are read and scored; rows with the
    vector of such a one share its score.
    """
    if not 1 <= k <= index.size.kept:
        raise ValueError(f"k must lie in 1..{index.size.kept}, got {k}")
    queries = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull()).toDF("query_id", "embedding")
    pairs = staged(beam_matches(queries, index, query_block))
    best = rank_matches(rescored(pairs, queries, vectors), k).drop("rank")
    few = F.row_number().over(Window.partitionBy("id").orderBy("copy"))
    copies = index.copies.withColumn("place", few).filter(F.col("place") <= k).select("id", "copy")
    doubled = best.join(copies, "id").select("query_id", F.col("copy").alias("id"), "score")
    return rank_matches(best.unionByName(doubled), k)
