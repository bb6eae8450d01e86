"""Top-k by inner product: exact, or over candidate cells (random hyperplanes, coarse centroids).

Each vector carries the cells it lies in and each query the cells it probes; only vectors in a
probed cell are scored, always by the exact product. Exact search is the case of one shared cell.
Whatever the method, a task keeps k rows per query: the pairs of a cell are never emitted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.udfs import once

CELLS = T.ArrayType(T.LongType())
MATCH_SCHEMA = "query_id bigint, id bigint, score double"
SCORE_DIGITS = 9  # scores are compared at this precision, so equal vectors tie and the lower id wins


def matrix_of(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _cell_lists(rows: list[np.ndarray]) -> pa.ListArray:
    return pa.array([row.tolist() for row in rows], type=pa.list_(pa.int64()))


@dataclass(frozen=True)
class Exact:
    """Every vector is a candidate."""

    name: str = "exact"
    probes_once = True

    def vector_cells(self, vectors: DataFrame) -> DataFrame:
        return vectors.withColumn("cells", F.array(F.lit(0).cast("bigint")))

    query_cells = vector_cells


@dataclass(frozen=True)
class HyperplaneCells:
    """Sign patterns against +1/-1 hyperplanes, `tables` patterns of `bits` bits each."""

    dim: int
    tables: int = 8
    bits: int = 6
    name: str = "lsh"
    probes_once = False

    def __post_init__(self):
        if not 1 <= self.bits <= 32 or self.tables < 1:
            raise ValueError("bits must lie in 1..32 and tables be positive")

    def planes(self) -> np.ndarray:
        """(tables * bits, dim) signs, each from the MD5 of its place: the same on every machine."""
        names = [f"{t}:{b}:{d}" for t in range(self.tables)
                 for b in range(self.bits) for d in range(self.dim)]
        low = [int(hashlib.md5(n.encode()).hexdigest()[0], 16) < 8 for n in names]
        return np.where(low, 1.0, -1.0).reshape(self.tables * self.bits, self.dim)

    def vector_cells(self, vectors: DataFrame) -> DataFrame:
        planes, tables, bits = self.planes(), self.tables, self.bits

        @F.arrow_udf(CELLS)
        def assign(embedding: pa.Array) -> pa.Array:
            if len(embedding) == 0:
                return _cell_lists([])
            above = (matrix_of(embedding) @ planes.T >= 0).reshape(-1, tables, bits)
            pattern = above @ (1 << np.arange(bits))
            return _cell_lists(list(pattern + (np.arange(tables) << 32)))

        return vectors.withColumn("cells", once(assign)(F.col("embedding")))

    query_cells = vector_cells


@dataclass(frozen=True)
class CentroidCells:
    """Each vector lies in the cell of its nearest centroid; a query probes the `nprobe` nearest."""

    centroids: tuple[tuple[float, ...], ...]
    nprobe: int = 2
    name: str = "ivf"
    probes_once = True

    def _nearest(self, vectors: DataFrame, n: int) -> DataFrame:
        centroids = np.array(self.centroids)

        @F.arrow_udf(CELLS)
        def assign(embedding: pa.Array) -> pa.Array:
            if len(embedding) == 0:
                return _cell_lists([])
            closeness = np.round(matrix_of(embedding) @ centroids.T, SCORE_DIGITS)
            return _cell_lists(list(np.argsort(-closeness, axis=1, kind="stable")[:, :n]))

        return vectors.withColumn("cells", once(assign)(F.col("embedding")))

    def vector_cells(self, vectors: DataFrame) -> DataFrame:
        return self._nearest(vectors, 1)

    def query_cells(self, queries: DataFrame) -> DataFrame:
        return self._nearest(queries, self.nprobe)

    @classmethod
    def train(cls, vectors: DataFrame, n_cells: int, nprobe: int = 2, seed: int = 42) -> CentroidCells:
        """Spherical k-means centroids of all vectors."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        points = vectors.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
        model = KMeans(k=n_cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(points)
        centers = np.array(model.clusterCenters())
        unit = centers / np.maximum(np.linalg.norm(centers, axis=1, keepdims=True), 1e-12)
        return cls(tuple(map(tuple, unit.tolist())), nprobe)


@dataclass(frozen=True)
class IndexSize:
    """How finely an index divides its vectors. Chosen for the size the store will have, and stored with it."""

    cells: int = 64  # of ivf
    probes: int = 32  # as few as measured recall allows: README
    tables: int = 16  # of lsh
    bits: int = 4


STRATEGIES = ("exact", "lsh", "ivf")


def strategy_named(engine: str, vectors: DataFrame, dim: int, size: IndexSize = IndexSize()):
    """The engine's cells; those of ivf are trained on all `vectors`."""
    if engine == "exact":
        return Exact()
    if engine == "lsh":
        return HyperplaneCells(dim, size.tables, size.bits)
    if engine == "ivf":
        return CentroidCells.train(vectors, max(2, size.cells), size.probes)
    raise ValueError(f"unknown engine: {engine}")


class _Best:
    """The k best (score, id) of each query so far; lower id first among equal scores."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.found = np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)  # query, score, id
        self.floor = np.full(n_queries, -np.inf)  # score of each query's k-th best
        self.offered = []

    def offer(self, asked: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """`scores` has a row for each query in `asked` and a column for each of `ids`."""
        k, n, least = self.k, scores.shape[1], self.floor[asked]
        if n > k:
            least = np.maximum(least, np.partition(scores, n - k, axis=1)[:, n - k])
        row, column = np.nonzero(scores >= least[:, None])
        self.offered.append((asked[row], scores[row, column], ids[column]))

    def settle(self) -> None:
        """Merge what was offered. A vector offered to a query twice counts once."""
        query, score, id_ = (np.concatenate(x) for x in zip(self.found, *self.offered))
        self.offered = []
        order = np.lexsort((id_, -score, query))
        query, score, id_ = query[order], score[order], id_[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (id_[1:] != id_[:-1])
        query, score, id_ = query[new], score[new], id_[new]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        kept = rank < self.k
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]
        self.found = query[kept], score[kept], id_[kept]

    def table(self, query_ids: np.ndarray) -> pa.Table:
        self.settle()
        query, score, id_ = self.found
        return pa.table({"query_id": pa.array(query_ids[query], pa.int64()), "id": pa.array(id_, pa.int64()),
                         "score": pa.array(score, pa.float64())})


QUERIES_AT_ONCE = 256  # bounds the score matrix a task holds


def _offer_all(best: _Best, asked: np.ndarray, queries: np.ndarray, vectors: np.ndarray,
               ids: np.ndarray) -> None:
    for start in range(0, len(asked), QUERIES_AT_ONCE):
        some = asked[start:start + QUERIES_AT_ONCE]
        best.offer(some, _scores(queries[some], vectors), ids)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    return np.round(queries @ vectors.T, SCORE_DIGITS)


def _probed(vectors: DataFrame, queries: pa.Table) -> DataFrame:
    """Only vectors in a cell some query probes; the others are dropped where they are read.

    A store keeps the one cell of a vector as a plain column, in whose order it is written, so the filter reaches
    the files. Vectors with several cells are filtered row by row.
    """
    cells = sorted({cell for probes in queries["cells"].to_pylist() for cell in probes})
    if "cell" in vectors.columns:
        return vectors.filter(F.col("cell").isin(cells))
    return vectors.filter(F.exists("cells", lambda cell: cell.isin(cells)))


def _scan(vectors: DataFrame, queries: pa.Table, k: int) -> DataFrame:
    """One pass over the vectors of probed cells, with the whole (size-checked) query batch in each task."""
    spark = vectors.sparkSession
    probes = queries["cells"].to_pylist()
    asked_by: dict[int, list[int]] = {}
    for query, cells in enumerate(probes):
        for cell in cells:
            asked_by.setdefault(cell, []).append(query)
    shared = spark.sparkContext.broadcast((
        np.array(queries["query_id"].to_pylist(), np.int64), matrix_of(queries["embedding"]),
        {cell: np.array(asked) for cell, asked in asked_by.items()}))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_matrix, asked = shared.value
        best = _Best(len(query_ids), k)
        for batch in batches:
            if len(batch) == 0:
                continue
            cells = batch["cells"]
            row = np.repeat(np.arange(len(batch)), np.diff(cells.offsets.to_numpy()))
            flat = cells.flatten().to_numpy(zero_copy_only=False)
            ids, matrix = batch["id"].to_numpy(), matrix_of(batch["embedding"])
            order = np.argsort(flat, kind="stable")
            for members in np.split(order, np.flatnonzero(np.diff(flat[order])) + 1):
                if len(members) and flat[members[0]] in asked:
                    picked = row[members]
                    _offer_all(best, asked[flat[members[0]]], query_matrix, matrix[picked], ids[picked])
            best.settle()
        yield from best.table(query_ids).to_batches()

    return _probed(vectors, queries).select("id", "embedding", "cells").mapInArrow(scan, MATCH_SCHEMA)


def _blocks(vectors: DataFrame, queries: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Both sides shuffled into (cell, vector block, query block) tasks of bounded size.

    A cell is cut into as many blocks as its row count asks for, so neither a crowded cell nor
    a crowded query batch can land in one task. The counts table holds one row per cell, which
    the strategies bound, so it may be broadcast.
    """
    v = vectors.select("id", "embedding", F.explode("cells").alias("cell"))
    q = queries.select("query_id", F.col("embedding").alias("asked"), F.explode("cells").alias("cell"))

    def blocks_of(side: DataFrame, name: str) -> DataFrame:
        return side.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias(name))

    grid = F.broadcast(blocks_of(v, "v_blocks").join(blocks_of(q, "q_blocks"), "cell"))

    def spread(column: str, blocks: str):
        return F.pmod(F.xxhash64(column), F.col(blocks))

    v = (v.join(grid, "cell")
         .withColumn("v_block", spread("id", "v_blocks"))
         .withColumn("q_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("q_blocks") - 1)))
         .select("cell", "v_block", "q_block", "id", "embedding"))
    q = (q.join(grid, "cell")
         .withColumn("q_block", spread("query_id", "q_blocks"))
         .withColumn("v_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("v_blocks") - 1)))
         .select("cell", "v_block", "q_block", "query_id", "asked"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        query_ids = right["query_id"].to_numpy()
        if len(left) == 0 or len(query_ids) == 0:
            return _Best(0, k).table(query_ids[:0])
        best = _Best(len(query_ids), k)
        _offer_all(best, np.arange(len(query_ids)), matrix_of(right["asked"]),
                   matrix_of(left["embedding"]), left["id"].to_numpy())
        return best.table(query_ids)

    place = ["cell", "v_block", "q_block"]
    return v.groupBy(*place).cogroup(q.groupBy(*place)).applyInArrow(score, MATCH_SCHEMA)


def rank_matches(matches: DataFrame, k: int) -> DataFrame:
    """Final ranks; each map task passes on at most k rows per query."""
    best_first = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return matches.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= k)


def topk(queries: DataFrame, vectors: DataFrame, k: int, strategy=Exact(), *,
         broadcast_queries: int = 4096, block_rows: int = 20_000) -> DataFrame:
    """`query_id, id, score, rank` of the k best vectors per query.

    `vectors` holds `id, embedding` (and `cells`, if the strategy assigned them when the vectors
    were stored); `queries` holds `query_id, embedding`. A batch of at most `broadcast_queries`
    queries travels to the vectors, which then need no shuffle; a larger one is joined block by
    block.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    vectors = vectors.filter(F.col("embedding").isNotNull())
    if "cells" not in vectors.columns:
        vectors = strategy.vector_cells(vectors)
    elif strategy.probes_once and "cell" not in vectors.columns:
        vectors = vectors.withColumn("cell", F.col("cells")[0])
    # Renamed columns of its own, as the queries are often rows of the very same table.
    queries = strategy.query_cells(
        queries.select("query_id", "embedding").toDF("query_id", "embedding")
        .filter(F.col("embedding").isNotNull()))
    asked = queries.limit(broadcast_queries + 1).toArrow()
    if len(asked) <= broadcast_queries:
        return rank_matches(_scan(vectors, asked, k), k)
    matches = _blocks(vectors, queries, k, block_rows)
    if not strategy.probes_once:  # a vector may meet a query in several cells
        matches = matches.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return rank_matches(matches, k)
