"""Product-quantised codes of vectors, with a proven bound on the score each code stands for.

A vector is cut into parts; a part's code is the number of its nearest codeword, one byte. With a code goes its error, the
distance from the vector to what the code stands for, so for any query q the true inner product lies within |q| * error of the one
with the codewords. Exact search reads codes first, and embeddings only of rows the bound cannot exclude.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.udfs import once
from ..functions.vectors import inner_product
from ..scratch import staged
from .topk import QUERIES_AT_ONCE, SCORE_DIGITS, matrix_of, rank_matches

WORDS = 256
ROUNDING = 1e-9  # scores are rounded to SCORE_DIGITS, sums of floats by less
CODED = T.StructType([T.StructField("code", T.BinaryType()), T.StructField("error", T.DoubleType())])
BOOKS_SCHEMA = "part int, word int, codeword array<double>"
BOUNDS_SCHEMA = "query_id bigint, id bigint, low double, high double"


@dataclass(frozen=True)
class Codebooks:
    """Codewords of each part: matrices of at most WORDS rows, as wide as the part."""

    words: tuple[np.ndarray, ...]

    @property
    def edges(self) -> np.ndarray:
        return np.r_[0, np.cumsum([w.shape[1] for w in self.words])]

    @classmethod
    def train(cls, vectors: DataFrame, parts: int = 32, sample: int = 20_000, rounds: int = 8) -> Codebooks:
        """Lloyd's k-means per part on the `sample` vectors with the smallest hashes of their ids.

        Which vectors that are changes how narrow the bounds are, not what a search returns.
        """
        kept = vectors.filter(F.col("embedding").isNotNull())
        drawn = (kept.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow())
        points = matrix_of(drawn["embedding"])
        if not len(points):
            raise ValueError("no vectors to learn codewords from")
        return cls(tuple(_means(part, rounds) for part in np.array_split(points, min(parts, points.shape[1]), axis=1)))

    def encode(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, parts) and errors, the latter never below the true distance."""
        edges, codes, square = self.edges, np.zeros((len(points), len(self.words)), np.uint8), np.zeros(len(points))
        for p, words in enumerate(self.words):
            part = points[:, edges[p]:edges[p + 1]]
            codes[:, p] = _nearest(part, words)
            square += ((part - words[codes[:, p]]) ** 2).sum(axis=1)
        return codes, np.sqrt(square) * (1 + 1e-9) + 1e-12

    def lookups(self, queries: np.ndarray) -> np.ndarray:
        """(parts, queries, WORDS): each query's product with each codeword."""
        edges, found = self.edges, np.zeros((len(self.words), len(queries), WORDS))
        for p, words in enumerate(self.words):
            found[p, :, :len(words)] = queries[:, edges[p]:edges[p + 1]] @ words.T
        return found

    def coded(self, vectors: DataFrame) -> DataFrame:
        """`id, code, error` of all vectors that are not null."""
        books = self

        @F.arrow_udf(CODED)
        def encode(embedding: pa.Array) -> pa.Array:
            codes, errors = books.encode(matrix_of(embedding)) if len(embedding) else (np.zeros((0, 1), np.uint8), np.zeros(0))
            return pa.StructArray.from_arrays([pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(errors)],
                                              ["code", "error"])

        kept = vectors.filter(F.col("embedding").isNotNull())
        return kept.select("id", once(encode)("embedding").alias("c")).select("id", "c.code", "c.error")

    def frame(self, spark: SparkSession) -> DataFrame:
        """The codewords as rows, to be kept beside the codes."""
        rows = [(p, w, word.tolist()) for p, words in enumerate(self.words) for w, word in enumerate(words)]
        return spark.createDataFrame(rows, BOOKS_SCHEMA)

    @classmethod
    def of(cls, rows: DataFrame) -> Codebooks:
        """WORDS rows a part, from `frame`."""
        found: dict[int, list] = {}
        for row in rows.orderBy("part", "word").collect():
            found.setdefault(row["part"], []).append(row["codeword"])
        return cls(tuple(np.array(words) for words in found.values()))


def _nearest(points: np.ndarray, words: np.ndarray) -> np.ndarray:
    lengths = (words ** 2).sum(axis=1) / 2
    chunks = [np.argmax(points[k:k + 8192] @ words.T - lengths, axis=1) for k in range(0, len(points), 8192)]
    return np.concatenate([np.zeros(0, np.int64), *chunks])


def _means(points: np.ndarray, rounds: int) -> np.ndarray:
    distinct = np.unique(points, axis=0)
    if len(distinct) <= WORDS:
        return distinct
    words = distinct[np.linspace(0, len(distinct) - 1, WORDS).astype(int)]
    for _ in range(rounds):
        of = _nearest(points, words)
        count = np.bincount(of, minlength=WORDS)
        sums = np.stack([np.bincount(of, column, WORDS) for column in points.T], axis=1)
        words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
    return words


def estimates(lookups: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(queries, rows): products with what the codes stand for."""
    total = np.zeros((lookups.shape[1], len(codes)))
    for part, code in zip(lookups, codes.T):
        total += part[:, code]
    return total


def code_matrix(codes: pa.Array | pa.ChunkedArray, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes.to_pylist()), np.uint8).reshape(-1, parts)


def _bounds(codes: DataFrame, asked: pa.Table, k: int, books: Codebooks) -> DataFrame:
    """Score ranges of all rows that can be among a query's k best, as far as a task can tell."""
    shared = codes.sparkSession.sparkContext.broadcast((
        np.array(asked["query_id"].to_pylist(), np.int64), matrix_of(asked["embedding"]), books))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, books = shared.value
        if not len(query_ids):
            return
        lengths = np.sqrt((queries ** 2).sum(axis=1))
        tables, parts = books.lookups(queries), len(books.words)
        floor = np.full(len(queries), -np.inf)
        best = np.full((len(queries), k), -np.inf)  # the k largest lower bounds so far
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]  # query, id, low, high
        for batch in batches:
            if len(batch) == 0:
                continue
            ids, matrix = batch["id"].to_numpy(), code_matrix(batch["code"], parts)
            errors = batch["error"].to_numpy()
            for start in range(0, len(queries), QUERIES_AT_ONCE):
                some = slice(start, start + QUERIES_AT_ONCE)
                middle = estimates(tables[:, some], matrix)
                width = lengths[some, None] * errors + ROUNDING
                low = middle - width
                best[some] = np.partition(np.concatenate([best[some], low], axis=1), -k, axis=1)[:, -k:]
                floor[some] = best[some].min(axis=1)
                row, column = np.nonzero(middle + width >= floor[some, None])
                found = row + start, ids[column], low[row, column], (middle + width)[row, column]
                kept = [np.concatenate(x) for x in zip(kept, found)]
            still = kept[3] >= floor[kept[0]]
            kept = [x[still] for x in kept]
        yield from pa.table({"query_id": query_ids[kept[0]], "id": kept[1], "low": kept[2], "high": kept[3]}).to_batches()

    return codes.select("id", "code", "error").mapInArrow(scan, BOUNDS_SCHEMA)


def possible_matches(queries: DataFrame, codes: DataFrame, k: int, books: Codebooks, query_block: int = 4096) -> DataFrame:
    """`query_id, id`: every row that can be among a query's k best by the bounds of its code; all others are proven not to be.

    Codes are read once for each `query_block` queries, which travel to them.
    """
    n = queries.count()
    blocks = max(1, -(-n // query_block))
    part = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = None
    for block in range(blocks):
        asked = queries.filter(part == block).select("query_id", "embedding").toArrow()
        rows = _bounds(codes, asked, k, books)
        found = rows if found is None else found.unionAll(rows)
    found = staged(found)
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("low")))
    floors = (found.withColumn("place", best).filter(F.col("place") <= k).groupBy("query_id")
              .agg(F.when(F.count(F.lit(1)) == k, F.min("low")).otherwise(F.lit(-np.inf)).alias("floor")))
    return found.join(floors, "query_id").filter("high >= floor").select("query_id", "id")


def rescored(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """`query_id, id, score` of given pairs, from the vectors of their ids alone."""
    wanted = pairs.select("id").distinct()
    read = vectors.select("id", F.col("embedding").alias("stored")).join(wanted, "id")
    asked = queries.select("query_id", F.col("embedding").alias("asked"))
    return pairs.join(read, "id").join(asked, "query_id").select(
        "query_id", "id", F.round(inner_product(F.col("asked"), F.col("stored")), SCORE_DIGITS).alias("score"))


def topk_coded(queries: DataFrame, codes: DataFrame, vectors: DataFrame, k: int, books: Codebooks,
               query_block: int = 4096) -> DataFrame:
    """`query_id, id, score, rank` of the k best vectors per query: the rows of exact search.

    `codes` holds `id, code, error` of all of `vectors` (`id, embedding`, ids distinct); `queries` holds `query_id, embedding`.
    Null embeddings take no part.
    """
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    # Columns of their own, as the queries are often rows of the very same table.
    queries = queries.select("query_id", "embedding").filter(F.col("embedding").isNotNull()).toDF("query_id", "embedding")
    pairs = staged(possible_matches(queries, codes, k, books, query_block))
    return rank_matches(rescored(pairs, queries, vectors), k)
