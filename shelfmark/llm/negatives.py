"""Hard negatives by scores that a spanning tree over the anchors bounds.

Anchors and candidates meet block by block. The anchors of a block hang in a minimum spanning tree by Euclidean distance. What is
known of a candidate's score with an anchor, an exact value or a range, gives its range with a child in the tree: the same, plus or
minus the length of the edge times the candidate's norm. Only candidates whose range meets what is wanted are scored, exactly;
the others hand their range on. The tree is walked in depth, the largest branch last, so only as many ranges
are kept as the tree has doublings.

Two passes: the best rows of an anchor's own label are its positives; their scores give the windows that its negatives must
fall in. Each pass returns a fixed number of rows for an anchor and block, which are then ranked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shelfmark.scratch import staged

from .common import buckets_for
from .topk import exact_scores

VECTOR_BLOCK, ANCHOR_BLOCK = 8192, 1024
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # a negative's score in hundredths of the positive's
FOUND = "anchor_id long, mark long, vec_id long, score long"
MINED = "anchor_id long, mark long, positive_rank int, positive_id long, positive_score long, negative_id long, negative_score long"


class AnchorTree:
    """A minimum spanning tree over the rows of a matrix, the first row its root."""

    def __init__(self, anchors: np.ndarray):
        points = anchors.astype(float)
        n = len(points)
        near, parent = np.full(n, np.inf), np.full(n, -1)
        free, order, new = np.ones(n, bool), [], 0
        for _ in range(n):
            order.append(new)
            free[new] = False
            far = np.sqrt(((points - points[new]) ** 2).sum(axis=1))
            closer = free & (far < near)
            near[closer], parent[closer] = far[closer], new
            new = int(np.argmin(np.where(free, near, np.inf)))
        self.parent, self.edge = parent, np.where(parent < 0, 0.0, near)
        size = np.ones(n, np.int64)
        for a in reversed(order[1:]):
            size[parent[a]] += size[a]
        self.children = [[] for _ in range(n)]
        for a in sorted(order[1:], key=lambda a: size[a]):
            self.children[parent[a]].append(a)

    def walk(self) -> Iterator[tuple[int, int, bool]]:
        """(anchor, parent or -1, whether the parent has no further children), parents first, the largest branch last."""
        stack = [(0, -1, True)] if self.children else []
        while stack:
            a, parent, last = stack.pop()
            yield a, parent, last
            own = self.children[a]
            stack += [(c, a, k == len(own) - 1) for k, c in reversed(list(enumerate(own)))]


def scored(anchors: np.ndarray, vectors: np.ndarray, wanted: Callable) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, rows of `vectors`, their exact scores) for each anchor.

    wanted(anchor, low, high) tells which rows may be wanted whose score lies in low..high; those and no others are scored.
    """
    norms = np.sqrt((vectors.astype(float) ** 2).sum(axis=1))
    lengths = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    rounding = 1e-9 * (1 + lengths.max(initial=0) * norms)
    tree, held = AnchorTree(anchors), {}
    for a, parent, last in tree.walk():
        if parent < 0:
            low, high = -lengths[a] * norms - rounding, lengths[a] * norms + rounding
        else:
            low, high = held.pop(parent) if last else held[parent]
            slack = tree.edge[a] * norms + rounding
            low, high = low - slack, high + slack
        rows = np.flatnonzero(wanted(a, low, high))
        exact = exact_scores(vectors[rows], anchors[a])
        low[rows] = high[rows] = exact
        if tree.children[a]:
            held[a] = low, high
        yield a, rows, exact


def _nth_largest(values: np.ndarray, n: int) -> float:
    return np.partition(values, len(values) - n)[len(values) - n] if len(values) >= n else -np.inf


def window_of(positive: int) -> tuple[int, int]:
    """Least and largest score of a negative, as integers of any size."""
    return -(-LEAST * positive // 100), MOST * positive // 100


def labelled_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, label, v: floor(scale * x) of each component; where vec_id is divisible by 7 the label is the next of ten.

    Without rows that take no part: those without an id, a label or a vector, or with a null or non-finite component. Rows that
    are equal in all three count once.
    """
    x = F.transform("embedding", lambda c: F.floor(F.greatest(
        F.least(c.cast("double") * scale, F.lit(2.0 ** 62)), F.lit(-2.0 ** 62))))
    unfit = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    label = F.col("label").cast("long")
    present = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return embeddings.where(present & ~unfit).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), x.alias("v")).distinct()


def _mark(anchor: np.ndarray, label: int) -> int:
    """Tells apart anchors of one id."""
    return xxhash.xxh64_intdigest(anchor.tobytes() + int(label).to_bytes(8, "little", signed=True)) - 2 ** 63


def _rows(found: list, schema: str) -> pd.DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    return pd.DataFrame(np.array(found, np.int64).reshape(-1, len(names)), columns=names)


def _opened(vectors: pd.DataFrame, asked: pd.DataFrame):
    vectors = vectors.sort_values("vec_id", kind="stable")
    return (vectors["vec_id"].to_numpy(), vectors["label"].to_numpy(), np.stack(vectors["v"].to_numpy()).astype(np.int64),
            asked["vec_id"].to_numpy(), asked["label"].to_numpy(), np.stack(asked["v"].to_numpy()).astype(np.int64))


def _best_of_label(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """The POSITIVES best rows of a block with each anchor's label."""
    if not len(vectors) or not len(asked):
        return _rows([], FOUND)
    ids, labels, rows, anchor_ids, anchor_labels, anchors = _opened(vectors, asked)

    def same(a: int) -> np.ndarray:
        return (labels == anchor_labels[a]) & (ids != anchor_ids[a])

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mine = same(a)
        return mine & (high >= _nth_largest(low[mine], POSITIVES))

    found = []
    for a, at, scores in scored(anchors, rows, wanted):
        best = np.lexsort((ids[at], -scores))[:POSITIVES]
        found += [(anchor_ids[a], _mark(anchors[a], anchor_labels[a]), ids[at[b]], scores[b]) for b in best]
    return _rows(found, FOUND)


def _best_in_windows(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """For each positive of each anchor the NEGATIVES best rows of a block with another label and a score in the window."""
    if not len(vectors) or not len(asked):
        return _rows([], MINED)
    ids, labels, rows, anchor_ids, anchor_labels, anchors = _opened(vectors, asked)
    positives = [list(zip(p, s)) for p, s in zip(asked["positive_ids"], asked["positive_scores"])]
    windows = [[window_of(int(score)) for _, score in own] for own in positives]

    def wanted(a: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        other, chosen = labels != anchor_labels[a], np.zeros(len(ids), bool)
        for least, most in set(windows[a]):
            sure = other & (low >= least) & (high <= most)
            chosen |= other & (low <= most) & (high >= max(least, _nth_largest(low[sure], NEGATIVES)))
        return chosen

    found = []
    for a, at, scores in scored(anchors, rows, wanted):
        mark, order = _mark(anchors[a], anchor_labels[a]), np.lexsort((ids[at], -scores))
        for rank, ((positive, score), (least, most)) in enumerate(zip(positives[a], windows[a]), 1):
            fitting = order[(scores[order] >= least) & (scores[order] <= most)][:NEGATIVES]
            found += [(anchor_ids[a], mark, rank, positive, score, ids[at[f]], scores[f]) for f in fitting]
    return _rows(found, MINED)


def hard_negatives(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """`mine` for the rows of `embeddings` (vec_id, embedding, label) whose vec_id is divisible by `every`."""
    vectors = staged(labelled_vectors(embeddings))
    return mine(vectors, vectors.where(F.col("vec_id") % every == 0))


def mine(vectors: DataFrame, anchors: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `vectors` and `anchors` hold vec_id, label, v. An anchor's positives are its POSITIVES best rows of its label, other
    than rows of its own id; a positive's negatives the NEGATIVES best rows of other labels with a score from LEAST to MOST
    hundredths of the positive's. Ties go to the smaller vec_id. Vectors meet anchors of their own length only. Different rows
    of one id are candidates each; different anchors of one id are mined each. An anchor without positives, and a positive
    without negatives, have no rows. Scores past 64 bits are held at the edge.
    """
    n_vectors, n_anchors = vectors.count(), anchors.count()
    v_blocks, a_blocks = buckets_for(n_vectors, VECTOR_BLOCK), buckets_for(n_anchors, ANCHOR_BLOCK)
    cell = ["dims", "v_block", "a_block"]

    def blocks(frame: DataFrame, own: str, n_own: int, other: str, n_other: int):
        return frame.toDF(*frame.columns).select(  # columns of its own, as the anchors are rows of the same table
            F.size("v").alias("dims"), F.pmod(F.xxhash64("vec_id", "label", "v"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other), *frame.columns).groupBy(*cell)

    def meet(asked: DataFrame, search: Callable, schema: str) -> DataFrame:
        stored = blocks(vectors.select("vec_id", "label", "v"), "v_block", v_blocks, "a_block", a_blocks)
        return stored.cogroup(blocks(asked, "a_block", a_blocks, "v_block", v_blocks)).applyInPandas(search, schema)

    def ranked(frame: DataFrame, id_: str, score: str, most: int, *of: str) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("anchor_id", "mark", *of).orderBy(F.desc(score), id_))
        return frame.withColumn("rank", rank).where(F.col("rank") <= most)

    positives = ranked(meet(anchors, _best_of_label, FOUND), "vec_id", "score", POSITIVES)
    listed = F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score")))  # POSITIVES at most
    positives = positives.groupBy("anchor_id", "mark").agg(listed.alias("p")).select(
        "anchor_id", "mark", F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores"))

    def marked(frame: pd.DataFrame) -> pd.Series:
        return pd.Series([_mark(v, label) for v, label in zip(frame["v"], frame["label"])], dtype="int64")

    mark = F.pandas_udf(marked, "long")(F.struct("label", "v"))
    asked = anchors.select("vec_id", "label", "v", mark.alias("mark")).join(
        staged(positives).withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "mark"]).drop("mark")
    mined = ranked(meet(asked, _best_in_windows, MINED), "negative_id", "negative_score", NEGATIVES, "positive_rank")
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
