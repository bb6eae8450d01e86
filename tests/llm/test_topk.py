import math

import numpy as np
import pytest

from shelfmark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string, query_id int"


def _brute(rows, k):
    vectors = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
               if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in sorted({(i, tuple(v)) for i, v in vectors if i % 100 == 0}):
        scored = sorted((-sum(a * b for a, b in zip(x, v)), i) for i, v in vectors if i != q and len(v) == len(x))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def _run(spark, rows, k):
    frame = spark.createDataFrame([(i, v, 1, "a", "b", 2) for i, v in rows], SCHEMA)
    vectors = topk.integer_vectors(frame)
    return sorted(tuple(r) for r in topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k).collect())


def _floats(draw, n, dims, scale=1.0):
    return [[float(np.float32(x)) for x in v] for v in draw.normal(size=(n, dims)) * scale]


@pytest.mark.parametrize("blocks", [(8192, 4096), (64, 2)])
def test_random_vectors(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "VECTOR_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[1])
    rows = list(zip(range(-150, 650), _floats(np.random.default_rng(1), 800, 8)))
    assert _run(spark, rows, 10) == _brute(rows, 10)


def test_ties_nulls_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 3), 1.0]) for k in range(40)]
    rows += [(100, [1.0, 1.0]), (100, [1.0, 1.0]), (5, [2.0, 1.0]), (200, [nan, 1.0]), (300, None), (400, [None, 1.0]), (500, [inf, 1.0]),
             (None, [1.0, 1.0]), (600, [1.0, 2.0, 3.0]), (601, [1.0, 1.0, -1.0]), (700, []), (701, []), (-200, [-1.0, 0.5])]
    assert _run(spark, rows, 7) == _brute(rows, 7)


def test_few_rows_and_none(spark):
    assert _run(spark, [], 10) == []
    assert _run(spark, [(0, [1.0])], 10) == []
    assert _run(spark, [(0, [1.0]), (1, [0.5])], 10) == [(0, 1, 1, 1024 * 512)]


def test_large_components_are_exact(spark):
    rows = [(0, [float(2 ** 21), 1.0]), (1, [float(2 ** 20), -3.0]), (2, [-float(2 ** 21), 0.25]), (3, [float(2 ** 20), -2.0])]
    assert _run(spark, rows, 10) == _brute(rows, 10)


def test_rows_left_out_are_proven_not_to_be_among_the_best():
    draw = np.random.default_rng(7)
    vectors = (draw.normal(size=(3_000, 16)) * 100).astype(np.int64)
    index = topk.ImpactIndex(np.arange(3_000), vectors)
    kept = []
    for query in vectors[:25]:
        best = np.argsort(-(vectors @ query), kind="stable")[:10]
        possible = index.possible(query, 10)
        assert np.isin(best, possible).all()
        kept.append(len(possible))
    assert np.mean(kept) < 600
