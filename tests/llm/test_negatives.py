import math

import numpy as np
import pytest

from shelfmark.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string, dims int, mark string, rank int"


def _brute(rows):
    table = {(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)) for i, v, label in rows
             if None not in (i, v, label) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a, label, x in table:
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, v)), i, other == label) for i, other, v in table if i != a and len(v) == len(x))
        for s, positive, _ in [r for r in scored if r[2]][:5]:
            fitting = [(i, -n) for n, i, same in scored if not same and -s * 30 <= -n * 100 <= -s * 90][:10]
            out += [(a, positive, rank, i, -s, n) for rank, (i, n) in enumerate(fitting, 1)]
    return sorted(out)


def _run(spark, rows):
    frame = spark.createDataFrame([(i, v, label, "a", "b", 1, "c", 2) for i, v, label in rows], SCHEMA)
    return sorted(tuple(r) for r in negatives.hard_negatives(frame).collect())


def _clustered(n, dims, seed):
    draw = np.random.default_rng(seed)
    points = draw.normal(size=(12, dims))[draw.integers(0, 12, n)] + 0.1 * draw.normal(size=(n, dims))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    return [(k - 150, [float(np.float32(x)) for x in p], int(c)) for k, (p, c) in enumerate(zip(points, draw.integers(0, 10, n)))]


@pytest.mark.parametrize("blocks", [(8192, 1024), (100, 3)])
def test_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "VECTOR_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[1])
    rows = _clustered(1_000, 8, 1)
    assert _run(spark, rows) == _brute(rows)


def test_ties_nulls_repeats_and_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(k, [float(k % 3), 1.0 + k % 5], k % 4) for k in range(60)]
    rows += [(100, [1.0, 1.0], 1), (100, [1.0, 1.0], 1), (5, [2.0, 1.0], 1), (200, [nan, 1.0], 1), (300, None, 1), (400, [None, 1.0], 1),
             (500, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (600, [1.0, 2.0, 3.0], 2), (601, [1.0, 1.0, 1.0], 2), (602, [0.5, 1.0, 0.5], 3),
             (800, [1.0, 2.0], None), (700, [], 2), (701, [], 2), (-200, [-1.0, 0.5], 9), (900, [0.0, 0.0], 3)]
    got = _run(spark, rows)
    assert got == _brute(rows)
    assert any(r[0] == 600 for r in got) and any(r[0] == 900 and r[5] == 0 for r in got)


def test_few_rows_and_none(spark):
    assert _run(spark, []) == []
    assert _run(spark, [(0, [1.0], 8), (1, [0.5], 3)]) == []


def test_large_components_are_exact(spark):
    rows = [(100, [float(2 ** 23), 1.0], 1), (1, [float(2 ** 22), -3.0], 1), (2, [float(2 ** 21), 0.25], 2), (3, [float(2 ** 21), -2.0], 3)]
    got = _run(spark, rows)
    assert got == _brute(rows) and len(got) == 2


def test_tree_reaches_every_anchor_by_short_edges():
    points = np.array([[0], [10], [1], [11], [2]])
    tree = negatives.AnchorTree(points)
    steps = list(tree.walk())
    assert sorted(a for a, *_ in steps) == [0, 1, 2, 3, 4]
    seen = set()
    for a, parent, _ in steps:
        assert parent == -1 or parent in seen
        seen.add(a)
    assert sorted(tree.edge) == [0, 1, 1, 1, 8]
    assert list(negatives.AnchorTree(np.zeros((0, 3))).walk()) == []


def test_bounds_leave_out_rows_and_lose_none():
    rows = _clustered(4_000, 16, 5)
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v, _ in rows])
    anchors, few, total = vectors[:400:2], 0, 0
    best = [np.sort(vectors @ a)[-10:].min() for a in anchors]

    def wanted(a, low, high):
        kept = high >= np.sort(low)[-10]
        assert kept[vectors @ anchors[a] >= best[a]].all()
        return kept

    for a, at, scores in negatives.scored(anchors, vectors, wanted):
        assert (scores == vectors[at] @ anchors[a]).all()
        few, total = few + len(at), total + len(vectors)
    assert few < 0.4 * total
