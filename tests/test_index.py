"""Codes with bounds, proximity graphs, and the indexes kept beside a store."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from entries import entry, write_page
from shelfmark.config import JobConfig
from shelfmark.operators import codes as coding
from shelfmark.operators.codes import Codebooks, possible_matches, topk_coded
from shelfmark.operators.graph import GraphSize, build_graph, topk_graph
from shelfmark.operators.topk import topk
from shelfmark.plans.gold_job import run_gold, run_search
from shelfmark.plans.index_job import build_index, drop_old_runs, search_index
from shelfmark.plans.silver_job import run_silver
from shelfmark.scratch import staged

VECTORS = "id long, embedding array<float>"


def _unit(n, dims, seed):
    points = np.random.default_rng(seed).normal(size=(n, dims))
    return [[float(np.float32(x)) for x in p] for p in points / np.linalg.norm(points, axis=1, keepdims=True)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, VECTORS)


def _asked(spark, rows):
    return spark.createDataFrame(rows, "query_id long, embedding array<float>")


def _rows(found):
    return sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 8)) for r in found.collect())


def test_a_code_bounds_its_score():
    draw = np.random.default_rng(3)
    points = draw.normal(size=(900, 10)) * draw.choice([0.01, 1, 50], (900, 1))
    books = Codebooks(tuple(coding._means(p, 3) for p in np.array_split(points[:400], 4, axis=1)))
    codes, errors = books.encode(points)
    queries = draw.normal(size=(20, 10))
    middle = coding.estimates(books.lookups(queries), codes)
    assert (np.abs(queries @ points.T - middle) <= np.linalg.norm(queries, axis=1)[:, None] * errors + 1e-9).all()


@pytest.mark.parametrize("block", [4096, 3])
def test_coded_search_is_exact(spark, block):
    rows = list(enumerate(_unit(700, 12, 1)))
    rows += [(1000 + k, rows[k % 5][1]) for k in range(300)] + [(5000, None)]  # copies hold near a third of the rows
    vectors, queries = _frame(spark, rows), _asked(spark, [(k, v) for k, v in rows[:9]] + [(99, None)])
    books = Codebooks.train(vectors, 6)
    coded = staged(books.coded(vectors))
    assert coded.count() == 1_000
    assert _rows(topk_coded(queries, coded, vectors, 7, books, block)) == _rows(topk(queries, vectors, 7))
    again = Codebooks.of(books.frame(spark))
    assert _rows(topk_coded(queries, coded, vectors, 3, again)) == _rows(topk(queries, vectors, 3))


def test_few_rows(spark):
    vectors, queries = _frame(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]), _asked(spark, [(7, [1.0, 0.0])])
    books = Codebooks.train(vectors)
    assert [r[:3] for r in _rows(topk_coded(queries, books.coded(vectors), vectors, 5, books))] == [(7, 1, 1), (7, 2, 2)]
    assert topk_coded(queries.limit(0), books.coded(vectors), vectors, 5, books).count() == 0
    with pytest.raises(ValueError):
        Codebooks.train(vectors.limit(0))


def test_vectors_are_read_of_survivors_only(spark):
    rows = list(enumerate(_unit(3_000, 16, 2)))
    vectors, queries = _frame(spark, rows), _asked(spark, rows[:20])
    books = Codebooks.train(vectors, 16)
    pairs = possible_matches(queries, staged(books.coded(vectors)), 5, books)
    assert pairs.count() < 0.2 * 20 * 3_000
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "embedding" not in plan


@pytest.mark.parametrize("shard_rows", [20_000, 400])
def test_graph_search_against_brute_force(spark, shard_rows):
    rows = list(enumerate(_unit(2_500, 16, 4)))
    rows += [(10_000 + k, rows[3][1]) for k in range(1_200)] + [(20_000, None)]  # one vector holds a third of the rows
    vectors, queries = _frame(spark, rows), _asked(spark, [(k, v) for k, v in enumerate(_unit(40, 16, 5))] + [(77, rows[3][1])])
    index = build_graph(vectors, Codebooks.train(vectors, 8), GraphSize(shard_rows=shard_rows))
    assert index.graph.count() == 2_500 and index.copies.count() == 1_200
    assert index.graph.agg(F.max(F.size("neighbours"))).first()[0] <= 2 * index.size.neighbours
    assert index.graph.groupBy("shard").count().agg(F.max("count")).first()[0] <= 1.5 * shard_rows
    found, truth = _rows(topk_graph(queries, index, vectors, 10)), _rows(topk(queries, vectors, 10))
    assert len({(q, i) for q, _, i, _ in found} & {(q, i) for q, _, i, _ in truth}) >= 0.9 * len(truth)
    points, asked = {i: np.array(v, float) for i, v in rows if v}, {r[0]: np.array(r[1], float) for r in queries.collect()}
    assert all(abs(asked[q] @ points[i] - s) < 1e-7 for q, _, i, s in found)
    assert [r for r in found if r[0] == 77] == [r for r in truth if r[0] == 77]


def test_graph_of_few_rows(spark):
    vectors, queries = _frame(spark, [(5, [1.0, 0.0])]), _asked(spark, [(7, [1.0, 0.0])])
    index = build_graph(vectors, Codebooks.train(vectors))
    assert [r[:3] for r in _rows(topk_graph(queries, index, vectors, 3))] == [(7, 1, 5)]
    with pytest.raises(ValueError):
        topk_graph(queries, index, vectors, 33)


@pytest.mark.parametrize("kind", ["codes", "graph"])
def test_an_index_beside_the_store_follows_it(spark, tmp_path, kind):
    config = JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"),
                       gold_dir=str(tmp_path / "gold"), scratch_dir=str(tmp_path / "scratch"), k=3)

    def land(page, first, word):
        write_page(config.bronze_dir, page, [entry(first + i, description=f"{word} {w} story about {w} and {word} and other things " * 2)
                                             for i, w in enumerate("harbour forest desert mountain river".split())])

    queries = spark.createDataFrame([(1, "a story about the harbour"), (2, "forest quiet")], "query_id long, text string")
    assert build_index(spark, config, kind, "r0") == 0
    land(1, 1, "quiet")
    run_silver(spark, config, "2024-05-02", "s1")
    run_gold(spark, config, "g1", delta_on="hash")
    with pytest.raises(ValueError):
        search_index(spark, config, queries, kind=kind)
    assert build_index(spark, config, kind, "r1") == 5
    same = [tuple(r) for r in run_search(spark, config, queries).orderBy("query_id", "rank").collect()]
    assert [tuple(r) for r in search_index(spark, config, queries, kind=kind).orderBy("query_id", "rank").collect()] == same
    land(1, 1, "loud")  # the same ids with other texts
    land(2, 50, "quiet")
    run_silver(spark, config, "2024-05-03", "s2")
    run_gold(spark, config, "g2", delta_on="hash")
    now = [tuple(r) for r in run_search(spark, config, queries).orderBy("query_id", "rank").collect()]
    assert now != same
    assert [tuple(r) for r in search_index(spark, config, queries, kind=kind).orderBy("query_id", "rank").collect()] == now
    assert build_index(spark, config, kind, "r2") == 10 and drop_old_runs(spark, config, kind) == 1
    assert [tuple(r) for r in search_index(spark, config, queries, kind=kind).orderBy("query_id", "rank").collect()] == now
