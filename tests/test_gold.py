import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from entries import entry, page_body, write_page, LOG_SCHEMA
from shelfmark.config import JobConfig
from shelfmark.operators.checks import check_engine_report, check_gold_no_growth, check_results
from shelfmark.operators.embed import HashingEmbedder, ModelEmbedder, embed_descriptions
from shelfmark.operators.evaluate import choose_engine, exact_percentiles, recall_at_k, sample_queries
from shelfmark.operators.topk import CentroidCells, Exact, HyperplaneCells, strategy_named, topk
from shelfmark.plans.benchmark_job import run_benchmark, without_self
from shelfmark.plans.full_run import EXAMPLE_QUERIES, run_all
from shelfmark.plans.gold_job import index_size, rebuild_index, run_gold, run_search
from shelfmark.plans.silver_job import refined_table, run_silver
from shelfmark.scratch import staged
from shelfmark.sources.vector_store import append_vectors, current_vectors, read_vectors, store_bytes, superseded

CORPUS = [
    ("Lanterns under the Ice", "Divers light the bottom of a frozen lake and map the drowned railway that crosses it. "),
    ("The Beekeeper's Ledger", "A retired accountant keeps bees on a rooftop and balances the books of the whole hive. "),
    ("Nine Bridges", "Rival masons race to finish nine stone bridges before the spring flood reaches the valley. "),
    ("Salt Radio", "A lighthouse operator answers weather calls at night and slowly learns every sailor's voice. "),
    ("Paper Orchestra", "Children fold instruments out of old newspapers and tour the mountain schools by bus. "),
]
AS_OF = "2024-05-02"


@pytest.fixture
def config(spark, tmp_path):
    config = JobConfig(bronze_dir=str(tmp_path / "bronze"), silver_dir=str(tmp_path / "silver"),
                       gold_dir=str(tmp_path / "gold"), reports_dir=str(tmp_path / "reports"),
                       scratch_dir=str(tmp_path / "scratch"), k=2)
    write_page(config.bronze_dir, 1, [entry(i + 1, description=text * 2, title={"romaji": title})
                                      for i, (title, text) in enumerate(CORPUS)])
    run_silver(spark, config, AS_OF, "silver_1")
    return config


def queries(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")


@pytest.mark.parametrize("engine", ["exact", "lsh", "ivf"])
def test_search_and_incremental_index(spark, config, engine):
    first = run_gold(spark, config, "g1", engine).first()
    assert (first["embeddings_nuevos"], first["vector_count_despues"]) == (5, 5)
    again = run_gold(spark, config, "g2", engine)
    assert check_gold_no_growth(again).first()["passed"]
    write_page(config.bronze_dir, 2, [entry(999, description="New arrival " * 10)])
    run_silver(spark, config, AS_OF, "silver_2")
    third = run_gold(spark, config, "g3", engine).first()
    assert (third["embeddings_nuevos"], third["vector_count_antes"], third["vector_count_despues"]) == (1, 5, 6)
    assert read_vectors(spark, config.vectors_dir, engine).filter("batch_seq = 1").count() == 1
    assert store_bytes(spark, config.vectors_dir, engine) > 0

    found = run_search(spark, config, queries(spark, "divers under a frozen lake",
                                              "masons who race to finish bridges"), engine=engine)
    if engine == "exact":
        checks = check_results(found, refined_table(spark, config).read(), 2, 0.2).collect()
        assert len(checks) == 2 and all(r["passed"] for r in checks)
    assert {r["rank"] for r in found.collect()} <= {1, 2}


def test_engines_keep_separate_stores_and_unknown_ones_fail(spark, config):
    run_gold(spark, config, "g1", "exact")
    assert run_gold(spark, config, "g2", "lsh").first()["embeddings_nuevos"] == 5
    with pytest.raises(ValueError):
        run_gold(spark, config, "g3", "unknown")
    with pytest.raises(ValueError):
        run_search(spark, config, queries(spark, "x"), embedder=HashingEmbedder(64))


def test_changed_text_is_embedded_again_on_request(spark, config):
    run_gold(spark, config, "g1")
    write_page(config.bronze_dir, 1, [entry(1, description="Entirely different words now " * 5)])
    run_silver(spark, config, AS_OF, "silver_2")
    assert run_gold(spark, config, "g2").first()["embeddings_nuevos"] == 0
    assert run_gold(spark, config, "g3", delta_on="hash").first()["embeddings_nuevos"] == 1
    (top,) = run_search(spark, config, queries(spark, "entirely different words"), k=1).collect()
    assert top["id"] == 1
    assert run_gold(spark, config, "g4", delta_on="hash").first()["embeddings_nuevos"] == 0


def test_embedder_takes_descriptions_only():
    for embedder in (HashingEmbedder, ModelEmbedder):
        assert list(inspect.signature(embedder.embed).parameters) == ["self", "description"]


def test_embeddings_are_unit_vectors(spark):
    df = spark.createDataFrame([(1, "one two two"), (2, ""), (3, None), (4, "Élan 東京 x")], "id long, description string")
    rows = {r["id"]: np.array(r["embedding"]) for r in embed_descriptions(df, HashingEmbedder(32)).collect()}
    assert all(len(v) == 32 for v in rows.values())
    assert [round(float(np.linalg.norm(rows[i])), 6) for i in (1, 2, 3, 4)] == [1, 0, 0, 1]


def test_model_embedder_loads_and_normalises(spark):
    def load():
        class Stub:
            def encode(self, texts):
                return np.array([[len(t), 1.0, 0.0] for t in texts])
        return Stub()

    df = spark.createDataFrame([(1, "abc"), (2, None)], "id long, description string")
    rows = embed_descriptions(df, ModelEmbedder("stub", load)).orderBy("id").collect()
    assert np.allclose(rows[0]["embedding"], np.array([3, 1, 0]) / np.sqrt(10))
    assert rows[1]["embedding"] == [0.0, 1.0, 0.0]


def test_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()

        class Stub:
            def encode(self, texts):
                return np.array([[len(t), 1.0] for t in texts])
        return Stub()

    df = spark.range(64).repartition(32).selectExpr("id", "repeat('x', cast(id as int)) AS description")
    embedder = ModelEmbedder("stub", load)
    for _ in range(2):
        rows = {r["id"]: r["embedding"] for r in embed_descriptions(df, embedder).collect()}
        assert all(np.allclose(rows[k], np.array([k, 1]) / np.hypot(k, 1)) for k in range(64))
    loads = [name.name.split("-")[0] for name in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) < 32  # 64 tasks


def unit_rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(n, dim)).astype(np.float32)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def vector_table(spark, matrix, name="id"):
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], f"{name} long, embedding array<float>")


def brute_force(query_matrix, matrix, k):
    scores = np.round(query_matrix.astype(np.float64) @ matrix.astype(np.float64).T, 9)
    return {(q, int(i)): rank + 1 for q, row in enumerate(scores)
            for rank, i in enumerate(np.lexsort((np.arange(len(row)), -row))[:k])}


def as_ranks(matches):
    return {(r["query_id"], r["id"]): r["rank"] for r in matches.collect()}


@pytest.mark.parametrize("limits", [{}, {"broadcast_queries": 3, "block_rows": 17}])
def test_exact_topk_matches_brute_force_with_ties(spark, limits):
    matrix = unit_rows(120, 16, 7)
    matrix[40:80] = matrix[0]  # a third of the rows are one and the same vector
    found = topk(vector_table(spark, matrix[:10], "query_id"), vector_table(spark, matrix), 5, **limits)
    assert as_ranks(found) == brute_force(matrix[:10], matrix, 5)


@pytest.mark.parametrize("strategy", [HyperplaneCells(16, tables=3, bits=3), CentroidCells(((1.0,) + (0.0,) * 15, (0.0,) * 15 + (1.0,), (0.0, 1.0) + (0.0,) * 14), nprobe=2)])
def test_both_ways_of_joining_give_the_same_candidates(spark, strategy):
    matrix = unit_rows(150, 16, 3)
    queries_, vectors = vector_table(spark, matrix[:20], "query_id"), vector_table(spark, matrix)
    small = as_ranks(topk(queries_, vectors, 4, strategy))
    blocks = as_ranks(topk(queries_, vectors, 4, strategy, broadcast_queries=0, block_rows=7))
    assert small == blocks
    cells = {r["id"]: set(r["cells"]) for r in strategy.vector_cells(vectors).collect()}
    probes = {r["query_id"]: set(r["cells"]) for r in strategy.query_cells(queries_).collect()}
    assert all(cells[i] & probes[q] for q, i in small)


def test_queries_may_be_rows_of_the_corpus(spark):
    matrix = unit_rows(60, 8, 2)
    vectors = vector_table(spark, matrix)
    asked = sample_queries(vectors, 12)
    found = as_ranks(topk(asked, vectors, 3, broadcast_queries=0, block_rows=10))
    wanted = brute_force(matrix, matrix, 3)
    chosen = {r["query_id"] for r in asked.collect()}
    assert found == {pair: rank for pair, rank in wanted.items() if pair[0] in chosen}


def test_fewer_vectors_than_k_and_bad_k(spark):
    matrix = unit_rows(3, 4, 1)
    assert topk(vector_table(spark, matrix[:1], "query_id"), vector_table(spark, matrix), 10).count() == 3
    assert topk(vector_table(spark, matrix[:1], "query_id").filter("false"), vector_table(spark, matrix), 10).count() == 0
    with pytest.raises(ValueError):
        topk(vector_table(spark, matrix, "query_id"), vector_table(spark, matrix), 0)


def test_recall_of_ivf_by_brute_force(spark, tmp_path):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS id", "embedding")
    reported = run_benchmark(spark, vectors, 5, str(tmp_path), ("exact", "ivf"), n_timed=1).filter("engine = 'ivf'").first()["recall_at_k"]
    rows = vectors.orderBy("id").collect()
    ids, matrix = np.array([r["id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    chosen = np.isin(ids, [r["query_id"] for r in sample_queries(vectors).collect()])
    index = strategy_named("ivf", vectors, 64)
    closeness = matrix @ np.array(index.centroids).T
    cells, hits = closeness.argmax(axis=1), 0
    for query, near in zip(matrix[chosen], closeness[chosen]):
        best = np.argsort(-(matrix @ query))[:5]
        hits += np.isin(cells[best], np.argsort(-near)[:index.nprobe]).sum()
    assert reported == pytest.approx(hits / 250, abs=0.004)
    assert reported >= 0.9


def test_benchmark_reports_every_metric(spark, tmp_path):
    vectors = vector_table(spark, unit_rows(60, 16, 7))
    reports = run_benchmark(spark, vectors, 5, str(tmp_path), n_queries=10, n_timed=2)
    assert check_engine_report(reports).first()["passed"]
    rows = {r["engine"]: r for r in reports.collect()}
    assert rows["exact"]["recall_at_k"] == 1.0 and rows["exact"]["disk_footprint_bytes"] > 0
    engine, text = choose_engine(reports).first()
    assert engine in rows and text
    honest = run_benchmark(spark, vectors, 5, str(tmp_path / "b"), ("exact", "lsh"), 10, 1, exclude_self=True)
    assert {r["engine"]: r["recall_at_k"] for r in honest.collect()}["exact"] == 1.0
    assert all(r["latency_p50_ms"] > 0 and r["batch_ms_per_query"] > 0 for r in rows.values())


def test_a_query_tied_out_of_its_own_top_k_leaves_k_others(spark):
    """Six equal vectors: the query with the largest id is not among its own three best."""
    same = vector_table(spark, np.ones((6, 4), np.float32))
    asked = same.filter("id = 5").select(F.col("id").alias("query_id"), "embedding")
    found = without_self(topk(asked, same, 4), 3).orderBy("rank").collect()
    assert [(r["rank"], r["id"]) for r in found] == [(1, 0), (2, 1), (3, 2)]


def test_vectors_are_taken_over_from_another_engine(spark, config):
    class Counting(HashingEmbedder):
        def embed(self, description):
            assert not self.closed, "embedded again"
            return super().embed(description)

    embedder = Counting()
    embedder.closed = False
    run_gold(spark, config, "g1", "exact", embedder)
    run_gold(spark, config, "g2", "lsh", embedder, embedded_by="exact")
    vectors = {e: {r["id"]: r["embedding"] for r in read_vectors(spark, config.vectors_dir, e).collect()} for e in ("exact", "lsh")}
    assert vectors["exact"] == vectors["lsh"] and len(vectors["lsh"]) == 5


def test_ivf_reads_probed_cells_only_and_may_be_rebuilt(spark, tmp_path):
    matrix = unit_rows(400, 16, 11)
    config = JobConfig(gold_dir=str(tmp_path / "gold"), scratch_dir=str(tmp_path / "scratch"), index_cells=20, index_probes=2)
    strategy = strategy_named("ivf", vector_table(spark, matrix), 16, index_size(config))
    rows = strategy.vector_cells(vector_table(spark, matrix)).select(
        F.lit("ivf").alias("engine"), F.lit(0).cast("bigint").alias("batch_seq"), "id", F.lit("h").alias("content_hash"),
        F.lit("e").alias("embedder"), "embedding", "cells")
    append_vectors(rows, config.vectors_dir)
    stored = read_vectors(spark, config.vectors_dir, "ivf")
    asked = vector_table(spark, matrix[:1], "query_id")
    found = topk(asked, stored, 5, strategy)
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "In(cell" in scan[scan.index("PushedFilters"):] or "EqualTo(cell" in scan
    assert as_ranks(found) == as_ranks(topk(asked, vector_table(spark, matrix), 5, strategy))
    (probes,) = [r["cells"] for r in strategy.query_cells(asked).collect()]
    assert stored.filter(F.col("cell").isin(probes)).count() < 0.4 * 400

    larger = JobConfig(**{**vars(config), "index_cells": 50, "index_probes": 50})
    assert rebuild_index(spark, larger, "ivf", "r") == 400
    again = read_vectors(spark, config.vectors_dir, "ivf")
    assert again.count() == 400 and again.select("cell").distinct().count() > 25
    every = CentroidCells(((1.0,) + (0.0,) * 15,) * 50, nprobe=50)
    assert as_ranks(topk(asked, again, 5, every)) == brute_force(matrix[:1], matrix, 5)


def test_search_moves_no_vectors(spark, config):
    run_gold(spark, config, "g1")
    stored = read_vectors(spark, config.vectors_dir, "exact")
    plan = current_vectors(stored, staged(superseded(stored)))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_choice_prefers_recall_then_size_then_order(spark):
    def choose(*rows):
        return choose_engine(spark.createDataFrame(
            rows, "engine string, engine_order int, recall_at_k double, disk_footprint_bytes long")).first()

    assert choose(("a", 0, 0.9, 1), ("b", 1, 0.95, 9)) == ("b", "b tiene el mayor recall@k medido (0.950).")
    assert choose(("a", 0, 1.0, 9), ("b", 1, 1.0, 3)) == (
        "b", "Empate en recall@k (1.000) entre a, b; gana b por menor huella en disco (3 bytes).")
    assert choose(("a", 0, 1.0, 3), ("b", 1, 1.0, 3))[0] == "a"


def test_recall_without_truth_or_hits(spark):
    found = spark.createDataFrame([("e", 1, 5), ("f", 1, 6)], "engine string, query_id long, id long")
    truth = spark.createDataFrame([(1, 5), (1, 7)], "query_id long, id long")
    rows = {r["engine"]: r["recall_at_k"] for r in recall_at_k(found, truth).collect()}
    assert rows == {"e": 0.5, "f": 0.0}
    assert {r["recall_at_k"] for r in recall_at_k(found, truth.filter("false")).collect()} == {0.0}


def test_sample_is_fixed(spark):
    vectors = vector_table(spark, unit_rows(80, 4, 1))
    first = [r["query_id"] for r in sample_queries(vectors).collect()]
    again = [r["query_id"] for r in sample_queries(vectors.repartition(5)).collect()]
    assert sorted(first) == sorted(again) and len(set(first)) == 50
    assert sample_queries(vectors.filter("id < 3")).count() == 3


@pytest.mark.parametrize("accuracy", [50, 100_000])
def test_percentiles_are_exact_on_skewed_values(spark, accuracy):
    rng = np.random.default_rng(5)
    values = {"heavy": np.concatenate([np.zeros(700), rng.pareto(1, 1300)]), "one": np.array([4.0]),
              "two": np.array([1.0, 2.0]), "same": np.full(900, 3.0)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double")
    ps = [0.0, 0.3, 0.5, 0.95, 0.999, 1.0]
    rows = {(r["g"], r["p"]): r["percentile"] for r in exact_percentiles(df, "g", "v", ps, accuracy).collect()}
    assert len(rows) == len(values) * len(ps)
    for (g, p), found in rows.items():
        assert found == pytest.approx(np.percentile(values[g], p * 100), rel=1e-12, abs=1e-12)


def test_values_are_not_dealt_by_group_alone(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        group = F.when(F.col("id") < 50_000, "most").otherwise("few").alias("g")
        df = spark.range(50_010).select(group, (F.col("id") % 997).cast("double").alias("v"))
        frame = exact_percentiles(df, "g", "v", [0.5], accuracy=1_000)
        found = {r["g"]: r["percentile"] for r in frame.collect()}
        assert found["most"] == pytest.approx(np.percentile(np.arange(50_000) % 997, 50))
        plan = frame._jdf.queryExecution().executedPlan().toString()
        joined = [line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line]
        assert joined and all("__salt" in line for line in joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_whole_run_writes_both_reports(spark, config, tmp_path):
    attempts = spark.createDataFrame(
        [(p, 1, 200, None, page_body(p, 3)) for p in (1, 2)], LOG_SCHEMA)
    other = JobConfig(**{**vars(config), "bronze_dir": str(tmp_path / "b2"), "silver_dir": str(tmp_path / "s2"),
                         "gold_dir": str(tmp_path / "g2"), "paginas": 2})
    texts = run_all(spark, other, AS_OF, "all", attempts=attempts)
    report = texts["execution_report.md"]
    assert "| filas_leidas | 6 | 6 |" in report and "| filas_nuevas | 6 | 0 |" in report
    assert report.count("✓") == 1 and "**Motor elegido:**" in report
    assert all(f'Query: "{q}"' in texts["semantic_search_examples.md"] for q in EXAMPLE_QUERIES)
    assert (tmp_path / "reports" / "execution_report.md").read_text(encoding="utf-8") == report
    assert sorted(p.name for p in (tmp_path / "reports").iterdir() if p.suffix == ".md") == sorted(texts)
