"""Compare search engines on one corpus and one query sample."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.evaluate import latency_percentiles, recall_at_k, sample_queries
from ..operators.topk import Exact, strategy_named, topk
from ..scratch import write_through
from ..sources.paths import stored_bytes

REPORT_SCHEMA = ("engine string, engine_order int, build_time_ms double, batch_ms_per_query double, "
                 "disk_footprint_bytes bigint")


def without_self(matches: DataFrame, k: int) -> DataFrame:
    """The k best matches of each query other than the query itself, ranked anew."""
    best = Window.partitionBy("query_id").orderBy("rank")
    others = matches.filter(F.col("query_id") != F.col("id")).withColumn("rank", F.row_number().over(best))
    return others.filter(F.col("rank") <= k)


def run_benchmark(spark: SparkSession, vectors: DataFrame, k: int, work_dir: str,
                  engines: Sequence[str] = ("exact", "lsh", "ivf"), n_queries: int = 50,
                  n_timed: int = 10, exclude_self: bool = False) -> DataFrame:
    """One row per engine: build time, latency p50/p95 of single queries, time per query of the whole batch, recall@k
    against exact search, stored bytes.

    Queries are vectors of the corpus, so each finds itself; `exclude_self` asks for one more and drops that match.
    The first `n_timed` queries are also asked one at a time, each as a job of its own: that is what the
    percentiles are of.
    """
    vectors = vectors.select("id", "embedding")
    queries = write_through(sample_queries(vectors, n_queries), f"{work_dir}/queries")
    asked, dim = max(queries.count(), 1), len(vectors.first()["embedding"])
    single = [r["query_id"] for r in queries.select("query_id").orderBy("query_id").limit(n_timed).collect()]

    def answer(some, corpus, strategy):
        return without_self(topk(some, corpus, k + 1, strategy), k) if exclude_self else topk(some, corpus, k, strategy)

    truth = write_through(answer(queries, vectors, Exact()), f"{work_dir}/truth")
    built, latencies, results = [], [], None
    for order, engine in enumerate(engines):
        started = time.perf_counter()
        strategy = strategy_named(engine, vectors, dim)
        place = f"{work_dir}/index_{engine}"
        corpus = write_through(strategy.vector_cells(vectors), place)
        build_ms = (time.perf_counter() - started) * 1000
        started = time.perf_counter()
        found = write_through(answer(queries, corpus, strategy), f"{work_dir}/found_{engine}")
        batch_ms = (time.perf_counter() - started) * 1000 / asked
        for query_id in single:
            started = time.perf_counter()
            answer(queries.filter(F.col("query_id") == query_id), corpus, strategy).collect()
            latencies.append((engine, (time.perf_counter() - started) * 1000))
        tagged = found.withColumn("engine", F.lit(engine))
        results = tagged if results is None else results.unionByName(tagged)
        built.append((engine, order, build_ms, batch_ms, stored_bytes(spark, place)))
    reports = spark.createDataFrame(built, REPORT_SCHEMA)
    timings = spark.createDataFrame(latencies, "engine string, latency_ms double")
    return (reports.join(latency_percentiles(timings), "engine")
            .join(recall_at_k(results, truth).select("engine", "recall_at_k"), "engine", "left")
            .na.fill(0.0, ["recall_at_k"]).orderBy("engine_order"))
