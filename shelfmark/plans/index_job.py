"""Indexes beside the vector store: codes with proven bounds (exact search) and proximity graphs (approximate search).

An index covers the batches the store held when it was built and says which was the last. What came later is scored by its vectors,
and replaces what the index holds for the same ids, so a search is never out of date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators.codes import Codebooks, topk_coded
from ..operators.embed import Embedder, HashingEmbedder, embed_descriptions
from ..operators.graph import GraphIndex, GraphSize, build_graph, topk_graph
from ..operators.search import enrich
from ..operators.topk import rank_matches, topk
from ..scratch import file_system, staged
from ..sources.paths import path_exists, write_text
from ..sources.vector_store import current_vectors, read_vectors, superseded
from .silver_job import refined_table

KINDS = ("codes", "graph")


def _place(config: JobConfig, kind: str, engine: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown index: {kind}")
    return f"{config.gold_dir}/index/{kind}/{engine}"


def _current(spark: SparkSession, config: JobConfig, stored: DataFrame) -> DataFrame:
    return current_vectors(stored, staged(superseded(stored), config.scratch_dir))


def build_index(spark: SparkSession, config: JobConfig, kind: str, run_id: str, engine: str = "exact",
                parts: int = 32, size: GraphSize = GraphSize()) -> int:
    """Index the engine's current vectors; returns their number. An index of another run stays in use until this one is whole."""
    place = _place(config, kind, engine)
    stored = read_vectors(spark, config.vectors_dir, engine)
    last = stored.agg(F.max("batch_seq")).first()[0]
    if last is None:
        return 0
    vectors = staged(_current(spark, config, stored).select("id", "embedding"), config.scratch_dir)
    books = Codebooks.train(vectors, parts)
    path = f"{place}/run={run_id}"
    books.frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/codewords")
    if kind == "codes":
        books.coded(vectors).write.mode("overwrite").parquet(f"{path}/codes")
    else:
        index = build_graph(vectors, books, size)
        index.graph.write.mode("overwrite").parquet(f"{path}/graph")
        index.copies.write.mode("overwrite").parquet(f"{path}/copies")
    write_text(spark, f"{run_id}\n{last}", f"{place}/current")
    return vectors.count()


def _opened(spark: SparkSession, place: str) -> tuple[str, int, Codebooks] | None:
    if not path_exists(spark, f"{place}/current"):
        return None
    run_id, last = (r[0] for r in spark.read.text(f"{place}/current").collect())
    path = f"{place}/run={run_id}"
    return path, int(last), Codebooks.of(spark.read.parquet(f"{path}/codewords"))


def indexed_topk(spark: SparkSession, config: JobConfig, queries: DataFrame, k: int, kind: str = "codes", engine: str = "exact",
                 size: GraphSize = GraphSize()) -> DataFrame:
    """`query_id, id, score, rank` from the engine's index and what was stored since; `queries` holds `query_id, embedding`."""
    place = _place(config, kind, engine)
    opened = _opened(spark, place)
    if opened is None:
        raise ValueError(f"no {kind} index of {engine}: build it first")
    path, last, books = opened
    stored = read_vectors(spark, config.vectors_dir, engine)
    later = _current(spark, config, stored.filter(F.col("batch_seq") > last)).select("id", "embedding")  # whole partitions
    replaced = staged(later.select("id"), config.scratch_dir)
    older = _current(spark, config, stored.filter(F.col("batch_seq") <= last)).select("id", "embedding")
    if kind == "codes":
        codes = spark.read.parquet(f"{path}/codes").join(replaced, "id", "left_anti")
        found = topk_coded(queries, codes, older, k, books)
    else:
        index = GraphIndex(spark.read.parquet(f"{path}/graph"), spark.read.parquet(f"{path}/copies"), books, size)
        found = topk_graph(queries, index, older, k).join(replaced, "id", "left_anti")
    fresh = topk(queries, later, k)
    columns = ["query_id", "id", "score"]
    return rank_matches(found.select(*columns).unionByName(fresh.select(*columns)), k)


def search_index(spark: SparkSession, config: JobConfig, queries: DataFrame, k: int | None = None, kind: str = "codes",
                 engine: str = "exact", embedder: Embedder | None = None) -> DataFrame:
    """Top-k entries for each of `queries` (`query_id, text`), as `gold_job.run_search` gives them."""
    asked = embed_descriptions(queries, embedder or HashingEmbedder(), "text")
    matches = indexed_topk(spark, config, asked, config.k if k is None else k, kind, engine)
    return enrich(staged(matches, config.scratch_dir), refined_table(spark, config).read())


def drop_old_runs(spark: SparkSession, config: JobConfig, kind: str, engine: str = "exact") -> int:
    """Remove what no search reads any more: indexes of other runs than the current one. Returns how many."""
    place = _place(config, kind, engine)
    opened = _opened(spark, place)
    if opened is None:
        return 0
    system, folder = file_system(spark, place)
    kept = opened[0].rsplit("/", 1)[1]
    old = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("run=") and s.getPath().getName() != kept]
    for path in old:
        system.delete(path, True)
    return len(old)
