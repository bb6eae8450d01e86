"""Keep the vector store in step with the refined table, and search it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import JobConfig
from ..operators.delta import embedding_delta
from ..operators.embed import Embedder, HashingEmbedder, embed_descriptions
from ..operators.search import search
from ..operators.topk import STRATEGIES, CentroidCells, Exact, HyperplaneCells, IndexSize, strategy_named
from ..scratch import drop_scratch, fresh_scratch, staged, write_through
from ..sources.paths import path_exists
from ..sources.vector_store import (append_vectors, current_vectors, next_batch, read_vectors, replace_vectors,
                                    superseded)
from .silver_job import refined_table, table_feed

GOLD_SCHEMA = "engine string, embeddings_nuevos bigint, vector_count_antes bigint, vector_count_despues bigint"
CENTROID_SCHEMA = T.StructType([
    T.StructField("cell", T.LongType()), T.StructField("centroid", T.ArrayType(T.DoubleType())),
    T.StructField("probes", T.IntegerType())])
PLANES_SCHEMA = "dim int, tables int, bits int"


def index_size(config: JobConfig) -> IndexSize:
    return IndexSize(config.index_cells, config.index_probes, config.index_tables, config.index_bits)


def _stored_strategy(spark: SparkSession, path: str, engine: str):
    if engine == "exact":
        return Exact()
    if not path_exists(spark, path):
        return None
    if engine == "ivf":
        rows = spark.read.schema(CENTROID_SCHEMA).parquet(path).orderBy("cell").collect()
        return CentroidCells(tuple(tuple(r["centroid"]) for r in rows), rows[0]["probes"])
    return HyperplaneCells(*spark.read.schema(PLANES_SCHEMA).parquet(path).first())


def _keep_strategy(spark: SparkSession, path: str, strategy) -> None:
    if strategy.name == "ivf":
        cells = [(i, list(c), strategy.nprobe) for i, c in enumerate(strategy.centroids)]
        spark.createDataFrame(cells, CENTROID_SCHEMA).write.mode("overwrite").parquet(path)
    elif strategy.name == "lsh":
        sizes = [(strategy.dim, strategy.tables, strategy.bits)]
        spark.createDataFrame(sizes, PLANES_SCHEMA).write.mode("overwrite").parquet(path)


def _strategy(spark: SparkSession, config: JobConfig, engine: str, vectors: DataFrame, dim: int):
    """The engine's cells: those the store began with, else new ones of the configured size, kept beside the store."""
    if engine not in STRATEGIES:
        raise ValueError(f"unknown engine: {engine}")
    path = f"{config.gold_dir}/cells/{engine}"
    strategy = _stored_strategy(spark, path, engine)
    if strategy is None:
        strategy = strategy_named(engine, vectors, dim, index_size(config))
        _keep_strategy(spark, path, strategy)
    return strategy


def rebuild_index(spark: SparkSession, config: JobConfig, engine: str, run_id: str) -> int:
    """Divide the engine's current vectors anew, by cells of the configured size trained on all of them.

    For a store that has outgrown the cells it began with. Returns the number of vectors kept.
    """
    stored = read_vectors(spark, config.vectors_dir, engine)
    scratch = fresh_scratch(spark, config.scratch_dir, run_id)
    current = write_through(current_vectors(stored, staged(superseded(stored), config.scratch_dir)), f"{scratch}/current")
    first = current.select(F.size("embedding")).first()
    if first is None:
        return 0
    strategy = strategy_named(engine, current, first[0], index_size(config))
    divided = strategy.vector_cells(current.drop("cell", "cells")).withColumn("batch_seq", F.lit(0).cast("bigint"))
    replace_vectors(divided, config.vectors_dir, engine, f"{scratch}/divided")
    _keep_strategy(spark, f"{config.gold_dir}/cells/{engine}", strategy)
    return current.count()


def _check_embedder(stored: DataFrame, embedder: Embedder) -> None:
    other = stored.filter(F.col("embedder") != embedder.name).select("embedder").first()
    if other:
        raise ValueError(f"store holds vectors of {other[0]}, not {embedder.name}")


def run_gold(spark: SparkSession, config: JobConfig, run_id: str, engine: str = "exact",
             embedder: Embedder | None = None, delta_on: str = "id", embedded_by: str | None = None) -> DataFrame:
    """Embed what the engine's store lacks and append it; nothing is embedded when nothing is new.

    `embedded_by` names an engine whose store holds the same texts: its vectors are taken over where their hash agrees.
    `delta_on="feed"` embeds what the table's feed says was inserted or updated since the engine's last run, instead of
    comparing all ids; without later runs neither the table nor the store is read. Its first run compares hashes.
    """
    feed = table_feed(refined_table(spark, config)) if delta_on == "feed" else None
    last = feed.last() if feed else -1
    if feed and last <= feed.seen(engine):
        held = feed.seen(f"{engine}_vectors")  # their number after the last run
        return spark.createDataFrame([(engine, 0, max(held, 0), max(held, 0))], GOLD_SCHEMA)
    embedder = embedder or HashingEmbedder()
    stored = read_vectors(spark, config.vectors_dir, engine)
    _check_embedder(stored, embedder)
    follows = feed is not None and feed.seen(engine) >= 0
    delta_on = "hash" if feed else delta_on
    held = stored if delta_on == "id" else current_vectors(stored)
    before = stored.count()
    scratch = fresh_scratch(spark, config.scratch_dir, run_id)
    refined = refined_table(spark, config).read().select("id", "content_hash", "description")
    # The keys first: with their number known, the texts are fetched by the cheaper kind of join.
    changed = feed.unseen(engine) if follows else embedding_delta(refined.select("id", "content_hash"), held, delta_on)
    wanted = write_through(changed.select("id"), f"{scratch}/wanted_{engine}")
    added = wanted.count()
    if added == 0:
        if feed:
            feed.handled(f"{engine}_vectors", before)
            feed.handled(engine, last)
        drop_scratch(spark, scratch)
        return spark.createDataFrame([(engine, 0, before, before)], GOLD_SCHEMA)
    delta = refined.join(wanted, "id", "left_semi")
    if embedded_by is not None:
        other = read_vectors(spark, config.vectors_dir, embedded_by)
        _check_embedder(other, embedder)
        known = current_vectors(other, staged(superseded(other), config.scratch_dir)).select("id", "content_hash", "embedding")
        taken = write_through(known.join(wanted, "id", "left_semi"), f"{scratch}/taken_{engine}")
        delta = delta.join(taken.select("id", "content_hash"), ["id", "content_hash"], "left_anti")
        embedded = embed_descriptions(delta, embedder).drop("description").unionByName(taken)
    else:
        embedded = embed_descriptions(delta, embedder).drop("description")
    embedded = write_through(embedded, f"{scratch}/embedded_{engine}")
    strategy = _strategy(spark, config, engine, embedded, len(embedded.first()["embedding"]))
    batch = strategy.vector_cells(embedded).select(
        F.lit(engine).alias("engine"), F.lit(next_batch(stored)).cast("bigint").alias("batch_seq"),
        "id", "content_hash", F.lit(embedder.name).alias("embedder"), "embedding", "cells")
    append_vectors(batch, config.vectors_dir)
    if feed:  # a run that dies before this embeds the same texts again: the newest vector counts
        feed.handled(f"{engine}_vectors", before + added)
        feed.handled(engine, last)
    drop_scratch(spark, scratch)
    return spark.createDataFrame([(engine, added, before, before + added)], GOLD_SCHEMA)


def run_search(spark: SparkSession, config: JobConfig, queries: DataFrame, k: int | None = None,
               engine: str = "exact", embedder: Embedder | None = None) -> DataFrame:
    """Top-k entries for each of `queries` (`query_id, text`) from the engine's stored vectors."""
    embedder = embedder or HashingEmbedder()
    k = config.k if k is None else k
    stored = read_vectors(spark, config.vectors_dir, engine)
    _check_embedder(stored, embedder)
    first = stored.select(F.size("embedding")).first()
    strategy = _strategy(spark, config, engine, stored, first[0] if first else 1)
    # Only a store that re-embeds changed texts holds an id twice.
    current = current_vectors(stored, staged(superseded(stored), config.scratch_dir))
    return search(queries, current, refined_table(spark, config).read(), k, embedder, strategy,
                  scratch=config.scratch_dir)
