"""The whole batch: land, refine twice, compare engines, index, search, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..config import JobConfig
from ..operators.embed import Embedder, HashingEmbedder
from ..operators.evaluate import choose_engine
from ..scratch import fresh_scratch, write_through
from ..sources.vector_store import current_vectors, read_vectors, superseded
from .benchmark_job import run_benchmark
from .gold_job import run_gold, run_search
from .landing_job import run_landing
from .report import (counts_markdown, engines_markdown, examples_report, full_report, search_markdown,
                     write_report)
from .silver_job import run_silver

# The example queries of the extended report; the first also heads the main one.
EXAMPLE_QUERIES = [
    "pirates searching for treasure",
    "mecha pilots defending a city",
    "detective solving a murder mystery",
    "high school romance and friendship",
    "space battle between rival factions",
    "cooking competition between chefs",
    "a lonely robot learning about humanity",
    "a young ninja who dreams of becoming the leader of his village",
    "a young boy with superhuman strength searching for magical dragon balls that grant wishes",
]


def run_all(spark: SparkSession, config: JobConfig, as_of: str, run_id: str,
            attempts: DataFrame | None = None, embedder: Embedder | None = None,
            examples: Sequence[str] = tuple(EXAMPLE_QUERIES)) -> dict[str, str]:
    """Run every stage and write both reports; returns their texts by file name.

    With `attempts` (a request log) pages are landed first and read from the landing table;
    without it the page files already in `bronze_dir` are read. The corpus is embedded once.
    """
    embedder = embedder or HashingEmbedder()
    layout = "files"
    if attempts is not None:
        run_landing(spark, config, attempts, as_of, run_id)
        layout = "table"
    runs = [f"{run_id}_1", f"{run_id}_2"]
    metrics = run_silver(spark, config, as_of, runs[0], layout).unionByName(
        run_silver(spark, config, as_of, runs[1], layout))

    work = fresh_scratch(spark, config.scratch_dir, run_id)
    # Every engine's store starts from the vectors of the exact one, which needs no index.
    run_gold(spark, config, run_id, "exact", embedder)
    exact = read_vectors(spark, config.vectors_dir, "exact")
    corpus = current_vectors(exact, write_through(superseded(exact), f"{work}/superseded")).select("id", "embedding")
    reports = write_through(run_benchmark(spark, corpus, config.k, f"{work}/benchmark"), f"{work}/reports")
    chosen = choose_engine(reports)
    engine, justification = chosen.first()

    if engine != "exact":
        run_gold(spark, config, run_id, engine, embedder, embedded_by="exact")
    numbered = list(enumerate(examples))
    queries = spark.createDataFrame(numbered, "query_id bigint, text string")
    results = write_through(
        run_search(spark, config, queries, config.k, engine, embedder), f"{work}/search")
    texts = {
        "execution_report.md": full_report(
            counts_markdown(metrics, runs), engines_markdown(reports, chosen), engine, justification,
            search_markdown(results, numbered[:1], limit=3)),
        "semantic_search_examples.md": examples_report(
            search_markdown(results, numbered, limit=config.k)),
    }
    for name, text in texts.items():
        write_report(spark, text, f"{config.reports_dir}/{name}")
    return texts
