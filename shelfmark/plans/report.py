"""Report tables, and the small Markdown files made of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import synopsis_preview
from ..operators.evaluate import engine_report_table
from ..operators.metrics import metrics_pivot
from ..scratch import staged
from ..sources.paths import write_text


def search_report(results: DataFrame, limit: int = 3) -> DataFrame:
    """The first `limit` results of each query with a four-digit score and a preview."""
    return results.filter(F.col("rank") <= limit).select(
        "query_id", "rank", "id", "title_romaji",
        F.format_string("%.4f", "score").alias("score"),
        synopsis_preview(F.col("description")).alias("synopsis"))


# Fixed texts: the headings of the reports and of their tables.
COUNTS_HEADING = "## Conteos de Silver (idempotencia, REQ-S4)"
ENGINES_HEADING = "## Comparativa de motores vectoriales (REQ-G0)"
SEARCH_HEADING = "## Top 3 de búsqueda semántica (REQ-G3)"
REPORT_TITLE, EXAMPLES_TITLE = "# Reporte de Ejecución", "# Ejemplos de Búsqueda Semántica"
ENGINE_COLUMNS = ["motor", "tiempo_construccion_ms", "latencia_p50_ms", "latencia_p95_ms",
                  "recall_at_k", "huella_disco_bytes", "elegido"]


def as_markdown(frame: DataFrame, titles: dict[str, str] | None = None) -> str:
    """A small frame as a Markdown table; its columns give the headings, unless `titles` renames them."""
    def line(cells) -> str:
        return f"| {' | '.join(cells)} |"

    heads = [(titles or {}).get(c, c) for c in frame.columns]
    body = [line("" if cell is None else str(cell) for cell in row) for row in frame.collect()]
    return "\n".join((line(heads), f"|{'---|' * len(heads)}", *body))


def counts_markdown(metrics: DataFrame, runs: Sequence[str]) -> str:
    numbered = {run: f"corrida {place}" for place, run in enumerate(runs, 1)}
    return as_markdown(metrics_pivot(metrics, runs).select("metric", *runs), {"metric": "métrica", **numbered})


def engines_markdown(reports: DataFrame, chosen: DataFrame) -> str:
    return as_markdown(engine_report_table(reports, chosen).orderBy("engine_order").select(*ENGINE_COLUMNS))


def search_markdown(results: DataFrame, queries: Sequence[tuple[int, str]], limit: int) -> str:
    """One block per query text; `queries` is the short list put into the report."""
    shown = search_report(results.filter(F.col("query_id").isin([q for q, _ in queries])), limit)
    shown = staged(shown)

    def block(query_id: int, text: str) -> str:
        mine = shown.filter(F.col("query_id") == query_id).orderBy("rank")
        return f'Query: "{text}"\n\n{as_markdown(mine.select("id", "title_romaji", "score", "synopsis"))}\n'

    return "\n".join(block(*query) for query in queries)


def full_report(counts: str, engines: str, winner: str, justification: str, top_results: str) -> str:
    verdict = f"**Motor elegido:** {winner} — {justification}"
    sections = {COUNTS_HEADING: [counts], ENGINES_HEADING: [engines, verdict], SEARCH_HEADING: [top_results]}
    return "\n\n".join([REPORT_TITLE, *(part for heading, parts in sections.items() for part in (heading, *parts))])


def examples_report(blocks: str) -> str:
    return f"{EXAMPLES_TITLE}\n\n{blocks}"


def write_report(spark: SparkSession, text: str, path: str) -> None:
    """One small text file, wherever Spark can write."""
    write_text(spark, text, path)
