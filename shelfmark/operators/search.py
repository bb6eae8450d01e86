"""Batch semantic search: a table of query texts in, ranked entries out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import staged
from .embed import Embedder, embed_descriptions
from .topk import Exact, topk


def enrich(matches: DataFrame, refined: DataFrame) -> DataFrame:
    """Add title and description; an id the table does not know keeps its row with nulls.

    Two steps, so that the wide table is filtered down to the matched ids by a join whose small
    side is the matches.
    """
    wanted = refined.select("id", "title_romaji", "description")
    found = wanted.join(matches.select("id").distinct(), "id", "inner")
    return matches.join(found, "id", "left").select(
        "query_id", "rank", "id", "title_romaji", "score", "description")


def search(queries: DataFrame, vectors: DataFrame, refined: DataFrame, k: int,
           embedder: Embedder, strategy=Exact(), scratch: str | None = None, **limits) -> DataFrame:
    """`queries` holds `query_id, text`; fewer than k rows come back from a smaller corpus.

    The matches are written out before the titles are fetched: two joins use them, and the
    corpus must not be scanned for each.
    """
    asked = embed_descriptions(queries, embedder, "text")
    return enrich(staged(topk(asked, vectors, k, strategy, **limits), scratch), refined)
