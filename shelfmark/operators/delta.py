"""What still has to be embedded."""

from __future__ import annotations

from pyspark.sql import DataFrame

DELTA_ON = {"id": ["id"], "hash": ["id", "content_hash"]}


def embedding_delta(refined: DataFrame, stored: DataFrame, delta_on: str = "id") -> DataFrame:
    """Refined rows without a stored vector.

    `delta_on='id'` never re-embeds a known id; `'hash'` also returns rows whose content changed.
    Only the key columns of the store are read.
    """
    key = DELTA_ON[delta_on]
    return refined.join(stored.select(*key), key, "left_anti")
