"""Content hash over business columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(columns: Iterable[str]) -> Column:
    """SHA-256 of the columns as one JSON object, keys sorted and nulls kept.

    Stable between runs and sensitive to every listed column. The caller leaves the
    arrival time out of `columns`, or each run would look like a change.
    """
    canonical = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.sha2(canonical, 256)


def row_digest(columns: Iterable[str]) -> Column:
    """The first 60 bits of `content_hash` as a number; sums of it tell whether two tables hold the same rows."""
    return F.conv(F.substring(content_hash(columns), 1, 15), 16, 10).cast("decimal(38,0)")
