"""Python functions in plans."""

from __future__ import annotations


def once(udf):
    """Have the planner run `udf` a single time per row.

    A filter on a computed column is normally pushed below the projection that computes it, so
    the function would run in the filter and again above it, and before any repartition placed
    to share out its work. Spark moves nothing past a function declared non-deterministic.
    """
    return udf.asNondeterministic()
