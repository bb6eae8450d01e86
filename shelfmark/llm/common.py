"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

ID_OF_NULL = -(2 ** 63)  # a row without an id sorts before all others


def utf8(name: str = "text") -> Column:
    """The column's UTF-8 bytes; null counts as empty. Python splits bytes exactly at \\x20 and \\x09-\\x0D."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")


def documents_of(docs: DataFrame) -> DataFrame:
    """The two columns the operators read, whatever else the table holds: doc_id (long) and text (bytes)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: what partition and bucket counts are derived from."""
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def buckets_for(total: int, each: int) -> int:
    return max(1, -(-total // each))


def spread_of(ids: np.ndarray, n: int) -> np.ndarray:
    """Bucket 0..n-1 of 64-bit hashes, by their high bits, so that sorted hashes have sorted buckets."""
    return ((ids >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def slices_of(sorted_buckets: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) for each run of equal values in a sorted array."""
    if len(sorted_buckets):
        edges = np.flatnonzero(np.diff(sorted_buckets)) + 1
        for a, b in zip(np.r_[0, edges], np.r_[edges, len(sorted_buckets)]):
            yield int(sorted_buckets[a]), int(a), int(b)


def return_freed_memory() -> None:
    """Have this worker give back what its arrays held: glibc else keeps blocks of up to 32 MB for the worker's next task."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        libc = ctypes.CDLL("libc.so.6")
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: from now on larger blocks are mapped, and unmapped when freed
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def bounded_sample(docs: DataFrame, most: int, salt: int) -> DataFrame:
    """At most `most` rows of `docs`: those with the smallest hashes of their doc_id, found without reading other columns."""
    drawn = F.xxhash64("doc_id", F.lit(salt))
    least = docs.select(drawn.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    return docs.where(drawn <= F.lit(least).cast("long")).limit(most)


def free_name(frame: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores until no column of `frame` has that name (in any case)."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
