"""SimHash near-duplicates: an inverted index on byte positions, with count filtering.

A fingerprint has eight bytes. Fingerprints that differ in at most three bits agree in five positions or
more. Of the fourteen sets of four positions whose numbers xor to zero, one avoids any three given
positions, so two linked fingerprints share the bytes of at least one set: a posting is a fingerprint under the
four bytes of a set. Pairs that meet under a posting list count their shared bytes, those with five or more
are verified by their bits. Copies are one fingerprint from the start, and a list gives links that join what is
linked, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.udfs import once
from shelfmark.scratch import staged

from .common import documents_of, free_name, utf8
from .components import components

SHINGLE_WORDS, MAX_BITS, SEED = 3, 3, 42
POSITION_SETS = [s for s in combinations(range(8), 4) if s[0] ^ s[1] ^ s[2] ^ s[3] == 0]
LIST_BLOCK = 1024  # longest part of a posting list that meets another part in one place


def simhash(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint; bit j is set if over half of the shingles' hashes have it. Zero for a text without words."""
    tokens = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.r_[0, np.cumsum(lengths + 1)[:-1]]
    n = max(1, len(tokens) - words + 1)
    stops = (starts + lengths)[-n:]
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, n, 65_536):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[k:k + 65_536].tolist(), stops[k:k + 65_536].tolist())]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a long), text_key (a hash that tells rows of one doc_id apart)."""
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([simhash(t, words) for t in texts], np.uint64).view(np.int64))

    return documents_of(docs).select(
        "doc_id", once(F.pandas_udf(of, "long"))("text").alias("fp"), F.xxhash64("text").alias("text_key"))


def _linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    differing = a.view(np.uint64) ^ b.view(np.uint64)
    shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    linked = shared >= 8 - max_bits
    linked[linked] = np.bitwise_count(differing[linked]) <= max_bits
    return linked


def _links(keys: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers in the same list (a run of equal keys) that join all linked rows of each list."""
    group = np.arange(len(fp))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    left = np.arange(len(fp))
    for apart in range(1, len(fp)):
        left = left[left + apart < len(fp)]
        left = left[keys[left] == keys[left + apart]]
        if not len(left):
            return
        linked = left[_linked(fp[left], fp[left + apart], max_bits)]
        new = []
        for i in linked[group[linked] != group[linked + apart]].tolist():
            a, b = root(i), root(i + apart)
            if a != b:
                group[max(a, b)] = min(a, b)
                new.append(i)
        if new:
            while True:  # shorten all paths, so that rows already joined are seen at once
                shorter = group[group]
                if np.array_equal(shorter, group):
                    break
                group = shorter
            yield np.array(new), np.array(new) + apart


def links(points: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """u, v: edges between the nodes of `points` (fp, node; fp unrepeated) that connect whatever is linked."""
    if not 0 <= max_bits <= 3:
        raise ValueError(f"three differing bits at most, not {max_bits}")
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(8)]
    key = [sum((F.shiftleft(byte[p], 8 * k) for k, p in enumerate(s)), F.lit(n << 32)) for n, s in enumerate(POSITION_SETS)]
    postings = points.select("fp", "node", F.explode(F.array(*key)).alias("key"))

    # Lists of one fingerprint link nothing. Long lists are cut in parts, and each two parts meet.
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / LIST_BLOCK).cast("long")
    part = F.when(F.col("n") <= LIST_BLOCK, F.lit(0)).otherwise(F.pmod(F.xxhash64("fp"), parts))
    others = F.sequence(F.lit(0).cast("long"), parts - 1)
    meetings = F.transform(others, lambda o: F.struct(F.least(o, part).alias("one"), F.greatest(o, part).alias("other")))
    met = postings.join(lists, "key").select("key", "fp", "node", F.explode(meetings).alias("m"))
    met = met.select(F.xxhash64("key", "m.one", "m.other").alias("key"), "fp", "node")

    def within(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = int(np.searchsorted(rows["key"].to_numpy(), rows["key"].iloc[-1]))  # the last list may go on
            rest = rows.iloc[last:]
            yield from edges_of(rows.iloc[:last])
        if rest is not None:
            yield from edges_of(rest)

    def edges_of(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        node = rows["node"].to_numpy()
        for a, b in _links(rows["key"].to_numpy(), rows["fp"].to_numpy(), max_bits):
            yield pd.DataFrame({"u": node[a], "v": node[b]})

    return met.repartition("key").sortWithinPartitions("key").mapInPandas(within, "u long, v long").distinct()


def _classes(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    marked = staged(fingerprints(docs, words))
    points = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("node")).where("node is not null"))
    found = components(links(points, max_bits))
    classes = points.join(found, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return marked.join(classes, "fp", "left")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id reachable over links), one row per row.

    Null texts count as empty: fingerprint zero, linked like any other. Rows without doc_id get the component of
    the documents with their fingerprint, or null, and link nothing. Rows that share a doc_id each get the component of their
    own fingerprint. Repeated rows stay; other columns are ignored.
    """
    return _classes(docs, words, max_bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """Of each component the document with the least doc_id, with all its columns.

    Of several rows with that doc_id the least one stays, by its columns in order. Rows without doc_id belong to no component
    and stay.
    """
    key = free_name(docs, "text_key")
    first = (_classes(docs, words, max_bits).where("doc_id = component_id")
             .select("doc_id", F.col("text_key").alias(key)).distinct())
    keyed = docs.where(F.col("doc_id").isNotNull()).withColumn(key, F.xxhash64(utf8()))
    others = [c for c in docs.columns if c.lower() != "doc_id"]
    kept = (keyed.join(first, ["doc_id", key], "left_semi")
            .groupBy("doc_id").agg(F.min(F.struct(*others)).alias(key)).select("doc_id", f"{key}.*"))
    return kept.select(*docs.columns).unionAll(docs.where(F.col("doc_id").isNull()))
