"""Merkle manifest of a dataset, and proofs for its rows by octopus multiproofs.

Each row is a leaf; the leaves of a language form a tree of eight children a node, and the roots of the languages form one more
tree. Leaves are put in order by ranges, each range a leaf partition of bounded size; places in the tree come from the
partitions' row counts. Four levels at a time are derived from the level below, in tiles of 4,096 nodes.

To prove its leaves a partition works out which node coordinates their common proof lacks: the children of its leaves' ancestors
that are no ancestors themselves. It fetches that union once, derives the ancestors its leaves share, and reads every
single proof from them, without asking for a node twice.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfmark.scratch import fresh_scratch, write_through

from .common import buckets_for, free_name

FANOUT_BITS = 3
FANOUT = 1 << FANOUT_BITS
PART_LEAVES = 1 << 15
TILE_LEVELS = 4  # levels that one task derives from FANOUT ** TILE_LEVELS nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "^"  # the tree over the languages' roots; trees of languages are named "" (null) or "=" and the language
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

PROVEN = "doc_id long, unnamed boolean, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf_hash(text: Column | None = None) -> Column:
    """SHA-256 (hex) of a row's fields, each `-` if null, else its UTF-8 length, `:` and its value."""
    def field(name: str) -> Column:
        value = (text if name == "text" and text is not None else F.col(name)).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    return F.sha2(F.concat(*map(field, FIELDS)).cast("binary"), 256)


def tampered() -> Column:
    """Whether a row is one of those whose text a test of the manifest changes; never for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))


def sizes(leaves: int) -> list[int]:
    """Nodes of each level of a tree, from its leaves to its root."""
    levels = [leaves]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // FANOUT))
    return levels


def missing_nodes(places: np.ndarray, leaves: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes from which, with the leaves at `places`, the root can be derived."""
    own, lacking = np.unique(places), []
    for level, size in enumerate(sizes(leaves)[:-1]):
        parents = np.unique(own >> FANOUT_BITS)
        children = (parents[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        lacking += [(level, int(p)) for p in np.setdiff1d(children[children < size], own, assume_unique=True)]
        own = parents
    return lacking


def _digest(parts: list[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


class PartialTree:
    """The part of a tree that some leaves and their missing nodes determine."""

    def __init__(self, leaves: int, known: dict[tuple[int, int], bytes]):
        """known: (level, place) -> digest as hex text."""
        self.depth, self.runs = len(sizes(leaves)) - 1, []
        nodes = {place: digest for (level, place), digest in known.items() if level == 0}
        for level, size in enumerate(sizes(leaves)[:-1]):
            runs, above = {}, {p: d for (at, p), d in known.items() if at == level + 1}
            for parent in {place >> FANOUT_BITS for place in nodes}:
                first = parent << FANOUT_BITS
                run = [nodes[place] for place in range(first, min(first + FANOUT, size))]
                runs[parent], above[parent] = run, _digest(run)
            self.runs.append(runs)
            nodes = above
        self.root = nodes[0]
        self._above: dict[tuple[int, int], bytes] = {}

    def siblings(self, place: int, level: int = 0) -> bytes:
        """The siblings of a node and of its ancestors, level by level; those of ancestors are put together once."""
        if level == self.depth:
            return b""
        parent, own = place >> FANOUT_BITS, place % FANOUT
        if (level, parent) not in self._above:
            self._above[level, parent] = self.siblings(parent, level + 1)
        run = self.runs[level][parent]
        return b"".join(run[:own] + run[own + 1:]) + self._above[level, parent]

    def fold(self, place: int, digest: bytes) -> bytes:
        """The root that follows from `digest` in place of a node and the node's siblings."""
        for level in range(self.depth):
            parent, own = place >> FANOUT_BITS, place % FANOUT
            run = self.runs[level][parent]
            digest, place = _digest(run[:own] + [digest] + run[own + 1:]), parent
        return digest


@dataclass
class Manifest:
    """leaves: part, tree, place, size (leaves of the tree), doc_id, leaf, altered (binary; null: not tampered with).

    nodes: tree, level, place, size (nodes of the level), hash (binary), level 0 included. trees: tree, lang, tree_place, trees,
    subroot, root.
    """

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def _placed(rows: DataFrame, order: list[str], path: str) -> DataFrame:
    """`rows` with part, place and size: their places in the order of their tree, found by ranges of bounded size.

    Rows that are equal in all of `order` may share out their places in any way.
    """
    salt = free_name(rows, "salt")  # equal rows may fill several ranges
    key = ["tree", *order, salt]
    dealt = (rows.withColumn(salt, F.monotonically_increasing_id())
             .repartitionByRange(buckets_for(rows.count(), PART_LEAVES), *key).sortWithinPartitions(*key).drop(salt))
    # Partition in the upper bits, row within it in the lower 33.
    kept = write_through(dealt.withColumn("at", F.monotonically_increasing_id()), f"{path}/ordered")
    kept = kept.withColumn("part", F.shiftright("at", 33))
    runs = kept.groupBy("part", "tree").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")  # a row for each of its partitions
    runs = runs.select("part", "tree", F.sum("n").over(tree).alias("size"),
                       (F.col("first") - F.sum("n").over(tree.orderBy("part")) + F.col("n")).alias("base"))
    placed = kept.join(runs, ["part", "tree"]).withColumn("place", F.col("at") - F.col("base")).drop("at", "base")
    return write_through(placed, f"{path}/placed")


def _tile(rows: pd.DataFrame) -> pd.DataFrame:
    """The next TILE_LEVELS levels over one node's worth of consecutive nodes of a tree."""
    rows = rows.sort_values("place")
    level, size, first = int(rows["level"].iloc[0]), int(rows["size"].iloc[0]), int(rows["place"].iloc[0])
    run, out = [h.hex().encode() for h in rows["hash"]], []
    for _ in range(TILE_LEVELS):
        if size == 1:
            break
        run = [_digest(run[k:k + FANOUT]) for k in range(0, len(run), FANOUT)]
        level, size, first = level + 1, -(-size // FANOUT), first >> FANOUT_BITS
        out += [(rows["tree"].iloc[0], level, first + k, size, bytes.fromhex(h.decode())) for k, h in enumerate(run)]
    return pd.DataFrame(out, columns=["tree", "level", "place", "size", "hash"])


def _levels(leaves: DataFrame, path: str) -> DataFrame:
    """tree, level, place, size, hash: the nodes of all trees. Levels are written some at a time, each from the one below."""
    nodes = below = leaves.select("tree", F.lit(0).alias("level"), "place", "size", "hash")
    levels = len(sizes(leaves.agg(F.max("size")).first()[0] or 0))
    for base in range(0, levels - 1, TILE_LEVELS):
        tile = F.shiftright("place", TILE_LEVELS * FANOUT_BITS)
        found = (below.where((F.col("level") == base) & (F.col("size") > 1)).groupBy("tree", tile)
                 .applyInPandas(_tile, "tree string, level int, place long, size long, hash binary"))
        below = write_through(found, f"{path}/from_level={base}")
        nodes = nodes.unionAll(below)
    return nodes


def build(docs: DataFrame, path: str | None = None) -> Manifest:
    """The manifest of `docs` (doc_id, source, lang, n_chars, text), written under `path` (default: a scratch folder).

    Leaves of a language ascend by doc_id, a null id first; rows of one id by their digest. A null lang is a language of
    its own, first of all. A repeated row is a leaf each time. An empty table has no leaves, nodes or trees. Other columns are
    ignored.
    """
    path = path or fresh_scratch(docs.sparkSession, name="manifest")
    lower = F.translate(F.col("text").cast("string"), UPPER, LOWER)
    rows = write_through(docs.select(
        F.when(F.col("lang").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("lang").cast("string"))).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf_hash()).alias("hash"),
        F.when(tampered(), F.unhex(leaf_hash(lower))).alias("altered")), f"{path}/rows")
    leaves = _placed(rows, ["doc_id", "hash"], f"{path}/leaves")
    nodes = _levels(leaves, f"{path}/nodes")
    roots = nodes.where("size = 1").select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "hash")
    tops = _placed(roots, ["name"], f"{path}/top_leaves")
    top_nodes = _levels(tops, f"{path}/top_nodes")
    root = top_nodes.where("size = 1").agg(F.first("hash")).scalar()
    trees = write_through(tops.select(
        F.col("name").alias("tree"), F.when(F.col("name") != "", F.substr("name", F.lit(2))).alias("lang"),
        F.col("place").alias("tree_place"), F.col("size").alias("trees"), F.col("hash").alias("subroot"), root.alias("root")),
        f"{path}/trees")
    return Manifest(leaves.withColumnRenamed("hash", "leaf"), nodes.unionAll(top_nodes), trees)


def _trees_of(rows: pd.DataFrame):
    """(tree, its rows), then the tree over all of them, as (TOP, a row for each)."""
    for tree, own in rows.groupby("tree", sort=False):
        yield tree, own["place"].to_numpy(), int(own["size"].iloc[0])
    tops = rows.drop_duplicates("tree")
    yield TOP, tops["tree_place"].to_numpy(), int(tops["trees"].iloc[0])


def _lacking(rows: pd.DataFrame) -> pd.DataFrame:
    part = int(rows["part"].iloc[0])
    found = [(part, tree, *node) for tree, places, size in _trees_of(rows) for node in missing_nodes(places, size)]
    return pd.DataFrame(found, columns=["part", "tree", "level", "place"])


def _expand(rows: pd.DataFrame, fetched: pd.DataFrame) -> pd.DataFrame:
    if not len(rows):
        return pd.DataFrame([], columns=[c.split()[0] for c in PROVEN.split(", ")])
    known: dict[str, dict] = {tree: {} for tree in (*rows["tree"].unique(), TOP)}
    for f in fetched.itertuples(index=False):
        known[f.tree][f.level, f.place] = f.hash.hex().encode()
    for r in rows.itertuples(index=False):
        known[r.tree][0, r.place] = r.leaf.hex().encode()
    trees = {}
    for tree, places, size in _trees_of(rows):
        if tree == TOP:  # comes last: its leaves are the roots derived before
            known[TOP] |= {(0, int(p)): trees[t].root for t, p in zip(rows.drop_duplicates("tree")["tree"], places)}
        trees[tree] = PartialTree(size, known[tree])
    top, above = trees[TOP], {}
    out = []
    for r in rows.itertuples(index=False):
        tree = trees[r.tree]
        if r.tree not in above:
            above[r.tree] = top.siblings(r.tree_place)
        leaf = (r.leaf if r.altered is None else r.altered).hex().encode()
        folded = top.fold(r.tree_place, tree.fold(r.place, leaf)).decode()
        root = r.root.hex()
        proof = _digest([tree.siblings(r.place), above[r.tree]]).decode()
        out.append((r.doc_id, r.unnamed, r.leaf.hex(), r.subroot.hex(), root, proof, folded, folded == root))
    return pd.DataFrame(out, columns=[c.split()[0] for c in PROVEN.split(", ")])


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for each of `leaves` (default: all of the manifest).

    leaf, subroot and root are the manifest's. folded_root is computed from the tampered leaf, else from the leaf, and its proof;
    verified says whether it is the root.
    """
    asked = (manifest.leaves if leaves is None else leaves).join(manifest.trees, "tree").select(
        "part", "tree", "place", "size", "tree_place", "trees", F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
        F.col("doc_id").isNull().alias("unnamed"), "leaf", "altered", "subroot", "root")
    by_part = asked.groupBy("part")  # at most about PART_LEAVES rows
    wanted = by_part.applyInPandas(_lacking, "part long, tree string, level int, place long")
    fetched = wanted.join(manifest.nodes.select("tree", "level", "place", "hash"), ["tree", "level", "place"])
    proven = by_part.cogroup(fetched.groupBy("part")).applyInPandas(_expand, PROVEN)
    return proven.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id"))).drop("unnamed")


def proofs(docs: DataFrame) -> DataFrame:
    """`prove` for every row of `docs`; what `build` says about nulls, repeats and empty tables holds."""
    return prove(build(docs))
