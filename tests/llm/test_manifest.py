import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import frame, rows

from shelfmark.llm import manifest


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, lower=False):
    doc_id, text, lang, source, n_chars = row[:5]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def _climb(leaves):
    """Root, and for each leaf its runs with its place in them."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for k in range(len(leaves)):
            run = level[at[k] // 8 * 8:at[k] // 8 * 8 + 8]
            paths[k].append((run, at[k] % 8))
            at[k] //= 8
        level = [_h(*level[k:k + 8]) for k in range(0, len(level), 8)]
    return level[0], paths


def _brute(table):
    groups = {}
    for row in table:
        groups.setdefault(b"" if row[2] is None else b"=" + row[2].encode(), []).append(row)
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
    trees = {name: _climb([_leaf(r) for r in own]) for name, own in groups.items()}
    if not trees:
        return []
    root, tops = _climb([trees[name][0] for name in sorted(trees)])
    out = []
    for top, name in zip(tops, sorted(trees)):
        for row, path in zip(groups[name], trees[name][1]):
            path = path + top
            proof = _h(*(x for run, k in path for x in run[:k] + run[k + 1:]))
            folded = _leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0)
            for run, k in path:
                folded = _h(*run[:k], folded, *run[k + 1:])
            out.append((str(row[0]), _leaf(row), trees[name][0], root, proof, folded, folded == root))
    return sorted(out)


def _run(spark, table):
    return sorted((str(r[0]), *r[1:]) for r in manifest.proofs(frame(spark, table)).collect())


@pytest.mark.parametrize("part", [1 << 15, 5])
def test_odd_rows(spark, monkeypatch, part):
    monkeypatch.setattr(manifest, "PART_LEAVES", part)
    assert _run(spark, rows()) == _brute(rows())


@pytest.mark.parametrize("n", [0, 9])
def test_small_trees(spark, n):
    table = [(k, f"Text {k}", "en", "s", k, *rows()[0][5:]) for k in range(n)]
    assert _run(spark, table) == _brute(table)


def test_one_language_holds_most_rows_and_many_hold_one(spark, monkeypatch):
    monkeypatch.setattr(manifest, "PART_LEAVES", 300)
    monkeypatch.setattr(manifest, "TILE_LEVELS", 2)
    draw = random.Random(3)
    table = [(draw.randint(-(1 << 62), 1 << 62), f"Text {k}", "é" if k % 2 else f"l{k}", None, k, *rows()[0][5:]) for k in range(1_500)]
    table += table[:40]
    assert _run(spark, table) == _brute(table)


def test_changed_rows_do_not_verify(spark):
    table = [(k, "Upper" if k % 2 else "lower", "en", "s", 5, *rows()[0][5:]) for k in range(60)]
    for doc_id, *_, verified in manifest.proofs(frame(spark, table)).collect():
        assert verified == (doc_id % 2 == 0 or zlib.crc32(str(doc_id).encode()) % 3 != 0)


def test_proofs_of_some_rows_fetch_few_nodes(spark):
    table = [(k, f"Text {k}", "en" if k % 3 else None, "s", k, *rows()[0][5:]) for k in range(400)]
    stored = manifest.build(frame(spark, table))
    some = stored.leaves.where("doc_id % 50 = 1")
    got = sorted((str(r[0]), *r[1:]) for r in manifest.prove(stored, some).collect())
    assert got == [r for r in _brute(table) if int(r[0]) % 50 == 1]


@pytest.mark.parametrize("leaves", [1, 7, 8, 9, 64, 65, 1000])
def test_missing_nodes_are_the_fewest(leaves):
    draw = np.random.default_rng(leaves)
    for _ in range(20):
        own = draw.choice(leaves, draw.integers(1, min(leaves, 40) + 1), replace=False)
        lacking = manifest.missing_nodes(np.repeat(own, 2), leaves)
        covered = [{*own.tolist()}]
        for size in manifest.sizes(leaves)[1:]:
            covered.append({p >> 3 for p in covered[-1]})
        wanted = {(level, 8 * p + k) for level, size in enumerate(manifest.sizes(leaves)[:-1]) for p in covered[level + 1]
                  for k in range(8) if 8 * p + k < size} - {(level, p) for level, own_ in enumerate(covered) for p in own_}
        assert len(lacking) == len(wanted) and set(lacking) == wanted
        nodes = {(0, p): _h(str(p)).encode() for p in range(leaves)}
        for level, size in enumerate(manifest.sizes(leaves)[1:]):
            for p in range(size):
                nodes[level + 1, p] = _h(*(nodes[level, c].decode() for c in range(8 * p, 8 * p + 8) if (level, c) in nodes)).encode()
        tree = manifest.PartialTree(leaves, {n: nodes[n] for n in [*lacking, *((0, int(p)) for p in own)]})
        assert all(tree.root == tree.fold(int(p), nodes[0, int(p)]) == nodes[len(manifest.sizes(leaves)) - 1, 0] for p in own)
