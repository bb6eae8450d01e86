from itertools import combinations

import numpy as np
import pytest
import xxhash
from cases import frame, rows

from shelfmark.llm import components, simhash


def _fingerprint(text: str, n: int = 3) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for white in "\t\n\v\f\r":
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps: list[tuple[int, int]], bits: int = 3) -> dict[int, int]:
    """node -> least node reachable, from (node, fingerprint)."""
    root = {n: n for n, _ in fps}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for (a, x), (b, y) in combinations(fps, 2):
        if (x ^ y).bit_count() <= bits:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {n: find(n) for n in root}


def test_three_differing_bytes_leave_a_position_set():
    for spoiled in combinations(range(8), 3):
        assert any(not set(s) & set(spoiled) for s in simhash.POSITION_SETS)


def test_fingerprints():
    for _, text, *_ in rows():
        assert simhash.simhash((text or "").encode()) == _fingerprint(text or "")


@pytest.mark.parametrize("block", [3, 1024])
def test_links_join_exactly_what_is_linked(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "LIST_BLOCK", block)
    draw = np.random.default_rng(block)
    fps = []
    for centre in draw.integers(0, 2 ** 64, 12, dtype=np.uint64).tolist():
        for _ in range(25):  # some within reach of each other, some only over others
            centre ^= sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 5), replace=False))
            fps.append(centre)
    fps = list(dict.fromkeys(fps))
    nodes = [(n, f) for n, f in enumerate(fps)]
    points = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)), n) for n, f in nodes], "fp long, node long")
    edges = simhash.links(points)
    by_node = dict(nodes)
    assert all((by_node[r["u"]] ^ by_node[r["v"]]).bit_count() <= 3 for r in edges.collect())
    got = {r["node"]: r["component"] for r in components.components(edges).collect()}
    want = _components(nodes)
    assert {n: got.get(n, n) for n, _ in nodes} == want
    assert len(set(want.values())) < len(nodes)


def test_components_of_a_long_chain_a_star_and_repeats(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(200)] + [(7, 7), (5, 6), (6, 5), (-3, 2000)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(301)}, **{1000 + k: 1000 for k in range(200)}, -3: -3, 2000: -3}
    assert components.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_edge_documents(spark):
    fps = [(i, _fingerprint(t or "")) for i, t, *_ in rows()]
    first = {}
    for i, f in fps:
        if i is not None:
            first[f] = min(i, first.get(f, i))
    linked = _components([(i, f) for f, i in first.items()])
    expected = sorted((str(i), f"{f:016x}", str(linked.get(first.get(f)))) for i, f in fps)
    got = simhash.near_duplicates(frame(spark)).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == expected


def test_empty_table(spark):
    assert simhash.near_duplicates(frame(spark, [])).collect() == []
    assert simhash.one_of_each(frame(spark, [])).collect() == []


def test_one_of_each_keeps_the_first_and_all_columns(spark):
    docs = frame(spark)
    kept = simhash.one_of_each(docs)
    assert kept.dtypes == docs.dtypes
    got = simhash.near_duplicates(docs).collect()
    ids = sorted({r["component_id"] for r in got if r["doc_id"] is not None})
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == ids
    assert sum(r["doc_id"] is None for r in kept.collect()) == 2
