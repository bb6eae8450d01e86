import zlib

import numpy as np
import pytest
from cases import SMALL, frame, prose, rows
from pyspark.sql import functions as F

from shelfmark.llm import packing
from shelfmark.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(packing.TOKENIZER))


def test_words_are_encoded_as_the_tokenizer_does(tokenizer):
    coder = packing.WordCoder(tokenizer_path(packing.TOKENIZER))
    hard = ["".join(map(chr, range(0x250))), "".join(f"a{chr(c)}B" for c in range(0x180)), "Don't WE'LL x\u0085y á İ ΣΑΣ",
            "a <|endoftext|>b <|startoftext|>", "漢字 ÀÉ—x’s …€5 ²½ q_r", " a​b　c"]
    for text in [*hard, *(t or "" for _, t, *_ in rows())]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(coder.ids(text.encode()), "<u4").tolist() == want, text[:60]


def test_texts_encoded_together_share_their_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "TEXT_AT_ONCE", 9_000)
    coder = packing.WordCoder(tokenizer_path(packing.TOKENIZER))
    texts = [t or "" for _, t, *_ in rows()] + ["", "a\x1cb \x1f x\x00y", "  Ünd\x85so\xa0on ", "漢字"] + [f"{prose(2, 300)} {k}" for k in range(30)]
    cut, inner = [], coder.cut
    coder.cut = lambda text: cut.append(len(text)) or inner(text)
    got = [np.frombuffer(i, "<u4").tolist() for i in coder.ids_of([t.encode() for t in texts])]
    assert got == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert 2 * sum(cut) < sum(map(len, texts))


def test_knapsack_is_best():
    draw = np.random.default_rng(3)
    for _ in range(20):
        worth = np.where(draw.random(31) < 0.4, draw.random(31), -np.inf)
        worth[0] = -np.inf
        best = np.zeros(31)
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(best[c - s] + worth[s] for s in range(1, c + 1))])
        assert packing.knapsack(worth) == pytest.approx(best)


@pytest.mark.parametrize("seed", range(6))
def test_plan_takes_every_piece_once(seed):
    draw = np.random.default_rng(seed)
    counts = np.zeros(65, np.int64)
    counts[1:] = draw.poisson(3.0 ** seed, 64) * (draw.random(64) < 0.7)
    chosen = packing.plan(counts)
    taken = np.zeros(65, np.int64)
    for pattern, times in chosen:
        assert sum(s * n for s, n in pattern) <= 64
        for s, n in pattern:
            taken[s] += n * times
    assert (taken == counts).all()
    needed = -(-int((counts * np.arange(65)).sum()) // 64)
    used = sum(times for _, times in chosen)
    assert needed <= used <= sum(times for _, times in packing.longest_first(counts)) * 1.01 + 1


@pytest.mark.parametrize("lengths", [range(1, 257), range(60, 128), (40, 90, 100, 130), (200,)])
def test_program_covers_all_and_is_near_its_bound(lengths):
    counts = np.zeros(257, np.int64)
    counts[list(lengths)] = np.random.default_rng(1).integers(500, 2_000, len(lengths))
    amounts, bound = packing.fractional(counts)
    covered = np.zeros(257)
    for pattern, amount in amounts.items():
        assert sum(s * n for s, n in pattern) <= 256 and amount > 0
        for s, n in pattern:
            covered[s] += amount * n
    assert covered == pytest.approx(counts)
    # No packing, not even in fractions, is below the bound; longest first is one from above.
    assert (counts * np.arange(257)).sum() / 256 <= bound * (1 + 1e-9)
    assert bound <= sum(t for _, t in packing.longest_first(counts)) * (1 + 1e-9)
    assert sum(amounts.values()) <= (1.01 if len(lengths) > 100 else 1.25) * bound


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_configurations_place_the_pieces_of_the_table(spark, sf):
    docs = spark.read.parquet(f"{SMALL.rsplit('/', 1)[0]}/{sf}/documents.parquet")
    counts = np.zeros(packing.CAPACITY + 1, np.int64)
    for r in packing.token_pieces(docs).groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    chosen, left = packing.rounded(packing.fractional(counts)[0], counts)
    assert left.sum() < 0.05 * counts.sum()
    fillings = chosen + packing.longest_first(left)
    assert packing.plan(counts) == fillings
    assert sum(t for _, t in fillings) == -(-int((counts * np.arange(len(counts))).sum()) // packing.CAPACITY)


def _check_places(placed, capacity):
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_edge_documents(spark, tokenizer):
    placed = packing.packed_documents(frame(spark)).collect()
    want = []
    for doc_id, text, *_ in rows():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start:start + 4096], "<u4")
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((tuple(r[:5]) for r in placed), key=key) == sorted(want, key=key)
    n = _check_places(placed, 4096)
    assert n == -(-sum(r[3] for r in want) // 4096)


def test_empty_table(spark):
    assert packing.packed_documents(frame(spark, [])).collect() == []


def test_many_pieces_of_one_length(spark):
    pieces = spark.range(9_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(
        F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 90 + 1).cast("int").alias("length"))
    placed = packing.pack(pieces, 100).collect()
    assert len({r["doc_id"] for r in placed}) == len(placed) == 9_000
    assert _check_places(placed, 100) <= 1.01 * sum(r["length"] for r in placed) / 100 + 1


def test_sequences_hold_the_ids(spark):
    docs = frame(spark, [r for r in rows() if r[0] in (1, 8, 12)])
    ids = packing.token_pieces(docs)
    placed = packing.packed_documents(docs)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(placed, ids).collect()}
    parts = {(r["doc_id"], r["piece"]): bytes(r["ids"]) for r in ids.collect()}
    for r in placed.collect():
        at = 4 * r["offset"]
        assert whole[r["sequence_id"]][at:at + 4 * r["length"]] == parts[r["doc_id"], r["piece"]]
