import hashlib
import random
import tracemalloc
from itertools import product

import pandas as pd
import pytest
from cases import frame, prose, rows, texts_of

from shelfmark.llm import repeats


def _brute(docs: list[tuple]) -> list[tuple]:
    """By hand: named documents in order; a window goes if its words start at a smaller (doc_id, start)."""
    first = {}
    split = [(i, text.encode().split()) for i, text in docs]
    for i, words in split:
        if i is not None:
            for p in range(len(words) - 19):
                key = tuple(words[p:p + 20])
                first[key] = min(first.get(key, (i, p)), (i, p))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            if i is not None and first[tuple(words[p:p + 20])] < (i, p):
                gone[p:p + 20] = [True] * 20
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(i), len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _run(docs):
    return sorted((str(r[0]), *r[1:4]) for r in repeats.remove_repeats(docs).collect())


def test_any_two_positions_meet_at_a_cover_position():
    cover = set(repeats.COVER)
    for a, b in product(range(repeats.PERIOD), repeat=2):
        assert any((a + k) % 13 in cover and (b + k) % 13 in cover for k in range(repeats.PERIOD))


@pytest.mark.parametrize("batch, keys", [(6 << 20, 1 << 20), (2_000, 100)])
def test_edge_documents(spark, monkeypatch, batch, keys):
    monkeypatch.setattr(repeats, "BATCH_BYTES", batch)
    monkeypatch.setattr(repeats, "BUCKET_KEYS", keys)
    assert _run(frame(spark)) == _brute(texts_of(rows()))


def test_random_passages_and_copies(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH_BYTES", 3_000)
    monkeypatch.setattr(repeats, "BUCKET_KEYS", 200)
    draw = random.Random(9)
    passages = [prose(k, draw.randint(15, 60)).split() for k in range(12)] + [["same"] * 45]
    docs = []
    for i in range(120):
        words = []
        for _ in range(draw.randint(0, 4)):
            passage = draw.choice(passages)
            cut = draw.randint(0, 10)
            words += passage[cut:] + prose(500 + draw.randint(0, 10 ** 6), draw.randint(0, 25)).split()
        docs.append((draw.randint(-40, 100), " ".join(words)))
    got = _run(frame(spark, [(*d, *[None] * 14) for d in docs]))
    want = _brute(docs)
    assert got == want
    assert sum(r[2] for r in want) > 1_000


def test_a_batch_holds_little_more_than_its_texts():
    rows_ = pd.DataFrame({"doc_id": range(20), "text": [prose(k, 10_000).encode() for k in range(20)]})
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    batch = repeats.Batch(rows_)
    held = tracemalloc.get_traced_memory()[0] - before
    tracemalloc.stop()
    assert len(batch.words) == 20 and held < 6 * rows_["text"].map(len).sum()


def test_cut_text_keeps_its_form(spark):
    passage = prose(1, 30)
    docs = [(1, f"start\n\n{passage} end", *[None] * 14), (2, f"one  two\nthree {passage}\nfour   five", *[None] * 14),
            (3, "kept \n as it is ", *[None] * 14), (4, passage, *[None] * 14), (None, passage, *[None] * 14), (5, None, *[None] * 14)]
    frame_ = frame(spark, docs)
    cut = repeats.without_repeats(frame_)
    assert cut.columns == frame_.columns
    got = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert got == {1: docs[0][1], 2: "one  two\nthree four   five", 3: "kept \n as it is ", 4: "", None: passage, 5: None}


def test_rows_are_neither_lost_nor_doubled(spark):
    docs = frame(spark)
    assert repeats.without_repeats(docs).count() == docs.count()


def test_empty_table(spark):
    assert _run(frame(spark, [])) == []
    assert repeats.without_repeats(frame(spark, [])).collect() == []
