import hashlib

import numpy as np
import pytest
from cases import SMALL, frame, rows, texts_of

from shelfmark.llm import pieces
from shelfmark.llm.tokens import WordTable, packed_ids, tokenizer_path


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))


def _digest(model, text):
    ids = model.encode(text, add_bos=True, add_eos=True)
    return (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(model.decode(ids).encode()).hexdigest())


HARD = [" ", "  ", "a ", " a", "  a  b   ", "▁", "▁▁a ▁", "a\n\n b\n", "\tx", "ﬁ Å é́", "x\u0000y", "😀 漢 字", " a　b", "a" * 300,
        "<s> </s> <unk> <0x0A>"]


def test_as_the_library_does(model):
    coder = pieces.ChunkCoder(tokenizer_path(pieces.MODEL))
    for text in HARD:
        ids, decoded = coder.code(text)
        want = model.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert decoded == model.decode(want), text


def test_tables(spark, model):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r["doc_id"]: tuple(r[1:]) for r in pieces.piece_digests(docs).collect()}
    assert got == {r["doc_id"]: _digest(model, r["text"] or "") for r in docs.collect()}
    edge = sorted((str(r["doc_id"]), *r[1:]) for r in pieces.piece_digests(frame(spark)).collect())
    assert edge == sorted((str(i), *_digest(model, t)) for i, t in texts_of(rows()))
    assert pieces.piece_digests(frame(spark, [])).collect() == []


def test_a_full_table_changes_nothing():
    worked = []
    table = WordTable(lambda words: worked.extend(words) or [w * 2 for w in words], limit=4)
    for _ in range(3):
        assert table.of([*"abcabc"]) == [x * 2 for x in "abcabc"]
        assert table.of([*"defghij"]) == [x * 2 for x in "defghij"]
        assert table.of([]) == []
    assert len(table.known) + len(table.older) <= 4 + 10
    assert packed_ids([1, 2 ** 32 - 1]) == b"\x01\0\0\0\xff\xff\xff\xff"
