import math
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import SMALL, frame, rows, texts_of

from shelfmark.llm import katz


class Brute:
    """The same model with dictionaries."""

    def __init__(self, docs: list[tuple]):
        self.docs = [(i, text.encode().lower().split()) for i, text in docs]
        self.one, self.two = Counter(), Counter()
        for i, words in self.docs:
            if not self.held_out(i):
                tokens = [*words, 1]
                self.one.update(tokens)
                self.two.update(zip([0, *words], tokens))
        self.n = sum(self.one.values())
        self.d1, self.d2 = (katz.discounts(np.array([sum(c == k for c in x.values()) for k in range(1, 7)]))
                            for x in (self.one, self.two))
        total = sum(self.cut(c, self.d1) for c in self.one.values())
        apart = 0 if total < self.n else 0.5
        self.p1 = {w: self.cut(c, self.d1) / (self.n + apart) for w, c in self.one.items()}
        self.unknown = (self.n + apart - total) / (self.n + apart) if self.n else 1.0
        self.count, self.kept, self.seen = Counter(), Counter(), Counter()
        for (h, w), c in self.two.items():
            self.count[h] += c
            self.kept[h] += self.cut(c, self.d2)
            self.seen[h] += self.p1[w]

    @staticmethod
    def held_out(i):
        return zlib.crc32(str(i).encode() if i is not None else b"") % 5 == 1

    @staticmethod
    def cut(c, d):
        return c * (d[c] if c <= 5 else 1)

    def p(self, h, w):
        if not self.count[h]:
            return self.p1.get(w, self.unknown)
        whole = self.count[h] + (0 if self.kept[h] < self.count[h] - 1e-9 else 0.5)
        if (h, w) in self.two:
            return self.cut(self.two[h, w], self.d2) / whole
        return (whole - self.kept[h]) / whole / (1 - self.seen[h]) * self.p1.get(w, self.unknown)

    def row(self, i, words):
        tokens = [*words, 1]
        base = sum(math.log10((self.one.get(t, 0) + 0.5) / (self.n + 0.5 * (len(self.one) + 1))) for t in tokens)
        score = sum(math.log10(self.p(h, t)) for h, t in zip([0, *words], tokens))
        return (i, self.held_out(i), len(tokens), sum(t in self.one for t in tokens), self.n, base, score)


def _compare(got, brute):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    want = sorted((brute.row(i, words) for i, words in brute.docs), key=key)
    got = sorted((tuple(r) for r in got), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


@pytest.mark.parametrize("chunk, bucket, frequent", [(1 << 21, 16 << 20, 128), (3_000, 20_000, 128), (3_000, 20_000, 4)])
def test_scores_of_a_table(spark, monkeypatch, chunk, bucket, frequent):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    monkeypatch.setattr(katz, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(katz, "FREQUENT_WORDS", frequent)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    brute = Brute([(r["doc_id"], r["text"] or "") for r in docs.collect()])
    _compare(katz.scores(docs).collect(), brute)


def test_edge_documents(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(katz, "BUCKET_BYTES", 5_000)
    _compare(katz.scores(frame(spark)).collect(), Brute(texts_of(rows())))


def test_distributions_sum_to_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    brute = Brute([(r["doc_id"], r["text"] or "") for r in docs])
    for h in [0, *list(brute.one)[:25]]:
        assert sum(brute.p(h, w) for w in brute.one) + brute.p(h, None) == pytest.approx(1)


def test_beats_single_words_on_held_out_documents(spark):
    got = [r for r in katz.scores(spark.read.parquet(f"{SMALL}/documents.parquet")).collect() if r["held_out"]]
    assert sum(r["score"] for r in got) > sum(r["base_score"] for r in got)


def test_without_training_documents_and_empty(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    got = katz.scores(frame(spark, [(held, "a b", None, *[None] * 13)])).collect()
    assert [tuple(r) for r in got] == [(held, True, 3, 0, 0, pytest.approx(0), pytest.approx(0))]
    assert katz.scores(frame(spark, [])).collect() == []


def test_discounts_where_good_turing_is_undefined():
    assert (katz.discounts(np.zeros(6, int))[1:] < 1).all()
    assert (katz.discounts(np.array([10, 0, 3, 0, 0, 9])) > 0).all()
    assert (katz.discounts(np.array([1000, 300, 150, 90, 60, 45]))[1:] < 1).all()
