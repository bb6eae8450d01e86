import re

import numpy as np
import pytest
from cases import frame, prose, rows

from shelfmark.llm import quality


def _base(text: str) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 2_000 else None
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    doubled = sum(line in lines[:k] for k, line in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled,
            None if covered is None else len(covered))


def test_base_counts_on_edge_documents(spark):
    got = quality.quality(frame(spark)).collect()
    assert len(got) == len(rows())
    extra = ["a\nb\na\n \n \n", "x x x x", "x x x", "# | <é> %\n#", "a b c a b c"]
    more = quality.quality(frame(spark, [(100 + k, t, "en", *[None] * 13) for k, t in enumerate(extra)])).collect()
    for source, result in ((rows(), got), ([(100 + k, t) for k, t in enumerate(extra)], more)):
        for (i, text, *_), r in zip(sorted(source, key=lambda r: (str(r[0]), r[1] or "")),
                                    sorted(result, key=lambda r: str(r["doc_id"]))):
            if i in (14, None):
                continue
            want = _base(text or "")
            found = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
            assert found[:4] == want[:4] and want[4] in (None, found[4]), i
            assert r["base_failed"] == (found[0] < 50 or 100 * found[4] > 50 * found[0])
            assert not (r["base_failed"] and r["kept"])


def test_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0.0, 5, 0])
    assert quality.distance(p, p, False) == 0
    assert quality.distance(p, q, False) == pytest.approx(1)
    assert quality.distance(p, np.zeros(3), True) == 0
    draw = np.random.default_rng(1)
    share = np.r_[0.25 * draw.dirichlet(np.ones(24)), 0.75]  # most words of a text are none of the common ones
    by_chance = [quality.distance(draw.multinomial(60, share).astype(float), share * 1e6, True) for _ in range(200)]
    assert np.mean(by_chance) < 0.12 and np.percentile(by_chance, 95) < quality.MAX_WORD_DISTANCE


def test_odd_documents_of_a_language_are_rejected(spark):
    words = prose(3, 400, 80).split()
    draw = np.random.default_rng(2)
    clean = [(k, " ".join(draw.choice(words, 150)), "en", "s", 1, *[None] * 11) for k in range(90)]
    odd = [(200, " ".join(f"{w}###" for w in draw.choice(words, 150)), "en", "s", 1, *[None] * 11),
           (201, " ".join(draw.choice(words, 150)).upper() + "!!" * 40, "en", "s", 1, *[None] * 11),
           (202, " | ".join(f"w{k}" for k in range(200)), "en", "s", 1, *[None] * 11)]
    kept = {r["doc_id"] for r in quality.quality(frame(spark, clean + odd)).collect() if r["kept"]}
    assert not kept & {200, 201, 202}
    assert len(kept) >= 0.95 * 90  # so few common words in each text leave a little to chance
    passing = quality.passing(frame(spark, clean + odd))
    assert passing.columns == frame(spark).columns and {r["doc_id"] for r in passing.collect()} == kept


def _small_language():
    words = prose(3, 400, 80).split()
    draw = np.random.default_rng(2)
    clean = [(k, " ".join(draw.choice(words, 150)), "en", "s", 1, *[None] * 11) for k in range(60)]
    odd = [(200, " ".join(f"{w}###" for w in draw.choice(words, 150)), "en", "s", 1, *[None] * 11),
           (201, " | ".join(f"w{k}" for k in range(200)), "en", "s", 1, *[None] * 11)]
    return clean + odd


def test_rows_of_another_language_change_no_verdict(spark):
    docs = frame(spark, _small_language())
    alone = {r["doc_id"]: tuple(r) for r in quality.quality(docs).collect()}
    assert not alone[200][-1] and not alone[201][-1]
    large = spark.range(300, 325).selectExpr("id doc_id", "repeat('ab cd ', 250000) text", "'xx' lang")
    among = quality.quality(docs.select("doc_id", "text", "lang").unionByName(large)).where("doc_id < 300").collect()
    assert {r["doc_id"]: tuple(r) for r in among} == alone


def test_more_languages_than_are_broadcast(spark, monkeypatch):
    docs = _small_language()
    docs += [(1_000 * k + i, text, f"l{k}", *rest) for k in range(1, 4) for i, text, _, *rest in docs] + rows()
    want = sorted(map(str, quality.quality(frame(spark, docs)).collect()))
    monkeypatch.setattr(quality, "BROADCAST_LANGUAGES", 2)
    assert sorted(map(str, quality.quality(frame(spark, docs)).collect())) == want
    passing = quality.passing(frame(spark, docs))
    assert passing.columns == frame(spark).columns and passing.count() == sum("kept=True" in w for w in want)


def test_agrees_with_labels_it_never_saw(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    judged = [(labels[r["doc_id"]], r["kept"]) for r in quality.quality(docs).collect()
              if r["doc_id"] in labels and not r["base_failed"]]
    assert sum(kept for label, kept in judged if label == 1) >= 0.99 * sum(label == 1 for label, _ in judged)
    assert sum(not kept for label, kept in judged if label == 0) >= 0.9 * sum(label == 0 for label, _ in judged)


def test_counts_do_not_depend_on_the_parts(spark, monkeypatch):
    docs = frame(spark)
    want = sorted(map(str, quality.language_counts(docs.selectExpr("coalesce(lang,'') lang", "cast(coalesce(text,'') as binary) text")).collect()))
    monkeypatch.setattr(quality, "PART_WORDS", 3)
    again = docs.repartition(3).selectExpr("coalesce(lang,'') lang", "cast(coalesce(text,'') as binary) text")
    assert sorted(map(str, quality.language_counts(again).collect())) == want


def test_empty_table(spark):
    assert quality.quality(frame(spark, [])).collect() == []
    assert quality.passing(frame(spark, [])).collect() == []
