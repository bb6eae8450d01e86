"""Each stage against a brute-force version on its own input, and the whole on rows of every kind."""

import sys
from collections import Counter
from itertools import combinations
from pathlib import Path

import pytest
from cases import SMALL, frame, rows

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402
from shelfmark.llm import packing, secrets, simhash  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """What each stage gets on the small table, and what the last one gives."""
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for k, (_, stage) in enumerate(pipeline.STAGES):
        found.append(docs)
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SMALL).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*found, docs]


def _rows(docs):
    return {r["doc_id"]: tuple(r) for r in docs.collect()}


def test_columns(inputs):
    assert all(docs.columns == COLUMNS for docs in inputs[:-1])


def test_quality_stage_keeps_rows_as_they_are(spark, inputs):
    before, after = _rows(inputs[0]), _rows(inputs[1])
    assert all(before[i] == row for i, row in after.items())
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1 and len(before[i][1].split()) >= 50]
    assert sum(i in after for i in good) >= 0.98 * len(good)
    assert not [i for i in after if len(before[i][1].split()) < 50]


def test_simhash_stage_keeps_the_first_of_each_group(inputs):
    before, after = _rows(inputs[1]), _rows(inputs[2])
    fps = {i: simhash.simhash((r[1] or "").encode()) for i, r in before.items()}
    root = {i: i for i in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 3:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert after == {i: r for i, r in before.items() if find(i) == i}


def test_substring_stage_cuts_later_windows(inputs):
    before, after = _rows(inputs[2]), _rows(inputs[3])
    assert before.keys() == after.keys()
    seen = set()
    for i in sorted(before):
        words = before[i][1].encode().split()
        gone = [False] * len(words)
        for p in range(len(words) - 19):
            window = tuple(words[p:p + 20])
            if window in seen:
                gone[p:p + 20] = [True] * 20
            seen.add(window)
        assert after[i][1].encode().split() == [w for w, g in zip(words, gone) if not g]
        assert after[i][4] == len(after[i][1])


def test_secret_stage_leaves_no_match(inputs):
    before, after = _rows(inputs[3]), _rows(inputs[4])
    assert before.keys() == after.keys()
    for i, row in before.items():
        assert not secrets.pattern_spans(after[i][1].encode())
        if not secrets.pattern_spans(row[1].encode()):
            assert after[i][1] == row[1] or secrets.PLACEHOLDER in after[i][1]


def test_packing_stage_holds_every_document(inputs):
    coder = packing.WordCoder(packing.tokenizer_path(packing.TOKENIZER))
    lengths = {i: len(coder.ids(r[1].encode())) // 4 + 1 for i, r in _rows(inputs[4]).items()}
    pieces = inputs[5].collect()
    total = Counter()
    for r in pieces:
        total[r["doc_id"]] += r["length"]
    assert dict(total) == lengths
    assert len({r["sequence_id"] for r in pieces}) <= -(-sum(lengths.values()) // 4096) + 1


def test_run_gives_what_the_stages_give(spark, inputs):
    got = pipeline.run(spark, SMALL)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, inputs[5].select(names).collect()))


@pytest.mark.parametrize("kept", [None, []])
def test_rows_of_every_kind_and_none(spark, kept):
    for name, stage in pipeline.STAGES[:-1]:
        docs = frame(spark, kept)
        result = stage(spark, docs, SMALL)
        assert result.columns == docs.columns
        n = result.count()
        assert n <= docs.count() and (n == len(rows()) or kept == [] or name in ("quality rules", "simhash dedup"))
