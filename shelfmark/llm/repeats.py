"""Substring dedup with difference-cover anchors.

Of 13 neighbouring word positions the four whose number modulo 13 is in {0, 1, 3, 9} are cover positions. Any two
positions have an offset below 13 that brings both to a cover position, so two equal windows of 20 words share
an anchor, the 8 words at a cover position, at the same offset. Anchors found more than once are
therefore extended to all windows around them, and only those windows are compared.

Documents are gathered in batches of a few megabytes by doc_id. A batch asks for each of its distinct anchors, then for each
distinct window around a repeated one, and gets answers; asked for once per batch, neither a popular
passage nor a group of copies makes a hot key. Windows are compared by 128-bit hashes of their words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import buckets_for, documents_of, free_name, return_freed_memory, slices_of, spread_of, text_bytes, utf8

WINDOW = 20
PERIOD, COVER = 13, (0, 1, 3, 9)  # every difference modulo 13 is one of two numbers of the cover
ANCHOR = WINDOW - PERIOD + 1
BATCH_BYTES = 6 << 20
BUCKET_KEYS = 1 << 20


class Words:
    """The number of a text's words, and the bytes of any run of them joined by blanks. The words themselves take ten times the text."""

    def __init__(self, text: bytes):
        words = text.split()
        self.n, self.joined = len(words), b" ".join(words)
        lengths = np.fromiter(map(len, words), np.int64, self.n)
        self.stops = np.cumsum(lengths + 1) - 1
        self.starts = self.stops - lengths

    def runs(self, at: np.ndarray, length: int) -> Iterator[bytes]:
        joined = self.joined
        for a, b in zip(self.starts[at].tolist(), self.stops[at + length - 1].tolist()):
            yield joined[a:b]


def cover_positions(n_words: int) -> np.ndarray:
    """Where anchors start in a text that has a window at all."""
    if n_words < WINDOW:
        return np.zeros(0, np.int64)
    every = (np.arange(0, n_words, PERIOD)[:, None] + np.array(COVER)).ravel()
    return every[every <= n_words - ANCHOR]


def _anchors(words: Words, at: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(run) for run in words.runs(at, ANCHOR)), np.uint64, len(at))


class Batch:
    """The documents of one batch, up to the windows they ask for."""

    def __init__(self, rows: pd.DataFrame):
        self.doc_id = rows["doc_id"].to_numpy()
        self.words = [Words(text) for text in rows["text"]]
        self.at = [cover_positions(w.n) for w in self.words]
        self.anchors = [_anchors(w, at) for w, at in zip(self.words, self.at)]

    def distinct_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors in order, and how often the batch holds each."""
        return np.unique(np.concatenate(self.anchors), return_counts=True)

    def ask_windows(self, elsewhere: np.ndarray) -> None:
        """Find the windows around anchors that stand twice here or also stand `elsewhere` (sorted).

        Sets `row`, `start` and `key` of each, and of the distinct ones, in order: `keys`, `of` (windows to distinct),
        `first` (least doc_id).
        """
        anchors, counts = self.distinct_anchors()
        repeated = np.union1d(anchors[counts > 1], elsewhere)
        digest = xxhash.xxh3_128_digest
        rows, starts, keys = [], [], []
        for row, (words, at, anchor) in enumerate(zip(self.words, self.at, self.anchors)):
            if not len(at):
                continue
            marks = np.zeros(words.n + 1, np.int64)
            found = np.searchsorted(repeated, anchor)
            found[found == len(repeated)] = 0
            marks[1 + at[repeated[found] == anchor if len(repeated) else np.zeros(len(at), bool)]] = 1
            before = np.cumsum(marks)
            start = np.arange(words.n - WINDOW + 1)
            start = start[before[start + PERIOD] > before[start]]
            rows.append(np.full(len(start), row))
            starts.append(start)
            keys.append(b"".join(digest(run) for run in words.runs(start, WINDOW)))
        self.row = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        self.start = np.concatenate([*starts, np.zeros(0, np.int64)]).astype(np.int64)
        self.key = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)
        doc_id = self.doc_id[self.row]
        self.order = np.lexsort((self.start, doc_id, self.key[:, 1], self.key[:, 0]))
        key = self.key[self.order]
        new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)][:len(key)]
        self.of = np.cumsum(new) - 1
        self.keys, self.first = key[new], doc_id[self.order][new]
        self.first_start = self.start[self.order][new]

    def removed(self, foreign: np.ndarray) -> list[np.ndarray]:
        """For each document, which words go. foreign: of the distinct windows, those that start earlier in another batch."""
        row, start = self.row[self.order], self.start[self.order]
        later = (self.doc_id[row] != self.first[self.of]) | (start != self.first_start[self.of])
        gone = foreign[self.of] | later
        marks = [np.zeros(w.n + 1, np.int64) for w in self.words]
        row, start = row[gone], start[gone]
        by_row = np.argsort(row, kind="stable")
        for r, a, b in slices_of(row[by_row]):
            np.add.at(marks[r], start[by_row[a:b]], 1)
            np.add.at(marks[r], start[by_row[a:b]] + WINDOW, -1)
        return [np.cumsum(m)[:-1] > 0 for m in marks]


def _requests(bucket: np.ndarray, batch: int, *columns: np.ndarray) -> pd.DataFrame:
    rows = [(b, batch, *(np.ascontiguousarray(c[x:y]).tobytes() for c in columns)) for b, x, y in slices_of(bucket)]
    return pd.DataFrame(rows, columns=["bucket", "batch", "keys", "docs"][:2 + len(columns)])


def _which(rows: pd.DataFrame, column: str, width: int) -> np.ndarray:
    """For each key of the concatenated requests, the number of its request."""
    return np.repeat(np.arange(len(rows)), [len(x) // width for x in rows[column]])


def _tidied(work: Callable[..., pd.DataFrame], *frames: pd.DataFrame) -> pd.DataFrame:
    """What `work` gives; the worker keeps nothing of what it took, as the next stages run in the same workers."""
    try:
        return work(*frames)
    finally:
        return_freed_memory()


def _cut(text: bytes, gone: np.ndarray) -> bytes:
    """The text without the words that go; what is kept stays as it stood, runs are joined by a blank."""
    if not gone.any():
        return text
    runs, at, kept = [], 0, None
    for word, leaves in zip(text.split(), gone.tolist()):
        a = text.index(word, at)
        at = a + len(word)
        if leaves:
            if kept is not None:
                runs.append(text[kept[0]:kept[1]])
            kept = None
        else:
            kept = (kept[0] if kept else a, at)
    if kept is not None:
        runs.append(text[kept[0]:kept[1]])
    return b" ".join(runs)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by blanks), and with `with_text` the input text
    (before) and the text as it is kept (after). One row per row.

    A window of 20 words goes if its words also start at a smaller doc_id, or earlier in the same document; a word
    goes with any such window. Null texts have no words. Repeated rows have the same place, so neither
    is earlier than the other. Rows without doc_id have no place: they stay whole and are nobody's earlier copy.
    Other columns are ignored.
    """
    named = documents_of(docs)
    total = text_bytes(named)
    batches = buckets_for(total, BATCH_BYTES)
    buckets = buckets_for(total // 16, BUCKET_KEYS)  # a word with its blank has about six bytes; 4 of 13 are asked for
    placed = named.where("doc_id is not null").withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    kept_schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        kept_schema += ", before binary, after binary"

    def ask_anchors(rows: pd.DataFrame) -> pd.DataFrame:
        anchors, _ = Batch(rows).distinct_anchors()
        return _requests(spread_of(anchors, buckets), int(rows["batch"].iloc[0]), anchors)

    def answer_anchors(rows: pd.DataFrame) -> pd.DataFrame:
        keys, which = np.frombuffer(b"".join(rows["keys"]), np.uint64), _which(rows, "keys", 8)
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        shared = np.zeros(len(keys), bool)
        shared[order] = np.r_[False, same] | np.r_[same, False]
        ends = np.cumsum(np.bincount(which[shared], minlength=len(rows)))[:-1]
        found = [x.tobytes() for x in np.split(keys[shared], ends)]
        return pd.DataFrame({"batch": rows["batch"], "bucket": rows["bucket"], "anchors": found, "foreign": None})

    def ask_windows(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return _requests(np.zeros(0, np.int64), 0, np.zeros(0), np.zeros(0))
        batch = with_answers(rows, answers)
        return _requests(spread_of(batch.keys[:, 0], buckets), int(rows["batch"].iloc[0]), batch.keys, batch.first)

    def with_answers(rows: pd.DataFrame, answers: pd.DataFrame) -> Batch:
        batch = Batch(rows)
        batch.ask_windows(np.sort(np.frombuffer(b"".join(x for x in answers["anchors"] if x is not None), np.uint64)))
        return batch

    def answer_windows(rows: pd.DataFrame) -> pd.DataFrame:
        keys, which = np.frombuffer(b"".join(rows["keys"]), np.uint64).reshape(-1, 2), _which(rows, "keys", 16)
        docs_ = np.frombuffer(b"".join(rows["docs"]), np.int64)
        order = np.lexsort((docs_, keys[:, 1], keys[:, 0]))
        later = np.zeros(len(keys), bool)
        later[order[1:]] = (keys[order[1:]] == keys[order[:-1]]).all(axis=1)
        ends = np.cumsum(np.bincount(which, minlength=len(rows)))[:-1]
        found = [np.packbits(x).tobytes() for x in np.split(later, ends)]
        return pd.DataFrame({"batch": rows["batch"], "bucket": rows["bucket"], "anchors": None, "foreign": found})

    def keep(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return kept_rows([], [], [])
        batch = with_answers(rows, answers)
        bits = {b: x for b, x in zip(answers["bucket"], answers["foreign"]) if x is not None}
        foreign = np.zeros(len(batch.keys), bool)
        for b, x, y in slices_of(spread_of(batch.keys[:, 0], buckets)):
            foreign[x:y] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=y - x)
        return kept_rows(rows["doc_id"], rows["text"], batch.removed(foreign))

    def kept_rows(ids, texts, gone) -> pd.DataFrame:
        rows = []
        for doc_id, text, leaves in zip(ids, texts, gone):
            kept = b" ".join([w for w, x in zip(text.split(), leaves.tolist()) if not x]) if leaves.any() else b" ".join(text.split())
            row = [doc_id, len(leaves), int(leaves.sum()), hashlib.sha256(kept).hexdigest()]
            rows.append(row + [text, _cut(text, leaves)] * with_text)
        return pd.DataFrame(rows, columns=[c.split()[0] for c in kept_schema.split(", ")])

    def whole(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            yield kept_rows(rows["doc_id"], rows["text"], [np.zeros(len(t.split()), bool) for t in rows["text"]])

    answer_schema = "batch int, bucket int, anchors binary, foreign binary"
    by_batch = placed.groupBy("batch")
    anchors = (by_batch.applyInPandas(lambda rows: _tidied(ask_anchors, rows), "bucket int, batch int, keys binary")
               .groupBy("bucket").applyInPandas(lambda rows: _tidied(answer_anchors, rows), answer_schema))
    windows = (by_batch.cogroup(anchors.groupBy("batch")).applyInPandas(
                   lambda rows, answers: _tidied(ask_windows, rows, answers), "bucket int, batch int, keys binary, docs binary")
               .groupBy("bucket").applyInPandas(lambda rows: _tidied(answer_windows, rows), answer_schema))
    kept = by_batch.cogroup(anchors.unionAll(windows).groupBy("batch")).applyInPandas(
        lambda rows, answers: _tidied(keep, rows, answers), kept_schema)
    unnamed = named.where("doc_id is null").mapInPandas(whole, kept_schema)
    return kept.unionAll(unnamed)


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`, with text cut as `remove_repeats` says; a text that loses nothing stays as it is."""
    key, after = free_name(docs, "text_key"), free_name(docs, "after")
    changed = (remove_repeats(docs, with_text=True).where("n_removed > 0")
               .select("doc_id", F.xxhash64("before").alias(key), F.col("after").cast("string").alias(after))
               .dropDuplicates(["doc_id", key]))
    cut = docs.withColumn(key, F.xxhash64(utf8())).join(changed, ["doc_id", key], "left")
    return cut.withColumn("text", F.coalesce(F.col(after), F.col("text"))).select(*docs.columns)
