"""Language-model scoring: a Katz backoff model of word pairs, learnt and applied in one Spark plan.

P(w|h) = d * c(hw) / c(h) for pairs seen in training, else backoff(h) * P(w); P(w) = d * c(w) / N for known
words, and what the discounts leave goes to one unknown word. d is the Good-Turing discount of a count up to five.
backoff(h) gives unseen pairs exactly what h's discounts leave, so every distribution sums to one. Where
discounts leave nothing, half a count is set apart.

Tables are partitioned by the hash of the first word. A task turns its documents, chunk by chunk, into postings: for each partition the
pairs of its words and the documents that hold them. A partition then asks the vocabulary, partitioned by word, for
its second words' counts, and has all it needs to evaluate its pairs: sums per document come back by
chunk. Texts are read once and never shuffled. Frequent first words would fill one partition: their pairs are dealt by both
words, pairs of two frequent words by chunk as well, and sums over them are made in a table of bounded size that all
partitions get. Which words these are comes from a sample; it changes where pairs go, not a result.

Words are known by 56-bit hashes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import bounded_sample, buckets_for, return_freed_memory, slices_of, spread_of, text_bytes, utf8

FOLDS, HELD_OUT = 5, 1
MAX_DISCOUNTED = 5
CHUNK_TOKENS = 1 << 20
CHUNK_DOCUMENTS = 1 << 16
BUCKET_BYTES = 8 << 20  # of text for each partition of the tables
FREQUENT_WORDS = 128  # at most so many, each with at least this share of all words
SAMPLE_DOCUMENTS = 2_000

_BITS = np.uint64((1 << 56) - 1)
# Hashes of what no word can be, as none holds white space.
BEGIN, END = (xxhash.xxh3_64_intdigest(mark) & int(_BITS) for mark in (b" ", b"\n"))

POSTINGS = ("bucket int, chunk long, n_docs int, train binary, heads binary, n_heads binary, words binary, n_words binary, "
            "docs binary, ids binary")
ANSWER = "bucket int, vbucket int, counts binary, stats array<long>"
SUMMARY = "kind int, h long, w long, count_w long, v array<long>"
SUMS = 6 + 6 + 2  # types seen 1..6 times of pairs and of words, training tokens, training types
N_VALUES = max(SUMS, 1 + 2 * (MAX_DISCOUNTED + 1))


def is_held_out(doc_id="doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def _hash(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), np.uint64, len(words)) & _BITS


def _seven(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _from_seven(data: bytes) -> np.ndarray:
    keys = np.zeros((len(data) // 7, 8), np.uint8)
    keys[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return keys.view("<u8").ravel()


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return spread_of(keys << np.uint64(8), n)


def _mixed(*keys: np.ndarray) -> np.ndarray:
    mix = np.zeros(1, np.uint64)
    for key in keys:
        mix = (mix ^ key) * np.uint64(0x9E3779B97F4A7C15)
        mix = mix ^ (mix >> np.uint64(29))
    return mix * np.uint64(0xBF58476D1CE4E5B9) & _BITS


def _among(keys: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Place of each key in the sorted `few`, or -1."""
    if not len(few):
        return np.full(len(keys), -1)
    at = np.minimum(np.searchsorted(few, keys), len(few) - 1)
    return np.where(few[at] == keys, at, -1)


class Chunk:
    """Documents of one task until there are enough tokens; then their postings."""

    def __init__(self):
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.begin, self.end = self.words[b" "], self.words[b"\n"]
        self.tokens, self.lengths, self.ids, self.nulls, self.train, self.first, self.size = [], [], [], [], [], None, 0

    def add(self, row: int, doc_id: int, unnamed: bool, train: bool, text: bytes) -> None:
        words = text.lower().split()
        self.tokens.append(np.fromiter(map(self.words.__getitem__, words), np.int32, len(words)))
        self.lengths.append(len(words) + 1)
        self.ids.append(doc_id)
        self.nulls.append(unnamed)
        self.train.append(train)
        self.first = row if self.first is None else self.first
        self.size += len(words) + 1

    def full(self) -> bool:
        return self.size >= CHUNK_TOKENS or len(self.ids) >= CHUNK_DOCUMENTS

    def postings(self, buckets: int, frequent: np.ndarray) -> pd.DataFrame:
        edge = np.array([self.end], np.int32)
        w = np.concatenate([x for t in self.tokens for x in (t, edge)]).astype(np.int64)
        ends = np.cumsum(self.lengths) - 1
        h = np.empty_like(w)
        h[1:] = w[:-1]
        h[np.r_[0, ends[:-1] + 1]] = self.begin
        doc = np.repeat(np.arange(len(self.ids)), self.lengths)
        hashes = _hash(list(self.words))
        hashes[[self.begin, self.end]] = BEGIN, END
        pairs, of = np.unique(h * len(hashes) + w, return_inverse=True)
        head, word = hashes[pairs // len(hashes)], hashes[pairs % len(hashes)]
        hot_h, hot_w = _among(head, frequent) >= 0, _among(word, frequent) >= 0
        dealt = np.where(hot_h, np.where(hot_w, _mixed(head, word, np.uint64([self.first])), _mixed(head, word)), _mixed(head))
        bucket = _bucket(dealt, buckets)
        order = np.lexsort((word, head, bucket))
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        place = place[of]
        docs = doc[np.argsort(place, kind="stable")].astype(np.uint16)
        n_words = np.bincount(place, minlength=len(order))
        bucket, head, word = bucket[order], head[order], word[order]
        until = np.cumsum(n_words)
        train = np.packbits(self.train).tobytes()
        ids = np.array(self.ids, np.int64).tobytes() + np.array(self.nulls, np.uint8).tobytes()
        rows = []
        for b, x, y in slices_of(bucket):
            starts = np.flatnonzero(np.r_[True, head[x + 1:y] != head[x:y - 1]])
            rows.append((b, self.first, len(self.ids), train, _seven(head[x:y][starts]),
                         np.diff(np.r_[starts, y - x]).astype(np.uint32).tobytes(), _seven(word[x:y]),
                         n_words[x:y].astype(np.uint32).tobytes(), docs[until[x] - n_words[x]:until[y - 1]].tobytes(),
                         b"" if rows else ids))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in POSTINGS.split(", ")])


class Table:
    """One partition: its pairs, their training counts, and the postings by chunk."""

    def __init__(self, rows: pd.DataFrame, pairs: bool = True):
        rows = rows.sort_values("chunk", kind="stable")
        self.rows = rows
        heads = np.concatenate([_from_seven(x) for x in rows["heads"]])
        n_heads = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["n_heads"]]).astype(np.int64)
        words = np.concatenate([_from_seven(x) for x in rows["words"]])
        self.n_words = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["n_words"]]).astype(np.int64)
        first = np.r_[0, np.cumsum(rows["n_docs"])]
        self.first = first
        self.docs = np.concatenate([np.frombuffer(x, np.uint16).astype(np.int64) + a for x, a in zip(rows["docs"], first)])
        train = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(rows["train"], rows["n_docs"])])
        starts = np.r_[0, np.cumsum(self.n_words)[:-1]]
        trained = np.add.reduceat(train[self.docs].astype(np.int64), starts)
        self.words, word = np.unique(words, return_inverse=True)
        self.word_counts = np.bincount(word, trained, len(self.words)).astype(np.int64)
        if pairs:
            self.heads, head = np.unique(heads, return_inverse=True)
            key, self.pair = np.unique(np.repeat(head, n_heads) * len(self.words) + word, return_inverse=True)
            self.head, self.word = key // len(self.words), key % len(self.words)
            self.counts = np.bincount(self.pair, trained, len(key)).astype(np.int64)

    def answered(self, answers: pd.DataFrame) -> np.ndarray:
        """Training counts in all partitions of `words`."""
        answers = answers[answers["vbucket"] >= 0].sort_values("vbucket")
        return np.frombuffer(b"".join(answers["counts"]), np.uint32).astype(np.int64)


def _histogram(counts: np.ndarray) -> np.ndarray:
    """How many counts are 1, 2, ... 6."""
    return np.bincount(counts[(counts > 0) & (counts <= 6)], minlength=7)[1:]


def _spread_counts(counts: np.ndarray) -> list[int]:
    """How many are 1..5, and the sum of the larger: all that is needed to sum discounted counts."""
    return [*_histogram(counts)[:MAX_DISCOUNTED].tolist(), int(counts[counts > MAX_DISCOUNTED].sum())]


def discounts(seen: np.ndarray) -> np.ndarray:
    """Good-Turing discount of counts 0..5, by how many types are seen 1..6 times; half a count where it is undefined."""
    k, d = MAX_DISCOUNTED, np.ones(MAX_DISCOUNTED + 1)
    cut = (k + 1) * seen[k] / seen[0] if seen[0] else 1.0
    for r in range(1, k + 1):
        value = ((r + 1) * seen[r] / (r * seen[r - 1]) - cut) / (1 - cut) if seen[r - 1] and cut < 1 else 0.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= MAX_DISCOUNTED, d[np.minimum(counts, MAX_DISCOUNTED)], 1.0)


def _sum_of(spread: np.ndarray, d: np.ndarray) -> float:
    r = np.arange(1, MAX_DISCOUNTED + 1)
    return float((spread[:-1] * r * d[1:]).sum() + spread[-1])


class Model:
    """What all partitions share: discounts, totals, and the sums over pairs with a frequent first word."""

    def __init__(self, summary: list, frequent: np.ndarray):
        values = {(s["kind"], s["h"], s["w"]): (s["count_w"], np.array(s["v"], np.int64)) for s in summary}
        sums = values.get((0, 0, 0), (0, np.zeros(N_VALUES, np.int64)))[1]
        pairs = [(h, w, c, v[0]) for (kind, h, w), (c, v) in values.items() if kind == 1 and v[0] > 0]
        self.frequent = frequent
        self.tokens, self.types = int(sums[12]), int(sums[13])
        self.d_words = discounts(sums[6:12])
        self.d_pairs = discounts(sums[:6] + _histogram(np.array([p[3] for p in pairs], np.int64)))
        low = sums[6:11]
        total = _sum_of(np.r_[low, self.tokens - (low * np.arange(1, 6)).sum()], self.d_words)
        self.apart = 0.0 if total < self.tokens else 0.5
        self.unknown = (self.tokens + self.apart - total) / (self.tokens + self.apart)
        # Frequent first words: count, sum of discounted counts, sum of P(w) of the words seen after them.
        self.hot = np.zeros((3, len(frequent)))
        self.hot_pairs = np.zeros((len(frequent), len(frequent)), np.int64)
        for (kind, h, _), (_, v) in values.items():
            if kind == 2:
                at = _among(np.array([h], np.uint64), frequent)[0]
                words = _sum_of(v[7:13], self.d_words) / (self.tokens + self.apart)
                self.hot[:, at] += v[0], _sum_of(v[1:7], self.d_pairs), words
        for h, w, count_w, c in pairs:
            a, b = _among(np.array([h, w], np.uint64), frequent)
            self.hot_pairs[a, b] = c
            self.hot[:, a] += c, discounted(np.array([c]), self.d_pairs)[0], self.word(np.array([count_w]))[0]

    def word(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by training count."""
        if not self.tokens:
            return np.ones(len(counts))
        return np.where(counts > 0, discounted(counts, self.d_words) / (self.tokens + self.apart), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.types + 1)))

    def pairs(self, table: Table, counts_w: np.ndarray) -> np.ndarray:
        """log10 P(w|h) of each pair of a partition."""
        p_word = self.word(counts_w)[table.word]
        hot_h = _among(table.heads, self.frequent)[table.head]
        hot_w = _among(table.words, self.frequent)[table.word]
        both = (hot_h >= 0) & (hot_w >= 0)
        counts = np.where(both, self.hot_pairs[hot_h, hot_w] if len(self.frequent) else 0, table.counts)
        kept, seen = discounted(counts, self.d_pairs), counts > 0
        sums = [np.bincount(table.head, x, len(table.heads))[table.head] for x in (counts, kept, np.where(seen, p_word, 0))]
        if len(self.frequent):
            sums = [np.where(hot_h >= 0, hot[hot_h], own) for hot, own in zip(self.hot, sums)]
        count_h, kept_h, words_h = sums
        apart = np.where(kept_h < count_h - 1e-9, 0.0, 0.5)
        with np.errstate(divide="ignore", invalid="ignore"):
            backoff = (count_h + apart - kept_h) / (count_h + apart) / (1 - words_h)
            p = np.where(seen, kept / (count_h + apart), np.where(count_h > 0, backoff, 1.0) * p_word)
        return np.log10(p)


def frequent_words(docs: DataFrame) -> np.ndarray:
    """Hashes of words with a large share of a bounded sample, and of the begin of a text, sorted."""
    sample = bounded_sample(docs, SAMPLE_DOCUMENTS, 5).select("text")

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counted = Counter()
        for part in parts:
            for text in part["text"]:
                counted.update(text.lower().split())
        least = counted.total() / FREQUENT_WORDS / 2
        common = [(w, n) for w, n in counted.items() if n >= least]
        yield pd.DataFrame({"word": [w for w, _ in common] + [None], "n": [n for _, n in common] + [counted.total()]})

    rows = sample.mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r["word"] and bytes(r["word"]): r["n"] for r in rows.orderBy(F.desc("n"), "word").limit(2 * FREQUENT_WORDS).collect()}
    total = found.pop(None, 0)
    words = [w for w, n in found.items() if n * FREQUENT_WORDS >= total][:FREQUENT_WORDS - 2]
    return np.unique(np.r_[_hash(words), np.array([BEGIN, END], np.uint64)])


def scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per row.

    Trained on documents whose crc32(doc_id as text) modulo 5 is not 1; a null doc_id counts as empty text there. A null
    text is empty: its one token is the end. Repeated rows train and are scored each time. Without training documents all
    words are the unknown one. Other columns are ignored.
    """
    spark = docs.sparkSession
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    frequent = frequent_words(chosen)
    buckets = buckets_for(text_bytes(chosen), BUCKET_BYTES)

    def post(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        chunk = Chunk()
        for part in parts:
            for row in part.itertuples(index=False):
                chunk.add(*row)
                if chunk.full():
                    yield chunk.postings(buckets, frequent)
                    chunk = Chunk()
                    return_freed_memory()
        if chunk.ids:
            yield chunk.postings(buckets, frequent)
        return_freed_memory()

    def ask(rows: pd.DataFrame) -> pd.DataFrame:
        return_freed_memory()
        table, bucket = Table(rows, pairs=False), int(rows["bucket"].iloc[0])
        asked = [(b, bucket, _seven(table.words[x:y]), table.word_counts[x:y].astype(np.uint32).tobytes())
                 for b, x, y in slices_of(_bucket(table.words, buckets))]
        return pd.DataFrame(asked, columns=["vbucket", "bucket", "words", "counts"])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        return_freed_memory()
        words, sizes = np.concatenate([_from_seven(x) for x in rows["words"]]), [len(x) // 7 for x in rows["words"]]
        own = np.concatenate([np.frombuffer(x, np.uint32) for x in rows["counts"]])
        distinct, of = np.unique(words, return_inverse=True)
        counts = np.bincount(of, own, len(distinct)).astype(np.int64)
        stats = [*_histogram(counts).tolist(), int(counts.sum()), int((counts > 0).sum())]
        found = np.split(counts[of].astype(np.uint32), np.cumsum(sizes)[:-1])
        return pd.DataFrame({"bucket": rows["bucket"], "vbucket": rows["vbucket"], "counts": [x.tobytes() for x in found],
                             "stats": [stats] + [[0] * 8] * (len(rows) - 1)})

    def summarise(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=[c.split()[0] for c in SUMMARY.split(", ")])
        return_freed_memory()
        table, out = Table(rows), []
        counts_w = table.answered(answers)
        hot_h = _among(table.heads, frequent)[table.head]
        hot_w = _among(table.words, frequent)[table.word]
        both = (hot_h >= 0) & (hot_w >= 0)
        totals = np.sum(list(answers["stats"]), axis=0)
        out.append((0, 0, 0, 0, [*_histogram(table.counts[~both]).tolist(), *totals.tolist()]))
        for p in np.flatnonzero(both & (table.counts > 0)).tolist():
            out.append((1, int(table.heads[table.head[p]]), int(table.words[table.word[p]]),
                        int(counts_w[table.word[p]]), [int(table.counts[p])]))
        for h in np.unique(hot_h[hot_h >= 0]).tolist():
            mine = (hot_h == h) & ~both & (table.counts > 0)
            out.append((2, int(frequent[h]), 0, 0, [int(table.counts[mine].sum()), *_spread_counts(table.counts[mine]),
                                                    *_spread_counts(counts_w[table.word[mine]])]))
        out = [(*o[:4], o[4] + [0] * (N_VALUES - len(o[4]))) for o in out]
        return pd.DataFrame(out, columns=[c.split()[0] for c in SUMMARY.split(", ")])

    partial = "chunk long, n_docs int, ids binary, tokens binary, known binary, base binary, score binary, train_tokens long"

    def evaluate(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in partial.split(", ")]
        if not len(rows):
            return pd.DataFrame([], columns=columns)
        return_freed_memory()
        model = Model(next(x for x in answers["summary"] if x is not None), frequent)
        table = Table(rows)
        counts_w = table.answered(answers)
        of_word = np.stack([counts_w > 0, model.base(counts_w)])[:, table.word]
        out, n = [], int(table.first[-1])
        sums = [np.bincount(table.docs, minlength=n).astype(np.uint32)]
        for value in (*of_word, model.pairs(table, counts_w)):
            sums.append(np.bincount(table.docs, np.repeat(value[table.pair], table.n_words), n))
        sums[1] = sums[1].astype(np.uint32)
        for row, a, b in zip(table.rows.itertuples(index=False), table.first, table.first[1:]):
            out.append((row.chunk, row.n_docs, row.ids, *(x[a:b].tobytes() for x in sums), model.tokens))
        return pd.DataFrame(out, columns=columns)

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n_docs"].iloc[0])
        ids = next(x for x in rows["ids"] if len(x))
        kinds = {"tokens": np.uint32, "known": np.uint32, "base": float, "score": float}
        sums = {k: np.sum([np.frombuffer(x, t) for x in rows[k]], axis=0) for k, t in kinds.items()}
        return pd.DataFrame({
            "doc_id": np.frombuffer(ids, np.int64, n), "unnamed": np.frombuffer(ids, np.uint8, n, 8 * n) > 0,
            "n_tokens": sums["tokens"].astype(np.int64), "n_known": sums["known"].astype(np.int64),
            "train_tokens": int(rows["train_tokens"].iloc[0]), "base_score": sums["base"], "score": sums["score"]})

    marked = chosen.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"),
        F.col("doc_id").isNull().alias("unnamed"), (~is_held_out()).alias("train"), "text")
    tables = marked.mapInPandas(post, POSTINGS).groupBy("bucket")
    answers = (tables.applyInPandas(ask, "vbucket int, bucket int, words binary, counts binary")
               .groupBy("vbucket").applyInPandas(answer, ANSWER))
    summary = (tables.cogroup(answers.groupBy("bucket")).applyInPandas(summarise, SUMMARY)
               .groupBy("kind", "h", "w").agg(F.max("count_w").alias("count_w"), F.array(
                   *(F.sum(F.col("v")[i]) for i in range(N_VALUES))).alias("v"))
               .agg(F.collect_list(F.struct("kind", "h", "w", "count_w", "v")).alias("summary")))  # FREQUENT_WORDS squared at most
    shared = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(F.broadcast(summary))
    told = answers.select("bucket", "vbucket", "counts").unionByName(
        shared.withColumn("vbucket", F.lit(-1)), allowMissingColumns=True)
    sums = tables.cogroup(told.groupBy("bucket")).applyInPandas(evaluate, partial)
    scored = sums.groupBy("chunk").applyInPandas(
        gather, "doc_id long, unnamed boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    scored = scored.withColumn("doc_id", F.when(~F.col("unnamed"), F.col("doc_id")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
