"""Best-fit packing: documents into as few sequences of bounded length as possible.

Only the histogram of piece lengths, at most `capacity` numbers, reaches the driver. A configuration says how many
pieces of each length one sequence takes. The linear program wants the fewest sequences whose configurations cover every
length's count. It is solved by multiplicative weights: a length weighs more the less of it is covered; a knapsack by dynamic
programming finds what sequences are worth most under these weights, configurations worth about that much are taken, and the
weights change. Weights over the worth of the best sequence also bound the program from below. Amounts are rounded down;
then configurations with the largest remainders are taken once more, pieces that ran out replaced by others that fill the
sequence. What is left is filled longest first. Pieces then find their place by their rank among pieces of the same length.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from shelfmark.functions.udfs import once
from shelfmark.scratch import staged

from .common import documents_of, return_freed_memory
from .tokens import WordTable, once_per_worker, packed_ids, tokenizer_path

TOKENIZER, CAPACITY, END_ID = "word_bpe_49k.json", 4096, 1
PIECE = "piece int, start long, length int, ids_crc32 long"
TEXT_AT_ONCE = 2 << 20  # bytes of text encoded together: more would share more parts and hold more memory
PART_END = b"\xff" * 4  # no id
Pattern = tuple[tuple[int, int], ...]  # (length, how many), longest first


#: Latin letters and common punctuation: composed already, and their small letters are among them. Not 1C to 1F, which are white
#: space to Python's patterns alone.
_PLAIN = [chr(c) for c in (*range(0x1C), *range(0x20, 0x130), *range(0x131, 0x180), *range(0x2010, 0x2028), 0x20AC)]
_is_plain = re.compile(f"[{re.escape(''.join(_PLAIN))}]*").fullmatch


def _class(kind: str) -> str:
    return re.escape("".join(c for c in _PLAIN if unicodedata.category(c)[0] == kind))


class WordCoder:
    """Encodes as the tokenizer does, each distinct word once.

    The tokenizer composes characters, turns white space to blanks, makes small letters, cuts the text by a pattern and
    merges within what the pattern found. No match of the pattern holds white space, so texts are first cut there. Distinct parts
    of texts in Latin letters are cut here by the same pattern; those of others go through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        split, level = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        if (split["type"], split["invert"], level["type"]) != ("Split", True, "ByteLevel"):
            raise ValueError(f"{path}: not a tokenizer of words found by a pattern")
        pattern = split["pattern"]["Regex"].replace(r"\p{L}", _class("L")).replace(r"\p{N}", _class("N"))
        self.cut = re.compile(f"{pattern}|\n").findall
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): bytes_of.pre_tokenize_str(c)[0][0] for c in _PLAIN}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.parts = WordTable(self._words), WordTable(self._parts)

    def _words(self, words: list[str]) -> Iterator[bytes]:
        for word in words:
            yield PART_END if word == "\n" else packed_ids([t.id for t in self.tokenizer.model.tokenize(word.translate(self.letters))])

    def _parts(self, parts: list[bytes]) -> Iterator[bytes]:
        for coded in self.tokenizer.encode_batch([p.decode() for p in parts], add_special_tokens=False):
            yield packed_ids(coded.ids)

    def _plain_ids(self, texts: list[str]) -> list[bytes]:
        """Ids of texts in Latin letters: each distinct part is encoded once, then the parts are put in their places."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
        parts = split.flatten().dictionary_encode()
        one = pa.ListArray.from_arrays([0, len(parts.dictionary)], parts.dictionary)
        words = self.cut(pc.binary_join(one, "\n")[0].as_py() + "\n")
        ids = np.frombuffer(b"".join(self.words.of(words)), "<u4")
        ends = np.flatnonzero(ids == 0xFFFFFFFF).astype(np.int32)
        starts, which = np.r_[np.int32(0), ends + np.int32(1)][:-1], parts.indices.to_numpy()
        length = (ends - starts)[which]
        edges = np.r_[np.int32(0), np.cumsum(length, dtype=np.int32)]
        found = ids[np.repeat(starts[which] - edges[:-1], length) + np.arange(edges[-1], dtype=np.int32)]
        edges = edges[split.offsets.to_numpy()].tolist()
        return [found[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def ids_of(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        waiting, plain, size = [], [], 0  # for each text its ids, or None for the next one of `plain`

        def ready() -> Iterator[bytes]:
            coded = iter(self._plain_ids(plain))
            return (next(coded) if ids is None else ids for ids in waiting)

        for text in texts:
            letters = text.decode("utf-8", "replace")
            is_plain = _is_plain(letters) and not any(s in letters for s in self.special)
            waiting.append(None if is_plain else b"".join(self.parts.of(letters.encode().split())))
            if is_plain:
                plain.append(letters.lower())
            size += len(text)
            if size >= TEXT_AT_ONCE:
                yield from ready()
                waiting, plain, size = [], [], 0
        yield from ready()

    def ids(self, text: bytes) -> bytes:
        return next(self.ids_of([text]))


def token_pieces(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY, end_id: int = END_ID,
                 with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (binary): each document's ids and `end_id`, cut after every `capacity`.

    Without `with_ids` the ids stay in the worker that made them: the column is null.
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(texts: pd.Series) -> pd.Series:
        coder = once_per_worker(("words", tokenizer), lambda: WordCoder(tokenizer_path(tokenizer)))
        found = []
        for ids in coder.ids_of(texts):
            ids += end
            parts = [ids[i:i + 4 * capacity] for i in range(0, len(ids), 4 * capacity)]
            found.append([{"piece": k, "start": k * capacity, "length": len(p) // 4, "ids_crc32": zlib.crc32(p), "ids": p if with_ids else None}
                          for k, p in enumerate(parts)])
        return_freed_memory()
        return pd.Series(found)

    pieces = once(F.pandas_udf(cut, f"array<struct<{PIECE.replace(' ', ':').replace(',:', ',')},ids:binary>>"))
    return documents_of(docs).select("doc_id", F.explode(pieces("text")).alias("p")).select("doc_id", "p.*")


def knapsack(worth: np.ndarray) -> np.ndarray:
    """The most a sequence of each capacity can be worth.

    worth[s]: of one piece of length s, -inf where there is none. Pieces may be taken again and again.
    """
    best = np.zeros(len(worth))
    for c in range(1, len(worth)):
        best[c] = max(best[c - 1], (best[:c][::-1] + worth[1:c + 1]).max())
    return best


def _filled(first: int, best: np.ndarray, worth: np.ndarray, lengths: np.ndarray) -> Pattern:
    """The configuration worth most with a piece of length `first` and others of `lengths`; of equal ones the longer piece."""
    free, counts = len(best) - 1 - first, {first: 1}
    while True:
        fitting = lengths[:np.searchsorted(lengths, free, "right")]
        if not len(fitting):
            return tuple(sorted(counts.items(), reverse=True))
        s = int(fitting[(best[free - fitting] + worth[fitting] + 1e-9 * fitting).argmax()])
        counts[s] = counts.get(s, 0) + 1
        free -= s


def fractional(counts: np.ndarray, rounds: int = 12, step: float = 0.5, rate: float = 2.0, near: float = 0.98) -> tuple[dict[Pattern, float], float]:
    """Amounts of configurations that cover `counts` (by length) exactly, and a lower bound on the sum of any such amounts.

    A round takes at most the share `step` of what is left of a length, in configurations worth at least the share
    `near` of the best one; the last round takes all that is left.
    """
    capacity, lengths = len(counts) - 1, np.flatnonzero(counts)
    left, amounts, bound = counts.astype(float), {}, 0.0
    for k in range(rounds):
        share = left[lengths] / counts[lengths]
        open_ = lengths[share > 0]
        if not len(open_):
            break
        # log of the weight: rate * (share not yet covered); a full sequence is worth about the same everywhere
        worth = np.full(capacity + 1, -np.inf)
        worth[open_] = open_ / capacity * np.exp(rate * (share[share > 0] - share.max()))
        best = knapsack(worth)
        bound = max(bound, float((counts[open_] * worth[open_]).sum() / best[capacity]))
        last = k == rounds - 1
        allowed = left if last else left * step
        if not last:
            left = left - allowed
        for first in open_[::-1].tolist():
            while allowed[first] > 0:
                pattern = _filled(first, best, worth, open_[allowed[open_] > 0])
                if not last and sum(worth[s] * n for s, n in pattern) < near * best[capacity]:
                    break
                amount = min(allowed[s] / n for s, n in pattern)
                for s, n in pattern:
                    allowed[s] = max(0.0, allowed[s] - amount * n)
                    if allowed[s] < 1e-9:
                        allowed[s] = 0.0
                amounts[pattern] = amounts.get(pattern, 0.0) + amount
        if not last:
            left = left + allowed
    return amounts, bound


def _refilled(pattern: Pattern, left: np.ndarray) -> tuple[Pattern, int]:
    """`pattern` with what there is of its pieces, the gap filled by others, exactly if one or two do; and the tokens free."""
    counts = {s: min(n, int(left[s])) for s, n in pattern if left[s]}
    rest, free = left.copy(), len(left) - 1
    for s, n in counts.items():
        rest[s] -= n
        free -= s * n
    while free:
        lengths = np.flatnonzero(rest[:free + 1])
        if not len(lengths):
            break
        pairs = lengths[(rest[free - lengths] > 0) & ((2 * lengths != free) | (rest[lengths] > 1))]
        half = lengths[lengths <= free // 2]
        s = free if rest[free] else int((pairs if len(pairs) else half if len(half) else lengths)[-1])
        counts[s] = counts.get(s, 0) + 1
        rest[s] -= 1
        free -= s
    return tuple(sorted(counts.items(), reverse=True)), free


def rounded(amounts: dict[Pattern, float], counts: np.ndarray) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Whole numbers of configurations, none with more tokens free than the amounts leave on average; and the pieces left."""
    capacity, left, chosen = len(counts) - 1, counts.astype(np.int64).copy(), []
    slack = capacity - float((counts * np.arange(capacity + 1)).sum()) / max(sum(amounts.values()), 1e-9)

    def use(pattern: Pattern, times: int) -> None:
        for s, n in pattern:
            left[s] -= n * times
        chosen.append((pattern, times))

    by_fill = {p: a for p, a in amounts.items() if capacity - sum(s * n for s, n in p) <= slack}
    for pattern, amount in by_fill.items():
        times = min(int(amount + 1e-6), *(int(left[s]) // n for s, n in pattern))
        if times:
            use(pattern, times)
    for pattern, _ in sorted(amounts.items(), key=lambda x: -(x[1] % 1)):
        whole, free = _refilled(pattern, left)
        if whole and free <= slack:
            use(whole, 1)
    return chosen, left


def longest_first(left: np.ndarray) -> list[tuple[Pattern, int]]:
    """Fillings for all of `left`: the longest piece that fits, again and again; each as often as its pieces allow."""
    left, capacity, found = left.copy(), len(left) - 1, []
    lengths = np.flatnonzero(left)
    while len(lengths):
        free, counts, below = capacity, [], len(lengths)
        while below:
            k = int(np.searchsorted(lengths[:below], free, "right")) - 1
            if k < 0:
                break
            s = int(lengths[k])
            n = min(int(left[s]), free // s)
            counts.append((s, n))
            free, below = free - s * n, k
        times = min(int(left[s]) // n for s, n in counts)
        for s, n in counts:
            left[s] -= n * times
        found.append((tuple(counts), times))
        lengths = lengths[left[lengths] > 0]
    return found


def plan(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """Configurations and how often each is used; together they take every piece exactly once.

    Where longest first alone needs fewer sequences, which it can if few sequences can be full, its fillings are returned.
    """
    chosen, left = rounded(fractional(counts)[0], counts)
    chosen, plain = chosen + longest_first(left), longest_first(counts.astype(np.int64))
    return min(chosen, plain, key=lambda fillings: sum(times for _, times in fillings))


class Places:
    """Sequence and offset of the r-th piece of each length. Its size follows the plan, not the corpus."""

    def __init__(self, counts: np.ndarray, chosen: list[tuple[Pattern, int]]):
        self.first_of = np.r_[0, np.cumsum(counts)][:-1]
        rows, at, sequence = [], self.first_of.copy(), 0
        for pattern, times in chosen:
            offset = 0
            for s, n in pattern:
                rows.append((at[s], n, sequence, offset))
                at[s] += n * times
                offset += s * n
            sequence += times
        self.starts, self.each, self.sequence, self.offset = np.asarray(sorted(rows), np.int64).reshape(-1, 4).T
        self.n_sequences = sequence

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = self.first_of[length] + rank
        k = np.searchsorted(self.starts, place, "right") - 1
        within = place - self.starts[k]
        return self.sequence[k] + within // self.each[k], self.offset[k] + within % self.each[k] * length


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (doc_id, piece, length from 1 to `capacity`, and more) with sequence_id and offset.

    The input is read three times, so hand in a written table. Among pieces of one length the order is doc_id, piece;
    repeated rows each get a place of their own. An empty table gives an empty one.
    """
    histogram = pieces.groupBy("length").count().collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    places = Places(counts, plan(counts))

    # One length may hold any share of the pieces: rank within shards, then add the shards before.
    shards = max(1, int(counts.sum()) // 2048)
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    before = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sharded.groupBy("length", "shard").agg(F.count("*").alias("n"))
               .select("length", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    ranked = sharded.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "shard").orderBy("doc_id", "piece")).cast("long") - 1)
    ranked = ranked.join(offsets, ["length", "shard"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = once(F.pandas_udf(place, "sequence_id long, offset long"))
    return ranked.withColumn("place", placed("length", "rank")).select(*pieces.columns, "place.*")


def packed_documents(docs: DataFrame, tokenizer: str = TOKENIZER, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A null text counts as empty and is one piece of one token, the end id. Ids themselves are not shuffled;
    `sequences` gathers them. Null doc_ids stay null, other columns are ignored.
    """
    pieces = token_pieces(docs, tokenizer, capacity, with_ids=False).drop("ids")
    return pack(staged(pieces), capacity).withColumn("length", F.col("length").cast("long"))


def sequences(placed: DataFrame, ids: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the sequences written out. `ids` has doc_id, piece, ids of unrepeated documents."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` parts
    return (placed.join(ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
            .groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
            .select("sequence_id", "length", F.aggregate(
                "parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids")))
