"""Quality rules: counts per document, and how far its distributions are from those of its language.

Two histograms, over character classes and over the language's common words, are compared with the language's
own by Jensen-Shannon distance. The references come from all documents of the language, and of no other. A histogram of few
words differs from any reference by chance; what a text of that length is expected to differ by is taken off first,
and short texts and small languages are not judged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shelfmark.functions.udfs import once
from shelfmark.scratch import staged

from .common import free_name, utf8

MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
COMMON_WORDS = 24
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.33, 0.185
REFERENCE_WORDS = 5_000  # a language of fewer words is no reference
BROADCAST_LANGUAGES = 1_000  # the references of so many languages travel to the documents, those with the most words
PART_WORDS = 200_000

# Classes of characters.
CLASSES = {
    "small": b"abcdefghijklmnopqrstuvwxyz", "capital": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789",
    "white": b" \t\n\r\v\f", "pause": b".,;:", "mark": b"!?", "symbol": b"#*$%&|<>",
}
_CLASS_OF = np.full(256, len(CLASSES))  # all other ASCII
for _k, _members in enumerate(CLASSES.values()):
    _CLASS_OF[list(_members)] = _k
_CLASS_OF[192:] = len(CLASSES) + 1  # first byte of another character
_CLASS_OF[128:192] = len(CLASSES) + 2  # its other bytes, not counted
N_CLASSES = len(CLASSES) + 2
_WHITE, _SYMBOL = list(CLASSES).index("white"), list(CLASSES).index("symbol")


def class_counts(text: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    return np.bincount(_CLASS_OF, by_byte, N_CLASSES + 1)[:N_CLASSES].astype(np.int64)


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows found twice or more, the first time included."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    word = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = np.unique(word[:-1] * len(ids) + word[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(ids) + word[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(words) - 2 + k] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray, chance: bool) -> float:
    """Jensen-Shannon distance (base 2) of two histograms; with `chance`, less what counts this small differ by."""
    if not p.sum() or not q.sum():
        return 0.0
    n, m = p.sum(), q.sum()
    p, q = p / n, q / m
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        divergence = sum(np.nansum(a * np.log2(a / middle)) for a in (p, q)) / 2
    if chance:  # 8 ln 2 n times the divergence of a sample is about chi-squared: its mean and one standard deviation
        degrees = len(p) - 1
        divergence -= (degrees + np.sqrt(2 * degrees)) / (8 * np.log(2)) * (1 / n + 1 / m)
    return float(np.sqrt(max(divergence, 0.0)))


def language_counts(docs: DataFrame) -> DataFrame:
    """lang, word (null for character classes), classes (null for words), n: sums over all documents."""
    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}
        classes: dict[str, np.ndarray] = {}

        def taken() -> Iterator[pd.DataFrame]:
            for lang, counted in words.items():
                yield pd.DataFrame({"lang": lang, "word": list(counted), "class": -1, "n": list(counted.values())})
            for lang, counted in classes.items():
                yield pd.DataFrame({"lang": lang, "word": None, "class": range(N_CLASSES), "n": counted})
            words.clear()
            classes.clear()

        held = 0
        for part in parts:
            for lang, text in zip(part["lang"], part["text"]):
                counted = words.setdefault(lang, Counter())
                held -= len(counted)
                counted.update(text.lower().split())
                held += len(counted)
                classes[lang] = classes.get(lang, 0) + class_counts(text)
                if held > PART_WORDS:
                    yield from taken()
                    held = 0
        yield from taken()

    parts = docs.mapInPandas(count, "lang string, word binary, class int, n long")
    return parts.groupBy("lang", "word", "class").agg(F.sum("n").alias("n"))


def references(docs: DataFrame) -> DataFrame:
    """lang, total, reference: of each language with enough words its common words and both histograms, packed; a written table."""
    counts = language_counts(docs)
    # Per language: words in all, and the most common ones (ties by bytes).
    words = counts.where("class < 0")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total")).where(F.col("total") >= REFERENCE_WORDS)
    common = words.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= COMMON_WORDS)
    classes = counts.where("class >= 0").groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("class", "n"))).alias("classes"))
    top = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "word", "n"))).alias("common"))

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            packed = []
            for total, best, of_class in zip(part["total"], part["common"], part["classes"]):
                counted = [c["n"] for c in best]
                lines = [b" ".join(bytes(c["word"]) for c in best)]  # words hold no white space
                for numbers in ([*counted, total - sum(counted)], [c["n"] for c in of_class]):
                    lines.append(" ".join(map(str, numbers)).encode())
                packed.append(b"\n".join(lines))
            yield pd.DataFrame({"lang": part["lang"], "total": part["total"], "reference": packed})

    return staged(totals.join(top, "lang").join(classes, "lang").mapInPandas(pack, "lang string, total long, reference binary"))


def unpacked(reference: bytes) -> tuple[dict[bytes, int], np.ndarray, np.ndarray]:
    words, common, classes = reference.split(b"\n")
    return {w: k for k, w in enumerate(words.split())}, np.array(common.split(), float), np.array(classes.split(), float)


def with_references(docs: DataFrame, name: str) -> DataFrame:
    """All rows and columns of `docs` and, as `name`, the reference of the row's language, null without one.

    The languages with the most words are broadcast. Where there are more, the documents of the others meet theirs by
    language; each of these has under a thousandth of all words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(""))
    known = references(docs.select(lang.alias("lang"), utf8().alias("text")))
    key = free_name(docs, "reference_lang")
    known = known.select(F.col("lang").alias(key), "total", F.col("reference").alias(name))
    keyed = docs.withColumn(key, lang)
    if known.count() <= BROADCAST_LANGUAGES:
        return keyed.join(F.broadcast(known.drop("total")), key, "left").drop(key)
    most = staged(known.orderBy(F.desc("total"), key).limit(BROADCAST_LANGUAGES).drop("total"))
    others = known.drop("total").join(F.broadcast(most.select(key)), key, "left_anti")
    rest = keyed.join(F.broadcast(most.select(key)), key, "left_anti").join(others, key, "left")
    return keyed.join(F.broadcast(most), key).unionByName(rest).drop(key)


def distances(reference: tuple | None, words: list[bytes], classes: np.ndarray) -> tuple[float, float]:
    """Of a text's character classes and of its words; zero without a reference."""
    if reference is None or len(words) < MIN_WORDS:
        return 0.0, 0.0
    bins, common, of_classes = reference
    other = len(bins)
    found = np.bincount([bins.get(w, other) for w in words], minlength=other + 1)
    return distance(classes, of_classes, False), distance(found, common, True)


RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
          "class_distance double, word_distance double, kept boolean")


def _judged(docs: DataFrame, name: str) -> DataFrame:
    """`docs` with the RESULT struct of each row as `name`. The references need a pass over all texts first."""
    def judge(texts: pd.Series, references: pd.Series) -> pd.DataFrame:
        rows, known = [], {None: None}
        for text, packed in zip(texts, references):
            if packed not in known:
                known[packed] = unpacked(packed)
            words, classes = text.split(), class_counts(text)
            repeated = repeated_words(words)
            failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
            of_classes, of_words = distances(known[packed], text.lower().split(), classes)
            like = of_classes <= MAX_CLASS_DISTANCE and of_words <= MAX_WORD_DISTANCE
            rows.append((len(words), int(classes.sum() - classes[_WHITE]), int(classes[_SYMBOL]), repeated_lines(text),
                         repeated, failed, of_classes, of_words, like and not failed))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    judged = once(F.pandas_udf(judge, RESULT))(utf8(), F.col(name))
    return with_references(docs, name).withColumn(name, judged)


def quality(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, the two distances, kept.

    A null text has no words and fails; a null lang counts as a language of its own. Repeated rows stay, null
    doc_ids too; other columns are ignored. An empty table gives an empty one.
    """
    narrow = docs.select("doc_id", "lang", "text")
    return _judged(narrow, "q").select("doc_id", "q.*")


def passing(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns."""
    name = free_name(docs, "judged")
    return _judged(docs, name).where(F.col(name).getField("kept")).select(*docs.columns)
