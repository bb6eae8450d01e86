"""Secret scans: fixed patterns, and a conditional random field that finds what looks and stands like their matches.

The field tags words as begin of a secret, inside or outside. Features are the word's shape (letters, digits and
other characters, not their identity), whether it names a secret, the same of the words beside it, and
features of the whole file. It learns from words the patterns match in a bounded sample of documents;
its spans are added where no pattern matched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.udfs import once

from .common import bounded_sample, utf8
from .crf import BEGIN, INSIDE, Crf
from .tokens import WordTable

KINDS = ("assign", "access", "hex", "learned")
TRAIN_DOCUMENTS = 1_500  # bound of the labelled sample: documents with the smallest hashes of their ids
AROUND = 8  # words on each side of a matched one that the field learns from
PLACEHOLDER = "[SECRET]"

# The patterns.
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{32,}")  # whole runs: a shorter one fails anyway
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_HEX_ONLY = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_SHAPE = bytes(97 if 97 <= c <= 122 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 128 if c >= 128 else c
               for c in range(256))
_NAMED = b"\x01"  # put before the shape of a word that holds one of the names


def pattern_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes, by start, then kind."""
    found = []
    small = text.lower()
    if any(name in small for name in _NAMES):
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"x" * 32 in text.translate(_HEX_ONLY):
        found += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def shape_features(shape: bytes) -> np.ndarray:
    named = shape.startswith(_NAMED)
    shape = shape[1:] if named else shape
    core = shape.strip(b"\"'`.,;:()[]{}<>")
    n, digits = len(core), core.count(b"0")
    letters = core.count(b"a") + core.count(b"A")
    alphabet = core.replace(b"a", b"A")
    switches = alphabet.count(b"0A") + alphabet.count(b"A0")
    upper = core.count(b"A")
    return np.array([
        1, *(low <= n <= high for low, high in ((0, 3), (4, 7), (8, 11), (12, 15), (16, 19), (20, 31), (32, 63), (64, 10 ** 9))),
        digits > 0, digits > 0 and letters > 0, digits * 2 > n, n > 0 and digits == n, upper > 0, upper > 1 and upper + digits == n,
        *(low <= switches <= high for low, high in ((1, 1), (2, 3), (4, 7), (8, 10 ** 9))),
        n >= 16 and switches >= 3, 0 < upper < letters and digits > 0 and n >= 16, b"=" in core or b":" in core,
        shape[-1:] in (b"=", b":"), shape in (b"=", b":"), shape[:1] in (b'"', b"'", b"`"), b"/" in core, b"." in core, b"-" in core,
        b"_" in core, b"@" in core, b"\x80" in core, letters == n > 0, n == 0, named], np.float32)


N_SHAPE = len(shape_features(b"a"))
PLACES = (0, -1, -2, 1)  # the word itself, the two before it, the one after
N_FILE = 4
N_FEATURES = N_SHAPE * len(PLACES) + N_FILE
_OUTSIDE_TEXT = np.zeros(N_SHAPE, np.float32)


def file_features(text: bytes, names: bool) -> np.ndarray:
    signs = sum(text.count(c) for c in (b"=", b"{", b"}", b";"))
    digits = len(text.translate(_SHAPE)) - len(text.translate(_SHAPE).replace(b"0", b""))
    return np.array([names, signs * 50 > len(text), digits * 10 > len(text), len(text) > 10_000], np.float32)


def word_shapes(text: bytes) -> tuple[list[bytes], bool]:
    """The shape of each word, and whether any holds a name."""
    shapes = text.translate(_SHAPE).split()
    small = text.lower()
    named = any(name in small for name in _NAMES)
    if named:
        words = small.split()
        shapes = [_NAMED + s if any(n in w for n in _NAMES) else s for s, w in zip(shapes, words)]
    return shapes, named


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 byte of each word."""
    white = np.isin(np.frombuffer(b" " + text + b" ", np.uint8), np.frombuffer(b" \t\n\r\v\f", np.uint8))
    edges = np.diff(white.astype(np.int8))
    return np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)


def training_rows(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, labels) of the words around each match, or of the first words of a text without any.

    Matches come a second time without their names and file: a secret is to be known by its looks as well.
    """
    shapes, named = word_shapes(text)
    if not shapes:
        return
    starts, ends = word_places(text)
    labels = np.zeros(len(shapes), np.int64)
    for start, end, kind in pattern_spans(text):
        if kind == 0:  # the value, not the name before it
            start = max(start, end - len(_ASSIGN.match(text, start)[2]))
        words = np.flatnonzero((starts < end) & (ends > start))
        labels[words[:1]], labels[words[1:]] = BEGIN, INSIDE
    marked = np.flatnonzero(labels)
    file = file_features(text, named)
    for centre in marked.tolist() if len(marked) else [min(AROUND, len(shapes) - 1)]:
        at = np.arange(max(0, centre - AROUND), min(len(shapes), centre + AROUND + 1))
        near = shapes[at[0]:at[-1] + 1]
        beyond = [shapes[k] if 0 <= k < len(shapes) else None for k in (at[0] - 2, at[0] - 1, at[-1] + 1)]
        yield _beside(near, beyond, file), labels[at]
        if len(marked):
            bare = [s and s.lstrip(_NAMED) for s in beyond]
            yield _beside([s.lstrip(_NAMED) for s in near], bare, np.zeros_like(file)), labels[at]


def _beside(shapes: list[bytes], beyond: list[bytes | None], file: np.ndarray) -> np.ndarray:
    """Feature rows of words in a row; beyond: the shapes of the two words before them and of the one after."""
    run = [beyond[0], beyond[1], *shapes, beyond[2]]
    rows = np.stack([_OUTSIDE_TEXT if s is None else shape_features(s) for s in run])
    columns = [rows[2 + d:2 + d + len(shapes)] for d in PLACES]
    return np.hstack([*columns, np.tile(file, (len(shapes), 1))])


def fit(docs: DataFrame, most: int = TRAIN_DOCUMENTS) -> Crf | None:
    """The field, learnt from at most `most` documents; None if none of them holds a match.

    Two thirds of them hold a name or the begin of an access key, the others are any; each the smallest by a hash.
    """
    chosen = docs.select("doc_id", utf8().alias("text"))
    small = F.lower(F.col("text").cast("string"))
    likely = F.lit(False)
    for name in _NAMES:
        likely = likely | small.contains(name.decode())
    likely = likely | F.col("text").cast("string").contains("AKIA")
    sample = bounded_sample(chosen.where(likely), most * 2 // 3, 7).unionAll(bounded_sample(chosen, most // 3, 7))

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for text in part["text"]:
                for features, labels in training_rows(text):
                    yield pd.DataFrame({"x": [np.packbits(features > 0).tobytes()], "y": [labels.astype(np.int8).tobytes()]})

    # Sequences of a few words each: some hundred bytes for each sampled match.
    found = sample.select("text").mapInPandas(rows, "x binary, y binary").distinct().orderBy("y", "x").limit(2 * most).collect()
    return learn([(np.unpackbits(np.frombuffer(bytes(r["x"]), np.uint8))[:len(r["y"]) * N_FEATURES].reshape(-1, N_FEATURES),
                   np.frombuffer(bytes(r["y"]), np.int8)) for r in found])


def learn(sequences: list[tuple[np.ndarray, np.ndarray]]) -> Crf | None:
    if not any(labels.any() for _, labels in sequences):
        return None
    size = len(sequences), 2 * AROUND + 1
    x, y, present = np.zeros((*size, N_FEATURES), np.float32), np.zeros(size, np.int64), np.zeros(size, bool)
    for k, (features, labels) in enumerate(sequences):
        x[k, :len(labels)], y[k, :len(labels)], present[k, :len(labels)] = features, labels, True
    return Crf.fit(x, y, present)


class Scanner:
    """Finds the spans of one text after the other."""

    def __init__(self, model: Crf | None):
        self.model = model
        if model is not None:
            parts = np.split(model.weights[:N_SHAPE * len(PLACES)], len(PLACES))
            self.by_place, self.by_file = np.hstack(parts), model.weights[N_SHAPE * len(PLACES):]
            # The scores a shape gives to its own word and to those beside it.
            self.table = WordTable(lambda shapes: [(shape_features(s) @ self.by_place).tobytes() for s in shapes])

    def spans(self, text: bytes) -> list[tuple[int, int, int]]:
        """(start, end, kind) in bytes by start, then kind: of the patterns, then of the field where no pattern matched."""
        found = pattern_spans(text)
        return sorted(found + self._learned(text, found), key=lambda s: (s[0], s[2]))

    def _learned(self, text: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        shapes, named = word_shapes(text) if self.model else ([], False)
        if not shapes:
            return []
        given = np.frombuffer(b"".join(self.table.of(shapes)), np.float64).reshape(-1, len(PLACES), 3)
        scores = np.tile(file_features(text, named) @ self.by_file, (len(shapes), 1))
        for k, d in enumerate(PLACES):
            if d <= 0:
                scores[-d:] += given[:len(shapes) + d, k]
            else:
                scores[:-d] += given[d:, k]
        tags = self.model.decode(scores)
        if not tags.any():
            return []
        starts, ends = word_places(text)
        spans = []
        for k in np.flatnonzero(tags).tolist():
            word = text[starts[k]:ends[k]]
            core = word.strip(b"\"'`.,;:()[]{}<>")
            start = int(starts[k]) + word.find(core)
            if not core or any(a < start + len(core) and start < b for a, b, _ in found):
                continue
            if tags[k] == INSIDE and spans and spans[-1][3] == k - 1:
                spans[-1] = (spans[-1][0], start + len(core), 3, k)
            else:
                spans.append((start, start + len(core), 3, k))
        return [s[:3] for s in spans]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def _in_characters(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    before = np.r_[0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)]
    return [(int(before[a]), int(before[b]), kind) for a, b, kind in spans]


def redact(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text with each group of overlapping spans replaced by the placeholder."""
    parts, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            parts += [text[at:start], PLACEHOLDER.encode()]
        at = max(at, end)
    return b"".join([*parts, text[at:]])


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"


def _look(model: Crf | None):
    def look(texts: pd.Series) -> pd.DataFrame:
        scanner, rows = Scanner(model), []
        for text in texts:
            spans = scanner.spans(text)
            placed = _in_characters(text, spans)
            base = [s for s in placed if s[2] < 3]
            counts = [sum(kind == k for _, _, kind in base) for k in range(3)]
            rows.append((*counts, hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(placed),
                         redact(text, spans).decode("utf-8", "replace") if spans else None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return once(F.pandas_udf(look, RESULT))(utf8())


def scan(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (`kind:start:end`, code points), redacted; a row per row.

    Without `model` one is learnt from `docs` first. `redacted` is null for texts without a span. A null text counts as
    empty. Null ids and repeated rows stay, other columns are ignored. Where no sampled document holds a match nothing is
    learnt and only the patterns count.
    """
    looked = _look(model or fit(docs))
    return docs.select("doc_id", looked.alias("s")).select("doc_id", "s.*")


def without_secrets(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """All rows and columns of `docs`, with the placeholder for each span in text."""
    redacted = _look(model or fit(docs)).getField("redacted")
    return docs.withColumn("text", F.coalesce(redacted, F.col("text")))
