"""Personal data: fixed patterns, and boosted trees that judge candidates of generous generators.

The patterns' matches stay as they are. Generators propose overlapping spans of four kinds: addresses written with words
or brackets, sub-spans of runs of digits, dotted and colon-separated addresses. Trees per kind score a candidate by
its format and its surroundings; scores are calibrated on held-out documents, and a candidate counts from a calibrated probability
on. Of overlapping candidates those with the greatest sum of probabilities are selected.

The trees learn from a bounded sample of documents. What the patterns match there is personal data; so is the same written
another way in its place. Other cuts of it, numbers that fail their check, dates, versions and the like are not.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shelfmark.functions.udfs import once

from .boosting import Boosted, Calibration
from .common import utf8

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
TRAIN_DOCUMENTS = 1_500  # bound of the sample: documents with the smallest hashes
MATCHES = 16  # of a sampled document that are learnt from, drawn by its hash
FORMS = 8  # a document with fewer matches shows them again with other digits and names
PROBABILITY = 0.9
HELD_OUT = 4  # one of so many sampled documents calibrates
SIDE = 48  # bytes on each side that a candidate is judged by

# The patterns.
_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL_BACK = re.compile(rb"[A-Za-z0-9._%+-]+")
_IP = re.compile(rb"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a match never begins within a run of digits
_CARD = re.compile(rb"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")

_NOT_DIGITS = bytes(c for c in range(256) if not 48 <= c <= 57)


def digits_of(text: bytes) -> bytes:
    return text.translate(None, _NOT_DIGITS)


def luhn(digits: bytes) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d -= 48
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def is_valid(kind: int, value: bytes) -> bool:
    """Whether a match of a kind's pattern counts."""
    digits = digits_of(value)
    if kind == IP:
        return all(len(part.lstrip(b"0")) <= 3 and int(part) <= 255 for part in value.split(b"."))
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == EMAIL or 9 <= len(digits) <= 15


def _emails(text: bytes) -> Iterator[tuple[int, int]]:
    at, free = text.find(b"@"), 0
    while at >= 0:
        local, domain = _LOCAL_BACK.match(text[free:at][::-1]), _DOMAIN.match(text, at + 1)
        free = at + 1  # a local part holds no @
        if local and domain:
            yield at - local.end(), domain.end()
            free = domain.end()
        at = text.find(b"@", free)


def pattern_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind) in bytes, by start, then kind."""
    found = [(a, b, EMAIL) for a, b in _emails(text)] if b"@" in text else []
    if len(digits_of(text)) >= 4:
        for kind, pattern in ((IP, _IP), (CARD, _CARD), (PHONE, _PHONE)):
            found += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if is_valid(kind, m[0])]
    return sorted(found, key=lambda s: (s[0], s[2]))


_AT = re.compile(rb"@|\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20", re.I)
_ANY_LOCAL_BACK = re.compile(rb"""[^\s@<>()\[\]{},;:"'=|]{1,64}""")
_ANY_DOMAIN = re.compile(rb"[A-Za-z0-9\x80-\xff-]{1,63}(?:(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20dot\x20)"
                         rb"[A-Za-z0-9\x80-\xff-]{1,63}){1,4}", re.I)
_RUN = re.compile(rb"[0-9](?:[\x20().\-/]{0,3}[0-9]){6,}")
_GROUP = re.compile(rb"[0-9]+")
_QUAD = re.compile(rb"(?<![0-9])[0-9]{1,3}(?:\x20?(?:\.|[\[(]\x20?(?:\.|dot)\x20?[\])]|\x20dot\x20)\x20?[0-9]{1,3}){3}(?![0-9])", re.I)
_COLONS = re.compile(rb"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])")
GROUPS = 8  # no candidate has more groups of digits


def candidates(text: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind), overlapping: a number of them for each place of the text that does not depend on its length."""
    found = []
    for m in _AT.finditer(text):
        local = _ANY_LOCAL_BACK.match(text[max(0, m.start() - 64):m.start()][::-1])
        domain = local and _ANY_DOMAIN.match(text, m.end())
        if domain:
            found.append((m.start() - local.end(), domain.end(), EMAIL))
    if text.count(b":") >= 3:
        found += [(*m.span(), IP) for m in _COLONS.finditer(text)]
    if len(digits_of(text)) < 4:
        return found
    found += [(*m.span(), IP) for m in _QUAD.finditer(text)]
    for run in _RUN.finditer(text):
        groups = [m.span() for m in _GROUP.finditer(text, *run.span())]
        for k, (start, _) in enumerate(groups):
            starts = [start - 1, start] if text[start - 1:start] in (b"+", b"(") else [start]
            if text[max(0, start - 2):start] in (b"+(", b"(+"):
                starts = [start - 2]
            n = 0
            for a, b in groups[k:k + GROUPS]:
                n += b - a
                if n > 19:
                    break
                found += [(s, b, PHONE) for s in starts if 7 <= n <= 15]
                if n >= 12:
                    found.append((start, b, CARD))
    return found


# Words that tell what a number or address beside them is.
_CONTEXT = [re.compile(rb"(?<![a-z])(?:" + words + rb")(?![a-z])") for words in (
    rb"tel|telephone|phone|mobile|cell|call|fax|whatsapp|dial|ring|telefon|handy|portable|t\xc3\xa9l|m\xc3\xb3vil|llama|appelez",
    rb"e-?mail|mail|contact|write|reach|correo|courriel|schreib\w*",
    rb"ip|host|server|address|addr|client|login|adresse",
    rb"card|visa|mastercard|amex|credit|debit|carte|tarjeta|karte|kreditkarte|payment|paid",
    rb"version|v|isbn|issn|order|invoice|ref|no|nr|id|page|pages|article|total|date|year|serial|sku|build|release")]
_SIDES = {c: k for k, chars in enumerate((b" \t\n\r", b"+", b"(", b")", b"#$%", b".", b"-", b"/:", b"=", b",;\"'|"), 4) for c in chars}


def _side(byte: bytes) -> int:
    if not byte:
        return 0
    if byte.isdigit():
        return 1
    return 2 if byte.isalpha() or byte >= b"\x80" else _SIDES.get(byte[0], 3)


_DATE = re.compile(rb"(?:19|20)[0-9]{2}[-./ ]?[01]?[0-9][-./ ]?[0-3]?[0-9](?![0-9])|[0-3]?[0-9][-./ ][01]?[0-9][-./ ](?:19|20)[0-9]{2}(?![0-9])")


def features(text: bytes, start: int, end: int, kind: int) -> list[int]:
    """Of a candidate's format, then of its surroundings; each 0..31."""
    value, before, after = text[start:end], text[max(0, start - SIDE):start], text[end:end + SIDE]
    groups = [m.end() - m.start() for m in _GROUP.finditer(value)] or [0]
    digits, low = digits_of(value), value.lower()
    head, tail = before.lower(), after[:16].lower()
    dots = value.count(b".")
    quad = [int(g[-4:]) for g in _GROUP.findall(value)]
    at = value.rfind(b"@")
    domain = re.split(rb"\.|dot|[\])}]", low)[-1].strip()
    said = [int(bool(w.search(head)) or 2 * bool(w.search(tail))) for w in _CONTEXT]
    row = [
        len(digits), len(groups), max(groups), min(groups), groups[0], groups[-1], luhn(digits), set(groups) == {4},
        value[:1] == b"+", value.count(b"("), value.count(b"(") == value.count(b")"), value.count(b" "), dots, value.count(b"-"),
        value.count(b"/"), value.count(b":"), len({*value} & {*b" .-/()"}), len(set(digits)), digits[:1] == b"0",
        bool(_DATE.match(value)), all(q <= 255 for q in quad), sum(q <= 255 for q in quad), len(quad) == 4,
        b"dot" in low, b"[" in value or b"(" in value, 0 if at >= 0 else 1 + (b"at" in low) + (b" at " in low), len(domain),
        domain.isalpha(), min(at if at >= 0 else 31, 31), sum(c >= 128 for c in value), sum(65 <= c <= 90 for c in value),
        2 * (b"::" in value) + any(97 <= c <= 102 for c in low), len(value) // 2,
        _side(before[-1:]), _side(after[:1]), _side(before[-2:-1]), _side(after[1:2]), _side(after[2:3]),
        before[-1:] in b" .-()/" and before[-2:-1].isdigit(), after[:1] in b" .-()/" and after[1:2].isdigit(), *said]
    return [min(31, max(0, int(v))) for v in row]


N_FEATURES = len(features(b"1", 0, 1, PHONE))


def _name(draw: random.Random, most: int) -> bytes:
    return bytes(draw.choices(b"abcdefghijklmnoprstuvwz", k=draw.randint(1, most)))


def _another(kind: int, value: bytes, draw: random.Random) -> bytes:
    """A value of the same form; a card's with the right check digit."""
    if kind == EMAIL:
        return value
    if kind == IP:
        return b".".join(b"%d" % draw.randint(0, 255) for _ in range(4))
    digits = bytearray(draw.choices(b"0123456789", k=len(digits_of(value))))
    if kind == CARD:
        digits[-1] = next(d for d in b"0123456789" if luhn(bytes(digits[:-1]) + bytes([d])))
    given = iter(digits)
    return bytes(next(given) if 48 <= c <= 57 else c for c in value)


def _written_otherwise(kind: int, value: bytes, draw: random.Random) -> list[bytes]:
    """The same personal data in other forms."""
    parts = _GROUP.findall(value)
    if kind == EMAIL:
        local, _, host = value.partition(b"@")
        if draw.random() < 0.7:  # another person at another place
            local = draw.choice((b"%s.%s", b"%s_%s", b"%s%s")) % (_name(draw, 8), draw.choice((_name(draw, 9), b"", b"%d" % draw.randint(1, 99))))
            host = b".".join([_name(draw, 9), *[_name(draw, 7)] * draw.randint(0, 1), draw.choice((b"com", b"org", b"net", b"de", b"fr", b"es", b"info"))])
        at, dot = draw.choice(((b" [at] ", b" [dot] "), (b" at ", b" dot "), (b"(at)", b"(dot)"), (b" (at) ", b"."), (b"[at]", b"."),
                               (b" {at} ", b" {dot} "), (b"@", b" [dot] "), (b"[at]", b"[dot]")))
        return [local + at + host.replace(b".", dot), local[:2] + "éà"[draw.randint(0, 1)].encode() + b"@" + host]
    if kind == IP:
        colons = b"2001:db8:" + b":".join(b"%x" % (int(p[-3:]) * 251 + 4096) for p in parts[:4]) + draw.choice((b"", b"::1", b":0:1"))
        sign = draw.choice((b"[.]", b"(.)", b"[dot]", b" . ", b" dot "))
        return [sign.join(parts), colons]
    if kind == CARD:
        d, sign = b"".join(parts), draw.choice((b".", b" ", b"-", b"/", b"  "))
        return [sign.join(d[k:k + 4] for k in range(0, len(d), 4)), d]
    own = parts[1:] if value[:1] == b"+" and len(parts) > 2 and len(parts[0]) < 4 else parts
    d = b"".join(own)
    code, mid, rest = d[:3], d[3:6], d[6:]
    return [draw.choice((b"(%s) %s-%s", b"(%s)%s-%s", b"%s-%s-%s", b"%s.%s.%s", b"%s %s %s", b"00%s %s %s", b"%s/%s-%s")) % (code, mid, rest),
            draw.choice((b"+%s.%s.%s", b"+1/%s/%s/%s", b"+%s/%s %s", b"(+%s) %s-%s")) % (code, mid, rest)]


def _look_alikes(value: bytes, draw: random.Random) -> list[bytes]:
    """What stands in texts like personal data and is none."""
    n = draw.randint
    digits = digits_of(value).ljust(16, b"7")[:16]
    wrong = digits[:-1] + b"%d" % ((digits[-1] - 48 + n(1, 9)) % 10)
    wrong = wrong if not luhn(wrong) else digits[:-1] + b"%d" % ((wrong[-1] - 48 + 1) % 10)
    return [wrong, b" ".join(wrong[k:k + 4] for k in range(0, 16, 4)), b"%d-%02d-%02d" % (n(1900, 2099), n(1, 12), n(1, 28)),
            b"%02d/%02d/%d %02d" % (n(1, 28), n(1, 12), n(1900, 2099), n(0, 23)), b"%d%02d%02d%06d" % (n(1990, 2030), n(1, 12), n(1, 28), n(0, 235959)),
            b"%d.%d.%d.%d" % (n(256, 999), n(0, 999), n(256, 999), n(0, 99)), b"%d.%d.%d.%d.%d" % (n(0, 20), n(0, 30), n(0, 30), n(0, 30), n(0, 9)),
            b"version %d.%d.%d.%d" % (n(0, 20), n(0, 30), n(0, 30), n(0, 30)), b"order %d" % n(10 ** 7, 10 ** 11), b"%d %03d %03d" % (n(1, 999), n(0, 999), n(0, 999)),
            b"ISBN 978-%d-%d-%d-%d" % (n(1, 9), n(10, 99), n(10 ** 5, 10 ** 6 - 1), n(0, 9)), b"%02d:%02d:%02d:%02d" % (n(0, 23), n(0, 59), n(0, 59), n(0, 99)),
            b"see at page dot one", b"met at %s.com today" % draw.choice((b"shop", b"news", b"site")), b"the shop at home. Then",
            b"@%s" % draw.choice((b"someone", b"team")), b"%x:%x:%x:%x:%x:%x" % tuple(n(16, 255) for _ in range(6)),
            b"%d.%d, %d.%d, %d.%d" % tuple(n(0, 999) for _ in range(6)), b"%d-%d" % (n(1000, 9999), n(1000, 9999))]


_SAID = ((b"mail ", b"contact: "), (b"host ", b"ip: "), (b"card ", b"paid by visa "), (b"call ", b"tel. ", b"phone: "))


def training_rows(text: bytes) -> Iterator[tuple[int, list[int], int]]:
    """(kind, features, label) of candidates in and around a text's matches."""
    draw = random.Random(zlib.crc32(text))
    matches = pattern_spans(text)
    others = [c for c in candidates(text) if not any(a < c[1] and c[0] < b for a, b, _ in matches)]
    for start, end, kind in draw.sample(others, min(len(others), MATCHES)):
        value = text[start:end]
        if kind in (CARD, IP) and not is_valid(kind, value if kind == CARD else b".".join(_GROUP.findall(value)[:4]) or b"999"):
            yield kind, features(text, start, end, kind), 0
    drawn = draw.sample(matches, min(len(matches), MATCHES))
    for k, (start, end, kind) in enumerate(drawn * max(1, FORMS // max(1, len(drawn)))):
        value, left, right = text[start:end], text[max(0, start - SIDE):start], text[end:end + SIDE]
        if k >= len(drawn):
            value = _another(kind, value, draw)
        forms = [(v, 1) for v in (value, *_written_otherwise(kind, value, draw))]
        forms += [(v, 0) for v in draw.sample(_look_alikes(value, draw), 6)]
        for form, label in forms:
            said = draw.choice(_SAID[kind]) if label and draw.random() < 0.3 else b""
            beside = b" " + digits_of(value) + b" " if label and kind in (CARD, PHONE) and draw.random() < 0.3 else b""
            near = left + said + form + beside + right
            first, last = len(left + said), len(left + said + form)
            for a, b, of in candidates(near):
                if a < last and first < b:
                    yield of, features(near, a, b, of), int(label and (a, b, of) == (first, last, kind))


class Judge:
    """Trees and calibration of one kind."""

    def __init__(self, x: np.ndarray, y: np.ndarray, held: np.ndarray):
        self.trees = Boosted.fit(x[~held], y[~held])
        self.calibration = Calibration(self.trees.scores(x[held]), y[held])

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.calibration.probability(self.trees.scores(x))


Model = dict[int, Judge]


def learn(kinds: np.ndarray, x: np.ndarray, y: np.ndarray, held: np.ndarray) -> Model:
    """A judge for each kind with examples of both labels in both parts."""
    model = {}
    for kind in range(len(KINDS)):
        own = kinds == kind
        if all(len(set(y[own & part].tolist())) == 2 for part in (held, ~held)):
            model[kind] = Judge(x[own], y[own], held[own])
    return model


def fit(docs: DataFrame, most: int = TRAIN_DOCUMENTS) -> Model:
    """The judges, learnt from at most `most` documents: those with the smallest hashes of id and text that hold an @ or ten digits
    and signs in a row, which all patterns need or nearly need. Empty where nothing was matched."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    likely = docs.where(text.contains("@") | text.rlike("[0-9][ .()0-9-]{6}"))
    drawn = F.xxhash64(F.col("doc_id").cast("long"), text, F.lit(12))
    least = likely.select(drawn.alias("h")).orderBy("h").limit(most).agg(F.max("h")).first()[0]
    sample = likely.where(drawn <= F.lit(least).cast("long")).select(drawn.alias("h"), utf8().alias("text")).dropDuplicates(["h"])

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for h, text_ in zip(part["h"], part["text"]):
                found = list(training_rows(text_))
                yield pd.DataFrame({"kind": [bytes(k for k, _, _ in found)], "x": [bytes(v for _, x, _ in found for v in x)],
                                    "y": [bytes(y for _, _, y in found)], "held": [h % HELD_OUT == 0]})

    found = sample.mapInPandas(rows, "kind binary, x binary, y binary, held boolean").orderBy("x", "y", "kind").collect()
    if not found:
        return {}
    kinds, x, y = (np.frombuffer(b"".join(bytes(r[c]) for r in found), np.uint8) for c in ("kind", "x", "y"))
    return learn(kinds, x.reshape(-1, N_FEATURES), y, np.repeat([r["held"] for r in found], [len(r["y"]) for r in found]))


def select(spans: list[tuple[int, int, int]], probabilities: list[float]) -> list[tuple[int, int, int]]:
    """Spans without overlap with the greatest sum of probabilities; of equal sums the one with fewer, longer spans."""
    order = sorted(range(len(spans)), key=lambda k: (spans[k][1], spans[k][0], spans[k][2]))
    ends, best = [], [(0.0, 0, 0, None, None)]  # sum, minus spans, length, span, rest
    for k in order:
        start, end, _ = spans[k]
        rest = best[bisect_right(ends, start)]
        with_ = (rest[0] + probabilities[k], rest[1] - 1, rest[2] + end - start, k, rest)
        best.append(max(with_, best[-1], key=lambda b: (round(b[0], 9), b[1], b[2])))
        ends.append(end)
    chosen, at = [], best[-1]
    while at[4] is not None:
        chosen.append(spans[at[3]])
        at = at[4]
    return chosen[::-1]


def added_spans(texts: list[bytes], matches: list[list], model: Model, probability: float = PROBABILITY) -> list[list]:
    """For each text the selected spans that overlap none of its matches; the candidates of all texts are judged at once."""
    proposed = []
    for k, (text, base) in enumerate(zip(texts, matches)):
        starts = [a for a, _, _ in base]
        reach = np.maximum.accumulate([b for _, b, _ in base]).tolist() if base else []
        for a, b, kind in set(candidates(text)) if model else ():
            before = bisect_right(starts, b - 1)
            if kind in model and (not before or reach[before - 1] <= a):
                proposed.append((k, a, b, kind))
    proposed.sort()
    by_text: list[tuple[list, list]] = [([], []) for _ in texts]
    judged = np.zeros(len(proposed))
    x = np.array([features(texts[k], a, b, kind) for k, a, b, kind in proposed], np.uint8).reshape(-1, N_FEATURES)
    of = np.array([p[3] for p in proposed], int)
    for kind, judge in model.items():
        judged[of == kind] = judge.probability(x[of == kind])
    for (k, *span), p in zip(proposed, judged.tolist()):
        if p >= probability:
            by_text[k][0].append(tuple(span))
            by_text[k][1].append(p)
    return [select(spans, p) for spans, p in by_text]


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, b, kind in spans)


def _in_characters(text: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if not spans or text.isascii():
        return spans
    before = np.r_[0, np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)]
    return [(int(before[a]), int(before[b]), kind) for a, b, kind in spans]


def redact(text: bytes, spans: list[tuple[int, int, int]]) -> bytes:
    """The text with its kind in place of each span; of overlapping spans the first names the whole."""
    parts, at = [], 0
    for start, end, kind in sorted(spans):
        if start >= at:
            parts += [text[at:start], b"[%s]" % KINDS[kind].upper().encode()]
        at = max(at, end)
    return b"".join([*parts, text[at:]])


RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long, redacted string")


def _look(model: Model, probability: float):
    def look(texts: pd.Series) -> pd.DataFrame:
        given, rows = list(texts), []
        matches = [pattern_spans(t) for t in given]
        for text, base, added in zip(given, matches, added_spans(given, matches, model, probability)):
            both = sorted(base + added, key=lambda s: (s[0], s[2]))
            listed = _listed(_in_characters(text, base))
            rows.append((*(sum(kind == k for _, _, kind in base) for k in range(4)), hashlib.sha256(listed.encode()).hexdigest(),
                         _listed(_in_characters(text, both)), len(added), redact(text, both).decode("utf-8", "replace") if both else None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return once(F.pandas_udf(look, RESULT))(utf8())


def scan(docs: DataFrame, model: Model | None = None, probability: float = PROBABILITY) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (`kind:start:end`, code points), n_added, redacted; a row per row.

    Without `model` one is learnt from `docs` first. The counts and base_sha256 are the patterns'; spans holds theirs and the
    n_added selected ones, which overlap none of theirs. redacted is null for texts without a span. A null text counts as
    empty. Null ids and repeated rows stay, other columns are ignored. Where the sample holds too few matches of a kind, only its
    pattern counts.
    """
    looked = _look(fit(docs) if model is None else model, probability)
    return docs.select("doc_id", looked.alias("s")).select("doc_id", "s.*")


def without_personal_data(docs: DataFrame, model: Model | None = None, probability: float = PROBABILITY) -> DataFrame:
    """All rows and columns of `docs`, with its kind in place of each span in text."""
    redacted = _look(fit(docs) if model is None else model, probability).getField("redacted")
    return docs.withColumn("text", F.coalesce(redacted, F.col("text")))
